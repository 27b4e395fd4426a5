"""Near-duplicate documents by an LSH forest over MinHash signatures.

1. One pass makes each document's set of word shingles, its size and a
   signature of TREES x DEPTH minima. Documents with the same set are one class
   from here on; its representative has the smallest id.
2. The forest: every tree sorts all representatives by its own slice of the
   signature (one range-partitioned sort over all trees; a hot prefix is spread
   over partitions). Rows next to each other have the longest common prefix: those that
   share at least ``depth`` leading minima are candidates, as is each row with the
   centre (the row nearest to the commonest minima) of its run of at most
   ``block`` such rows.
3. Candidates are verified on the full shingle sets of their texts: first each
   document's most similar neighbour and centre. Links are contracted to components.
4. Regions (documents under one prefix of ``depth`` minima) that still hold
   several components are searched in full, if they have at most ``crowded``
   members. A larger one is replaced by its regions one minimum deeper, and these
   again, until they are small or the slice ends; what is crowded even then is
   searched in pairs of blocks, one a task. First signatures and sizes tell
   which members may be similar to one of another component; then these members'
   shingle sets (as 64-bit hashes) are compared within the same pair of blocks,
   each pair of documents in the first tree alone whose prefix it shares, and only links that join components leave the task
   (a tree of at most as many links as members), to be verified on full texts.

A pair at the threshold shares the prefix in some tree with probability
1 - (1 - s^depth)^trees: 0.99999 at s = 0.8 with 16 trees and depth 3. Where
every region that it shares is crowded and divided, it is 0.9998 at depth 4 and 0.998 at depth 5; neighbours
and centres, which do not depend on depth, still link most of these. The signature filter lies 4.5 standard
deviations below the threshold and compares a byte of each minimum, which passes no fewer pairs.

Edge cases: null, empty and white-space texts have the size 0 and link with
nothing; a text with fewer words than a shingle is one shingle; rows with a
null id have no component and are kept; rows that repeat an id are one node
with each of its texts; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from spindrift.llm.common import Stages, components, partitions

TREES, DEPTH = 16, 8
SIZE = TREES * DEPTH
_RNG = np.random.default_rng(20240229)
_MUL = (_RNG.integers(1, 1 << 32, SIZE, dtype="u8") | 1).astype("u4")
_ADD = _RNG.integers(0, 1 << 32, SIZE, dtype="u8").astype("u4")


def shingles(text: str | None, words: int) -> set[bytes]:
    """Distinct shingles of a text: A-Z lower-cased, words parted by ASCII white space."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return set()
    return {b" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))}


#: Bytes of text handled at a time, and of the longest words that are hashed together.
PART, LONG = 1 << 16, 64
_BLANK = np.isin(np.arange(256), np.frombuffer(b" \t\n\r\x0b\x0c", "u1"))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype="u8")
_BASE = 0x9E3779B97F4A7C15
_POWER, _INVERSE = (np.cumprod(np.concatenate([np.ones(1, "u8"), np.full(PART, x, "u8")])) for x in (_BASE, pow(_BASE, -1, 1 << 64)))


def _words(raw: bytes) -> np.ndarray:
    """Hashes of the words of at most PART bytes; long words are hashed one by one."""
    data = np.frombuffer(raw, "u1")
    edge = np.flatnonzero(np.diff(_BLANK[data], prepend=True, append=True))
    start, stop = edge[::2], edge[1::2]
    sums = np.concatenate([np.zeros(1, "u8"), np.cumsum(_BYTE[data] * _POWER[: len(data)])])
    h = (sums[stop] - sums[start]) * _INVERSE[start]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    for k in np.flatnonzero(stop - start > LONG).tolist():
        h[k] = xxh3_64_intdigest(raw[start[k] : stop[k]])
    return h


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text, however long text and words are."""
    if len(raw) <= PART:
        return _words(raw)
    out, at, size = [], 0, len(raw)
    while at < size:
        end = min(size, at + PART)
        while end < size and end > at and not _BLANK[raw[end]]:
            end -= 1
        if end > at:
            out.append(_words(raw[at:end]))
        else:  # a word longer than a part
            rest = raw[at:].lstrip()
            word = rest.split(None, 1)[0] if rest else b""
            end = size - len(rest) + len(word)
            out.append(np.array([xxh3_64_intdigest(word)] if word else [], "u8"))
        at = end
    return np.concatenate(out)


class Hasher:
    """64-bit hashes of the shingles of a text, made of those of its words."""

    def __init__(self, words: int):
        self.words = words

    def __call__(self, text: str | None) -> np.ndarray:
        h = word_hashes((text or "").encode("utf-8", "surrogatepass").lower())
        if not len(h):
            return np.empty(0, "u8")
        n = max(1, len(h) - self.words + 1)
        out = np.zeros(n, "u8")
        for i in range(min(self.words, len(h))):
            out = (out + h[i : i + n]) * np.uint64(0x9E3779B97F4A7C15 + 2 * i)
            out ^= out >> np.uint64(29)
        if len(h) < self.words:
            out += np.uint64(len(h))
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out.sort()
        return out[np.concatenate([[True], out[1:] != out[:-1]])]


def signature(hashes: np.ndarray) -> np.ndarray:
    low = np.full(SIZE, 0xFFFFFFFF, "u4")
    h = (hashes >> np.uint64(32)).astype("u4")
    for a in range(0, len(h), 2048):
        x = h[a : a + 2048, None] * _MUL + _ADD
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        np.minimum(low, x.min(0), out=low)
    return low


def _sign(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(words)
        for batch in batches:
            size, key, sig, low = [], [], [], []
            for text in batch.column(1).to_pylist():
                h = hasher(text)
                size.append(len(h))
                key.append(blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None)
                minima = signature(h)
                sig.append(minima.astype(">u4").tobytes() if len(h) else None)
                low.append(minima.astype("u1").tobytes() if len(h) else None)
            yield pa.record_batch({"doc_id": batch.column(0), "n_shingles": pa.array(size, pa.int64()), **{k: pa.array(v, pa.binary()) for k, v in (("key", key), ("sig", sig), ("low", low))}})

    return run


def _verify(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, set()
        for batch in batches:
            ok = []
            for s, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if s is not last and s != last:
                    last, own = s, shingles(s, words)
                other = shingles(t, words)
                both = len(own & other)
                ok.append(100 * both >= percent * (len(own) + len(other) - both))
            yield pa.record_batch({"a": batch.column(0), "b": batch.column(1), "ok": pa.array(ok, pa.bool_())})

    return run


_W = DEPTH * 4
_PASS = "kind int, a long, b long, same int, centre boolean, k binary"
PAIR, MEMBER, END = 0, 1, 2
#: Ids (8 bytes each) up to which a list of them is broadcast instead of shuffling all texts.
FEW = 1_000_000


def _rows(kind: int, a, b=None, same=None, centre=None, k=None) -> pa.RecordBatch:
    n = len(a)
    cols = [pa.array(np.full(n, kind, "i4")), pa.array(a, pa.int64())]
    cols += [pa.nulls(n, t) if x is None else pa.array(x, t) for x, t in ((b, pa.int64()), (same, pa.int32()), (centre, pa.bool_()), (k, pa.binary()))]
    return pa.RecordBatch.from_arrays(cols, ["kind", "a", "b", "same", "centre", "k"])


def _centre(low: np.ndarray, ids: np.ndarray) -> int:
    """The row nearest to the commonest minima, of equal ones that with the least id."""
    order = np.sort(low, axis=0)
    place = np.arange(len(order))[:, None]
    start = np.maximum.accumulate(np.where(np.vstack([np.ones((1, low.shape[1]), bool), order[1:] != order[:-1]]), place, 0), axis=0)
    common = order[(place - start).argmax(0), np.arange(low.shape[1])]
    return int(np.lexsort((ids, -(low == common).sum(1)))[0])


class _Sorted:
    """Candidates and members of regions among the rows ``k (tree, slice), id, n, low`` of one partition, in order of k and id.

    A run (rows that share tree and ``depth`` minima) is cut into blocks; blocks of one run are chained by their neighbouring rows and by their centres.
    """

    def __init__(self, depth: int, least: int, percent: int, block: int):
        self.head, self.least, self.percent, self.block = 1 + 4 * depth, least, percent, block
        self.last: tuple | None = None  # the last row (k, id, n, low) of the block before, and its centre

    def pairs(self, rows: tuple, x: np.ndarray, y: np.ndarray, centre: bool) -> pa.RecordBatch:
        _, ids, n, low = rows
        same = (low[x] == low[y]).sum(1)
        fit = (same >= self.least) & (100 * np.minimum(n[x], n[y]) >= self.percent * np.maximum(n[x], n[y])) & (ids[x] != ids[y])
        x, y, same = x[fit], y[fit], same[fit]
        return _rows(PAIR, np.minimum(ids[x], ids[y]), np.maximum(ids[x], ids[y]), same.astype("i4"), np.full(len(x), centre))

    def process(self, rows: tuple, final: bool) -> Iterator[pa.RecordBatch]:
        k, ids, n, low = rows
        head = k[:, : self.head]
        new = np.concatenate([[True], (head[1:] != head[:-1]).any(1)])
        near = np.flatnonzero(~new)
        yield self.pairs(rows, near - 1, near, False)
        start = np.flatnonzero(new)
        stop = np.append(start[1:], len(new))
        # Runs that may go on in another partition have their members noted however short they are.
        alone = stop - start == 1
        alone[0] &= self.last is not None and (self.last[0][: self.head] != head[0]).any()
        if final:
            alone[-1] = False
        kept = np.flatnonzero(~np.repeat(alone, stop - start))
        yield _rows(MEMBER, ids[kept], k=[x.tobytes() for x in k[kept]])
        centre = None
        for s, e in zip(start.tolist(), stop.tolist(), strict=True):
            centre = None
            for a in range(s, e, self.block):
                z = min(e, a + self.block)
                at = a + _centre(low[a:z], ids[a:z]) if z - a > 2 else a
                if z - a > 2:
                    yield self.pairs(rows, np.delete(np.arange(a, z), at - a), np.full(z - a - 1, at), True)
                if centre is not None:
                    yield self.pairs(rows, np.array([centre]), np.array([at]), True)
                elif a == 0 and self.last is not None and (self.last[0][: self.head] == head[0]).all():
                    both = tuple(np.concatenate([x[None], y[None], z_[:1], z_[at : at + 1]]) for x, y, z_ in zip(self.last[:4], self.last[4:], rows, strict=True))
                    yield self.pairs(both, np.array([0]), np.array([2]), False)
                    yield self.pairs(both, np.array([1]), np.array([3]), True)
                centre = at
        self.last = (*(x[-1] for x in rows), *(x[centre] for x in rows))

    def end(self) -> pa.RecordBatch:
        return _rows(END, [int(self.last[1])], [int(self.last[5])], k=[self.last[0].tobytes()])

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            k, low = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "u1").reshape(batch.num_rows, -1) for c in ("k", "low"))
            rows = (k, batch.column("id").to_numpy(), batch.column("n").to_numpy(), low)
            if held is None:
                yield _rows(END, rows[1][:1], rows[1][:1], k=[k[0].tobytes()])
            else:
                rows = tuple(np.concatenate(x) for x in zip(held, rows, strict=True))
            # The last run waits for its other rows, but for whole blocks of them.
            same = (rows[0][:, : self.head] == rows[0][-1, : self.head]).all(1)
            first = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            first += (len(same) - first - 1) // self.block * self.block
            if first:
                yield from self.process(tuple(x[:first] for x in rows), False)
            held = tuple(x[first:] for x in rows)
        if held is not None:
            yield from self.process(held, True)
            yield self.end()


def _hits(percent: int, least: int):
    """Members of a pair of blocks whose signature and size allow a similar member of another component. side: 0 within one block, else 1 or 2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tile, tree, inner = (batch.column(c)[i].as_py() for c in ("tile", "tree", "inner"))
                p, q = ([batch.column(n)[i].values.field(x) for x in ("id", "comp", "n", "low")] for n in ("left", "right"))
                (ai, ac, an), (bi, bc, bn) = ([c.to_numpy(zero_copy_only=False) for c in x[:3]] for x in (p, q))
                sa, sb = (np.frombuffer(b"".join(x[3].to_pylist()), "u1").reshape(-1, SIZE) for x in (p, q))
                left, right = np.zeros(len(ai), bool), np.zeros(len(bi), bool)
                for k in range(len(ai)):
                    fit = np.flatnonzero((bc != ac[k]) & (100 * np.minimum(bn, an[k]) >= percent * np.maximum(bn, an[k])))
                    fit = fit[(sb[fit] == sa[k]).sum(1) >= least]
                    left[k] = len(fit) > 0
                    right[fit] = True
                ids, side = (ai[left], np.zeros(left.sum(), "i4")) if inner else (np.concatenate([ai[left], bi[right]]), np.repeat(np.array([1, 2], "i4"), [left.sum(), right.sum()]))
                yield pa.record_batch({"tile": np.full(len(ids), tile), "tree": np.full(len(ids), tree, "i4"), "id": ids, "side": side})

    return run


def _joining(words: int, percent: int, least: int, depth: int, plain: bool):
    """Links that join components among rows ``tile, tree, side, id, comp, sig, text``, sorted by tile. plain: no region was divided, so a pair that an earlier tree brings together is left to that."""

    def links(rows: list[tuple]) -> list[tuple[int, int]]:
        tree = rows[0][0]
        side, ids, comp = (np.array([r[i] for r in rows]) for i in (1, 2, 3))
        sig = np.frombuffer(b"".join(r[4] for r in rows), ">u4").reshape(len(rows), SIZE)
        hashes = [r[5] for r in rows]
        n = np.array([len(h) for h in hashes])
        known = comp.copy()  # the root of each row's component
        head = np.ascontiguousarray(sig.reshape(len(rows), TREES, DEPTH)[:, :tree, :depth])
        out = []
        for k in range(len(rows) - 1):
            rest = np.arange(k + 1, len(rows))
            ok = (known[rest] != known[k]) & ((side[rest] != side[k]) | (side[k] == 0)) & (100 * np.minimum(n[rest], n[k]) >= percent * np.maximum(n[rest], n[k]))
            rest = rest[ok]
            rest = rest[(sig[rest] == sig[k]).sum(1) >= least]
            if plain and tree:
                rest = rest[~(head[rest] == head[k]).all(2).any(1)]
            if not len(rest):
                continue
            every = np.concatenate([hashes[j] for j in rest])
            at = np.minimum(np.searchsorted(hashes[k], every), n[k] - 1)
            cut = np.cumsum(n[rest]) - n[rest]
            both = np.add.reduceat((hashes[k][at] == every).astype("i8"), cut)
            for j in rest[100 * both >= percent * (n[rest] + n[k] - both)]:
                if known[j] != known[k]:
                    out.append((int(min(ids[k], ids[j])), int(max(ids[k], ids[j]))))
                    known[known == known[j]] = known[k]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, now, rows = Hasher(words), None, []
        for batch in batches:
            out = []
            for tile, tree, side, i, comp, sig, text in zip(*(batch.column(c).to_pylist() if c != 6 else (x.as_py() for x in batch.column(c)) for c in range(7)), strict=True):
                if tile != now and rows:
                    out += links(rows)
                    rows = []
                now = tile
                if not rows or rows[-1][2] != i:  # else a row that repeats
                    rows.append((tree, side, i, comp, sig, hasher(text)))
            yield pa.record_batch({"a": pa.array([r[0] for r in out], pa.int64()), "b": pa.array([r[1] for r in out], pa.int64())})
        if rows:
            out = links(rows)
            yield pa.record_batch({"a": pa.array([r[0] for r in out], pa.int64()), "b": pa.array([r[1] for r in out], pa.int64())})

    return run


def _regions(members: DataFrame, comp: DataFrame, depth: int, crowded: int) -> DataFrame:
    """``p, tree, id, comp, m, divided`` of regions with several components, at the depth that leaves each at most ``crowded`` members, if any does."""
    at = lambda d: F.xxhash64(F.lit(d), F.substr("k", F.lit(1), F.lit(1 + 4 * d)))
    tree = F.conv(F.hex(F.substr("k", F.lit(1), F.lit(1))), 16, 10).cast("int").alias("tree")
    now = members.join(comp, "id", "left").select("id", "k", tree, F.coalesce("component", "id").alias("comp"))
    several = [F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m")]
    now = now.withColumn("p", at(depth))
    open_ = now.join(now.groupBy("p").agg(*several).where("lo <> hi").select("p", "m"), "p")
    small = open_.where(F.col("m") <= crowded).select("p", "tree", "id", "comp", "m", F.lit(False).alias("divided"))
    large = open_.where(F.col("m") > crowded).select("id", "tree", "comp", F.col("p").alias("top"), F.posexplode(F.array(*[at(d) for d in range(depth + 1, DEPTH + 1)])).alias("d", "p"))
    sized = large.groupBy("p").agg(*several)
    # Of each row's deeper regions the first that is small enough, or the deepest; those of one component need nothing.
    fit = large.join(sized, "p").where((F.col("m") <= crowded) | (F.col("d") == DEPTH - depth - 1))
    first = fit.groupBy("id", "top").agg(F.min(F.struct("d", "p", "m", "lo", "hi", "comp", "tree")).alias("x")).select("x.*", "id").where("lo <> hi")
    return small.unionByName(first.select("p", "tree", "id", "comp", "m", F.lit(True).alias("divided")))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, depth: int = 3, block: int = 1024, crowded: int = 4096) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    words: words of a shingle; percent: 100 x the least Jaccard similarity of a
    link; depth: minima that candidates share at least; block: rows of a
    block; crowded: members from which a region is divided.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "minhash")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = stages.put(own.mapInArrow(_sign(words), "doc_id long, n_shingles long, key binary, sig binary, low binary"), "signed")
    reps = signed.where("key is not null and doc_id is not null").groupBy("key").agg(F.min_by(F.struct("doc_id", "n_shingles", "sig", "low"), "doc_id").alias("r"))
    reps = stages.put(reps.select("key", F.col("r.doc_id").alias("id"), F.col("r.n_shingles").alias("n"), "r.sig", "r.low"), "reps")
    share = percent / 100
    least = int(SIZE * max(0.0, share - 4.5 * (share * (1 - share) / SIZE) ** 0.5))

    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("t")
    slices = reps.select("id", "n", "low", "sig", tree)
    slices = slices.select(F.concat(F.substring(F.unhex(F.hex("t")), -1, 1), F.substr("sig", F.col("t") * _W + 1, F.lit(_W))).alias("k"), "id", "n", "low")
    order = slices.repartitionByRange(partitions(spark), "k", "id").sortWithinPartitions("k", "id")
    found = stages.put(order.mapInArrow(_Sorted(depth, least, percent, block), _PASS), "forest", ["kind"])
    # Two rows a partition, in order: the seams between partitions, and the centres beside them.
    seam = Window.orderBy("k", "a")
    ends = found.where(F.col("kind") == END).select("k", "a", "b", *[F.lag(c).over(seam).alias(f"{c}0") for c in ("k", "a", "b")])
    ends = ends.where(F.substr("k", F.lit(1), F.lit(1 + 4 * depth)) == F.substr("k0", F.lit(1), F.lit(1 + 4 * depth)))
    seams = ends.select(F.explode(F.array(F.struct("a", "a0", F.lit(False).alias("centre")), F.struct(F.col("b").alias("a"), F.col("b0").alias("a0"), F.lit(True).alias("centre")))).alias("x")).where("x.a <> x.a0")
    seams = seams.select(F.least("x.a", "x.a0").alias("a"), F.greatest("x.a", "x.a0").alias("b"), F.lit(SIZE).alias("same"), "x.centre")
    cand = found.where(F.col("kind") == PAIR).select("a", "b", "same", "centre").unionByName(seams)
    ends = cand.select("a", "b", "same", "centre", F.explode(F.array("a", "b")).alias("v"))
    best = ends.groupBy("v", "centre").agg(F.max(F.struct("same", -F.col("a"), -F.col("b"))).alias("x"))
    first = stages.put(best.select((-F.col("x.col2")).alias("a"), (-F.col("x.col3")).alias("b")).distinct(), "first")

    links = _Links(stages, own, words, percent)
    links.read(first.select(F.explode(F.array("a", "b")).alias("id")))
    links.join(first)
    stages.drop("texts0")
    members = found.where(F.col("kind") == MEMBER).select(F.col("a").alias("id"), "k")
    rest = _regions(members, links.comp, depth, crowded).join(reps.select("id", "n", "low"), "id")
    rest = rest.withColumn("c", F.pmod(F.xxhash64("id"), F.ceil(F.col("m") / block)).cast("int"))
    blocks = rest.groupBy("p", "c", "m", "tree").agg(F.max("divided").alias("divided"), F.collect_list(F.struct("id", "comp", "n", "low")).alias("rows"))
    blocks = stages.put(blocks, "blocks")
    plain = blocks.where("divided").isEmpty()
    right = blocks.select("p", F.col("c").alias("d"), F.col("rows").alias("right"))
    left = blocks.select("p", "c", "tree", F.col("rows").alias("left"), F.explode(F.sequence("c", F.ceil(F.col("m") / block).cast("int") - 1)).alias("d"))
    tiles = left.join(right, ["p", "d"]).repartition(partitions(spark), "p", "c", "d").select(F.xxhash64("p", "c", "d").alias("tile"), "tree", (F.col("c") == F.col("d")).alias("inner"), "left", "right")
    hits = stages.put(tiles.mapInArrow(_hits(percent, least), "tile long, tree int, id long, side int"), "hits")
    stages.drop("blocks", "forest", "first")
    links.read(hits.select("id"))
    attrs = reps.select("id", "sig").join(links.comp, "id", "left").select("id", "sig", F.coalesce("component", "id").alias("comp"))
    near = hits.join(attrs, "id").join(links.texts.withColumnRenamed("doc_id", "id"), "id").select("tile", "tree", "side", "id", "comp", "sig", "text")
    near = near.repartition(partitions(spark), "tile").sortWithinPartitions("tile", "side", "id")
    joining = stages.put(near.mapInArrow(_joining(words, percent, least, depth, plain), "a long, b long"), "joining")
    links.join(joining.distinct())
    stages.drop("hits", "texts1")

    of_class = reps.join(links.comp, "id", "left").select("key", F.coalesce("component", "id").alias("component_id"))
    out = (
        signed.select("doc_id", "n_shingles", "key")
        .join(of_class, "key", "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
    )
    return stages.finish(out, "classes")


class _Links:
    """Confirmed links and their components."""

    def __init__(self, stages: Stages, docs: DataFrame, words: int, percent: int):
        self.stages, self.docs, self.words, self.percent, self.k = stages, docs, words, percent, 0
        self.texts = docs
        self.comp = docs.sparkSession.createDataFrame([], "id long, component long")

    def read(self, ids: DataFrame) -> None:
        """Gathers the texts of documents ``id``."""
        ids = self.stages.put(ids.select(F.col("id").alias("doc_id")).distinct(), f"ids{self.k}")
        ids = F.broadcast(ids) if ids.count() <= FEW else ids
        self.texts = self.stages.put(self.docs.join(ids, "doc_id"), f"texts{self.k}")

    def join(self, pairs: DataFrame) -> None:
        """Verifies pairs ``a, b`` and joins the components of those that hold."""
        s, k, texts = self.stages, self.k, self.texts
        self.k += 1
        ta, tb = (texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"t{x}")) for x in ("a", "b"))
        both = pairs.select("a", "b").join(tb, "b").join(ta, "a").select("a", "b", "ta", "tb")
        checked = s.put(both.mapInArrow(_verify(self.words, self.percent), "a long, b long, ok boolean"), f"checked{k}")
        ca, cb = (self.comp.select(F.col("id").alias(x), F.col("component").alias(f"c{x}")) for x in ("a", "b"))
        ok = checked.where("ok")
        if k:
            ok = ok.join(ca, "a", "left").join(cb, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
        if not ok.isEmpty():
            moved = components(ok, s, f"cc{k}-")
            if k:  # every id follows its component
                follow = moved.select(F.col("id").alias("component"), F.col("component").alias("to"))
                old = self.comp.join(follow, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
                moved = old.unionByName(moved.join(old.select("id"), "id", "left_anti"))
            self.comp = s.put(moved, f"comp{k}")
        s.drop(f"checked{k}")


def op10_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """Near duplicates of all documents: four-word shingles, similarity of 0.8 or more."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=4)


QUERIES = {"op10_near_duplicates": op10_near_duplicates}
QUERY_SQL: dict[str, str] = {}
