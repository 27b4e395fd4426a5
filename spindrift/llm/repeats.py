"""Removal of repeated byte strings with a run-length index.

A byte goes if a string of ``length`` bytes that covers it also starts in a
document with a smaller id.

1. Every window of ``length`` bytes has a minimizer: the least hash of its
   ANCHOR-byte strings. Equal windows have equal minimizers. A first pass finds the minimizers
   that occur in two different texts; they become a bit map of bounded size
   (false positives cost work, not correctness).
2. A second pass cuts each text into strings: runs of windows with one such
   minimizer. Equal strings are aggregated (smallest and largest document) before they
   are moved and indexed, and occurrences are kept as hashes (of 96 bits: the string's, and half of its minimizer) and places.
3. The distinct strings are dealt by minimizer to buckets; in a large corpus they are moved in
   groups of buckets, so that they are packed by hundreds and not by few. A group is indexed piece by piece, so that the
   memory of an index does not follow the group's size: a piece has whole minimizers, WINDOWS windows at most; if one minimizer has more, pieces of it have
   whole contexts (the bytes beside the minimizing string, on the longer side: equal windows have these in common, too). For each piece the windows
   are sorted, their Burrows-Wheeler transform is run-length compressed, and its
   intervals of equal windows get the smallest document that holds them. The strings stream through it backwards from their
   sampled ends: each step extends the match by one byte with a rank on the runs and caps it at
   ``length``, so that the interval is always that of a whole window. Its smallest document is
   what the window's occurrences are held against.
4. Places whose document is larger than that are marked, merged per document, and cut out.
   Places of strings that occur very often are not shuffled: what the index says of
   these strings is of bounded size and sent to the places.

A text equal to that of a smaller document is repeated as a whole and needs no index. Such texts are found
through the least ids of parts of their rows, so that a text of very many rows is not met by one task.

Edge cases: null texts are empty; texts shorter than ``length`` lose nothing;
rows that repeat an id count as one document with several texts, each cut by itself; rows with a null
id lose nothing and cause no loss; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrift.llm.common import Stages, partitions, sent_by

ANCHOR = 24
#: Parts in which the rows of equal texts are met.
SALTS = 256
#: Groups of buckets up to which a bucket is a group, and buckets of a group at most.
GROUPS, GROUP = 256, 16
#: Windows handled at a time; a longer text is cut into overlapping parts.
PART = 1 << 17
#: Windows of an index, unless one minimizer has more with one context.
WINDOWS = 1 << 17
#: Bytes of texts that are sent to Python at a time.
SENT = 4 << 20
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_BYTE = np.random.default_rng(50).integers(1, 1 << 63, 256, dtype="u8")


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << max(16, int(n).bit_length())
    if n not in _POWERS:
        out = []
        for x in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(n, x, "u8")
            p[0] = 1
            out.append(np.cumprod(p))
        _POWERS[n] = (out[0], out[1])
    return _POWERS[n]


def _hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Mixed hash of each string of ``size`` bytes."""
    power, inverse = _powers(len(data))
    sums = np.concatenate([np.zeros(1, "u8"), np.cumsum(_BYTE[data] * power[: len(data)])])
    h = (sums[size:] - sums[:-size]) * inverse[: len(data) - size + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def minimizers(data: np.ndarray, length: int) -> np.ndarray:
    """Mixed minimizer of each window."""
    anchor = min(ANCHOR, length)
    width = length - anchor + 1
    h = _hashes(data, anchor)
    k = 1
    while 2 * k <= width:
        h = np.minimum(h[:-k], h[k:])
        k *= 2
    if k < width:
        h = np.minimum(h[: len(h) - (width - k)], h[width - k :])
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(32)


def contexts(data: np.ndarray, length: int) -> np.ndarray:
    """Hash of what stands in each window beside its first string of the least hash, on the longer side. Equal windows have equal ones; it changes
    once while windows move past that string."""
    anchor = min(ANCHOR, length)
    half = (length - anchor) // 2
    if not half:
        return np.zeros(len(data) - length + 1, "u8")
    rows = np.lib.stride_tricks.sliding_window_view(_hashes(data, anchor), length - anchor + 1)
    least = np.concatenate([rows[i : i + 4096].argmin(1) for i in range(0, len(rows), 4096)])
    left = least >= half
    c = _hashes(data, half)[np.arange(len(rows)) + np.where(left, least - half, least + anchor)]
    return np.where(left, c, ~c)


def _runs(raw: bytes, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Parts of a text: offset, first window of each run, its minimizer; the last run ends with the part."""
    for at in range(0, len(raw) - length + 1, PART):
        m = minimizers(np.frombuffer(raw, "u1")[at : at + PART + length - 1], length)
        first = np.concatenate([[0], np.flatnonzero(m[1:] != m[:-1]) + 1])
        yield at, first, m[first]


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _two_texts(m: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct minimizers with the least and the greatest of their texts."""
    order = np.argsort(m)
    m, t = m[order], t[order]
    start = np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]])) if len(m) else np.empty(0, "i8")
    if not len(m):
        return m, t, t
    return m[start], np.minimum.reduceat(t, start), np.maximum.reduceat(t, start)


def _first_pass(length: int, bits: int):
    """Packed minimizers by bucket, two texts of each at most for each flush."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ms, ts, n = [], [], 0

        def flush() -> pa.RecordBatch:
            m, lo, hi = _two_texts(np.concatenate(ms), np.concatenate(ts))
            two = lo != hi
            m, t = np.concatenate([m, m[two]]), np.concatenate([lo, hi[two]])
            order = np.argsort(m)
            m, t = m[order], t[order]
            cut = np.searchsorted((m >> np.uint64(64 - bits)).astype("i8"), np.arange((1 << bits) + 1))
            low = (m >> np.uint64(32 - bits)).astype("u4")  # the 32 bits behind the bucket's
            rows = [(b, low[i:j].tobytes(), t[i:j].tobytes()) for b, (i, j) in enumerate(zip(cut, cut[1:], strict=False)) if j > i]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2))], ["bucket", "m", "t"])

        for batch in batches:
            for text in (x.as_py() for x in batch.column(0)):
                raw = _bytes(text)
                if len(raw) < length:
                    continue
                mark = np.uint64(xxhash.xxh64_intdigest(raw))
                for _, _, m in _runs(raw, length):
                    ms.append(m)
                    ts.append(np.full(len(m), mark, "u8"))
                    n += len(m)
                if n > 400_000:
                    yield flush()
                    ms, ts, n = [], [], 0
        if ms:
            yield flush()

    return run


def _bitmap(bits: int, size: int):
    """A bucket's part of the bit map of minimizers with two texts."""

    def run(table: pa.Table) -> pa.Table:
        m, t = (np.frombuffer(b"".join(table.column(c).to_pylist()), k) for c, k in (("m", "u4"), ("t", "u8")))
        bucket = table.column("bucket")[0].as_py()
        m, lo, hi = _two_texts(m, t)
        at = (m[lo != hi] >> np.uint32(32 - (size - bits))).astype("i8")
        part = np.zeros(1 << (size - bits), "u1")
        part[at] = 1
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "part": pa.array([zstandard.compress(np.packbits(part, bitorder="little").tobytes(), 1)], pa.binary())})

    return run


_MAPS: dict[str, np.ndarray] = {}


def _second_pass(length: int, name: str, shared, bits: int, size: int, n_buckets: int, by_text: bool):
    """Occurrences ``m, h, id, th, pos``; and, for each bucket (or group of buckets), the distinct strings of a flush with their least and greatest ids and counts, packed.

    by_text: ``th`` is the text's hash (Spark's xxhash64), else null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _MAPS:
            _MAPS.clear()
            full = np.zeros(1 << (size - 3), "u1")
            step = 1 << (size - bits - 3)
            for b, part in shared.value:
                full[b * step : (b + 1) * step] = np.frombuffer(zstandard.decompress(part), "u1")
            _MAPS[name] = full
        bitmap = _MAPS[name]
        ms, hs, ids, ths, ps, own = [], [], [], [], [], {}

        def flush() -> Iterator[pa.RecordBatch]:
            n, kinds = len(hs), [pa.int32(), *[pa.int64()] * 4, pa.int32(), pa.binary()]
            names = ["m", "h", "id", "th", "pos", "bucket", "strings"]
            each = [np.concatenate(ms), np.array(hs, "i8"), np.repeat(np.array(ids, "i8"), [len(x) for x in ms]), np.repeat(np.array(ths, "i8"), [len(x) for x in ms]) if by_text else None, np.concatenate(ps)]
            yield pa.RecordBatch.from_arrays([pa.nulls(n, k) if x is None else pa.array(x, k) for x, k in zip(each, kinds, strict=False)] + [pa.nulls(n, k) for k in kinds[5:]], names)
            keys = np.array(list(own), "i8").reshape(-1, 2)
            rest = list(own.values())
            bucket = keys[:, 0] >> 8 & 0x7FFFFFFF
            bucket %= n_buckets
            order = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            rows = []
            for b in np.flatnonzero(np.diff(cut)):
                x = order[cut[b] : cut[b + 1]]
                s, lo, hi, k = zip(*(rest[i] for i in x), strict=True)
                parts = (keys[x, 0].astype("i4"), keys[x, 1], np.array(lo, "i8"), np.array(hi, "i8"), np.array([len(y) for y in s], "u4"), np.array(k, "u4"))
                raw = len(x).to_bytes(8, "little") + b"".join(y.tobytes() for y in parts) + b"".join(s)
                rows.append((int(b), zstandard.compress(raw, 3)))
            yield pa.RecordBatch.from_arrays([pa.nulls(len(rows), k) for k in kinds[:5]] + [pa.array([r[i] for r in rows], kinds[5 + i]) for i in (0, 1)], names)
            for x in (ms, hs, ids, ths, ps, own):
                x.clear()

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), (x.as_py() for x in batch.column(1)), strict=True):
                raw = _bytes(text)
                if i is None or len(raw) < length:
                    continue
                th = int(np.uint64(xxhash.xxh64_intdigest(raw, 42)).view("i8")) if by_text else None
                for at, first, m in _runs(raw, length):
                    bit = m >> np.uint64(64 - size)
                    hit = np.flatnonzero(bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype("u1") & 1)
                    if not len(hit):
                        continue
                    ends = np.append(first[1:], min(PART, len(raw) - at - length + 1)) + (length - 1)
                    starts, stops, keys = (first[hit] + at).tolist(), (ends[hit] + at).tolist(), m[hit].view("i8").tolist()
                    for a, b, k in zip(starts, stops, keys, strict=True):
                        s = raw[a:b]
                        h = xxhash.xxh64_intdigest(s) - (1 << 63)
                        x = own.get((k, h))
                        if x is None:
                            own[k, h] = [s, i, i, 1]
                        else:
                            x[3] += 1
                            if i < x[1]:
                                x[1] = i
                            elif i > x[2]:
                                x[2] = i
                        hs.append(h)
                    ms.append(m[hit].astype("u4").view("i4"))
                    ps.append(first[hit] + at)
                    ids.append(i)
                    ths.append(th)
                if len(hs) > 60_000:
                    yield from flush()
        if hs:
            yield from flush()

    return run


def _unpack(packed: Iterator[bytes]) -> tuple[np.ndarray, np.ndarray, bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Minimizers, hashes, all bytes, starts, sizes, least and greatest ids, counts: each string once, in the order of the minimizers."""
    heads, raws, before = [], [], 0
    for p in packed:
        raw = zstandard.decompress(p)
        n = int.from_bytes(raw[:8], "little")
        m = np.frombuffer(raw, "i4", n, 8)
        h, lo, hi = np.frombuffer(raw, "i8", 3 * n, 8 + 4 * n).reshape(3, n)
        size, count = np.frombuffer(raw, "u4", 2 * n, 8 + 28 * n).reshape(2, n).astype("i8")
        heads.append([x.copy() for x in (m, h, lo, hi)] + [before + np.cumsum(size) - size, size, count])
        raws.append(raw[8 + 36 * n :])
        before += len(raws[-1])
    m, h, lo, hi, at, size, count = (np.concatenate(x) for x in zip(*heads, strict=True))
    order = np.lexsort((h, m))
    m, h = m[order], h[order]
    new = np.flatnonzero(np.concatenate([[True], (m[1:] != m[:-1]) | (h[1:] != h[:-1])]))
    lo, hi, count = (f.reduceat(x[order], new) for f, x in ((np.minimum, lo), (np.maximum, hi), (np.add, count)))
    return m[new], h[new], b"".join(raws), at[order[new]], size[order[new]], lo, hi, count


def _pieces(m: np.ndarray, windows: np.ndarray, most: int) -> list[int]:
    """Where strings in the order of their minimizers are cut into pieces of whole minimizers, with ``most`` windows or else one minimizer."""
    start = np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]]))
    cuts, n = [], most
    for i, k in zip(start.tolist(), np.add.reduceat(windows, start).tolist(), strict=True):
        if n + k > most:
            cuts.append(i)
            n = 0
        n += k
    return [*cuts, len(m)]


class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform of the strings' windows, with the least document of each interval of equal windows.

    Rows are the suffixes that start a window, and of each string the one
    after its last window, in the order of their first ``depth`` bytes. Every window is thus reached from
    one row by one backward step; a step counts on the runs and gives the place among the rows so reached.
    """

    END = 256

    def __init__(self, strings: list[bytes], docs: np.ndarray, depth: int):
        sizes = np.array([len(s) for s in strings])
        begin = np.cumsum(sizes + 1) - sizes - 1
        text = np.frombuffer(b"\0".join(strings) + bytes(depth + 1), "u1")
        kind = "i4" if len(text) < 1 << 31 else "i8"
        n_rows = sizes - depth + 2
        self.first = np.cumsum(n_rows) - n_rows  # a string's first row, before sorting
        who = np.repeat(np.arange(len(strings), dtype=kind), n_rows)
        at = np.arange(len(who), dtype=kind) + np.repeat((begin - self.first).astype(kind), n_rows)
        key = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, depth)[at]).view(f"S{depth}").ravel()
        order = np.argsort(key).astype(kind)
        new = np.ones(len(order), bool)
        for i in range(1, len(order), 1 << 14):  # not all keys a second time
            some = key[order[i - 1 : i + (1 << 14)]]
            new[i : i + (1 << 14)] = some[1:] != some[:-1]
        del key
        who, at = who[order], at[order]
        whole = at < (begin + n_rows - 1)[who]
        self.start = np.flatnonzero(new).astype(kind)  # first row of each interval
        self.interval = np.cumsum(new, dtype=kind) - 1
        self.least = np.minimum.reduceat(np.where(whole, docs[who], np.iinfo("i8").max), self.start)
        self.row = np.empty(len(order), kind)
        self.row[order] = np.arange(len(order), dtype=kind)
        self.reached = np.flatnonzero(whole).astype(kind)
        last = np.where(at > begin[who], text[at - 1].astype("i2"), self.END)
        del who, at, whole, new
        self.text, self.begin, self.windows = text, begin, n_rows - 1
        edge = np.flatnonzero(np.concatenate([[True], last[1:] != last[:-1]]))
        self.run_at, self.run_char = edge, last[edge].astype("i8")
        run_size = np.diff(np.append(edge, len(order)))
        by_char = np.lexsort((np.arange(len(edge)), self.run_char))
        self.key = self.run_char[by_char] * len(edge) + by_char
        self.before = np.concatenate([[0], np.cumsum(run_size[by_char])])  # also counts the smaller characters

    def extend(self, row: np.ndarray, char: np.ndarray) -> np.ndarray:
        """A row whose window is char and then the start of the window at ``row`` (an interval's first): one backward step on the runs."""
        run = np.searchsorted(self.run_at, row, "right") - 1
        at = np.searchsorted(self.key, char * len(self.run_at) + run)
        return self.reached[self.before[at] + np.where(self.run_char[run] == char, row - self.run_at[run], 0)]

    def stream(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The strings backwards, all at once: string numbers, window offsets, the windows' least documents."""
        lanes = np.argsort(-self.windows, kind="stable")
        place = self.windows[lanes] - 1
        row = self.start[self.interval[self.row[self.first[lanes] + place]]]  # sampled ends
        while len(lanes):
            yield lanes, place, self.least[self.interval[row]]
            place = place - 1
            left = place >= 0
            lanes, place, row = lanes[left], place[left], row[left]
            if len(lanes):
                row = self.start[self.interval[self.extend(row, self.text[self.begin[lanes] + place].astype("i8"))]]


def _divided(strings: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Strings cut where the context of their windows changes: contexts, numbers of the strings, offsets in them, and what is cut out; in the order of the contexts."""
    sizes = np.array([len(x) for x in strings])
    cuts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // PART, prepend=-1)).tolist()
    found, out = [], []
    for begin, end in zip(cuts, [*cuts[1:], len(strings)], strict=True):
        raw, n = b"".join(strings[begin:end]), sizes[begin:end]
        start = np.cumsum(n) - n
        who = np.repeat(np.arange(end - begin), n - length + 1)
        at = np.arange(len(who)) + (length - 1) * who  # as each string before has so many bytes more than windows
        c = contexts(np.frombuffer(raw, "u1"), length)[at]
        first = np.flatnonzero(np.concatenate([[True], (c[1:] != c[:-1]) | (who[1:] != who[:-1])]))
        stop = at[np.append(first[1:], len(who)) - 1] + length
        at, who = at[first], who[first]
        found.append((c[first], who + begin, at - start[who]))
        out += [raw[i:j] for i, j in zip(at.tolist(), stop.tolist(), strict=True)]
    c, who, at = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(c, kind="stable")
    return c[order], who[order], at[order], [out[i] for i in order.tolist()]


def _index(length: int, often: int):
    """What the indexes of a group's pieces say of their strings: ``a`` to ``b`` is held by document ``low``; hot: strings that occur more than ``often`` times."""

    def one(m: np.ndarray, h: np.ndarray, strings: list[bytes], lo: np.ndarray, hi: np.ndarray, count: np.ndarray, at: np.ndarray) -> pa.Table:
        # Of each string the document that its last windows have in common, and where they end; a span is kept where that changes.
        none = np.iinfo("i8").max
        held, stop, found = np.full(len(strings), none), np.zeros(len(strings), "i8"), []
        for who, off, low in RunLengthIndex(strings, lo, length).stream():
            low = np.where(low < hi[who], low, none)
            new = low != held[who]
            if new.any():
                who, off, low = who[new], off[new], low[new]
                old = held[who]
                ended = old != none
                found.append((who[ended], off[ended] + 1, stop[who[ended]], old[ended]))
                held[who], stop[who] = low, off
        who = np.flatnonzero(held != none)
        found.append((who, np.zeros(len(who), "i8"), stop[who], held[who]))
        who, first, last, low = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.table({"m": m[who], "h": h[who], "a": first + at[who], "b": last + at[who] + length, "low": low, "hot": (count[who] > often).astype("i4")})

    def run(table: pa.Table) -> pa.Table:
        m, h, raw, at, size, lo, hi, count = _unpack(x.as_py() for x in table.column("strings"))
        cuts = _pieces(m, size - length + 1, WINDOWS)
        found = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            strings = [raw[i : i + n] for i, n in zip(at[a:b].tolist(), size[a:b].tolist(), strict=True)]
            if (size[a:b] - length + 1).sum() <= WINDOWS:
                found.append(one(m[a:b], h[a:b], strings, lo[a:b], hi[a:b], count[a:b], np.zeros(b - a, "i8")))
                continue
            c, who, off, strings = _divided(strings, length)
            parts = _pieces(c, np.array([len(x) - length + 1 for x in strings]), WINDOWS)
            for i, j in zip(parts, parts[1:], strict=False):
                found.append(one(*(x[a + who[i:j]] if isinstance(x, np.ndarray) else x[i:j] for x in (m, h, strings, lo, hi, count)), off[i:j]))
        return pa.concat_tables(found)

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, whole, marks in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
            raw = _bytes(text)
            if whole:
                spans = [(0, len(raw))]
            elif not marks.is_valid:
                spans = []
            else:
                x = marks.values
                a, b = (x.field(n).to_numpy(zero_copy_only=False) for n in ("a", "b"))
                order = np.argsort(a, kind="stable")
                a, b = a[order], np.maximum.accumulate(b[order])
                new = np.flatnonzero(np.concatenate([[True], a[1:] > b[:-1]]))
                spans = list(zip(a[new].tolist(), b[np.append(new[1:], len(a)) - 1].tolist(), strict=True))
            kept, at = [], 0
            for a, b in spans:
                kept.append(raw[at:a])
                at = b
            kept.append(raw[at:])
            rest = b"".join(kept)
            out.append((len(raw), len(raw) - len(rest), len(spans), rest))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array([r[i] for r in out], pa.int64()) for i in range(3)), pa.array([r[3] for r in out], pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
        )


def _copies(light: DataFrame, keys: list[str], length: int) -> DataFrame:
    """Keys of the rows whose text a smaller id has, too. Rows of a text meet its least id in SALTS parts."""
    salted = light.where(F.col("n") >= length).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    part = salted.groupBy("md5", "salt").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    text = part.groupBy("md5").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo < hi")
    least = part.select("md5", "salt").join(text.select("md5", "lo"), "md5")
    return salted.join(least, ["md5", "salt"]).where("id > lo").select(*keys, F.lit(True).alias("whole")).distinct()


def remove_repeats(docs: DataFrame, *, length: int = 50, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = 1 << 20, max_bits: int = 29, hot_rows: int = 1 << 17) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes) of every row.

    bucket_bytes: size of a bucket; max_bits: the bit map has 2^max_bits bits at most; hot_rows: strings that occur
    more than once in so many bytes of the corpus are hot. As every window belongs to one occurrence, hot
    strings have fewer than hot_rows windows together, which bounds what is broadcast of them.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "repeats")
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    th = F.xxhash64(F.coalesce("t", F.lit("")))
    # Texts seen before: by their hash, without the texts themselves.
    light = stages.put(own.where("id is not null").select("id", th.alias("th"), F.md5(F.col("t").cast("binary")).alias("md5"), F.coalesce(F.octet_length("t"), F.lit(0)).alias("n")), "light")
    total = int(light.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    by_text = not light.groupBy("id").agg(F.count("*").alias("k")).where("k > 1").isEmpty()
    keys = ["id", "th"] if by_text else ["id"]
    copies = stages.put(_copies(light, keys, length), "copies")
    stages.drop("light")
    size = min(max_bits, max(20, total.bit_length()))
    # A bucket of minimizers comes from about 16 MB of texts.
    bits = min(size - 12, max(2, (partitions(spark) - 1).bit_length(), (total >> 24).bit_length()))
    packed = own.where("id is not null").select("t").mapInArrow(_first_pass(length, bits), "bucket int, m binary, t binary")
    with sent_by(spark, SENT):
        parts = packed.groupBy("bucket").applyInArrow(_bitmap(bits, size), "bucket int, part binary").collect()  # 2^max_bits bits together at most, compressed
    shared = spark.sparkContext.broadcast([(r["bucket"], r["part"]) for r in parts])
    del packed, parts
    n = max(1, -(-total // (2 * bucket_bytes)))  # a bucket is about this many bytes where half the corpus is repeated
    per = max(1, min(GROUP, n // GROUPS))
    n_groups = -(-n // per)
    passed = own.mapInArrow(_second_pass(length, stages.root, shared, bits, size, n_groups, by_text), "m int, h long, id long, th long, pos long, bucket int, strings binary")
    with sent_by(spark, SENT):
        seen = stages.put(passed.withColumn("kind", F.col("bucket").isNotNull().cast("int")), "seen", ["kind"])
    found = seen.where("kind = 1").select("bucket", "strings").groupBy("bucket").applyInArrow(_index(length, total // hot_rows), "m int, h long, a long, b long, low long, hot int")
    found = stages.put(found, "found", ["hot"])
    stages.drop("seen/kind=1")
    del passed
    places = seen.where("kind = 0").select("m", "h", *keys, "pos")
    hot, rest = (found.where(f"hot = {k}").drop("hot") for k in (1, 0))
    # Fewer than hot_rows rows.
    met = places.join(F.broadcast(hot), ["m", "h"]).unionByName(places.join(F.broadcast(hot.select("m", "h").distinct()), ["m", "h"], "left_anti").join(rest, ["m", "h"]))
    spans = met.where("low < id").select(*keys, (F.col("pos") + F.col("a")).alias("a"), (F.col("pos") + F.col("b")).alias("b"))
    marks = spans.groupBy(*keys).agg(F.collect_set(F.struct("a", "b")).alias("marks"))
    per_doc = stages.put(marks.join(copies, keys, "full"), "marks")
    stages.drop("seen", "found", "copies")
    asked = own.withColumn("th", th) if by_text else own
    return asked.join(per_doc, keys, "left").select("id", "t", "whole", "marks").mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op4_repeats(spark, sf_dir: str) -> DataFrame:
    """Remove the 50-byte repeats of all documents."""
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op4_repeats": op4_repeats}
QUERY_SQL: dict[str, str] = {}
