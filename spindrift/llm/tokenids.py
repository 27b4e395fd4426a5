"""Token ids as files of canonical, length-limited Huffman codes.

Format. A table of blocks in ascending document order (part files in ascending
order, blocks in order within a file) and a codebook table (token, length).
A block holds whole documents and can be decoded alone:

    magic "HTB1" | uint32 documents n, uint32 checkpoint spacing K, uint32 crc32 of the rest
    n x int64 document id | n x uint8 id is null | n x uint64 ids in the document
    n x uint64 byte offset of the document's codes
    checkpoints, uint32: bit offset within the document of its ids 0, K, 2K, ...
    codes, most significant bit first, each document from a byte boundary

Every checkpoint starts a lane; a table lookup decodes one id of every lane at a
time, so decoding is vectorised although Huffman codes are sequential.

The ids are made once and written as a stage (uncoded), with counts per task;
counts are summed over all documents; the code is built on the driver from at
most one count per vocabulary entry (package-merge), then documents are coded,
moved to their range of document ids (coded, the smallest form) and packed.

Edge cases: a null text counts as empty, and so has the end id alone; rows with
a null document id come first; rows that repeat an id stay apart, ordered by
their codes; an empty table gives no blocks; extra columns are ignored. One
document's ids must fit in a task's memory, as its text does.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrift.llm import bpe
from spindrift.llm.common import Stages, partitions, tidy

MAGIC = b"HTB1"
SPACING = 128
BLOCK_TOKENS = 1 << 18
MAX_LENGTH = 16
PART = 1 << 16


def code_lengths(counts: np.ndarray, limit: int = MAX_LENGTH) -> np.ndarray:
    """Optimal prefix code lengths of at most ``limit`` bits (0 where the count is 0) by package-merge."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), "u1")
    n = len(used)
    if n <= 1:
        out[used] = 1
        return out
    limit = max(limit, int(np.ceil(np.log2(n))))
    order = used[np.argsort(counts[used], kind="stable")]
    single = counts[order].astype("f8")
    levels, packs = [], np.empty(0)
    for _ in range(limit):
        both = np.concatenate([single, packs])
        at = np.argsort(both, kind="stable")
        levels.append(at < n)
        row = both[at]
        packs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(1)
    take, length = 2 * n - 2, np.zeros(n, "i8")
    for is_single in reversed(levels):
        m = int(is_single[:take].sum())
        length[:m] += 1
        take = 2 * (take - m)
    out[order] = length
    return out


class Code:
    """Canonical code: shorter codes first, then smaller ids."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype("u1")
        self.bits = int(lengths.max(initial=1))
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        step = np.left_shift(np.uint64(1), (self.bits - lengths[order]).astype("u8"))
        first = np.concatenate([[0], np.cumsum(step)[:-1]]).astype("u8")
        self.codes = np.zeros(len(lengths), "u8")
        self.codes[order] = first >> (self.bits - lengths[order]).astype("u8")
        self.symbol, self.width = np.zeros(1 << self.bits, "u4"), np.ones(1 << self.bits, "i8")
        n = int(step.sum())
        self.symbol[:n] = np.repeat(order, step.astype("i8"))
        self.width[:n] = np.repeat(lengths[order], step.astype("i8"))

    def encode(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[list[bytes], list[bytes]]:
        """Codes and checkpoints of consecutive documents of the given sizes."""
        length = self.lengths[ids].astype("i8")
        ends = np.cumsum(length)
        last = np.cumsum(sizes)
        total = np.concatenate([[0], ends])[last]
        doc_bits = np.diff(total, prepend=0)
        doc_bytes = -(-doc_bits // 8)
        byte_at = np.concatenate([[0], np.cumsum(doc_bytes)])
        shift = np.repeat(byte_at[:-1] * 8 - (total - doc_bits), sizes)
        at = ends - length + shift
        value = self.codes[ids] << (64 - (at & 31) - length).astype("u8")
        words = np.bincount(at >> 5, weights=(value >> np.uint64(32)).astype("f8"), minlength=int(byte_at[-1] // 4 + 3))
        words[1:] += np.bincount(at >> 5, weights=(value & np.uint64(0xFFFFFFFF)).astype("f8"), minlength=len(words))[:-1]
        raw = words.astype(">u4").tobytes()
        codes = [raw[a:b] for a, b in zip(byte_at, byte_at[1:], strict=False)]
        marks = []
        for k, (e, s) in enumerate(zip(last, sizes, strict=True)):
            marks.append((at[e - s : e : SPACING] - byte_at[k] * 8).astype("<u4").tobytes())
        return codes, marks

    def decode(self, block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
        """Document ids, their sizes, and all their ids one after the other."""
        if block[:4] != MAGIC:
            raise ValueError("not a block of token ids")
        n, spacing, crc = struct.unpack_from("<III", block, 4)
        if zlib.crc32(block[16:]) != crc:
            raise ValueError("a block of token ids is damaged")
        doc = np.frombuffer(block, "<i8", n, 16)
        null = np.frombuffer(block, "u1", n, 16 + 8 * n)
        sizes = np.frombuffer(block, "<u8", n, 16 + 9 * n).astype("i8")
        start = np.frombuffer(block, "<u8", n, 16 + 17 * n).astype("i8")
        lanes = -(-sizes // spacing)
        m = int(lanes.sum())
        marks = np.frombuffer(block, "<u4", m, 16 + 25 * n).astype("i8")
        raw = np.frombuffer(block, "u1", -1, 16 + 25 * n + 4 * m)
        raw = np.concatenate([raw, np.zeros(4, "u1")]).astype("u4")
        window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        pos = np.repeat(start * 8, lanes) + marks
        first_lane = np.cumsum(lanes) - lanes
        nth = np.arange(m) - np.repeat(first_lane, lanes)
        left = np.minimum(np.repeat(sizes, lanes) - nth * spacing, spacing)
        to = np.repeat(np.cumsum(sizes) - sizes, lanes) + nth * spacing
        order = np.argsort(-left, kind="stable")
        pos, to, left = pos[order], to[order], left[order]
        out = np.empty(int(sizes.sum()), "<u4")
        active = np.searchsorted(-left, -np.arange(spacing), "left")
        drop = np.uint32(32 - self.bits)
        for t in range(spacing):
            a = active[t]
            if not a:
                break
            p = pos[:a]
            key = (window[p >> 3] << (p & 7).astype("u4")) >> drop
            out[to[:a] + t] = self.symbol[key]
            p += self.width[key]
        return [None if z else int(d) for d, z in zip(doc, null, strict=True)], sizes, out


def _block(docs: list[tuple[int | None, int, bytes, bytes]]) -> bytes:
    n = len(docs)
    sizes = np.array([d[1] for d in docs], "<u8")
    starts = np.cumsum([0, *(len(d[3]) for d in docs)][:-1]).astype("<u8")
    body = b"".join((
        np.array([d[0] or 0 for d in docs], "<i8").tobytes(), np.array([d[0] is None for d in docs], "u1").tobytes(),
        sizes.tobytes(), starts.tobytes(), *(d[2] for d in docs), *(d[3] for d in docs),
    ))
    return MAGIC + struct.pack("<III", n, SPACING, zlib.crc32(body)) + body


def _slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    a, total = 0, 0
    for b, s in enumerate(sizes):
        if b > a and total + s > most:
            yield a, b
            a, total = b, 0
        total += s
    if a < len(sizes):
        yield a, len(sizes)


def _coded(code: Code, ids: list[bytes], dtype: np.dtype) -> tuple[np.ndarray, list[bytes], list[bytes]]:
    """Sizes, codes and checkpoints of documents, PART ids at a time, so that the arrays stay in the processor's cache."""
    sizes, codes, marks = np.array([len(x) // dtype.itemsize for x in ids], "i8"), [], []
    for a, b in _slices(sizes.tolist(), PART):
        more = code.encode(np.frombuffer(b"".join(ids[a:b]), dtype), sizes[a:b])
        codes += more[0]
        marks += more[1]
    return sizes, codes, marks


def tokenized(df: DataFrame, tokenizer: str, end_id: int | None, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, ids`` (bytes), and rows with ``hist`` (counts of the task's ids) alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = bpe.load(tokenizer)
        end = b"" if end_id is None else np.array([end_id], enc.dtype).tobytes()
        counts = np.zeros(max(enc.tokenizer.get_vocab_size(), (end_id or 0) + 1), "i8")
        names, kinds = ["doc_id", "ids", "hist"], [pa.int64(), pa.binary(), pa.list_(pa.struct([("id", pa.int32()), ("n", pa.int64())]))]
        for batch in batches:
            ids = [enc.ids(t or "") + end for t in batch.column(1).to_pylist()]
            for a, b in _slices([len(x) for x in ids], 1 << 24):
                counts += np.bincount(np.frombuffer(b"".join(ids[a:b]), enc.dtype), minlength=len(counts))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(ids[a:b], kinds[1]), pa.nulls(b - a, kinds[2])], names)
        used = np.flatnonzero(counts)
        if len(used):
            pairs = pa.StructArray.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used])], ["id", "n"])
            yield pa.RecordBatch.from_arrays([pa.nulls(1, kinds[0]), pa.nulls(1, kinds[1]), pa.ListArray.from_arrays([0, len(used)], pairs)], names)

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, ids binary, hist array<struct<id:int,n:long>>"
    )


def write_ids(df: DataFrame, path: str, tokenizer: str, end_id: int | None = 0, *, id_col: str = "doc_id", text_col: str = "text", stages: Stages | None = None) -> None:
    """Encode every text and write ``path/blocks`` and ``path/codebook``."""
    spark = df.sparkSession
    own = stages is None
    stages = stages or Stages(spark, "tokenids")
    raw = stages.put(tokenized(df, tokenizer, end_id, id_col, text_col), "raw")
    dtype = bpe.load(tokenizer).dtype
    hist = raw.select(F.explode("hist").alias("h")).groupBy("h.id").agg(F.sum("h.n").alias("n")).collect()  # at most the vocabulary
    counts = np.zeros(max((r["id"] for r in hist), default=0) + 1, "i8")
    for r in hist:
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts)
    book = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(book, "token int, length int").coalesce(1).write.parquet(f"{path}/codebook")
    docs = raw.where("ids is not null").select("doc_id", "ids")
    n = partitions(spark)
    bounds = np.unique(docs.approxQuantile("doc_id", [k / n for k in range(1, n)], 0.2 / n)) if n > 1 else np.empty(0)
    shared = spark.sparkContext.broadcast((lengths, bounds))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, bounds = shared.value
        code = Code(lengths)
        for batch in batches:
            ids = batch.column(1).to_pylist()
            for a, b in _slices([len(x) // dtype.itemsize for x in ids], 1 << 20):
                sizes, codes, marks = _coded(code, ids[a:b], dtype)
                doc = batch.column(0).slice(a, b - a)
                part = np.searchsorted(bounds, doc.fill_null(-(1 << 62)).to_numpy(), "right").astype("i4")
                yield pa.record_batch({"part": part, "doc_id": doc, "n": sizes, "marks": pa.array(marks, pa.binary()), "codes": pa.array(codes, pa.binary())})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start, held, size = None, 0, [], 0

        def close() -> pa.RecordBatch:
            return pa.record_batch({"part": pa.array([part], pa.int32()), "start": [start], "n_tokens": [size], "block": pa.array([_block(held)], pa.binary())})

        for batch in batches:
            for p, *doc in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (p != part or size >= BLOCK_TOKENS):
                    yield close()
                    start, held, size = start + size, [], 0
                if p != part:
                    part, start = p, 0
                held.append(tuple(doc))
                size += doc[1]
        if held:
            yield close()

    coded = docs.mapInArrow(encode, "part int, doc_id long, n long, marks binary, codes binary")
    placed = coded.repartitionById(n, F.col("part")).sortWithinPartitions("part", "doc_id", "codes")
    with tidy(spark):
        placed.mapInArrow(pack, "part int, start long, n_tokens long, block binary").write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    stages.drop("raw")
    if own:
        stages.drop("")


def read_docs(spark: SparkSession, path: str, make, schema: str) -> DataFrame:
    """Decode all blocks. make(doc_id, start, ids as a uint32 array) gives each document's row."""
    book = spark.read.schema("token int, length int").parquet(f"{path}/codebook").collect()  # at most the vocabulary
    lengths = np.zeros(max((r["token"] for r in book), default=0) + 1, "i8")
    for r in book:
        lengths[r["token"]] = r["length"]
    blocks = spark.read.schema("part int, start long, n_tokens long, block binary").parquet(f"{path}/blocks")
    sums = {r["part"]: r["n"] for r in blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}  # a row for each written range
    before, total = {}, 0
    for p in sorted(sums):
        before[p], total = total, total + sums[p]
    shared = spark.sparkContext.broadcast((lengths, before))
    arrow = spark.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        lengths, before = shared.value
        code, out = Code(lengths), to_arrow_schema(arrow)
        for batch in batches:
            for part, start, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                doc, sizes, ids = code.decode(block.as_py())
                at = np.concatenate([[0], np.cumsum(sizes)])
                rows = [make(d, before[part] + start + int(at[k]), ids[at[k] : at[k + 1]]) for k, d in enumerate(doc)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), out, strict=True)], schema=out)

    return blocks.select("part", "start", "block").mapInArrow(run, schema)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` of every document."""
    return read_docs(spark, path, lambda d, start, ids: (d, start, ids.tolist()), "doc_id long, start long, ids array<long>")


def op1_token_ids(spark, sf_dir: str) -> DataFrame:
    """Write every document's ids and return start, size and crc32 of each from the files."""
    import public_tokenizers

    stages = Stages(spark, "op1")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    write_ids(docs, stages.path("ids"), public_tokenizers.path("byte_bpe_50k.json"), 0, stages=stages)
    return read_docs(
        spark, stages.path("ids"), lambda d, start, ids: (d, start, len(ids), zlib.crc32(ids.tobytes())), "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


QUERIES = {"op1_token_ids": op1_token_ids}
QUERY_SQL: dict[str, str] = {}
