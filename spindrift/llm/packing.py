"""Conflict-constrained best-fit packing of documents into bins of equal capacity.

No bin holds two pieces of one source or of one duplicate cluster (equal texts
but for case and white space; pieces of one document are of one cluster). Pieces are cut at
capacity, ordered by falling length, and each goes to the compatible bin with
the least residual that holds it, or to a new bin.

Bins are kept by residual in a tree over 1..capacity whose nodes carry the
intersection of their bins' source and cluster bitmaps. A search walks the
successors of the wanted length upwards; a subtree whose every bin conflicts on the same
bit is passed over as a whole, and a subtree that only looks compatible is
searched and left again, so the search ends at the tightest compatible bin.

Packing is sequential, so pieces are dealt by hash into shards of about ``shard``
pieces, each packed in one task; the number of shards follows the input, and
each mixes all sources. Bins are numbered shard * 2^32 + n.

Edge cases: documents without tokens get one piece of length 0 and no bin
(null); a null source conflicts with nothing; rows that repeat are one
cluster and so lie in different bins; null ids are packed as well; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrift.llm import bpe
from spindrift.llm.common import Stages


class Bins:
    """Open bins by residual; bit 0 of the bitmaps is never set in a bin."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.size = 1 << max(1, capacity.bit_length())
        self.node = [-1] * (2 * self.size)  # an empty subtree has every bit
        self.at: list[dict[int, list[int]]] = [{} for _ in range(self.size)]
        self.n = 0

    def _update(self, residual: int) -> None:
        mask = -1
        for m in self.at[residual]:
            mask &= m
        node, i = self.node, residual + self.size
        node[i] = mask
        i >>= 1
        while i:
            both = node[2 * i] & node[2 * i + 1]
            if node[i] == both:
                break
            node[i] = both
            i >>= 1

    def _add(self, residual: int, mask: int, number: int) -> None:
        if residual:
            self.at[residual].setdefault(mask, []).append(number)
            self._update(residual)

    def _find(self, i: int, lo: int, hi: int, length: int, bits: int) -> tuple[int, int] | None:
        if hi <= length or self.node[i] & bits:
            return None
        if hi - lo == 1:
            for m in self.at[lo]:
                if not m & bits:
                    return lo, m
            return None
        mid = (lo + hi) // 2
        return self._find(2 * i, lo, mid, length, bits) or self._find(2 * i + 1, mid, hi, length, bits)

    def place(self, length: int, bits: int) -> tuple[int, int]:
        """Bin number and offset of a piece with conflict bits (bit 0 excluded)."""
        hit = self._find(1, 0, self.size, length, bits | 1)
        if hit is None:
            self.n += 1
            self._add(self.capacity - length, bits, self.n - 1)
            return self.n - 1, 0
        residual, mask = hit
        numbers = self.at[residual][mask]
        number = numbers.pop(0)
        if not numbers:
            del self.at[residual][mask]
        self._update(residual)
        self._add(residual - length, mask | bits, number)
        return number, self.capacity - residual


def _pack(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        source, _ = pd.factorize(pdf["source"])  # null: -1
        cluster, names = pd.factorize(pdf["cluster"])
        many = np.flatnonzero(np.bincount(cluster, minlength=len(names)) > 1)
        first = 1 + int(source.max(initial=-1)) + 1
        bit_of = {int(c): first + i for i, c in enumerate(many)}
        bins, out = Bins(capacity), []
        for n, s, c in zip(pdf["length"], source, cluster, strict=True):
            if n == 0:
                out.append((None, 0))
                continue
            bits = (1 << (1 + int(s)) if s >= 0 else 0) | (1 << bit_of[c] if c in bit_of else 0)
            out.append(bins.place(int(n), bits))
        base = int(pdf["shard"].iloc[0]) << 32
        return pd.DataFrame({
            "doc_id": pdf["doc_id"].to_numpy(), "piece": pdf["piece"].to_numpy(), "n_tokens": pdf["length"].to_numpy(),
            "bin_id": pd.array([None if b is None else base + b for b, _ in out], dtype="Int64"), "bin_offset": [o for _, o in out],
        })

    return run


def measured(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, source, cluster, n`` with the text's number of token ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = bpe.load(tokenizer)
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            n = [len(enc.ids(t)) // enc.dtype.itemsize for t in texts]
            same = [xxhash.xxh64_intdigest(" ".join(t.lower().split()).encode("utf-8", "surrogatepass")) - (1 << 63) for t in texts]
            yield pa.record_batch({"doc_id": batch.column(0), "source": batch.column(1), "cluster": pa.array(same, pa.int64()), "n": pa.array(n, pa.int64())})

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    return own.mapInArrow(run, "doc_id long, source string, cluster long, n long")


def pack(sizes: DataFrame, capacity: int = 4096, shard: int = 8192, stages: Stages | None = None) -> DataFrame:
    """``doc_id, piece, n_tokens, bin_id, bin_offset`` of ``doc_id, source, cluster, n`` rows."""
    stages = stages or Stages(sizes.sparkSession, "packing")
    cut = F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / capacity) - 1, F.lit(0)).cast("int"))).alias("piece")
    pieces = sizes.select("doc_id", "source", "cluster", "n", cut).withColumn("length", F.least(F.lit(capacity), F.col("n") - F.col("piece") * capacity))
    pieces = stages.put(pieces, "pieces")
    shards = max(1, -(-pieces.count() // shard))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "source", "cluster"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(_pack(capacity), "doc_id long, piece int, n_tokens long, bin_id long, bin_offset long")


def op3_packing(spark, sf_dir: str) -> DataFrame:
    """Pack all documents, measured in token ids, into bins of 4096."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(measured(docs, public_tokenizers.path("byte_bpe_50k.json")))


QUERIES = {"op3_packing": op3_packing}
QUERY_SQL: dict[str, str] = {}
