"""Exact top-k search by distributed histogram selection.

Every pass scores everything: chunks of candidates are read where they lie, blocks of queries
are sent to them (QUERY_BYTES a round, so what is broadcast is bounded), and each tile is one integer matrix product. The first passes only count scores
per query in bins of the interval that must hold its kth best score; counts
are summed over all tiles, and the bin with the kth score is the next interval,
until it is a single value. The last pass returns the rows above that value
and, of those equal to it, the k smallest ids of each tile; the global order by
score and id decides ties.

A tile counts only bins from its own kth best score upwards: the global kth
score can't lie below it. Scores are never stored, and memory depends on the
tile alone, not on either side's size or on how many rows tie. Work is queries
times candidates, which an exact search of this kind can't avoid.

Scores are exact longs. A component beyond a long after scaling, and a score of
2^63 - 1 or more in size, raise an error; nothing is left out for its size.

Edge cases: vectors that are null, empty or hold null or non-finite components
take no part, nor do rows with a null id; only vectors of equal length are compared; rows that repeat id and
vector count once; every row with the query's id is left out of its
candidates; a query without candidates, and an empty table, give no rows;
extra columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindrift.llm.common import Stages

BINS = 4096
#: Queries that are sent to all tasks at once.
QUERY_BYTES = 64 << 20
MOST = (1 << 63) - 1
RESULT = "query_id long, rank int, vec_id long, score long"


def scaled(df: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """``id, v (array<long>), dim`` of the rows that take part."""
    over = F.raise_error(F.lit("top_k: a scaled component exceeds a long")).cast("long")

    def floor(c: Column) -> Column:
        x = c.cast("double") * F.lit(float(scale))
        return F.when(F.abs(x) < float(1 << 63), F.floor(x)).otherwise(over)

    whole = F.transform(vector_col, floor)
    fine = F.forall(vector_col, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return (
        df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(vector_col) > 0))
        .where(F.coalesce(fine, F.lit(False)))
        .select(F.col(id_col).cast("long").alias("id"), whole.alias("v"))
        .distinct()
        .withColumn("dim", F.size("v"))
    )


def _matrix(rows: pa.ListScalar, dim: int) -> tuple[np.ndarray, np.ndarray]:
    own = rows.values
    v = own.field("v")
    flat = v.flatten().to_numpy(zero_copy_only=False)
    return own.field("id").to_numpy(zero_copy_only=False), flat.reshape(-1, dim)


def _widen(score: np.ndarray, q: np.ndarray, c: np.ndarray, own: np.ndarray, sizes: np.ndarray) -> None:
    """Scores whose bound exceeds 2^62 are made anew with unbounded integers; an error where one is no long."""
    for i, j in np.argwhere((sizes >= 2.0**62) & ~own):
        exact = sum(a * b for a, b in zip(q[i].tolist(), c[j].tolist(), strict=True))
        if abs(exact) >= MOST:
            raise OverflowError("top_k: a score exceeds a long")
        score[i, j] = exact


def _tiles(batches: Iterator[pa.RecordBatch], shared):
    """Query ids, intervals, bin widths, missing counts, candidate ids and scores of each tile; an own row scores the least."""
    for batch in batches:
        for i in range(batch.num_rows):
            dim = batch.column("dim")[i].as_py()
            c_id, c = _matrix(batch.column("rows")[i], dim)
            c_norm = np.sqrt((c.astype("f8") ** 2).sum(1))
            for q_id, q, lo, hi, width, need in shared.value.get(dim, ()):
                q_norm = np.sqrt((q.astype("f8") ** 2).sum(1))
                most = q_norm.max(initial=0) * c_norm.max(initial=0)
                kind = "f8" if most < 2**52 else "i8"
                score = (q.astype(kind) @ c.T.astype(kind)).astype("i8")
                own = q_id[:, None] == c_id[None, :]
                if most >= 2.0**62:
                    _widen(score, q, c, own, q_norm[:, None] * c_norm[None, :])
                score[own] = np.iinfo("i8").min
                yield q_id, (lo, hi), width, need, c_id, score


def _count(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for q_id, (lo, hi), width, need, _, score in _tiles(batches, shared):
            for i in range(len(q_id)):
                own = score[i][(score[i] >= lo[i]) & (score[i] < hi[i]) & (score[i] > np.iinfo("i8").min)]
                if not len(own):
                    continue
                # The distance from the lower end fits an unsigned long.
                at = ((own.astype("u8") - np.int64(lo[i]).astype("u8")) // np.uint64(width[i])).astype("i8")
                if len(at) > need[i]:
                    at = at[at >= np.partition(at, len(at) - need[i])[len(at) - need[i]]]
                b, n = np.unique(at, return_counts=True)
                yield pa.record_batch({"id": np.full(len(b), q_id[i]), "bin": b, "n": n.astype("i8")})

    return run


def _select(k: int, shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for q_id, (lo, _), _, _, c_id, score in _tiles(batches, shared):
            for i in range(len(q_id)):
                over = np.flatnonzero((score[i] > lo[i]) & (score[i] > np.iinfo("i8").min))
                ties = np.flatnonzero((score[i] == lo[i]) & (score[i] > np.iinfo("i8").min))
                if len(ties) > k:
                    ties = ties[np.argpartition(c_id[ties], k)[:k]]
                at = np.concatenate([over, ties])
                yield pa.record_batch({"query_id": np.full(len(at), q_id[i]), "vec_id": c_id[at], "score": score[i][at]})

    return run


def top_k(df: DataFrame, is_query: Callable[[Column], Column], k: int = 10, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 1024.0, query_block: int = 256, chunk: int = 8192) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k best candidates by integer inner product.

    is_query: makes the condition on the id column that selects the queries.
    query_block, chunk: rows of a tile's two sides.
    """
    spark = df.sparkSession
    stages = Stages(spark, "topk")
    rows = stages.put(scaled(df, id_col, vector_col, scale), "rows")
    queries = rows.where(is_query(F.col("id")))
    # One row for each vector length that occurs.
    counts = {r["dim"]: r["n"] for r in rows.groupBy("dim").agg(F.count("*").alias("n")).toLocalIterator()}
    asked = {r["dim"]: r["n"] for r in queries.groupBy("dim").agg(F.count("*").alias("n")).toLocalIterator()}
    if not asked:
        return spark.createDataFrame([], RESULT)
    chunks = {d: -(-counts[d] // chunk) for d in asked}
    of = lambda table: F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[F.col("dim")]
    table = (
        rows.where(F.col("dim").isin(list(asked)))
        .withColumn("c", F.pmod(F.xxhash64("id", "v"), of(chunks).cast("long")))
        .groupBy("dim", "c")
        .agg(F.collect_list(F.struct("id", "v")).alias("rows"))
    )
    table = stages.put(table, "chunks")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))) * (1 + 1e-9) + 1
    top = {r["dim"]: r["m"] for r in rows.groupBy("dim").agg(F.max(norm).alias("m")).toLocalIterator()}
    size = norm * of({d: float(top[d]) for d in asked})
    bound = F.when(size < float(1 << 62), size.cast("long") + 1).otherwise(F.lit(MOST))
    rounds = max(1, -(-sum(asked[d] * (8 * d + 40) for d in asked) // QUERY_BYTES))

    def scan(state: DataFrame, make, schema: str, name: str) -> DataFrame:
        """All chunks, read where they lie, against the queries, which are sent to them: QUERY_BYTES a round."""
        parts = []
        for r in range(rounds):
            own = state.where(F.pmod(F.xxhash64("id", "v", F.lit("round")), F.lit(rounds)) == r).select("id", "v", "dim", "lo", "hi", "width", "need").toArrow()
            blocks: dict[int, list] = {}
            for d in asked:
                mine = own.filter(pc.equal(own["dim"], d)).combine_chunks()
                cols = [mine[x].to_numpy() for x in ("id", "lo", "hi", "width", "need")]
                v = mine["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                blocks[d] = [(cols[0][z], v[z], *(c[z] for c in cols[1:])) for z in (slice(a, a + query_block) for a in range(0, len(v), query_block))]
            out = table.mapInArrow(make(spark.sparkContext.broadcast(blocks)), schema)
            parts.append(out if rounds == 1 else stages.put(out, f"{name}-{r}"))
        return functools.reduce(DataFrame.unionByName, parts)

    state = queries.select("id", "v", "dim", (-bound).alias("lo"), bound.alias("hi"), F.floor(bound / (BINS // 2) + 1).alias("width"), F.lit(k).cast("long").alias("need"))
    widest = state.agg(F.max("width")).first()[0]
    step = 0
    while widest >= 1:
        found = scan(state, _count, "id long, bin long, n long", f"count{step}").groupBy("id", "bin").agg(F.sum("n").alias("n"))
        seen = F.sum("n").over(Window.partitionBy("id").orderBy(F.desc("bin")))
        cut = found.withColumn("seen", seen).groupBy("id").agg(
            F.collect_list(F.struct("bin", "n", "seen")).alias("bins"),
        )
        state = state.join(cut, "id", "left")
        bins = F.filter("bins", lambda x: x["seen"] >= F.col("need"))
        hit = F.array_max(F.transform(bins, lambda x: F.struct(x["bin"].alias("bin"), (F.col("need") - x["seen"] + x["n"]).alias("need"))))
        state = state.withColumn("hit", hit)
        # Fewer candidates than k: the interval's lower end stays, so all of them are returned.
        wide = lambda c: c.cast("decimal(19,0)")
        edge = lambda b: F.least(wide(F.col("lo")) + wide(b) * wide(F.col("width")), wide(F.col("hi"))).cast("long")
        narrow = F.floor((F.col("width") - 1) / BINS + 1)
        state = state.select(
            "id", "v", "dim",
            F.when(F.col("hit").isNull(), F.col("lo")).otherwise(edge(F.col("hit.bin"))).alias("lo"),
            F.when(F.col("hit").isNull(), F.col("hi")).otherwise(edge(F.col("hit.bin") + 1)).alias("hi"),
            F.when(F.col("hit").isNull() | (F.col("width") <= 1), F.lit(1)).otherwise(narrow).cast("long").alias("width"),
            F.coalesce("hit.need", "need").alias("need"),
        )
        state = stages.put(state, f"state{step}")
        step += 1
        widest = 0 if widest <= 1 else -(-widest // BINS)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    picked = scan(state, lambda shared: _select(k, shared), "query_id long, vec_id long, score long", "picked")
    return picked.distinct().withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op6_topk(spark, sf_dir: str) -> DataFrame:
    """Top 10 by integer inner product for every vector whose id is divisible by 100, against all other rows."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), lambda i: i % 100 == 0, 10)


QUERIES = {"op6_topk": op6_topk}
QUERY_SQL = {
    "op6_topk": """
        with e as (select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) v from embeddings
            where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (select q.vec_id query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::bigint score
            from e q join e c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 100 = 0)
        select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score from s
        qualify row_number() over (partition by query_id order by score desc, vec_id) <= 10"""
}
