"""A training corpus from ``documents`` in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
and read again as the next one's docs. All but the last return the columns of
their docs, extra ones included, whatever their names. Decisions are made for
each row, so repeated and null ids do not matter. Null and empty texts pass the
first two stages unchanged, one of each id is left by the third, and packing gives them no bin. An
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrift.llm import linededup, minhash, mixing, packing, toxicity
from spindrift.llm.common import Stages, free_name, kept_names

TOXIC_FROM = 0.5
CAPACITY = 4096
#: Shares of tokens by the classifier's quality; no document is taken more than once.
WEIGHTS = {"good": 0.95, "poor": 0.05}


def by_id(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, str]:
    """Docs and the column that tells their rows apart: the ids, or where ids repeat or are null a number for each row of a written copy."""
    if docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("doc_id is null or n > 1").isEmpty():
        return docs, "doc_id"
    row = free_name("row", docs.columns)
    return Stages(spark, "rows").put(docs.withColumn(row, F.monotonically_increasing_id()), "rows"), row


def few(keys: DataFrame) -> DataFrame:
    """Keys of rows, to be sent to the texts instead of shuffling these where there are at most minhash.FEW; a join by key otherwise."""
    return F.broadcast(keys) if keys.count() <= minhash.FEW else keys


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of TOXIC_FROM or more go. Rows equal in id and text have one score."""
    stages, row = Stages(spark, "toxic"), free_name("row", docs.columns)
    rows = docs.withColumn(row, F.xxhash64(F.coalesce("text", F.lit(""))))
    scores = toxicity.score(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"), row_col=row, stages=stages)
    gone = few(stages.finish(scores.where(F.col("score") >= TOXIC_FROM).select("doc_id", "row").distinct(), "gone"))
    return rows.join(gone, rows["doc_id"].eqNullSafe(gone["doc_id"]) & (rows[row] == gone["row"]), "left_anti").select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates that recur in documents that are no near copies of each other go, but for the first; n_chars follows the text.

    Near copies, as the next stage judges them, lose the same lines and so reach it whole.
    """
    rows, row = by_id(spark, docs)
    near = minhash.near_duplicates(rows, id_col=row)
    of = free_name("class", rows.columns)
    classes = near.select(F.col("doc_id").alias(row), F.col("component_id").alias(of))
    out = linededup.dedup_lines(Stages(spark, "classes").put(rows.join(few(classes), row), "classed"), class_col=of)
    names = kept_names([*rows.columns, of], linededup.ADDED)
    length = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return out.select(*[length.get(c, F.col(names[c])).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row with the smallest id stays (null only where all are), as does one of the rows that repeat an id and a blank text."""
    rows, row = by_id(spark, docs)
    near = minhash.near_duplicates(rows, id_col=row).withColumnRenamed("doc_id", "near")
    if row == "doc_id":
        return rows.join(few(near.where("not kept").select(F.col("near").alias(row))), row, "left_anti").select(docs.columns)
    ids = rows.select(F.col(row).alias("near"), "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"))
    group = F.when((F.col("n_shingles") > 0) | F.col("doc_id").isNull(), F.col("component_id"))
    keys = [group.alias("g"), F.when(group.isNull(), F.col("doc_id")).alias("i"), F.when(group.isNull(), F.col("th")).alias("h")]
    first = near.join(ids, "near").groupBy(*keys).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "near")).alias("first"))
    return rows.join(few(first.select(F.col("first.near").alias(row))), row, "left_semi").select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken by their rates, at most once, so that token totals of good and poor quality meet WEIGHTS."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    domain = F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    mixed = mixing.mix(docs, labels.select("doc_id", domain.alias("domain")), WEIGHTS, cap=1.0)
    names = kept_names(docs.columns, mixing.ADDED)
    return mixed.where("copies > 0").select(*[F.col(names[c]).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in bins of CAPACITY token ids."""
    import public_tokenizers

    return packing.pack(packing.measured(docs, public_tokenizers.path("byte_bpe_50k.json")), CAPACITY)


STAGES = [("toxicity", reject_toxic), ("line dedup", drop_lines), ("MinHash near-dedup", drop_near_duplicates), ("mixing to target weights", mix), ("best-fit packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = Stages(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stages.put(stage(spark, docs, sf_dir), str(i))
        if i:
            stages.drop(str(i - 1))
    return docs


#: Most stages cannot be told in SQL; tests/llm/test_twins.py holds a plain version of each, and of the whole.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
QUERY_SQL: dict[str, str] = {}
