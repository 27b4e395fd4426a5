"""Shared pieces: the shared folder, written stages, and connected components."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: list[str] = []


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset, a temporary one, on a single machine alone."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir is unset: stages need a folder that the driver and all executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="shared-"))
    return f"file://{_OWN[0]}"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files: Spark deletes those of a query when it has ended."""
    before = spark.conf.get(CLEANUP, None)
    if before is None:
        yield
        return
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def sent_by(spark: SparkSession, n_bytes: int) -> Iterator[None]:
    """Rows that queries inside send to Python go in batches of about ``n_bytes``: each task holds several of them, in and outside the JVM."""
    before = spark.conf.get(BATCH, None)
    if before is None:
        yield
        return
    spark.conf.set(BATCH, str(n_bytes))
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


class Stages:
    """Tables that one query writes to the shared folder, so that lost executors cost only the running stage.

    ``put`` writes and rereads a stage. ``drop`` removes one that is no longer
    read, ``finish`` writes the last one and removes all others of the query. What the result still reads goes when the session's process ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        atexit.register(self._remove, self.root)

    def path(self, stage: str) -> str:
        return f"{self.root}/{stage}"

    def put(self, df: DataFrame, stage: str, partition_by: list[str] | None = None) -> DataFrame:
        writer = df.write.mode("overwrite").option("compression", "zstd")
        with tidy(self.spark):
            (writer.partitionBy(*partition_by) if partition_by else writer).parquet(self.path(stage))
        return self.get(stage, df.schema)

    def get(self, stage: str, schema=None) -> DataFrame:
        reader = self.spark.read
        return (reader.schema(schema) if schema is not None else reader).parquet(self.path(stage))

    def drop(self, *stages: str) -> None:
        for stage in stages:
            self._remove(self.path(stage))

    def finish(self, df: DataFrame, stage: str) -> DataFrame:
        out = self.put(df, stage)
        fs, root = self._file_system(self.root)
        self.drop(*[name for x in fs.listStatus(root) if (name := x.getPath().getName()) != stage])
        return out

    def _file_system(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _remove(self, path: str) -> None:
        try:
            fs, p = self._file_system(path)
            fs.delete(p, True)
        except Exception:  # noqa: BLE001  the session has ended; the folder's owner clears it
            pass


def kept_names(columns: list[str], added: tuple[str, ...]) -> dict[str, str]:
    """The names under which a table's own columns stay beside added ones: ``_in`` follows a name until it is free."""
    taken, out = {c.lower() for c in (*columns, *added)}, {}
    for c in columns:
        out[c] = c
        if c.lower() in {a.lower() for a in added}:
            while out[c].lower() in taken:
                out[c] += "_in"
            taken.add(out[c].lower())
    return out


def free_name(name: str, columns: list[str]) -> str:
    """The name, with as many ``_`` behind it as it takes to be no column's."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _large_star(e: DataFrame) -> DataFrame:
    """Larger neighbours of a node move to its smallest neighbour, or to the node itself where it is smaller."""
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    both = e.join(e.groupBy("u").agg(F.min("v").alias("m")), "u")
    return both.select("u", F.col("m").alias("v")).unionByName(both.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()


#: Links (16 bytes each) up to which the driver joins them itself instead of in rounds of queries.
FEW_LINKS = 100_000


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the links, in order, and the smallest id that each is joined with."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    low = np.arange(len(ids))
    while True:
        x, y = low[a], low[b]
        if (x == y).all():
            return ids, ids[low]
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
        while (low[low] != low).any():
            low = low[low]


def components(edges: DataFrame, stages: Stages, name: str = "cc", max_rounds: int = 60, few: int = FEW_LINKS) -> DataFrame:
    """Connected components of ``a, b`` (long): rows ``id, component`` with the smallest id of each component.

    The driver joins at most ``few`` links by itself: a round of queries costs it more memory
    (plans, and threads that stay for a minute) than these do. More links do not reach it: they go through
    alternating large-star and small-star steps. Each needs a minimum per node
    (combined before the shuffle) and an equi-join, so hubs are neither gathered
    nor replicated. Every round is a written stage. Ends when the links are
    stars around the components' minima.
    Ids without a link are not returned. Null ids link nothing.
    """
    e = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = stages.put(e, f"{name}0")
    if e.count() <= few:
        links = e.toArrow()
        ids, low = roots(*(links.column(c).to_numpy() for c in ("u", "v")))
        found = stages.put(e.sparkSession.createDataFrame(pa.table({"id": pa.array(ids, pa.int64()), "component": pa.array(low, pa.int64())})).coalesce(1), f"{name}1")
        stages.drop(f"{name}0")
        return found
    for k in range(1, max_rounds):
        e = stages.put(_small_star(_large_star(e)), f"{name}{k}")
        stages.drop(f"{name}{k - 1}")
        # Settled: every node has one link, to a node that has none: stars around the minima.
        ends = e.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(e.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up > 0 and down > 0)").isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
