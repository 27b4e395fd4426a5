"""Follow a folder of outlines: each new file is parsed once and its group roll-up appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spindrift.operators.outline import parse, with_parents
from spindrift.plans.outline import rollup_by_group
from spindrift.sources.outline import lines


def follow(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Windows over line order are batch operators, so each micro-batch runs them over its whole files.

    The batch id names the output folder and a repeated batch overwrites its
    own, which makes the sink idempotent.
    """
    texts = spark.readStream.format("text").option("wholetext", True).load(folder).select("value", F.col("_metadata.file_path").alias("path"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        rollup_by_group(with_parents(parse(lines(batch, "path", "value")))).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return texts.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
