"""Read and write task outlines.

A file is read whole, since Spark's line reader promises no order; the line
number then comes from the position. One file has to fit in a task's memory;
the number of files is not limited.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def lines(df: DataFrame, file: str | Column, text: str | Column) -> DataFrame:
    """Rows ``file, line_no, line`` (numbered from 1) of the outlines in a text column.

    Null texts have no lines; an empty text has one empty line; a carriage
    return before the line feed is dropped.
    """
    file = F.col(file) if isinstance(file, str) else file
    text = F.col(text) if isinstance(text, str) else text
    return df.select(file.alias("file"), F.posexplode(F.split(text, "\r?\n", -1)).alias("pos", "line")).select(
        "file", (F.col("pos") + 1).alias("line_no"), "line"
    )


def read_outline(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of the outlines in a folder or files: named by their paths or, where ``write_outline`` wrote them, by the names that they had."""
    df = spark.read.text(path, wholetext=True)
    if "file" in df.columns:  # else digits would be read as numbers
        written = spark.read.schema("value string, file string").text(path, wholetext=True)
        return lines(written, "file", F.regexp_replace("value", r"\n\z", ""))  # the writer ends each file with a line feed of its own
    return lines(df, F.col("_metadata.file_path"), "value")


def write_outline(parsed: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the ``line`` column of each outline again, lines in order, one text file below a folder ``file=<name>`` for each."""
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n")
    parsed.groupBy(F.col("file").cast("string").alias("file")).agg(text.alias("value")).write.mode(mode).partitionBy("file").text(path)
