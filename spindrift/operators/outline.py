"""From lines of task outlines to tasks with section, parent and root."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spindrift.functions import outline as of


def parse(lines: DataFrame) -> DataFrame:
    """``file, line_no, line`` to one row a task.

    Adds section (text of the last heading, null before the first), indent,
    status, title, tags and stamped_at. Headings, blank lines and lines of
    another form give no row. Equal titles and stamps stay apart by line_no.
    """
    order = Window.partitionBy("file").orderBy("line_no")
    line = F.col("line")
    heading = F.when(of.is_heading(line), F.regexp_extract(line, of.HEADING, 2))
    at = F.when(of.is_heading(line), F.col("line_no"))
    return (
        lines.withColumn("section", F.last(heading, ignorenulls=True).over(order))
        .withColumn("section_line", F.last(at, ignorenulls=True).over(order))
        .where(of.is_task(line))
        .select(
            "file", "line_no", "section", "section_line", of.indent(line).alias("indent"), of.status(line).alias("status"),
            of.title(line).alias("title"), of.tags(line).alias("tags"), of.stamped_at(line).alias("stamped_at"), "line",
        )
    )


def with_parents(tasks: DataFrame, levels: list[int] | None = None) -> DataFrame:
    """Add parent_line and root_line.

    The parent is the nearest earlier task of the section with a smaller
    indent; the root is the last task without a parent, the line itself
    included. One window for each distinct indent replaces a theta self-join:
    work is linear in the lines. ``levels``: the distinct indents, gathered from
    the data if not given (a few integers).
    """
    if levels is None:
        levels = sorted(r["indent"] for r in tasks.select("indent").distinct().toLocalIterator())
    section = Window.partitionBy("file", "section_line").orderBy("line_no")
    before = section.rowsBetween(Window.unboundedPreceding, -1)
    near = [
        F.when(F.col("indent") > v, F.last(F.when(F.col("indent") == v, F.col("line_no")), ignorenulls=True).over(before))
        for v in levels
    ]
    none = F.lit(None).cast("int")
    parent = F.greatest(none, none, *near)
    own = F.when(F.col("parent_line").isNull(), F.col("line_no"))
    return tasks.withColumn("parent_line", parent).withColumn("root_line", F.last(own, ignorenulls=True).over(section))
