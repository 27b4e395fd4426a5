"""Column expressions for one line of a task outline. All of them are built-in, codegen-friendly expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The three status glyphs of the format.
GLYPHS = {"☐": "open", "✔": "done", "✘": "cancelled"}

TASK = r"^( *)([☐✔✘])( +)(.*)$"
HEADING = r"^( *)([^ ☐✔✘].*):$"
STAMP = r"@(done|cancelled)\((\d\d-\d\d-\d\d \d\d:\d\d)\)"
TAG = r"(?U)@(\w+)"


def is_task(line: Column) -> Column:
    return F.coalesce(line.rlike(TASK), F.lit(False))


def is_heading(line: Column) -> Column:
    return F.coalesce(line.rlike(HEADING), F.lit(False))


def indent(line: Column) -> Column:
    return F.length(F.regexp_extract(line, r"^( *)", 1))


def status(line: Column) -> Column:
    """``open``, ``done`` or ``cancelled``; null for a line without a known glyph."""
    glyph = F.regexp_extract(line, TASK, 2)
    out = F.lit(None).cast("string")
    for mark, name in GLYPHS.items():
        out = F.when(glyph == mark, name).otherwise(out)
    return out


def title(line: Column) -> Column:
    """Free text of a task without its stamp."""
    return F.when(is_task(line), F.rtrim(F.regexp_replace(F.regexp_extract(line, TASK, 4), STAMP, "")))


def tags(line: Column) -> Column:
    """Names behind ``@``, stamps included; a bare ``@`` is prose."""
    return F.when(is_task(line), F.regexp_extract_all(line, F.lit(TAG), F.lit(1)))


def stamped_at(line: Column) -> Column:
    """Time of the done/cancelled stamp, century 20xx, without zone; null where absent or impossible."""
    stamp = F.regexp_extract(line, STAMP, 2)
    return F.concat(F.lit("20"), stamp).try_cast("timestamp_ntz")
