"""Line dedup by a log-template tree.

A line's variable fields (tokens with a digit, an @ or a scheme) are masked. The tree has a
fixed depth: the number of tokens, then the leading tokens; its leaves hold
templates. Within a leaf, lines in the order of their hash join the most similar template
(share of equal tokens at the same place, wildcards not counted as equal) or start a new one; where a
line differs from its template, the template gets a wildcard. A template that
occurs in two or more documents is recurring: its first line (smallest document, then line)
stays, all its other lines are dropped. With a column of copy classes, classes
take the place of documents: lines that only copies of one text share are not
recurring, and a recurring line stays once in every document of the class it
occurs in first, so copies lose the same lines.

A leaf of more than ``part`` distinct lines is dealt by hash into parts that
are matched each for itself. Then blocks of the parts' templates meet each
other, every pair of blocks in a task of its own, and templates that agree on
the same share of tokens are one: no task ever holds a whole leaf.

Lines travel as hashes: only the distinct masked lines of leaves that hold
several of them and several documents are fetched, once each, for the
matching. Repeats, however many, are aggregated before they are shuffled.

Edge cases: blank lines are never dropped and null or empty texts have no lines
to drop; a text whose lines all go stays as an empty text; rows that repeat id
and text are one document and get the same result; null ids sort first; an
empty table gives no rows; extra columns are kept, those named like a column
that is added (``n_lines``, ``n_dropped``) with ``_in`` behind their name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrift.llm.common import Stages, components, kept_names, partitions

WILD = "<*>"
ADDED = ("n_lines", "n_dropped")
#: A token with a digit, an @ or ://, from its first character on; every character is looked at a fixed number of times.
VARIABLE = r"(?<![^ ])[^ :0-9@]*+(?::(?!//)[^ :0-9@]*+)*+(?:[0-9@]|://)[^ ]*+"
BLANKS = "\t\r\x0b\x0c"


def masked(line: Column) -> Column:
    """The line with its variable tokens masked and single spaces between tokens."""
    plain = F.translate(line, BLANKS, " " * len(BLANKS))
    whole = F.regexp_replace(F.regexp_replace(plain, VARIABLE, WILD), "  +", " ")
    return F.trim(F.when(line.rlike(f"[0-9@{BLANKS}]") | line.contains("://") | line.contains("  "), whole).otherwise(line))


def match(lines: list[list[str]], least: float) -> tuple[list[int], list[list[str]]]:
    """Template number of each line of one part, and the templates' tokens ('' for a wildcard); all lines have the same number of tokens."""
    ids: dict[str, int] = {}
    rows = np.array([[ids.setdefault(t, len(ids)) for t in x] for x in lines], "i4")
    n = rows.shape[1]
    templates, size, out = np.empty((16, n), "i4"), 0, []
    for r in rows:
        best = -1
        if size:
            same = (templates[:size] == r).sum(1)
            at = int(same.argmax())
            if same[at] >= least * n:
                best = at
        if best < 0:
            if size == len(templates):
                templates = np.concatenate([templates, np.empty_like(templates)])
            best, size = size, size + 1
            templates[best] = r
        else:
            templates[best][templates[best] != r] = -1
        out.append(best)
    names = [*ids, ""]
    return out, [[names[t] for t in x] for x in templates[:size]]


_FOUND = "leaf long, h long, template long, tokens string"


def _cluster(least: float):
    """Templates of each part; rows come sorted by leaf, part and hash. Parts of divided leaves also give their templates' tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hs, lines, out = None, [], [], []

        def close() -> None:
            leaf, part, divided = key
            if len(lines) == 1:
                numbers, templates = [0], [lines[0]]
            else:
                numbers, templates = match(lines, least)
            first = set()
            for h, t in zip(hs, numbers, strict=True):
                new = divided and t not in first
                first.add(t)
                out.append((leaf, h, part << 32 | t, " ".join(templates[t]) if new else None))
            hs.clear()
            lines.clear()

        def send() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))], ["leaf", "h", "template", "tokens"])
            out.clear()
            return batch

        for batch in batches:
            for leaf, part, divided, h, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != (leaf, part, divided):
                    if hs:
                        close()
                    key = (leaf, part, divided)
                if hs and hs[-1] == h:  # from a row that repeats
                    continue
                hs.append(h)
                lines.append(line.split(" "))
            if len(out) > 10_000:
                yield send()
        if hs:
            close()
        yield send()

    return run


def _alike(least: float):
    """Links between the templates of two blocks of a leaf: one tree for each set that hangs together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for left, right in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids: dict[str, int] = {"": -1}
                p, q = (np.array([[ids.setdefault(t, len(ids)) for t in x["tokens"].split(" ")] for x in side], "i4") for side in (left, right))
                root = {x["tid"]: x["tid"] for x in left + right}

                def find(x: int, root: dict[int, int] = root) -> int:
                    while root[x] != x:
                        root[x] = x = root[root[x]]
                    return x

                for k, r in enumerate(q):
                    for j in np.flatnonzero(((p == r) & (r >= 0)).sum(1) >= least * len(r)):
                        a, b = find(right[k]["tid"]), find(left[j]["tid"])
                        if a != b:
                            root[a] = b
                            out.append((right[k]["tid"], left[j]["tid"]))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in (0, 1)], ["a", "b"])

    return run


def _templates(text: DataFrame, stages: Stages, least: float, part: int) -> DataFrame:
    """``leaf, h, tid`` of the lines ``leaf, h, n, line`` (n: distinct lines of the leaf)."""
    parts = F.ceil(F.col("n") / part)
    dealt = text.select("leaf", F.pmod(F.xxhash64("h", "leaf"), parts).alias("part"), (parts > 1).alias("divided"), "h", "line")
    dealt = dealt.repartition(partitions(text.sparkSession), "leaf", "part").sortWithinPartitions("leaf", "part", "h")
    found = stages.put(dealt.mapInArrow(_cluster(least), _FOUND).withColumn("tid", F.xxhash64("leaf", "template")), "templates")
    divided = found.where("tokens is not null")
    if divided.isEmpty():
        return found.select("leaf", "h", "tid")
    size = divided.groupBy("leaf").agg(F.ceil(F.count("*") / part).cast("int").alias("m"))
    block = F.pmod(F.xxhash64("tid"), F.col("m")).cast("int")
    blocks = divided.join(size, "leaf").groupBy("leaf", "m", block.alias("c")).agg(F.collect_list(F.struct("tid", "tokens")).alias("rows"))
    blocks = stages.put(blocks, "blocks")
    left = blocks.select("leaf", "c", F.col("rows").alias("left"), F.explode(F.sequence("c", F.col("m") - 1)).alias("d"))
    tiles = left.join(blocks.select("leaf", F.col("c").alias("d"), F.col("rows").alias("right")), ["leaf", "d"])
    tiles = tiles.repartition(partitions(text.sparkSession), "leaf", "c", "d").select("left", "right")
    joined = components(stages.put(tiles.mapInArrow(_alike(least), "a long, b long"), "alike"), stages, "tcc")
    return found.join(joined.withColumnRenamed("id", "tid"), "tid", "left").select("leaf", "h", F.coalesce("component", "tid").alias("tid"))


def recurring(docs: DataFrame, stages: Stages, depth: int, least: float, part: int) -> DataFrame:
    """``id, th`` (document) and ``drops`` (positions of the lines to drop); ``c``, where docs has it, is the class of copies."""
    own = [c for c in ("c",) if c in docs.columns]
    lines = docs.select("id", "th", *own, F.posexplode(F.split("t", "\n", -1)).alias("pos", "line")).where(F.trim("line") != "")
    lines = lines.select("id", "th", "pos", *own, masked(F.col("line")).alias("m")).where("m <> ''")
    spaces = F.octet_length("m") - F.octet_length(F.replace("m", F.lit(" "), F.lit("")))
    leaf = F.xxhash64(spaces, F.substring_index("m", " ", depth))
    light = stages.put(lines.select("id", "th", "pos", *own, leaf.alias("leaf"), F.xxhash64("m").alias("h")), "light")
    doc = F.struct(F.coalesce("c", "id").alias("id"), F.when(F.col("c").isNull(), F.col("th")).alias("th")) if own else F.struct("id", "th")
    one = light.groupBy("leaf", "h").agg(F.min(F.struct("id", "th", "pos", *own)).alias("first"), F.min(doc).alias("lo"), F.max(doc).alias("hi"))
    one = stages.put(one, "lines")
    crowded = one.groupBy("leaf").agg(F.count("*").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("n > 1 and lo <> hi").select("leaf", "n")
    wanted = one.join(crowded, "leaf").select("leaf", "h", "n", "first.id", "first.th", "first.pos")
    per_doc = wanted.groupBy("id", "th").agg(F.collect_list(F.struct("leaf", "h", "n", "pos")).alias("w"))
    text = docs.join(per_doc, ["id", "th"]).select(F.split("t", "\n", -1).alias("ls"), F.explode("w").alias("w"))
    text = text.select("w.leaf", "w.h", "w.n", masked(F.element_at("ls", F.col("w.pos") + 1)).alias("line"))
    found = _templates(text, stages, least, part)
    # Lines of leaves that needed no matching are templates by themselves.
    named = one.join(found, ["leaf", "h"], "left").withColumn("tid", F.coalesce("tid", "leaf"))
    often = named.groupBy("tid").agg(F.min("first").alias("keep"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo <> hi")
    keys = stages.put(named.select("leaf", "h", "tid").join(often.select("tid", "keep"), "tid"), "keys")
    found = light.join(keys, ["leaf", "h"])
    if own:
        same = F.coalesce(F.col("c") == F.col("keep.c"), F.lit(False)) | ((F.col("id") == F.col("keep.id")) & (F.col("th") == F.col("keep.th")))
        first = found.where(same).groupBy("id", "th", "tid").agg(F.min("pos").alias("at"), F.collect_set("pos").alias("all"))
        again = first.select("id", "th", F.explode(F.array_remove("all", F.col("at"))).alias("pos"))
        gone = found.where(~same).select("id", "th", "pos").unionByName(again)
    else:
        gone = found.where(F.struct("id", "th", "pos") != F.col("keep")).select("id", "th", "pos")
    out = stages.put(gone.groupBy("id", "th").agg(F.collect_set("pos").alias("drops")), "drops")
    stages.drop("light", "lines", "templates", "blocks", "alike", "keys")
    return out


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", class_col: str | None = None, depth: int = 4, similarity: float = 0.75, part: int = 1024, stages: Stages | None = None) -> DataFrame:
    """All rows and columns with recurring lines taken out of the text; adds ``n_lines`` and ``n_dropped``.

    class_col: class of copies (long; equal for rows that repeat id and text; null: the document by itself);
    depth: leading tokens below the token count; similarity: share of equal
    tokens that joins a line to a template; part: distinct lines of a leaf that one task matches.
    """
    stages = stages or Stages(docs.sparkSession, "linededup")
    id_, th = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))), F.xxhash64(F.coalesce(text_col, F.lit("")))
    own = [F.col(class_col).cast("long").alias("c")] if class_col else []
    drops = recurring(docs.select(id_.alias("id"), th.alias("th"), F.col(text_col).alias("t"), *own), stages, depth, similarity, part)
    keyed = docs.select(F.struct("*").alias("row"), id_.alias("id"), th.alias("th"))
    text = F.col("row").getField(text_col)
    parts = F.split(text, "\n", -1)
    kept = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains("drops", i)), "\n")
    names = kept_names(docs.columns, ADDED)
    whole = {text_col: F.when(F.col("drops").isNull(), text).otherwise(kept)}
    return keyed.join(drops, ["id", "th"], "left").select(
        *[whole.get(c, F.col("row").getField(c)).alias(names[c]) for c in docs.columns],
        F.coalesce(F.size(F.filter(parts, lambda x: F.trim(x) != "")), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).alias("n_dropped"),
    )


def op8_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Recurring line templates of all documents: lines, dropped lines, and what is left of each text."""
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.length("text").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {"op8_line_dedup": op8_line_dedup}
QUERY_SQL: dict[str, str] = {}
