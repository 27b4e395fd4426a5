import duckdb
import pytest
from pyspark.sql import functions as F

from spindrift.operators.outline import parse, with_parents
from spindrift.plans import outline
from spindrift.plans.outline import rollup_by_group
from spindrift.sources.outline import lines, read_outline, write_outline
from spindrift.streaming.outline import follow

TEXT = """Garden:
    ☐ Beds
        ✔ dig @done(25-01-02 10:00)
          ✔ stones @done(25-01-02 10:00)
          ☐ compost: half／done @today @low
    ☐  Shed
        ✘ paint
        ✔ dig @done(25-13-02 10:00)
  Done:
    ✔ sow @ noon, see @done(24-12-31 23:59)"""


@pytest.fixture(scope="module")
def tasks(spark):
    df = spark.createDataFrame([("a", TEXT), ("b", ""), ("c", None)], "f string, t string")
    return with_parents(parse(lines(df, "f", "t"))).cache()


def test_parse(tasks):
    rows = {r.line_no: r for r in tasks.collect()}
    assert sorted(rows) == [2, 3, 4, 5, 6, 7, 8, 10]
    assert [rows[i].status for i in sorted(rows)] == ["open", "done", "done", "open", "open", "cancelled", "done", "done"]
    assert rows[6].title == "Shed" and rows[5].tags == ["today", "low"] and rows[10].tags == ["done"]
    assert rows[8].stamped_at is None and str(rows[3].stamped_at) == "2025-01-02 10:00:00"
    assert rows[10].section == "Done" and rows[3].section == "Garden"


def test_parents_and_rollup(tasks):
    rows = {r.line_no: (r.parent_line, r.root_line) for r in tasks.collect()}
    assert rows == {2: (None, 2), 3: (2, 2), 4: (3, 2), 5: (3, 2), 6: (None, 6), 7: (6, 6), 8: (6, 6), 10: (None, 10)}
    assert sorted(map(tuple, rollup_by_group(tasks).select("root", "n_open", "n_done", "n_cancelled").collect())) == [("Beds", 1, 2, 0), ("Shed", 0, 1, 1)]


def test_files_and_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.todo").write_text(TEXT)
    (tmp_path / "in/007").write_text("Next:\n    ☐ 读书 @重要\n")
    read = read_outline(spark, str(tmp_path / "in")).withColumn("file", F.element_at(F.split("file", "/"), -1))
    write_outline(read.coalesce(1), str(tmp_path / "out"))
    again = read_outline(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, read.collect())) and again.select("file").distinct().count() == 2
    assert parse(again).where("file = '007'").first().tags == ["重要"]
    follow(spark, str(tmp_path / "in"), str(tmp_path / "roll"), str(tmp_path / "ck")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "roll")).count() == 2  # "Next" has no group


@pytest.mark.parametrize("name", sorted(outline.QUERIES))
def test_queries_match_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view orders as select * from '{sf}/orders.parquet'")
    got = outline.QUERIES[name](spark, sf)
    want = con.execute(f"select {', '.join(got.columns)} from ({outline.ORACLE_SQL[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want)) and want
