"""Roll-ups over parsed outlines, and the registered queries over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrift.operators.outline import parse, with_parents
from spindrift.sources.outline import lines


def rollup_by_group(tasks: DataFrame) -> DataFrame:
    """Open, done and cancelled descendants of each group, without the group's own line."""
    count = lambda s: F.count_if((F.col("status") == s) & F.col("parent_line").isNotNull()).alias(f"n_{s}")
    return (
        tasks.groupBy("file", "root_line")
        .agg(F.max(F.when(F.col("line_no") == F.col("root_line"), F.col("title"))).alias("root"), *map(count, ("open", "done", "cancelled")))
        .where("n_open + n_done + n_cancelled > 0")
    )


def by_month(tasks: DataFrame) -> DataFrame:
    """Stamped tasks by month and status."""
    return tasks.where("stamped_at is not null").groupBy(F.date_format("stamped_at", "yyyy-MM").alias("month"), "status").agg(F.count("*").alias("n"))


def _order_groups(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    """``orders`` as lines of outlines (dates moved on by 20 years, as stamps are of this century): for each of the keys and each order status a group, a task an order, and a note below each task."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    glyph = F.expr("case o_orderstatus when 'F' then '✔' when 'P' then '✘' else '☐' end")
    stamp = F.expr(
        "case o_orderstatus when 'F' then concat(' @done(', date_format(o_orderdate + interval 20 years, 'yy-MM-dd HH:mm'), ')')"
        " when 'P' then concat(' @cancelled(', date_format(o_orderdate + interval 20 years, 'yy-MM-dd HH:mm'), ')') else '' end"
    )
    task = F.concat(F.lit("        "), glyph, F.lit(" order "), "o_orderkey", stamp, F.lit("\n          ☐ check @"), F.substring("o_orderpriority", 3, 1))
    groups = orders.groupBy(*keys, "o_orderstatus").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", task.alias("t")))).alias("ts"))
    return groups.withColumn("b", F.concat(F.lit("    ☐ "), "o_orderstatus", F.lit("\n"), F.array_join(F.transform("ts", lambda x: x["t"]), "\n")))


def _joined(groups: DataFrame, by: str, order: str, text: str) -> DataFrame:
    return groups.groupBy(*by.split()).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, text))), lambda x: x[text]), "\n").alias("text"))


def order_outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One outline a customer, under one heading."""
    files = _joined(_order_groups(spark, sf_dir, "o_custkey"), "o_custkey", "o_orderstatus", "b")
    return files.withColumn("text", F.concat(F.lit("Orders:\n"), "text"))


def sectioned_outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One outline a customer, a heading an order priority."""
    parts = _joined(_order_groups(spark, sf_dir, "o_custkey", "o_orderpriority"), "o_custkey o_orderpriority", "o_orderstatus", "b")
    parts = parts.withColumn("s", F.concat(F.lit("  "), "o_orderpriority", F.lit(":\n"), "text"))
    return _joined(parts, "o_custkey", "o_orderpriority", "s")


def _tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_parents(parse(lines(order_outlines(spark, sf_dir), "o_custkey", "text")), [4, 8, 10])


def outline_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = parse(lines(order_outlines(spark, sf_dir), "o_custkey", "text"))
    return tasks.groupBy("section", "indent", "status").agg(F.count("*").alias("n"))


def outline_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = parse(lines(order_outlines(spark, sf_dir), "o_custkey", "text"))
    return tasks.where("indent = 8").select("file", "title", "status", F.date_format("stamped_at", "yyyy-MM-dd HH:mm").alias("stamp"))


def outline_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = _tasks(spark, sf_dir)
    return tasks.groupBy("file", "indent").agg(F.count("parent_line").alias("n_with_parent"), F.sum(F.col("line_no") - F.col("parent_line")).alias("sum_distance"))


def outline_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup_by_group(_tasks(spark, sf_dir)).select("file", "root", "n_open", "n_done", "n_cancelled")


def outline_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = parse(lines(order_outlines(spark, sf_dir), "o_custkey", "text"))
    return tasks.select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


def outline_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_month(parse(lines(order_outlines(spark, sf_dir), "o_custkey", "text")))


def outline_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks under several headings a file; the levels are gathered from the lines."""
    tasks = with_parents(parse(lines(sectioned_outlines(spark, sf_dir), "o_custkey", "text")))
    return tasks.groupBy("file", "section", "indent").agg(F.count("*").alias("n"), F.countDistinct("root_line").alias("n_roots"), F.sum(F.col("line_no") - F.col("parent_line")).alias("sum_distance"))


QUERIES = {f.__name__: f for f in (outline_status, outline_tasks, outline_parents, outline_rollup, outline_tags, outline_months, outline_sections)}

_ORD = "(select o_custkey, o_orderkey, o_orderstatus s, o_orderdate + interval 20 year d, substr(o_orderpriority, 3, 1) p from orders)"
_STATUS = "case s when 'F' then 'done' when 'P' then 'cancelled' else 'open' end"

ORACLE_SQL = {
    "outline_status": f"""
        select 'Orders' as section, 4 as indent, 'open' as status, count(*) as n from (select distinct o_custkey, s from {_ORD}) having count(*) > 0
        union all select 'Orders', 8, {_STATUS}, count(*) from {_ORD} group by 3
        union all select 'Orders', 10, 'open', count(*) from {_ORD} having count(*) > 0""",
    "outline_tasks": f"""
        select o_custkey as file, 'order ' || o_orderkey as title, {_STATUS} as status,
            case when s in ('F', 'P') then strftime(d, '%Y-%m-%d %H:%M') end as stamp from {_ORD}""",
    "outline_parents": f"""
        with g as (select o_custkey, s, count(*) n from {_ORD} group by 1, 2)
        select o_custkey as file, 4 as indent, 0::bigint as n_with_parent, null::bigint as sum_distance from g group by 1
        union all select o_custkey, 8, sum(n)::bigint, sum(n * n)::bigint from g group by 1
        union all select o_custkey, 10, sum(n)::bigint, sum(n)::bigint from g group by 1""",
    "outline_rollup": f"""
        select o_custkey as file, s as root, count(*) + count(*) filter (s not in ('F', 'P')) as n_open,
            count(*) filter (s = 'F') as n_done, count(*) filter (s = 'P') as n_cancelled from {_ORD} group by 1, 2""",
    "outline_tags": f"""
        select tag, count(*) as n from (select p as tag from {_ORD} union all
            select case s when 'F' then 'done' else 'cancelled' end from {_ORD} where s in ('F', 'P')) group by 1""",
    "outline_months": f"""
        select strftime(d, '%Y-%m') as month, {_STATUS} as status, count(*) as n from {_ORD} where s in ('F', 'P') group by 1, 2""",
    "outline_sections": """
        with g as (select o_custkey as file, o_orderpriority as section, o_orderstatus, count(*) n from orders group by all)
        select file, section, 4 as indent, count(*) as n, count(*) as n_roots, null::bigint as sum_distance from g group by 1, 2
        union all select file, section, 8, sum(n)::bigint, count(*), sum(n * n)::bigint from g group by 1, 2
        union all select file, section, 10, sum(n)::bigint, count(*), sum(n)::bigint from g group by 1, 2""",
}
