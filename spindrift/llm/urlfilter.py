"""URL filter: a blocked Bloom filter passes possible hits to an exact hash join.

The list holds rules (host and path prefix, allow or block) and canonical URLs
to block. Every entry is one key, ``host/path``; a URL asks for the keys of
each of its host's suffixes with each of its path's prefixes that is as long
as some listed path, and for its canonical form. A split-block Bloom filter (256-bit
blocks, eight bits a key, one a word) answers most of these without a shuffle;
its size is at most MAX_BLOCKS blocks (8 MB), so it is broadcast, and a
longer list only makes more false positives. Possible hits meet the list in an exact join
on the key, which removes them. The longest fitting rule wins, then the one with the
longer host, then block; a listed canonical URL counts where no rule fits.
All of it is DataFrame expressions.

Edge cases: a null url, or one without ``://``, has empty host and path and
is allowed; an empty host fits no rule; rows that repeat stay apart; an empty
list allows all; null entries of the list are left out; other columns of the
pages are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_BLOCKS = 1 << 18
#: Odd multipliers of the eight words; fixed values of this filter's layout.
SALTS = (0x47B6137B, 0x44974D91, 0x0824AD5B, 0x22B7289D, 0x705495C7, 0x2DF1424B, 0x1EFC4947, 0x5C6BFB31)


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.`` and path without a final slash, marked so that it is no rule's key; null for an empty host."""
    return F.when(host != "", F.concat(F.lit("="), F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, r"/$", "")))


def _bits(key: Column) -> list[Column]:
    h = F.shiftrightunsigned(F.xxhash64(key), 33)
    return [F.shiftrightunsigned((h * F.lit(s)).bitwiseAND(F.lit(0xFFFFFFFF)), 27).cast("int") for s in SALTS]


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(n_blocks)).cast("int")


def bloom(keys: DataFrame, n_blocks: int) -> DataFrame:
    """``block, w0 .. w7`` of the keys' filter: at most n_blocks rows."""
    words = [F.bit_or(F.expr(f"shiftleft(1, b{i})")).alias(f"w{i}") for i in range(8)]
    return keys.select(_block(F.col("key"), n_blocks).alias("block"), *[b.alias(f"b{i}") for i, b in enumerate(_bits(F.col("key")))]).groupBy("block").agg(*words)


def possible(asked: DataFrame, listing: DataFrame, n_blocks: int) -> DataFrame:
    """The rows whose ``key`` passes the filter of the listing's keys: all that are listed, and some false positives."""
    tested = asked.withColumn("block", _block(F.col("key"), n_blocks)).join(F.broadcast(bloom(listing, n_blocks)), "block")
    for i, b in enumerate(_bits(F.col("key"))):
        tested = tested.where(F.getbit(f"w{i}", b) == 1)
    return tested.select(asked.columns)


def judge(pages: DataFrame, rules: DataFrame, listed: DataFrame, *, id_col: str = "page_id", url_col: str = "url", bits_per_key: int = 16) -> DataFrame:
    """``<id>, host, path, rule, verdict, listed`` for every page.

    rules: ``host, path, verdict``; listed: ``url``, the URLs to block.
    """
    u = pages.select(F.col(url_col).alias("url")).where("url is not null").distinct()
    at = lambda df: df.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    exact = at(listed.select("url")).select(canonical(F.col("host"), F.col("path")).alias("key")).where("key is not null").distinct()
    listing = rules.where("host is not null and path is not null and verdict is not null").select(
        F.concat("host", "path").alias("key"), F.length("host").alias("n_host"), "verdict", F.lit(True).alias("is_rule")
    )
    n = listing.count() + exact.count()
    n_blocks = min(MAX_BLOCKS, max(1, -(-n * bits_per_key // 256)))
    # Lengths of the listed paths: a handful of integers, at most as many as the longest path has characters.
    lengths = sorted(r["n"] for r in rules.where("path is not null").select(F.length("path").alias("n")).distinct().collect())
    listing = listing.unionByName(exact.select("key", F.lit(0).alias("n_host"), F.lit("block").alias("verdict"), F.lit(False).alias("is_rule")))

    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(F.array(*[F.lit(x) for x in lengths]).cast("array<int>"), lambda n: F.when(n <= F.length("path"), F.substr("path", F.lit(1), n)))
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(F.array_compact(prefixes), lambda p: F.concat(s, p))))
    asked = at(u).where("host <> ''").select("url", F.explode(F.array_append(keys, canonical(F.col("host"), F.col("path")))).alias("key"))
    tested = possible(asked, listing, n_blocks)
    best = F.max(F.struct("is_rule", F.length("key").alias("n"), "n_host", "verdict", "key"))
    hits = tested.join(listing, "key").groupBy("url").agg(best.alias("hit"))
    own = at(pages.select(id_col, F.col(url_col).alias("url")))
    # Null urls, however many, don't meet in the join.
    judged = own.where("url is not null").join(hits, "url", "left").unionByName(own.where("url is null"), allowMissingColumns=True)
    return judged.select(
        id_col, "host", "path", F.when(F.col("hit.is_rule"), F.col("hit.key")).alias("rule"),
        F.coalesce("hit.verdict", F.lit("allow")).alias("verdict"), F.coalesce(~F.col("hit.is_rule"), F.lit(False)).alias("listed"),
    )


RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def blocklist(spark, sf_dir: str) -> DataFrame:
    """The query's list ``url``: a stand-in for an outside list, as the tables hold none.

    A URL of each customer's site, none of which is crawled, and of the crawled URLs those whose canonical form has an md5 that begins with 0.
    """
    crawled = spark.read.parquet(f"{sf_dir}/pages.parquet").select("url")
    taken = crawled.where(F.md5(canonical(host(F.col("url")), path(F.col("url"))).cast("binary")).startswith("0"))
    key = F.col("c_custkey").cast("string")
    sites = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.concat(F.lit("http://c"), key, F.lit(".example.org/fr/"), key).alias("url"))
    return taken.unionByName(sites)


def op2_url_filter(spark, sf_dir: str) -> DataFrame:
    """Judge every page's URL by five rules and the list."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules, blocklist(spark, sf_dir))


QUERIES = {"op2_url_filter": op2_url_filter}
QUERY_SQL = {
    "op2_url_filter": f"""
        with a as (select page_id, case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) else '' end as r from pages),
        h as (select page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') as host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) as path from a),
        c as (select *, regexp_replace(host, '^www\\.', '') || regexp_replace(path, '/$', '') as canon from h),
        l as (select distinct canon from c where host <> '' and starts_with(md5('=' || canon), '0')
            union select 'c' || c_custkey || '.example.org/fr/' || c_custkey from customer),
        rules(rh, rp, v) as (values {', '.join(map(repr, RULES))}),
        m as (select page_id, host, path, canon, max(struct_pack(n := length(rh || rp), m := length(rh), v := v, rule := rh || rp)) as best
            from (select distinct page_id, host, path, canon from c) left join rules on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) group by 1, 2, 3, 4)
        select c.page_id, c.host, c.path, best.rule as rule, coalesce(best.v, case when l.canon is not null then 'block' else 'allow' end) as verdict,
            best.rule is null and l.canon is not null as listed
        from c join m using (page_id, host, path) left join l on l.canon = c.canon and c.host <> ''"""
}
