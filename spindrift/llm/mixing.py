"""Mixing to target weights with soft membership, in DataFrame expressions alone.

1. A table of labelled documents trains a naive Bayes classifier on words: the
   ``max_words`` words that tell the domains apart best, counted on at most
   ``max_labelled`` labelled rows (the smallest by a hash of the id).
2. It gives every document's domain posteriors p from its whole text; the
   log-likelihoods of its n known words are divided by sqrt(n), which keeps memberships soft.
3. Rates r >= 0 (<= cap, if given) minimise the squared distance of the expected
   domain token totals, sum of r * tokens * p, from the target weights' share of the budget,
   starting from r = 1. Every step of the projected gradient is one aggregation of as
   many sums as there are domains and pairs of them; the step's metric is the domains' Gram matrix
   over the rates that meet no bound, or over all rates where that went too far.
4. A document is taken floor(r + u) times, u uniform by a hash of the document.

The driver holds only domain-by-domain sums. Tokens are words between white space.

Edge cases: null and empty texts have no tokens and the prior as posterior; rows that repeat id and
text get the same result; null ids are rows like others; without labelled rows there is
one domain, "all"; target weights of unknown domains are left out and the rest
is scaled to 1; an empty table gives no rows; extra columns are kept, those named like an
added column with ``_in`` behind their name. A word that is not among the ``max_words``
best ones counts as a token, but not for the posteriors.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrift.llm.common import Stages, kept_names

ADDED = ("n_tokens", "posteriors", "rate", "copies")
SPACE = r"[ \t\n\x0b\f\r]+"


def _words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def posteriors(docs: DataFrame, labelled: DataFrame, stages: Stages, max_labelled: int, max_words: int) -> tuple[DataFrame, list[str]]:
    """``id, th, tokens, p`` (array, in the order of the domains) of all distinct documents ``id, th, t``; the domains."""
    sample = labelled.where("id is not null and domain is not null").groupBy("id").agg(F.min("domain").alias("domain")).orderBy(F.xxhash64("id")).limit(max_labelled)
    sample = stages.put(sample, "labelled")
    # One row a domain.
    prior = {r["domain"]: r["n"] for r in sample.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    domains = sorted(prior) or ["all"]
    k = len(domains)
    log_prior = [float(np.log((prior.get(d, 0) + 1) / (sum(prior.values()) + k))) for d in domains]
    counted = docs.select("id", "t").join(F.broadcast(sample), "id").select("domain", F.explode(_words(F.col("t"))).alias("w"))
    counted = counted.groupBy("w").agg(*[F.count_if(F.col("domain") == d).alias(f"n{i}") for i, d in enumerate(domains)])
    counted = stages.put(counted, "words")
    total = counted.agg(*[F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}") for i in range(k)]).first()
    every = max(1, sum(total))
    seen = sum((F.col(f"n{i}") for i in range(k)), F.lit(0))
    gain = sum(((F.col(f"n{i}") - seen * (total[i] / every)) ** 2 / (seen * ((total[i] + 1) / every)) for i in range(k)), F.lit(0.0))
    rate = F.array(*[F.log((F.col(f"n{i}") + seen / every) / (total[i] + 1)) for i in range(k)])
    best = counted.where(seen >= 5).orderBy(F.desc(gain), "w").limit(max_words).select("w", rate.alias("rate"))
    best = stages.put(best, "weights")
    # max_words rows at most: broadcast.
    hits = docs.select("id", "th", F.explode(_words(F.col("t"))).alias("w")).join(F.broadcast(best), "w")
    hits = hits.groupBy("id", "th").agg(F.count("*").alias("n"), *[F.sum(F.col("rate")[i]).alias(f"s{i}") for i in range(k)])
    logit = F.array(*[F.lit(log_prior[i]) + F.coalesce(F.col(f"s{i}") / F.sqrt("n"), F.lit(0.0)) for i in range(k)])
    sized = docs.select("id", "th", F.size(_words(F.col("t"))).cast("double").alias("tokens"))
    joined = sized.join(hits, ["id", "th"], "left").withColumn("z", logit)
    joined = joined.withColumn("e", F.transform("z", lambda x: F.exp(x - F.array_max("z"))))
    norm = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    return stages.put(joined.select("id", "th", "tokens", F.transform("e", lambda x: x / norm).alias("p")), "posteriors"), domains


def fit_rates(members: DataFrame, weights: list[float], *, budget: float | None = None, cap: float | None = None, rounds: int = 40, tolerance: float = 1e-6) -> tuple[Column, dict]:
    """The rate as an expression on ``p``, and what was reached. members: ``tokens, p``.

    budget: total tokens; None: all tokens, or, under a cap, as many as the scarcest domain allows.
    """
    k = len(weights)
    a = [F.col("tokens") * F.col("p")[i] for i in range(k)]
    row = members.agg(*[F.coalesce(F.sum(x), F.lit(0.0)) for x in a], *[F.coalesce(F.sum(a[i] * F.col("p")[j]), F.lit(0.0)) for i in range(k) for j in range(k)]).first()
    total, gram = np.array(row[:k]), np.array(row[k:]).reshape(k, k)
    weights = np.array(weights) / sum(weights)
    if budget is None:
        budget = float(min(t / w for t, w in zip(total, weights, strict=True) if w > 0)) * cap if cap is not None else float(total.sum())
    target = weights * budget
    steps: list[list[float]] = []

    def rate() -> Column:
        if not steps:
            return F.lit(1.0 if cap is None else min(1.0, cap))
        table = F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in steps])

        def step(r: Column, s: Column) -> Column:
            r = F.greatest(F.lit(0.0), r - sum((F.col("p")[i] * s[i] for i in range(k)), F.lit(0.0)))
            return r if cap is None else F.least(F.lit(float(cap)), r)

        return F.aggregate(table, F.lit(1.0 if cap is None else min(1.0, cap)), step)

    r, top = F.col("r"), F.lit(float("inf") if cap is None else float(cap))
    free = (r > 0) & (r < top)
    sums = [F.coalesce(F.sum(r * x), F.lit(0.0)) for x in a]
    sums += [F.coalesce(F.sum(F.when(free, a[i] * F.col("p")[j])), F.lit(0.0)) for i in range(k) for j in range(k)]
    last, plain, got = np.inf, False, target
    for _ in range(rounds):
        row = np.array(members.select(rate().alias("r"), "tokens", "p").agg(*sums).first())
        now, inner = row[:k], row[k:].reshape(k, k)
        off = np.abs(now - target).max()
        if off > last and not plain:  # too far: from the state before, the step of the whole Gram matrix, which can't overshoot
            steps.pop()
            plain, inner = True, gram
        else:
            got, last, plain = now, min(off, last), False
        if budget <= 0 or last <= tolerance * budget:
            break
        step = np.linalg.pinv(gram if plain else inner + 1e-6 * gram, rcond=1e-12) @ (got - target)
        if np.abs(step).max() < 1e-9:  # the bounds allow no better fit
            break
        steps.append(list(step))
    return rate(), {"target": target, "got": got, "steps": len(steps)}


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], *, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain", budget: float | None = None, cap: float | None = None, max_labelled: int = 20_000, max_words: int = 2000) -> DataFrame:
    """All rows and columns with ``n_tokens, posteriors (map), rate, copies``."""
    stages = Stages(docs.sparkSession, "mixing")
    id_, th = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))), F.xxhash64(F.coalesce(text_col, F.lit("")))
    own = docs.select(id_.alias("id"), th.alias("th"), F.col(text_col).alias("t"))
    labelled = labelled.select(F.col(id_col).cast("long").alias("id"), F.col(domain_col).alias("domain"))
    members, domains = posteriors(own, labelled, stages, max_labelled, max_words)
    wanted = [weights.get(d, 0.0) for d in domains]
    rate, _ = fit_rates(members, wanted if sum(wanted) else [1.0] * len(domains), budget=budget, cap=cap)
    chance = F.pmod(F.xxhash64("id", "th", F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)
    rated = members.dropDuplicates(["id", "th"]).withColumn("rate", rate).select(
        F.col("id").alias("__id"), F.col("th").alias("__th"), F.col("tokens").cast("long").alias("n_tokens"),
        F.map_from_arrays(F.array(*map(F.lit, domains)), "p").alias("posteriors"), "rate", F.floor(F.col("rate") + chance).cast("int").alias("copies"),
    )
    names = kept_names(docs.columns, ADDED)
    keyed = docs.select(F.struct("*").alias("row"), id_.alias("__id"), th.alias("__th"))
    return keyed.join(stages.finish(rated, "rated"), ["__id", "__th"]).select(*[F.col("row").getField(c).alias(names[c]) for c in docs.columns], *ADDED)


def by_quality_and_toxicity(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", F.concat(F.when(F.col("quality") == 1, "good").otherwise("poor"), F.when(F.col("toxic") == 1, "-toxic").otherwise("-clean")).alias("domain"))


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    """Rates of all documents for four domains, by the labels' quality and toxicity, at the corpus' size."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labelled = by_quality_and_toxicity(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = mix(docs, labelled, {"good-clean": 0.8, "poor-clean": 0.1, "good-toxic": 0.06, "poor-toxic": 0.04})
    return out.select("doc_id", "n_tokens", "rate", "copies", *[F.col("posteriors")[d].alias(d.replace("-", "_")) for d in ("good-clean", "good-toxic", "poor-clean", "poor-toxic")])


QUERIES = {"op5_mixing": op5_mixing}
QUERY_SQL: dict[str, str] = {}
