"""Toxicity by weak supervision.

1. Terms (words, and stems ``abcd*`` of four to six letters) that labelled
   documents of the learning folds show almost only when toxic are counted on
   at most ``max_labelled`` labelled rows.
2. One pass over all documents notes which terms each whole text holds, and its shape.
3. Voters: groups of terms (lexicon words, stem patterns) that vote toxic, and
   patterns of the whole text (no term at all, several terms, a dense share of terms,
   shouting, junk marks). A generative label model with vote rates for each class
   (the voters' accuracies) and their correlations within a class is fitted by EM to the votes of all documents; it starts from the labelled
   rows. Votes are summed by vote pattern before they are gathered as moments.
4. A logistic regression on the terms is trained on the label model's posterior
   labels of at most ``max_train`` documents, and scores every document.

Labels, lang, source and doc_id are never inputs of a score; the id chooses folds
and samples only.

Edge cases: null and empty texts hold no term and get the score of that; rows
with a null id get a score and are held out; rows that repeat stay apart; without usable labels (none,
or one class) every score is the smoothed share of toxic labels; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrift.llm.common import Stages

WORD = re.compile(r"[^\W\d_]+")
STEMS = (4, 5, 6)
FOLDS = 5
SHAPES = 5


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def terms_of(words: set[str]) -> set[str]:
    out = {w for w in words if len(w) > 2}
    for n in STEMS:
        out.update(w[:n] + "*" for w in words if len(w) >= n)
    return out


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    every, toxic = Counter(), Counter()

    def flush() -> pa.RecordBatch:
        names = list(every)
        out = pa.record_batch({"term": pa.array(names, pa.string()), "n": pa.array([every[t] for t in names], pa.int64()), "n_toxic": pa.array([toxic[t] for t in names], pa.int64())})
        every.clear()
        toxic.clear()
        return out

    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            terms = terms_of(set(WORD.findall((text or "").lower())))
            every.update(terms)
            if label:
                toxic.update(terms)
            if len(every) > 500_000:
                yield flush()
    yield flush()


def _note(terms: dict[str, int]):
    """Which terms a text holds, its number of words, and how many marks and capitals it has."""
    words_only = {t: i for t, i in terms.items() if not t.endswith("*")}
    stems = {n: {t[:-1]: i for t, i in terms.items() if t.endswith("*") and len(t) == n + 1} for n in STEMS}
    stems = {n: s for n, s in stems.items() if s}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, n_words, n_hits, shout, marks = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                words = WORD.findall(text.lower())
                found: set[int] = set()
                strong: set[str] = set()
                for w in set(words):
                    if w in words_only:
                        found.add(words_only[w])
                        strong.add(w)
                    for n, s in stems.items():
                        i = s.get(w[:n])
                        if i is not None:
                            found.add(i)
                            strong.add(w)
                hits.append(sorted(found))
                n_words.append(len(words))
                n_hits.append(len(strong) and sum(w in strong for w in words))
                shout.append(text.isupper())
                marks.append(sum(map(text.count, "#$%&*!")))
            yield pa.record_batch({
                "doc_id": batch.column(0), "hits": pa.array(hits, pa.list_(pa.int32())), "n_words": pa.array(n_words, pa.int32()),
                "n_hits": pa.array(n_hits, pa.int32()), "shout": pa.array(shout, pa.bool_()), "marks": pa.array(marks, pa.int32()),
                **dict(zip(batch.schema.names[2:], batch.columns[2:], strict=True)),
            })

    return run


NOTED = ("hits", "n_words", "n_hits", "shout", "marks")
NOTES = "doc_id long, hits array<int>, n_words int, n_hits int, shout boolean, marks int"


def _shape(hits: int, n_words: int, n_hits: int, shout: bool, marks: int) -> int:
    """Votes on the whole text, as bits: no term, several terms, dense terms, shouting, junk."""
    return (hits == 0) | (n_hits >= 3) << 1 | (n_hits * 100 >= 2 * max(n_words, 1)) << 2 | bool(shout) << 3 | (marks * 4 > n_words > 0) << 4


def _masks(voter: np.ndarray):
    bit = [1 << (SHAPES + int(v)) for v in voter]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = Counter()
            for hits, *rest in zip(*(c.to_pylist() for c in batch.select(list(NOTED)).columns), strict=True):
                m = _shape(len(hits), *rest)
                for h in hits:
                    m |= bit[h]
                masks[m] += 1
            yield pa.record_batch({"mask": pa.array(list(masks), pa.int64()), "n": pa.array(list(masks.values()), pa.int64())})

    return run


def _votes(masks: np.ndarray, m: int) -> np.ndarray:
    return (masks[:, None] >> np.arange(m) & 1).astype("f8")


class LabelModel:
    """Vote rates of both classes (the voters' accuracies) and the votes' correlations within a class.

    A voter's log-likelihood ratio counts less the more its votes go along with other voters'.
    """

    def __init__(self, prior: float, clean: np.ndarray, toxic: np.ndarray, corr: np.ndarray):
        self.prior, self.clean, self.toxic, self.corr = prior, clean, toxic, corr
        share = 1 / np.clip(corr, 0, 1).sum(1)  # the diagonal is 1
        yes, no = np.log(toxic / clean) * share, np.log((1 - toxic) / (1 - clean)) * share
        self.weight, self.bias = yes - no, np.log(prior / (1 - prior)) + no.sum()

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(votes @ self.weight + self.bias, -30, 30)))

    @classmethod
    def of_moments(cls, prior: float, t: np.ndarray) -> LabelModel:
        """t: documents, toxic ones, votes, votes of toxic ones, votes of each pair, one after the other."""
        m = int(np.sqrt(len(t) - 1)) - 1
        n, n1, s, s1, ss = t[0], t[1], t[2 : 2 + m], t[2 + m : 2 + 2 * m], t[2 + 2 * m :].reshape(m, m)
        rate = lambda k, n: np.clip((k + 0.5 * s / n_all) / (n + 1), 1e-5, 1 - 1e-5)
        n_all = max(n, 1)
        toxic, clean = rate(s1, n1), rate(s - s1, n - n1)
        cov = (ss - n1 * np.outer(toxic, toxic) - (n - n1) * np.outer(clean, clean)) / n_all
        sd = np.sqrt(np.clip(np.diag(cov), 1e-9, None))
        corr = cov / np.outer(sd, sd)
        np.fill_diagonal(corr, 1.0)
        return cls(prior, clean, toxic, corr)


def _moments_of(votes: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.concatenate([[n.sum(), (p * n).sum()], n @ votes, (p * n) @ votes, ((votes * n[:, None]).T @ votes).ravel()])


def _moments(model: LabelModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = len(model.clean)
        total = np.zeros((m + 1) ** 2 + 1)
        for batch in batches:
            n, x = batch.column(1).to_numpy().astype("f8"), _votes(batch.column(0).to_numpy(), m)
            total += _moments_of(x, n, model.posterior(x))
        yield pa.record_batch({"k": np.arange(len(total)), "v": total})

    return run


def fit_label_model(patterns: DataFrame, prior: float, known: np.ndarray, rounds: int = 4) -> LabelModel:
    """EM over the counts of vote patterns, with the labelled rows' moments added as known; only sums of fixed size reach the driver."""
    model = LabelModel.of_moments(prior, known)
    for _ in range(rounds):
        t = known.copy()
        for r in patterns.mapInArrow(_moments(model), "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
            t[r["k"]] += r["v"]
        model = LabelModel.of_moments(prior, t)
    return model


def _logistic(rows: list[list[int]], y: np.ndarray, n_terms: int, l2: float = 1e-4, steps: int = 300) -> tuple[np.ndarray, float]:
    """Accelerated gradient descent on the sparse term matrix, a column for 'no term' included."""
    x = [h or [n_terms] for h in rows]
    r = np.repeat(np.arange(len(x)), [len(h) for h in x])
    c = np.concatenate([np.asarray(h, "i8") for h in x])
    w, b, vw, vb = np.zeros(n_terms + 1), 0.0, np.zeros(n_terms + 1), 0.0
    rate = 4.0 / max(1.0, np.bincount(r).max())
    for _ in range(steps):
        aw, ab = w + 0.9 * vw, b + 0.9 * vb
        g = (1 / (1 + np.exp(-np.clip(np.bincount(r, aw[c], len(x)) + ab, -30, 30))) - y) / len(x)
        vw, vb = 0.9 * vw - rate * (np.bincount(c, g[r], n_terms + 1) + l2 * aw), 0.9 * vb - rate * g.sum()
        w, b = w + vw, b + vb
    return w, b


def _scores(weights: np.ndarray, bias: float):
    n = len(weights) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = np.array([weights[h].sum() if h else weights[n] for h in batch.column(1).to_pylist()]) + bias
            yield pa.record_batch({"doc_id": batch.column(0), **dict(zip(batch.schema.names[2:], batch.columns[2:], strict=True)), "score": 1 / (1 + np.exp(-np.clip(z, -30, 30)))})

    return run


def smallest(rows: DataFrame, most: int, stages: Stages) -> DataFrame:
    """The ``most`` rows of least hash of the id, as a stage.

    Collecting an ordered limit sends that many rows of every task to the driver. Here little more
    than ``most`` rows below a bound meet in a task; the bound rises while it lets too few of them through.
    """
    h, n = F.xxhash64("doc_id"), rows.count()
    share = (most + 6 * most**0.5) / max(n, 1)
    while True:
        low = rows.where(h <= int(share * 2**64) - 2**63) if share < 1 else rows
        out = stages.put(low.orderBy(h).limit(most), "smallest")
        if share >= 1 or out.count() >= most:
            return out
        share *= 2


def score(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", row_col: str | None = None, max_labelled: int = 20_000, max_terms: int = 2000, min_share: float = 0.02, n_voters: int = 40, max_train: int = 40_000, stages: Stages | None = None) -> DataFrame:
    """``doc_id, score`` for every row.

    row_col: number of a row (long), in the result as ``row``, where ids repeat or are null;
    max_labelled: labelled rows that terms are learnt from, the smallest by a hash
    of the id; min_share: share of the toxic ones that a term must occur in; max_train: documents, chosen alike, for the classifier.
    """
    spark = docs.sparkSession
    stages = stages or Stages(spark, "toxicity")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *([F.col(row_col).cast("long").alias("row")] if row_col else []))
    known = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"))
        .limit(max_labelled)
    )
    known = stages.put(known, "known")
    seen = own.join(F.broadcast(known), "doc_id")  # at most max_labelled rows
    counts = seen.select("text", "y").mapInArrow(_count_terms, "term string, n long, n_toxic long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("k"))
    n_known, n_toxic = (known.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first())
    sure = (F.col("k") + 0.2) / (F.col("n") + 2)
    rows = counts.where((sure >= 0.7) & (F.col("k") >= max(4, min_share * n_toxic))).orderBy(F.desc("k"), "term").limit(max_terms).collect()  # at most max_terms
    terms = {r["term"]: i for i, r in enumerate(rows)}
    prior = (n_toxic + 1) / (n_known + 4)
    notes = stages.put(own.mapInArrow(_note(terms), f"{NOTES}, row long" if row_col else NOTES), "notes")
    own = ["row"] if row_col else []
    if not terms:
        return notes.select("doc_id", *own, F.lit(float(prior)).alias("score"))

    # Voters: the term that covers most toxic documents not covered so far starts each group; the others join the group they share most documents with.
    labelled = notes.join(F.broadcast(known), "doc_id").select("y", *NOTED).collect()  # at most max_labelled rows without texts
    sets: list[set[int]] = [set() for _ in terms]
    for d, r in enumerate(labelled):
        if r["y"]:
            for h in r["hits"]:
                sets[h].add(d)
    left = set().union(*sets)
    heads: list[int] = []
    while len(heads) < n_voters and left:
        best = max(range(len(sets)), key=lambda i: (len(sets[i] & left), -i))
        if not sets[best] & left:
            break
        heads.append(best)
        left -= sets[best]
    voter = np.array([max(range(len(heads)), key=lambda g: (len(s & sets[heads[g]]) / (1 + len(s | sets[heads[g]])), -g)) for s in sets])
    m = SHAPES + len(heads)

    patterns = stages.put(notes.mapInArrow(_masks(voter), "mask long, n long").groupBy("mask").agg(F.sum("n").alias("n")), "patterns")
    bit = [1 << (SHAPES + int(v)) for v in voter]
    mask_of = lambda r: _shape(len(r["hits"]), r["n_words"], r["n_hits"], r["shout"], r["marks"]) | int(np.bitwise_or.reduce(np.array([bit[h] for h in r["hits"]], "i8"), initial=0))
    x = _votes(np.array([mask_of(r) for r in labelled], "i8"), m)
    y = np.array([r["y"] for r in labelled], "f8")
    model = fit_label_model(patterns, prior, _moments_of(x, np.ones(len(y)), y))

    train = smallest(notes.where(F.col("doc_id").isNotNull()), max_train, stages).select(*NOTED).collect()  # at most max_train rows without texts
    train = [*labelled, *train]
    posterior = model.posterior(_votes(np.array([mask_of(r) for r in train], "i8"), m))
    weights, bias = _logistic([r["hits"] for r in train], posterior, len(terms))
    return notes.select("doc_id", "hits", *own).mapInArrow(_scores(weights, bias), "doc_id long, row long, score double" if row_col else "doc_id long, score double")


def judged(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    return score(docs, labels, **options).select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    """Score every document; labels of the fold with remainder 0 are never read by the learner."""
    return judged(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op9_toxicity": op9_toxicity}
QUERY_SQL: dict[str, str] = {}
