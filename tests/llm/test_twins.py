"""Brute-force twins of operators that SQL cannot tell, and edge rows."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from spindrift.llm import common, embdedup, linededup, minhash, mixing, packing, repeats, toxicity, urlfilter

SF = "/root/testdata/sf0.01"


def exact_components(rows, words, percent):
    """Exact similarity join: an index on the rarest shingles, which two similar sets can't but share."""
    sets = {i: minhash.shingles(t, words) for i, t in rows}
    freq = collections.Counter(x for s in sets.values() for x in s)
    root, index = {i: i for i in sets}, collections.defaultdict(list)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in sets.items():
        cand = set()
        for x in sorted(s, key=lambda x: (freq[x], x))[: len(s) - math.ceil(percent * len(s) / 100) + 1]:
            cand.update(index[x])
            index[x].append(i)
        for j in cand:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("options", [{}, {"crowded": 8, "block": 8}])
def test_near_duplicates_equal_an_exact_join(spark, options):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    want = exact_components([tuple(r) for r in docs.collect()], 4, 80)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, words=4, **options).collect()}
    assert got == want and any(c != i for i, (_, c) in want.items())


def tree(rows, depth=4, least=0.75, classes=None):
    """Single-process line dedup of (id, text) with distinct ids: kept texts. classes: of copies, by id; else each document is its own."""
    hashes = {}
    of = classes or {i: i for i, _ in rows}

    def mask(line):
        tokens = [t for t in re.split("[ \t\r\x0b\x0c]+", line) if t]
        return tuple("<*>" if re.search("[0-9@]|://", t) else t for t in tokens)

    lines = [(i, p, mask(x), x) for i, t in rows for p, x in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if x[2]]
    for h, m in hashes_of({" ".join(x[2]) for x in lines}).items():
        hashes[m] = h
    leaves = collections.defaultdict(set)
    for _, _, m, _ in lines:
        leaves[len(m), m[:depth]].add(m)
    template = {}
    for leaf, members in leaves.items():
        found = []
        for m in sorted(members, key=lambda m: hashes[" ".join(m)]):
            same = [sum(a == b for a, b in zip(m, t, strict=True)) for t in found]
            best = max(range(len(found)), key=lambda k: (same[k], -k), default=None)
            if best is None or same[best] < least * len(m):
                best = len(found)
                found.append(list(m))
            else:
                found[best] = [a if a == b else None for a, b in zip(found[best], m, strict=True)]
            template[m] = (leaf, best)
    places = collections.defaultdict(list)
    for i, p, m, _ in lines:
        places[template[m]].append((i, p))
    gone = set()
    for v in places.values():
        if len({of[i] for i, _ in v}) > 1:
            # The class of the first place keeps the line, once in a document.
            stay = {i: p for i, p in sorted(v, reverse=True) if of[i] == of[min(v)[0]]}
            gone.update((i, p) for i, p in v if stay.get(i) != p)
    return {i: None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if (i, p) not in gone) for i, t in rows}


_SPARK = []


def hashes_of(lines):
    df = _SPARK[0].createDataFrame([(x,) for x in lines], "m string")
    return {r.h: r.m for r in df.select("m", F.xxhash64("m").alias("h")).collect()}


def test_line_dedup_equals_a_plain_tree(spark):
    _SPARK[:] = [spark]
    rnd = random.Random(11)
    word = lambda: rnd.choice(["alpha", "beta", "gamma", "delta", "eps"])
    rows = [(i, "\n".join(" ".join(["see", "the", "page", "of", *(word() for _ in range(rnd.randint(1, 9))), rnd.choice(["n7", "x y", "http://q"])]) for _ in range(4))) for i in range(120)]
    rows += [(i + 1000, t) for i, t in (tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("doc_id < 300").collect())]
    rows += [(5000, None), (5001, ""), (5002, "\t \n\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = linededup.dedup_lines(df).collect()
    assert {r.doc_id: r.text for r in got} == tree(rows) and sum(r.n_dropped for r in got) > 100


def test_divided_leaves_find_the_same_recurring_lines(spark):
    """Lines of one template, in a leaf of many parts: one stays, whatever the parts."""
    rows = [(i, " ".join(["sold", "by", "the", "shop", "in", "our", "town", "to", "mister", "".join(map(chr, (97 + i % 26, 97 + i // 26)))])) for i in range(300)]
    rows += [(1000 + i, f"sold by the shop {' '.join(chr(97 + i) * k for k in range(1, 7))}") for i in range(20)]
    got = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), part=8).collect()
    assert sorted(r.doc_id for r in got if r.text) == [0, *range(1000, 1020)]


def test_rates_equal_a_plain_projected_gradient(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.6, 0.4, 0.3], 400)
    tokens = rng.integers(1, 200, 400).astype("f8")
    members = spark.createDataFrame([(float(t), [float(x) for x in q]) for t, q in zip(tokens, p, strict=True)], "tokens double, p array<double>")
    for cap, weights in ((None, [0.2, 0.5, 0.3]), (1.0, [0.1, 0.6, 0.3])):
        rate, fit = mixing.fit_rates(members, weights, cap=cap)
        a, target = tokens[:, None] * p, fit["target"]
        r = np.ones(400)
        gram = np.linalg.norm(a.T @ a, 2)
        for _ in range(20_000):
            r = np.clip(r - a @ (a.T @ r - target) / gram, 0, cap or np.inf)
        got = np.array([x.r for x in members.select(rate.alias("r")).collect()])
        assert (got >= 0).all() and (cap is None or (got <= cap).all())
        # The wanted totals where the bounds allow them, else the nearest ones.
        far, plain = (np.linalg.norm(a.T @ x - target) / target.sum() for x in (got, r))
        assert far <= 1.02 * plain + 1e-5, (far, plain)


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(4)
    y = rng.random(40_000) < 0.2
    toxic, clean = np.array([0.8, 0.6, 0.7, 0.1]), np.array([0.05, 0.1, 0.02, 0.3])
    votes = (rng.random((40_000, 4)) < np.where(y[:, None], toxic, clean)).astype("f8")
    model = toxicity.LabelModel.of_moments(0.2, toxicity._moments_of(votes[:2000], np.ones(2000), y[:2000].astype("f8")))
    for _ in range(4):
        model = toxicity.LabelModel.of_moments(0.2, toxicity._moments_of(votes, np.ones(len(votes)), model.posterior(votes)))
    assert np.abs(model.toxic - toxic).max() < 0.06 and np.abs(model.clean - clean).max() < 0.02
    assert ((model.posterior(votes) >= 0.5) == y).mean() > 0.93


def test_filter_passes_listed_keys_and_few_others(spark):
    listing = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"))
    asked = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    few = {n: urlfilter.possible(asked, listing, n).select("key").collect() for n in (16, 125)}
    want = {r.key for r in listing.collect()}
    for n, rows in few.items():
        found = {r.key for r in rows}
        assert want <= found and len(rows) == len(found)  # no false negative
        assert (len(found) - len(want) > 300) if n == 16 else (len(found) - len(want) < 40)
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    pages = asked.select(F.monotonically_increasing_id().alias("page_id"), F.concat(F.lit("http://"), "key", F.lit("/")).alias("url"))
    listed = listing.select(F.concat(F.lit("https://www."), "key").alias("url"))
    for bits in (1, 16):  # however many false positives there are, the join removes them
        assert urlfilter.judge(pages, rules, listed, bits_per_key=bits).where("verdict = 'block'").count() == 2000


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert linededup.dedup_lines(docs).count() == 0
    assert packing.pack(spark.createDataFrame([], "doc_id long, source string, cluster long, n long")).count() == 0
    assert mixing.mix(docs, spark.createDataFrame([], "doc_id long, domain string"), {"a": 1.0}).count() == 0
    assert embdedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_clashing_names(spark):
    rows = [(1, "one shared line\nown", 7, 8, 9), (2, "one shared line", 7, 8, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_dropped int, th int, n_dropped_in int")
    got = {r.doc_id: r.asDict() for r in linededup.dedup_lines(docs).collect()}
    assert got[2] == {"doc_id": 2, "text": "", "n_dropped_in_in": 7, "th": 8, "n_dropped_in": 9, "n_lines": 1, "n_dropped": 1}
    docs = spark.createDataFrame(rows, "doc_id long, text string, rate int, copies int, n_tokens int")
    got = mixing.mix(docs, spark.createDataFrame([(1, "a")], "doc_id long, domain string"), {"a": 1.0})
    assert got.where("copies >= 0").select("rate_in", "copies_in", "n_tokens_in").distinct().collect() == [(7, 8, 9)] and got.count() == 2


def test_a_text_of_several_parts(spark):
    rnd = random.Random(12)
    block = "".join(rnd.choice("abcdefgh ") for _ in range(300))
    long = "".join(rnd.choice("abcdefgh ") for _ in range(repeats.PART + 400))
    long = long[: repeats.PART - 100] + block + long[repeats.PART - 100 :]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in repeats.remove_repeats(spark.createDataFrame([(1, block), (2, long)], "doc_id long, text string")).collect()}
    assert got == {1: (0, 0), 2: (300, 1)}


def test_pipeline_with_extra_columns_and_empty_tables(spark, tmp_path):
    import corpus_pipeline

    rnd = random.Random(13)
    say = lambda bad: " ".join(rnd.choice(["vile", "scum", "filth"] if bad and k % 2 else ["good", "fine", "well", "calm", "true", "kind"]) for k in range(30))
    rows = [(i, say(i % 5 == 0), "en", f"s{i % 7}", 0, i, 2, 3, 4) for i in range(200)] + [(500, None, "en", None, 0, 1, 2, 3, 4), (501, "", "en", "s", 0, 1, 2, 3, 4)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row int, copies int, n_lines int, class int"
    spark.createDataFrame([(r[0], 1, int(r[0] % 5 == 0)) for r in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == [c.split()[0] for c in schema.split(", ")]
    assert all((r.row, r.copies, r.n_lines) == rows[r.doc_id][5:8] for r in docs.where("doc_id < 500").collect()) and docs.count() > 100
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_shared_folder_is_needed_on_a_cluster(spark):
    class Conf:
        get = staticmethod(lambda *a: None)

    class Context:
        master = "spark://host:7077"
        getConf = staticmethod(lambda: Conf)

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(RuntimeError, match="checkpoint"):
        common.shared_dir(Session)


def packed_as_best_fit(pieces, bins, capacity):
    """pieces: (doc_id, piece, length, source, cluster); bins: bin and offset of each. Every piece, longest first, is in a compatible bin with the least residual."""
    left, holds = {}, {}
    for i, k, n, source, cluster in sorted(pieces, key=lambda x: (-x[2], x[0], x[1])):
        b, offset = bins[i, k]
        if n == 0:
            assert b is None
            continue
        own = {("source", source)} - {("source", None)} | {("cluster", cluster)}
        fits = [left[x] for x in left if left[x] >= n and not holds[x] & own]
        assert b in left if fits else b not in left, (i, k)
        if fits:
            assert left[b] == min(fits) and not holds[b] & own and offset == capacity - left[b]
        else:
            assert offset == 0
        left[b] = left.get(b, capacity) - n
        holds[b] = holds.get(b, set()) | own


def memberships(texts, labels, domains):
    """Naive Bayes of a few domains on all words that occur five times or more: tokens and posteriors of each text."""
    words = lambda t: [w for w in re.split("[ \t\n\x0b\f\r]+", t or "") if w]
    counts = {d: collections.Counter() for d in domains}
    for i, d in labels.items():
        if i in texts:
            counts[d].update(words(texts[i]))
    total = {d: sum(c.values()) for d, c in counts.items()}
    known = {w: sum(c[w] for c in counts.values()) for w in set().union(*counts.values())}
    known = {w: n for w, n in known.items() if n >= 5}
    prior = collections.Counter(labels.values())
    out = {}
    for i, t in texts.items():
        ws = words(t)
        hit = [w for w in ws if w in known]
        z = []
        for d in domains:
            s = sum(math.log((counts[d][w] + known[w] / sum(total.values())) / (total[d] + 1)) for w in hit)
            z.append(math.log((prior[d] + 1) / (sum(prior.values()) + len(domains))) + (s / math.sqrt(len(hit)) if hit else 0))
        e = np.exp(np.array(z) - max(z))
        out[i] = (len(ws), e / e.sum())
    return out


def test_pipeline_equals_plain_stages(spark, tmp_path):
    """Every stage against a plain version on what the stage before left; then run() against the last of them."""
    import public_tokenizers
    import tokenizers

    import corpus_pipeline

    _SPARK[:] = [spark]
    rnd, names = random.Random(21), ["doc_id", "text", "lang", "source", "n_chars"]
    vocabulary = ["".join(rnd.choice("bcdfglmnprst") + rnd.choice("aeiou") for _ in range(3)) for _ in range(120)]
    line = lambda poor, n=12: " ".join(rnd.choice(vocabulary[60:] if poor and rnd.random() < 0.6 else vocabulary[:60]) for _ in range(n))
    shared = ["all rights of this page belong to nobody", "read more about us here", "posted on {} by the desk of the town"]
    texts, bad, poor = {}, set(), {}
    for g in range(70):
        lines = [line(g % 3 == 0) for _ in range(rnd.randint(1, 9))]
        if g % 4 == 0:
            lines.insert(rnd.randint(0, len(lines)), rnd.choice(shared).format(rnd.randint(1, 99)))
        if g % 7 == 0:
            lines.append(lines[0])
        if g % 5 == 1:
            lines[-1] += " " + " ".join(rnd.choice(["vile", "scum", "filth"]) for _ in range(4))
        for k in range(1 if g % 3 else rnd.randint(2, 5)):
            own = list(lines)
            if k > 1:  # near copies
                own[-1] += " " + line(False, 1)
            i = rnd.randrange(10_000)
            while i in texts:
                i += 1
            texts[i], poor[i] = "\n".join(own), g % 3 == 0
            if g % 5 == 1:
                bad.add(i)
    texts |= {10_001: "", 10_002: None, 10_003: " \n", 10_004: line(False, 3000).replace(" ", "\n", 40)}
    rows = [(i, t, "en", rnd.choice(["hot", "hot", f"s{i % 6}", None]), len(t or "")) for i, t in texts.items()]
    labels = [(i, 1 - poor[i], int(i in bad)) for i in poor]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    source = {r[0]: r[3] for r in rows}

    def stage(k, texts):
        docs = spark.createDataFrame([(i, t, "en", source[i], len(t or "")) for i, t in texts.items()], schema).repartition(3)
        out = corpus_pipeline.STAGES[k][1](spark, docs, str(tmp_path))
        assert k == 4 or out.columns == names
        return out.collect()

    # Toxicity: documents with a word that only toxic ones hold.
    left = {r.doc_id: r.text for r in stage(0, texts)}
    assert left == {i: t for i, t in texts.items() if i not in bad} and bad
    # Line dedup over classes of near copies.
    classes = {i: c for i, (_, c) in exact_components(list(left.items()), 5, 80).items()}
    got = {r.doc_id: r.text for r in stage(1, left)}
    assert got == tree(list(left.items()), classes=classes) and got != left
    # Near-dedup: the smallest id of each component.
    left = {r.doc_id: r.text for r in stage(2, got)}
    assert left == {i: got[i] for i, (_, c) in exact_components(list(got.items()), 5, 80).items() if i == c} and len(left) < len(got)
    # Mixing: memberships of a plain classifier, totals as near the target as a plain projected gradient comes, rows taken by their rate.
    domains, weights = ["good", "poor"], corpus_pipeline.WEIGHTS
    own = memberships(left, {i: domains[p] for i, p in poor.items()}, domains)
    quality = spark.createDataFrame([(i, domains[p]) for i, p in poor.items()], "doc_id long, domain string")
    docs = spark.createDataFrame([(i, t) for i, t in left.items()], "doc_id long, text string")
    chance = F.pmod(F.xxhash64("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))), F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)
    mixed = {r.doc_id: r for r in mixing.mix(docs, quality, weights, cap=1.0).withColumn("u", chance).collect()}
    a = []
    for i, r in mixed.items():
        n, p = own[i]
        assert r.n_tokens == n and np.allclose([r.posteriors[d] for d in domains], p, atol=1e-9), i
        a.append(n * p)
    a, rate = np.array(a), np.array([r.rate for r in mixed.values()])
    share = np.array([weights[d] for d in domains])
    target = share * min(t / w for t, w in zip(a.sum(0), share, strict=True))
    plain = np.ones(len(a))
    for _ in range(20_000):
        plain = np.clip(plain - a @ (a.T @ plain - target) / np.linalg.norm(a.T @ a, 2), 0, 1)
    far, least = (np.linalg.norm(a.T @ r - target) / target.sum() for r in (rate, plain))
    assert ((rate >= 0) & (rate <= 1)).all() and far <= 1.02 * least + 1e-5, (far, least)
    taken = {i: left[i] for i, r in mixed.items() if math.floor(r.rate + r.u) > 0}
    assert {r.doc_id: r.text for r in stage(3, left)} == taken and 0 < len(taken) < len(left)
    # Packing: pieces by the library's ids, each in the tightest bin without its source or its copies.
    encode = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    size = {i: len(encode(t or "", add_special_tokens=False).ids) for i, t in taken.items()}
    cap = corpus_pipeline.CAPACITY
    pieces = [(i, k, min(cap, size[i] - k * cap), source[i], " ".join((t or "").lower().split())) for i, t in taken.items() for k in range(max(1, -(-size[i] // cap)))]
    last = stage(4, taken)
    assert sorted((r.doc_id, r.piece, r.n_tokens) for r in last) == sorted(x[:3] for x in pieces)
    packed_as_best_fit(pieces, {(r.doc_id, r.piece): (r.bin_id, r.bin_offset) for r in last}, cap)
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect()), key=str) == sorted(map(tuple, last), key=str)
