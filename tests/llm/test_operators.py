import collections
import random
import tracemalloc
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from spindrift.llm import bpe, common, embdedup, linededup, minhash, mixing, packing, registry, repeats, tokenids, topk, toxicity, urlfilter

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, key string, m long, id long"


def fixture(spark, n=60, seed=1):
    """Texts with exact and near copies, shared lines, nulls, empties, a very long text, and columns with clashing names."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice(["an", "be", "co", "du", "é", "fo"]) for _ in range(rnd.randint(1, 3)))
    line = lambda: " ".join(word() for _ in range(rnd.randint(3, 30)))
    shared = [line() for _ in range(5)]
    texts = ["\n".join(rnd.choice([line, line, lambda: rnd.choice(shared)])() for _ in range(rnd.randint(1, 8))) for _ in range(n)]
    texts += [texts[0], texts[1], texts[2] + " end", None, "", "  ", "one two", "one  two", " ".join(word() for _ in range(4000)), None]
    rows = [(i, t, "x", 1, -i) for i, t in enumerate(texts)]
    return rows, spark.createDataFrame(rows, DOC).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOC)


def test_bpe_equals_the_library():
    import public_tokenizers as p

    b, rnd = bpe.load(p.path("byte_bpe_50k.json")), random.Random(2)
    bits = [" ", "  ", "\n", "\t", "a", "Bc", "'s", "1", "!", "é", "<|endoftext|>", "the", "'", "\x1c", "\x85", "日", "\u3000", ",", "."]
    for _ in range(5000):
        x = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12)))
        assert np.frombuffer(b.ids(x), b.dtype).tolist() == b.tokenizer.encode(x, add_special_tokens=False).ids, repr(x)


def test_bpe_looks_letters_up_in_a_set():
    import public_tokenizers as p

    assert "[^\\W\\d_]+" not in bpe.SPLIT.__self__.pattern.split("|")[0]
    b = bpe.load(p.path("byte_bpe_50k.json"))
    for x in ("ab𝒳𝒴 𝒵a", " a𐐀y", "日本𝒳 ü", "x²", "a𝟗b", "née's 'S", "", " "):
        assert np.frombuffer(b.ids(x), b.dtype).tolist() == b.tokenizer.encode(x, add_special_tokens=False).ids, repr(x)


@pytest.mark.parametrize("counts", [[5], [0, 3, 0], [1, 1, 1], [1 << i for i in range(20)], list(range(300))])
def test_code_round_trip(counts):
    lengths = tokenids.code_lengths(np.array(counts), 9)
    used = lengths[lengths > 0].astype(float)
    assert (lengths > 0).tolist() == [c > 0 for c in counts] and (2.0**-used).sum() <= 1 and used.max() <= 9
    code, ids = tokenids.Code(lengths), np.random.default_rng(0).choice(np.flatnonzero(lengths), 1000)
    sizes = np.array([0, 1, 700, 299])
    codes, marks = code.encode(ids, sizes)
    block = tokenids._block([(i or None, int(s), m, c) for i, (s, m, c) in enumerate(zip(sizes, marks, codes, strict=True))])
    docs, n, out = code.decode(block)
    assert docs == [None, 1, 2, 3] and n.tolist() == sizes.tolist() and (out == ids).all()
    with pytest.raises(ValueError):
        code.decode(block[:-1] + bytes([block[-1] ^ 1]))


def test_documents_are_coded_in_small_parts():
    rnd, dtype, seen = np.random.default_rng(3), np.dtype("<u2"), []
    docs = [rnd.integers(0, 300, n).astype(dtype) for n in (0, 70_000, *[2000] * 60, 1)]
    code = tokenids.Code(tokenids.code_lengths(np.ones(300)))

    class Seen:
        def encode(self, ids, sizes):
            seen.append((len(ids), len(sizes)))
            return code.encode(ids, sizes)

    sizes, codes, marks = tokenids._coded(Seen(), [d.tobytes() for d in docs], dtype)
    assert all(n <= tokenids.PART or k == 1 for n, k in seen) and len(seen) > 2 and sizes.tolist() == [len(d) for d in docs]
    whole = code.encode(np.concatenate(docs), sizes)
    assert (codes, marks) == whole


def test_token_ids(spark, tmp_path):
    import public_tokenizers as p

    rows, df = fixture(spark)
    tokenids.write_ids(df, str(tmp_path / "ids"), p.path("byte_bpe_50k.json"))
    t = bpe.load(p.path("byte_bpe_50k.json")).tokenizer
    got = {r.doc_id: r for r in tokenids.read_ids(spark, str(tmp_path / "ids")).collect()}
    at = 0
    for i, text, *_ in rows:
        want = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        assert got[i].ids == want and got[i].start == at
        at += len(want)
    tokenids.write_ids(empty(spark), str(tmp_path / "none"), p.path("byte_bpe_50k.json"))
    assert tokenids.read_ids(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("name", sorted(registry.QUERY_SQL))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("embeddings", "pages", "customer"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = registry.QUERIES[name](spark, SF)
    want = con.execute(f"select {', '.join(got.columns)} from ({registry.QUERY_SQL[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want)) and want


def test_urls_edges(spark):
    urls = [None, "no scheme", "http://", "HTTP://A.Example.COM/en/7?x", "http://b.net/de/", "http://net", "x://co.org/es/#f", "http://q/a", "http://www.q/a/"]
    pages = spark.createDataFrame([*enumerate(urls), (3, urls[3])], "page_id long, url string")
    rules = spark.createDataFrame(urlfilter.RULES, "host string, path string, verdict string")
    got = sorted(map(tuple, urlfilter.judge(pages, rules, spark.createDataFrame([("http://q/a",), (None,)], "url string")).select("page_id", "host", "path", "rule", "verdict").collect()))
    assert got[0] == (0, "", "", None, "allow") and got[1] == (1, "", "", None, "allow") and got[2] == (2, "", "", None, "allow")
    assert got[3] == got[4] == (3, "a.example.com", "/en/7", "example.com/en/7", "allow")
    assert [g[3:] for g in got[5:]] == [("net/de/", "allow"), (None, "allow"), ("org/es/", "block"), (None, "block"), (None, "block")]
    assert urlfilter.judge(pages.limit(0), rules, pages.select("url")).count() == 0


def brute_repeats(rows, w=50):
    seen, out = {}, {}
    for i, t, *_ in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        own = [b[p : p + w] for p in range(len(b) - w + 1)]
        for p, x in enumerate(own):
            if seen.get(x, i) < i:
                gone[p : p + w] = True
        for x in own:
            seen.setdefault(x, i)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[i] = (len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, "u1")[~gone]))
    return out


@pytest.mark.parametrize("hot_rows", [1, 500, 1 << 17])
def test_repeats(spark, hot_rows):
    """No string, some strings or all strings occur often enough to be hot."""
    rows, df = fixture(spark)
    rows += [(100, "ab" * 300, "", 0, 0), (101, "x" + "ab" * 200, "", 0, 0), (102, "a" * 49, "", 0, 0)]
    rows += [(200 + i, rows[3][1] if i % 2 else f"{i} {rows[4][1]}", "", 0, 0) for i in range(60)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(spark.createDataFrame(rows, DOC).repartition(4), hot_rows=hot_rows).collect()}
    assert got == brute_repeats(rows)
    with_null = repeats.remove_repeats(spark.createDataFrame([(None, rows[0][1]), (1, rows[0][1])], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.n_removed) for r in with_null} == {(None, 0), (1, 0)}
    assert repeats.remove_repeats(empty(spark)).count() == 0
    a, b, c = (rows[i][1] * 3 for i in range(3))
    twice = repeats.remove_repeats(spark.createDataFrame([(1, a), (2, "x" + a), (2, b), (2, b), (3, b), (3, c)], "doc_id long, text string")).collect()
    want = [(1, len(a.encode()), a), (2, 1 + len(a.encode()), "x"), (2, len(b.encode()), b), (2, len(b.encode()), b), (3, len(b.encode()), ""), (3, len(c.encode()), c)]
    # A text that holds itself three times repeats itself within one document alone, which takes nothing.
    shared = lambda t: any(t.encode()[p : p + 50] in x.encode() for x in (a, b, c) if x != t for p in range(len(t.encode()) - 49))
    assert not any(map(shared, (a, b, c)))
    assert sorted((r.doc_id, r.n_bytes, bytes(r.kept).decode()) for r in twice) == sorted(want)


def test_run_length_index():
    rnd = random.Random(3)
    strings = list({bytes(rnd.choice(b"ab") for _ in range(rnd.randint(6, 12))) for _ in range(60)})
    index = repeats.RunLengthIndex(strings, np.arange(len(strings)), 6)
    seen = {(int(a), int(b)): int(c) for w, o, low in index.stream() for a, b, c in zip(w, o, low, strict=True)}
    assert seen == {(i, k): min(j for j, t in enumerate(strings) if s[k : k + 6] in t) for i, s in enumerate(strings) for k in range(len(s) - 5)}


def brute_components(sets, linked):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and linked(sets[a], sets[b]):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in sets}


def test_near_duplicates(spark):
    rows, _ = fixture(spark)
    base = rows[68][1].split()[:300]
    rows += [(200 + k, " ".join(base[: 300 - k * 20]), "", 0, 0) for k in range(8)]
    df = spark.createDataFrame(rows + [(None, "one two", "", 0, 0)], DOC).repartition(3)
    sets = {i: minhash.shingles(t, 4) for i, t, *_ in rows}
    want = brute_components(sets, lambda a, b: bool(a) and 100 * len(a & b) >= 80 * len(a | b))
    got = minhash.near_duplicates(df, words=4, block=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == {i: (len(sets[i]), want[i]) for i in sets}
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_components(spark):
    rnd = random.Random(4)
    edges = [(rnd.randint(0, 200), rnd.randint(0, 200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(40)] + [(None, 3), (5, 5)]
    got = {r.id: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long"), common.Stages(spark, "t")).collect()}
    ids = {i: i for e in edges if None not in e for i in e}
    pairs = {frozenset(e) for e in edges if None not in e}
    want = brute_components(ids, lambda a, b: frozenset((a, b)) in pairs)
    assert got == {i: c for i, c in want.items() if i in got} and {i for i, c in want.items() if c != i} <= set(got)


def test_training_rows_are_the_least_and_bounded_before_they_meet(spark, monkeypatch):
    rows = spark.range(0, 20_000, 1, 40).select(F.col("id").alias("doc_id"))
    repeated = spark.range(0, 4000, 1, 8).select((F.col("id") % 3).alias("doc_id"))
    for df, most in ((rows, 300), (rows, 30_000), (repeated, 700), (rows.limit(0), 5)):
        put = []
        stages = common.Stages(spark, "t")
        monkeypatch.setattr(stages, "put", lambda df, name, put=put, own=stages.put: put.append(df) or own(df, name))
        got = [r.h for r in toxicity.smallest(df, most, stages).select(F.xxhash64("doc_id").alias("h")).collect()]
        every = sorted(r.h for r in df.select(F.xxhash64("doc_id").alias("h")).collect())
        assert sorted(got) == every[:most]
        if most == 300:
            assert len(put) == 1 and "Filter (xxhash64(" in put[0]._jdf.queryExecution().optimizedPlan().toString()


def test_few_links_take_few_queries_and_give_the_same(spark):
    rnd = random.Random(7)
    edges = [(rnd.randint(-200, 200), rnd.randint(-200, 200)) for _ in range(250)] + [(1000 + i, 1001 + i) for i in range(30)] + [(None, 3), (5, 5)]
    store = spark._jsparkSession.sharedState().statusStore()
    for links in (edges, [(2, 2), (None, 1)]):
        df = spark.createDataFrame(links, "a long, b long")
        before = store.executionsCount()
        got = sorted(map(tuple, common.components(df, common.Stages(spark, "t")).collect()))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        assert store.executionsCount() - before <= 6
        assert got == sorted(map(tuple, common.components(df, common.Stages(spark, "t"), few=0).collect()))


def test_embedding_edges(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 0.0]), (5, None), (6, [float("nan"), 1.0]), (7, [0.0, 1.0, 0.0]), (8, [-0.0, 1.0, 0.0]), (None, [1.0, 0.0]), (9, []), (1, [1.0, 0.0])]
    got = sorted(((r.vec_id or 0), r.n_links, r.component_id, r.kept) for r in embdedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect())
    assert got == [(0, 0, None, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), *[(i, 0, i, True) for i in (4, 5, 6)], (7, 1, 7, True), (8, 1, 7, False), (9, 0, 9, True)]


def test_topk_edges(spark):
    rows = [(0, [0.5, 0.1]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [float("inf"), 0.0]), (5, [-1.0, 0.0]), (100, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (2, [1.0, 0.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), lambda i: i % 100 == 0, 2, chunk=1, query_block=1).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 512 * 1024), (0, 2, 2, 512 * 1024)]
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), lambda i: i == 0).count() == 0


def test_line_dedup(spark):
    rows = [
        (1, "hello shared line number 1\nown words of one\n\n"), (2, "own words of two here\nhello shared line number 22"), (3, None), (4, ""),
        (5, "hello shared line number x9\nhello shared line number x9"), (5, "hello shared line number x9\nhello shared line number x9"), (None, "alone here now"),
    ]
    got = sorted(((r.doc_id or 0), r.text, r.n_dropped, r.extra) for r in linededup.dedup_lines(spark.createDataFrame([(*r, "e") for r in rows], "doc_id long, text string, extra string")).collect())
    assert got[1] == (1, rows[0][1], 0, "e") and got[2] == (2, "own words of two here", 1, "e")
    assert got[3] == (3, None, 0, "e") and got[4] == (4, "", 0, "e") and got[5] == got[6] == (5, "", 2, "e") and got[0] == (0, "alone here now", 0, "e")
    assert linededup.match([["a", "b", "c", "d"], ["a", "b", "c", "e"], ["x", "y", "z", "w"]], 0.75)[0] == [0, 0, 1]


def test_packing(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice(["s", "s", "t", "u", None]), rnd.randint(0, 20), rnd.choice([0, 1, 7, 50, 99, 100, 101, 333])) for i in range(400)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, source string, cluster long, n long"), 100, shard=100).collect()
    of = {r[0]: r for r in rows}
    total, bins = collections.Counter(), collections.defaultdict(list)
    for r in got:
        total[r.doc_id] += r.n_tokens
        assert (r.bin_id is None) == (r.n_tokens == 0)
        if r.bin_id is not None:
            bins[r.bin_id].append((r.bin_offset, r.n_tokens, *of[r.doc_id][1:3]))
    assert all(total[i] == r[3] for i, r in of.items())
    for b in bins.values():
        b.sort()
        assert all(x[0] == sum(y[1] for y in b[:k]) for k, x in enumerate(b)) and sum(x[1] for x in b) <= 100
        assert len({x[3] for x in b}) == len(b) and max(collections.Counter(x[2] for x in b if x[2]).values(), default=1) == 1


def test_best_fit_is_tightest():
    rnd, bins, open_ = random.Random(6), packing.Bins(50), []
    for _ in range(500):
        length, bits = rnd.randint(1, 50), 1 << rnd.randint(1, 4) | 1 << rnd.randint(5, 30)
        fit = [(50 - used - length) for used, mask in open_ if 50 - used >= length and not mask & bits and used < 50]
        number, offset = bins.place(length, bits)
        if number == len(open_):
            assert not fit
            open_.append((0, 0))
        used, mask = open_[number]
        assert offset == used and not mask & bits and (not fit or 50 - used - length == min(fit))
        open_[number] = (used + length, mask | bits)


def test_mixing(spark):
    rnd = random.Random(7)
    rows = [(i, " ".join(rnd.choice(["good", "fine", "well"] if i % 3 else ["bad", "poor", "vile"]) for _ in range(rnd.randint(1, 30))), "e") for i in range(300)]
    rows += [(300, None, "e"), (301, "", "e"), (None, "good", "e"), (5, rows[5][1], "e")]
    labelled = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(0, 300, 2)], "doc_id long, domain string")
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, extra string"), labelled, {"a": 0.5, "b": 0.5}).collect()
    assert len(got) == len(rows) and all(r.rate >= 0 for r in got)
    one = {(r.doc_id, r.text): r for r in got}.values()
    share = sum(r.n_tokens * r.rate * r.posteriors["a"] for r in got) / sum(r.n_tokens * r.rate for r in got)
    assert abs(share - 0.5) < 1e-5 and len(one) == len(rows) - 1
    assert mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, extra string"), labelled.limit(0), {"a": 1.0}).count() == len(rows)


def test_toxicity(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    got = toxicity.op9_toxicity(spark, "/root/testdata/sf0.1").collect()
    hit = collections.Counter((labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels)
    assert hit[1, 1] >= 0.8 * (hit[1, 0] + hit[1, 1]) and hit[0, 1] <= 0.05 * (hit[0, 0] + hit[0, 1])
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    _, df = fixture(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(df, none).count() == df.count() and toxicity.score(empty(spark), none).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} <= set(docs) and max(r.bin_offset + r.n_tokens for r in got) <= 4096
    assert len(corpus_pipeline.STAGES) == 5


def planted(spark, folder, rows, labels):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_pipeline_keeps_one_of_each_copy_group(spark, tmp_path):
    import corpus_pipeline

    rnd, rows = random.Random(8), []
    line = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    common = line(6)
    for g in range(12):
        # Every third group has a single line; a near copy has other words at one place.
        lines = [line(60)] if g % 3 == 0 else [line(12) for _ in range(8)] + [common]
        near = [lines[0].rsplit(" ", 1)[0] + " " + line(1), *lines[1:]]
        texts = ["\n".join(x) for x in (lines, lines, near, lines)]
        rows += [(100 * g + k, t, "en", f"s{k}", len(t)) for k, t in enumerate(texts)]
    folder = planted(spark, tmp_path, rows, [(r[0], 1, 0) for r in rows])
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, folder)
    left = {r.doc_id: r for r in docs.collect()}
    text = {r[0]: r[1] for r in rows}
    assert sorted(left) == [100 * g for g in range(12)]
    # Recurring over groups, the common line stays in the first of them alone.
    assert all(r.text == (text[i] if i % 300 == 0 or i == 100 else text[i].removesuffix("\n" + common)) and r.n_chars == len(r.text) for i, r in left.items())
    got = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r.doc_id for r in got) == sorted(left) and all(r.n_tokens > 0 and r.bin_id is not None for r in got)


def test_pipeline_decides_by_row(spark, tmp_path):
    import corpus_pipeline

    rnd = random.Random(9)
    say = lambda bad, n=20: " ".join(rnd.choice(["vile", "scum", "filth"] if bad and k % 2 else ["good", "fine", "well", "calm"]) for k in range(n))
    labelled = [(i, say(i % 3 == 0), "en", "s", 0) for i in range(300)]
    rows = [(1000, say(False), "en", "s", 0), (1000, say(True), "en", "s", 1), (None, say(True), "en", "s", 1), (None, say(False), "en", "s", 0)]
    folder = planted(spark, tmp_path, labelled + rows, [(r[0], 1, int(r[0] % 3 == 0)) for r in labelled])
    got = corpus_pipeline.reject_toxic(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder).collect()
    assert sorted(((r.doc_id or 0), r.n_chars) for r in got if r.doc_id is None or r.doc_id >= 1000) == [(0, 0), (1000, 0)]

    a, b, c, d = (" ".join("".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(40)) for _ in range(4))
    rows = [(7, a), (7, a), (3, b), (7, b), (None, b), (None, c), (None, c), (9, d), (8, ""), (8, ""), (8, None), (6, ""), (None, ""), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = collections.Counter((r.doc_id, r.text or "") for r in corpus_pipeline.drop_near_duplicates(spark, docs, folder).collect())
    assert got == {(7, a): 1, (3, b): 1, (None, c): 1, (9, d): 1, (8, ""): 1, (6, ""): 1, (None, ""): 2}


def test_topk_takes_large_components(spark):
    rnd = random.Random(10)
    rows = [(i, [float(rnd.choice([-1, 1]) * rnd.choice([1, 8192, 9000, 70_000, 2_000_000])), float(rnd.randint(-9, 9))]) for i in range(40)]
    rows += [(100, [2_900_000.0, 0.5]), (101, [2_900_000.0, 0.25]), (102, [-2_900_000.0, 0.25])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), lambda i: i % 20 == 0, 5, chunk=7, query_block=2).collect()
    v = {i: [int(x * 1024) for x in e] for i, e in rows}
    want = []
    for q in (i for i in v if i % 20 == 0):
        best = sorted((-sum(a * b for a, b in zip(v[q], v[c], strict=True)), c) for c in v if c != q)[:5]
        want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(want) and max(w[3] for w in want) > 1 << 62
    for big in (1e7, 1e30):
        with pytest.raises(Exception, match="exceeds a long"):
            topk.top_k(spark.createDataFrame([(0, [big]), (1, [big])], "vec_id long, embedding array<float>"), lambda i: i == 0).collect()


def shuffled(spark) -> int:
    """Bytes of shuffles that the session has written so far."""
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_embedding_join_does_not_shuffle_pairs(spark, tmp_path):
    """Vectors are moved a fixed number of times, whatever tiles and slabs they are joined in, and no link is lost between these."""
    rng = np.random.default_rng(7)
    x = rng.standard_normal((3000, 64))
    x[2000:2900] = x[:900] + rng.standard_normal((900, 64)) * 0.45
    x[2900:] = x[5] + rng.standard_normal((100, 64)) * 0.2
    x = x.astype("f4").astype("f8")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    want = brute_components({int(i): i for i in np.flatnonzero(near.any(1))}, lambda a, b: near[a, b])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    df.write.parquet(str(tmp_path / "vectors"))
    df = spark.read.parquet(str(tmp_path / "vectors"))
    before = shuffled(spark)
    out = {(r.vec_id, r.n_links, r.component_id) for r in embdedup.near_duplicates(df).collect()}
    assert shuffled(spark) - before < 4 * 3000 * 64 * 4
    assert out == {(i, int(near[i].sum()), want.get(i, i)) for i in range(3000)}
    assert out == {(r.vec_id, r.n_links, r.component_id) for r in embdedup.near_duplicates(df, tile=400, slab_bytes=1 << 19).collect()}


def test_words_are_hashed_together(monkeypatch):
    """Words have one hash wherever they stand, none is hashed by itself unless it is long, and texts and words of any length are cut alike."""
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdeé<0") for _ in range(rnd.choice([1, 2, 5, 9, 64, 65])))
    blank = lambda: "".join(rnd.choice(" \t\n\r\x0b\x0c") for _ in range(rnd.randint(1, 3)))
    texts = ["", " ", "a", " a", "a ", "a\xa0b \x1c c"] + ["".join(x for _ in range(n) for x in (word(), blank())) for n in (1, 5, 20_000)]
    texts += ["x " * 40_000, f"a {'b' * 200_000} c", "b" * 200_000, f"{'b' * (minhash.PART - 1)} a", f"{'b' * minhash.PART}  a"]
    seen, single = {}, []
    digest = minhash.xxh3_64_intdigest
    monkeypatch.setattr(minhash, "xxh3_64_intdigest", lambda w: single.append(w) or digest(w))
    for text in texts:
        words = text.encode().split()
        hashes = minhash.word_hashes(text.encode()).tolist()
        assert len(hashes) == len(words) and all(seen.setdefault(w, h) == h for w, h in zip(words, hashes, strict=True))
    assert len(set(seen.values())) == len(seen)
    assert single and all(len(w) > minhash.LONG for w in single)


def test_buckets_of_a_large_corpus_are_moved_in_groups(spark, monkeypatch):
    """What is packed at a time does not fall apart into a row for each of very many buckets, and the result is the same."""
    rows, df = fixture(spark)
    rows += [(200 + i, rows[3][1] if i % 2 else f"{i} {rows[4][1]}", "", 0, 0) for i in range(60)]
    made = []
    second = repeats._second_pass
    monkeypatch.setattr(repeats, "_second_pass", lambda *a: made.append(a[5]) or second(*a))
    monkeypatch.setattr(repeats, "GROUPS", 4)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(spark.createDataFrame(rows, DOC).repartition(4), bucket_bytes=500).collect()}
    assert got == brute_repeats(rows)
    total = sum(len((r[1] or "").encode()) for r in rows)
    assert made[0] <= -(-total // 1000) // 8


def test_index_of_a_very_common_minimizer_takes_bounded_memory():
    """Strings of one minimizer with very many contexts: the index is made of pieces, and each window still gets its least document."""
    rnd, common_part = random.Random(7), b"the very common passage!"
    bits = [bytes(rnd.choice(b"abcdefgh ") for _ in range(4)) for _ in range(12)]
    side = lambda: b"".join(rnd.choice(bits) for _ in range(7))[:26]
    strings = sorted({side() + common_part + side() for _ in range(24_000)})
    n = len(strings)
    h = np.array([xxhash.xxh64_intdigest(x) - (1 << 63) for x in strings])
    lo = np.random.default_rng(1).permutation(n)
    parts = (np.full(n, 77 << 8, "i4"), h, lo, np.full(n, n + 1), np.array([len(x) for x in strings], "u4"), np.ones(n, "u4"))
    packed = zstandard.compress(n.to_bytes(8, "little") + b"".join(x.tobytes() for x in parts) + b"".join(strings))
    table = pa.table({"bucket": pa.array([0], pa.int32()), "strings": pa.array([packed], pa.binary())})
    windows = sum(len(x) - 49 for x in strings)
    assert windows > 4 * repeats.WINDOWS
    index = repeats._index(50, 10)
    tracemalloc.start()
    found = index(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 * windows
    got = {(x["h"], k): x["low"] for x in found.to_pylist() for k in range(x["a"], x["b"] - 49)}
    least = {}
    for x, d in zip(strings, lo.tolist(), strict=True):
        for k in range(len(x) - 49):
            least[x[k : k + 50]] = min(d, least.get(x[k : k + 50], d))
    assert got == {(i, k): least[x[k : k + 50]] for x, i in zip(strings, h.tolist(), strict=True) for k in range(len(x) - 49)}


@pytest.mark.parametrize("length", [50, 25, 10])
def test_repeats_of_a_very_common_passage(spark, monkeypatch, length):
    """Pieces of very few windows give the same result, and the session's settings stay as they were."""
    rnd, passage = random.Random(9), "a passage that is found nearly everywhere, and more"
    word = lambda: rnd.choice(["an ", "be ", "co ", "du ", "é ", "fo "])
    words = lambda: "".join(word() for _ in range(rnd.randint(0, 14)))
    rows = [(i, words() + passage[rnd.randint(0, 9) :] + words() + passage * rnd.randint(0, 2) + words(), "", 0, 0) for i in range(150)]
    rows += [(200, "ab" * 300, "", 0, 0), (201, "x" + "ab" * 200, "", 0, 0), (202, None, "", 0, 0)]
    monkeypatch.setattr(repeats, "WINDOWS", 40)
    before = spark.conf.get(common.BATCH)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(spark.createDataFrame(rows, DOC).repartition(4), length=length).collect()}
    assert got == brute_repeats(rows, length)
    assert spark.conf.get(common.BATCH) == before
