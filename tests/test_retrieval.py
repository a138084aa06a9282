import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from statuteloom.operators import evaluation as e
from statuteloom.operators import retrieval as r
from statuteloom.plans.table_queries import QUERIES


def test_tokens(spark):
    got = spark.createDataFrame([("The punishment under 106(2) or Section 498A, and theft",)], "t string").select(r.tokens(F.col("t")).alias("x")).first()["x"]
    assert got == ["punishment", "under", "106(2)", "section", "498a", "theft"]


def test_dense_ranks_cosines_of_any_sign(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [-1.0, 0.0])], "vec_id int, embedding array<double>")
    got = r.dense(v, v.where("vec_id = 1").withColumnRenamed("vec_id", "query"), 3).orderBy("rank").collect()
    assert [(x.vec_id, x.score) for x in got] == [(1, 1.0), (2, 0.0), (3, -1.0)]
    others = r.dense(v, v.where("vec_id = 1").withColumnRenamed("vec_id", "query"), 3, without_self=True)
    assert sorted(x.vec_id for x in others.collect()) == [2, 3]


@pytest.mark.parametrize("block", [1, 100])
def test_bm25_against_brute_force(spark, block):
    texts = ["theft of a cow", "theft theft", "murder most foul", "cow", None, "", "theft of a cow"]
    asked = ["theft cow", "foul murder", "unknown", "theft theft"]
    toks = lambda df: df.select(df.columns[0], r.tokens(F.coalesce("t", F.lit(""))).alias("toks"))
    docs = toks(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, t string"))
    got = {(x["query"], x.doc_id): (x.score, x["rank"]) for x in r.bm25(docs, toks(spark.createDataFrame(list(enumerate(asked)), "query bigint, t string")), k=3, block=block).collect()}
    bags = [Counter((t or "").replace(" of a ", " ").split()) for t in texts]
    mean = sum(sum(b.values()) for b in bags) / len(bags)
    want = {}
    for q, text in enumerate(asked):
        scores = []
        for d, bag in enumerate(bags):
            score = 0.0
            for term in set(text.split()):
                df = sum(term in b for b in bags)
                score += math.log(1 + (len(bags) - df + 0.5) / (df + 0.5)) * bag[term] * 2.2 / (bag[term] + 1.2 * (0.25 + 0.75 * sum(bag.values()) / mean)) if df else 0
            scores.append((-round(score, 4), d))
        for rank, (score, d) in enumerate([s for s in sorted(scores) if s[0] < 0][:3], 1):
            want[q, d] = (-score, rank)
    assert got == want
    assert r.bm25(docs.limit(0), docs.limit(0).withColumnRenamed("doc_id", "query")).count() == 0


def test_okapi_floor(spark):
    docs = spark.createDataFrame([(k, ["common"] + (["rare"] if k == 0 else [])) for k in range(5)], "doc_id bigint, toks array<string>")
    got = {x.term: x.idf for x in r.idf(docs, spark.createDataFrame([("common",), ("rare",), ("none",)], "term string"), 5, okapi=True).collect()}
    rare, common = math.log(4.5 / 1.5), math.log(0.5 / 5.5)
    assert got == {"rare": pytest.approx(rare), "common": pytest.approx(0.25 * (rare + common) / 2)}


def test_dense_ties_zero_and_null_vectors(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, [0.0, 0.0]), (5, None), (6, []), (7, [1.0, 1.0])], "vec_id bigint, embedding array<float>")
    q = v.where("vec_id in (1, 4, 5)").withColumnRenamed("vec_id", "query")
    got = [(x["query"], x.vec_id, x.score) for x in r.dense(v, q, 3).orderBy("query", "rank").collect()]
    assert got == [(1, 1, 1.0), (1, 2, 1.0), (1, 7, 0.7071)]
    assert [x.vec_id for x in r.dense(v, q, 2, without_self=True).orderBy("rank").collect()] == [2, 7]


@pytest.mark.parametrize("block", [2, 100])
def test_every_close_vector_is_counted(spark, block):
    rows = [(k, [1.0, 0.5, float(k % 3 == 0) * 0.001] if k < 130 else [0.0, 0.1 * (k % 7), 1.0]) for k in range(160)] + [(160, None), (161, [0.0, 0.0, 0.0])]
    v = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    cos = lambda a, b: round(sum(x * y for x, y in zip(a, b)) / math.hypot(*a) / math.hypot(*b), 4)
    want = {}
    for k, a in rows[:160]:
        near = [s for q, b in rows[:160] if q % 20 == 0 and q != k and (s := cos(a, b)) >= 0.9]
        if near:
            want[k] = (len(near), max(near))
    got = r.close(v, v.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query"), 0.9, block=block).collect()
    assert {x.vec_id: (x.queries, x.closest) for x in got} == want and len(got) == len(want) > 130


def test_leakage_guard_reports_all_copies(spark, tmp_path):
    rows = [(k, [1.0, 2.0] if k < 120 else [-1.0, float(k % 2)]) for k in range(130)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {x.vec_id: (x.queries, x.closest) for x in QUERIES["leakage_guard"](spark, str(tmp_path)).collect() if x.vec_id < 120}
    assert got == {k: (6 - (k % 20 == 0), 1.0) for k in range(120)}


def _sections(spark, path):
    words = ["theft", "cattle", "house", "night", "fraud", "court", "river", "poison", "robbery", "letter"]
    rows = []
    for k in range(400):  # 30 sections, of which the first has most of the rows
        n = 0 if k % 20 and k < 300 else k % 30
        body = " ".join(words[(n * j + j + n) % 10] for j in range(1, 4 + n % 7)) + " theft" * (n == 0) + " filler" * (k % 13)
        rows.append((k, "BNS" if n % 2 else "BSA", n, f"{words[n % 10]} {words[(n + 3) % 10]} theft", body))
    spark.createDataFrame(rows, "sec_id bigint, act string, section int, title string, text string").write.parquet(str(path / "sections.parquet"))
    return rows


def _brute(rows, k1=1.2, b=0.75):
    """Query to [(-score, sec_id)] of all rows with a score, in order."""
    bags = {x[0]: Counter(x[4].split()) for x in rows}
    mean, n = sum(sum(c.values()) for c in bags.values()) / len(bags), len(bags)
    df = Counter(t for c in bags.values() for t in c)
    out = {}
    for q in rows:
        if q[0] % 20 == 0:
            terms = set(q[3].split())
            scores = [(-round(sum(math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c[t] * (k1 + 1) / (c[t] + k1 * (1 - b + b * sum(c.values()) / mean)) for t in terms), 4), d) for d, c in bags.items()]
            out[q[0]] = sorted(s for s in scores if s[0] < 0)
    return out


def test_copies_of_a_section_use_up_no_places(spark, tmp_path):
    rows = _sections(spark, tmp_path)
    key, want = {x[0]: (x[1], x[2]) for x in rows}, {}
    for q, ranked in _brute(rows).items():
        best = {}
        for score, d in ranked:
            best.setdefault(key[d], score)
        for rank, (score, k) in enumerate(sorted((s, k) for k, s in best.items())[:20], 1):
            want[q, rank] = (*k, -score)
    got = {(x["query"], x["rank"]): (x.act, x.section, x.score) for x in QUERIES["collapse_sections"](spark, str(tmp_path)).collect()}
    assert got == want


@pytest.mark.parametrize("apart", [False, True])
def test_fusion_is_that_of_the_whole_rankings(spark, tmp_path, apart):
    if apart:  # 20 short rows lead one ranking and 20 long ones the other; the 50 between them are past 20 in both, and win
        bodies = ["theft word"] * 20 + ["theft " * 4 + "word " * 56] * 20 + ["theft " * 2 + "word " * 18] * 50 + ["word " * 10] * 50
        rows = [(k, "BNS", k, "theft", body) for k, body in enumerate(bodies)]
        spark.createDataFrame(rows, "sec_id bigint, act string, section int, title string, text string").write.parquet(str(tmp_path / "sections.parquet"))
    else:
        rows = _sections(spark, tmp_path)
    want, a, b = {}, _brute(rows), _brute(rows, 0.9, 0.4)
    for q in a:
        total = Counter()
        for ranked in (a[q], b[q]):
            for rank, (_, d) in enumerate(ranked, 1):
                total[d] += 1 / (60 + rank)
        for rank, (score, d) in enumerate(sorted((-round(s, 8), d) for d, s in total.items())[:5], 1):
            want[q, rank] = (d, -score)
    assert not apart or want[0, 1] == (40, round(2 / 81, 8))
    assert {(x["query"], x["rank"]): (x.sec_id, x.score) for x in QUERIES["rank_fusion"](spark, str(tmp_path)).collect()} == want


@pytest.mark.parametrize("block", [2, 100])
def test_places_against_brute_force(spark, tmp_path, block):
    rows = _sections(spark, tmp_path)
    s = spark.read.parquet(str(tmp_path / "sections.parquet"))
    docs = s.select("sec_id", r.tokens(F.col("text")).alias("toks"))
    asked = s.where("sec_id in (0, 20, 100, 320)").select(F.col("sec_id").alias("query"), r.tokens(F.col("title")).alias("toks"))
    wanted = asked.select("query").crossJoin(s.where("sec_id % 7 = 0").select("sec_id"))
    want = {(q, d): rank for q, ranked in _brute(rows).items() if q in (0, 20, 100, 320) for rank, (_, d) in enumerate(ranked, 1) if d % 7 == 0}
    assert {(x["query"], x.sec_id): x["rank"] for x in r.bm25_places(docs, asked, wanted, doc_id="sec_id", block=block).collect()} == want


def test_fusion_reads_each_text_once(spark, tmp_path, monkeypatch):
    rows, read, tokens = _sections(spark, tmp_path), spark.sparkContext.accumulator(0), r.tokens

    def seen(text):
        read.add(1)
        return text

    counting = F.udf(seen, "string").asNondeterministic()
    monkeypatch.setattr(r, "tokens", lambda text: tokens(counting(text)))
    assert QUERIES["rank_fusion"](spark, str(tmp_path)).count() > 0
    assert read.value == len(rows) + sum(x[0] % 20 == 0 for x in rows)


@pytest.mark.parametrize("block", [1, 100])
def test_fusion_counts_places_past_all_lists(spark, block):
    # 90 short rows lead one ranking and 120 long ones the other; the places of each in the other decide, and no list is as long
    bodies = ["theft word"] * 90 + ["theft " * 4 + "word " * 56] * 120 + ["word " * (10 + j % 7) for j in range(50)]
    rows = [(f"d{k * 37 % 260:03d}", "", 0, "", body) for k, body in enumerate(bodies)]
    asked = [("a", ["theft"]), ("b", ["theft", "none"]), ("c", ["theft", "theft"]), ("d", ["none"]), ("e", []), ("f", None)]
    docs = spark.createDataFrame([(x[0], x[4].split()) for x in rows] + [("x", None)], "doc_id string, toks array<string>").repartition(5)
    rules, total = [(1.2, 0.75), (0.9, 0.4)], Counter()
    bags = {x[0]: Counter(x[4].split()) for x in rows}
    mean = sum(sum(c.values()) for c in bags.values()) / 260
    for k1, b in rules:
        scores = {d: math.log(1 + 50.5 / 210.5) * c["theft"] * (k1 + 1) / (c["theft"] + k1 * (1 - b + b * sum(c.values()) / mean)) for d, c in bags.items() if c["theft"]}
        for rank, (_, d) in enumerate(sorted((-round(s, 4), d) for d, s in scores.items()), 1):
            total[d] += 1 / (60 + rank)
    want = [(d, -score) for score, d in sorted((-round(s, 8), d) for d, s in total.items())[:5]]
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    for on in ("true", "false"):  # one partition, and several
        spark.conf.set("spark.sql.adaptive.enabled", on)
        try:
            got = r.bm25_fused(docs, spark.createDataFrame(asked, "query string, toks array<string>"), rules, block=block).orderBy("query", "rank").collect()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        assert [tuple(x) for x in got] == [(q, *w, n) for q in "abc" for n, w in enumerate(want, 1)]
    if block > 1:  # the operator for any rankers, by scans of its own
        docs, asked = docs.where("toks IS NOT NULL"), spark.createDataFrame(asked[:1], "query string, toks array<string>")
        ranker = lambda k1, b: (lambda depth: r.bm25(docs, asked, depth, k1, b), lambda wanted: r.bm25_places(docs, asked, wanted, k1, b))
        assert [tuple(x) for x in r.fuse_exactly([ranker(*x) for x in rules], 5).orderBy("rank").collect()] == [("a", *w, n) for n, w in enumerate(want, 1)]


def test_fusion_collapse_and_rerank(spark):
    a = spark.createDataFrame([(1, 10, 9.0, 1), (1, 20, 8.0, 2)], "query bigint, doc_id bigint, score double, rank int")
    b = spark.createDataFrame([(1, 20, 9.0, 1), (1, 30, 8.0, 2)], "query bigint, doc_id bigint, score double, rank int")
    assert [(x.doc_id, x.score) for x in r.fuse([a, b]).orderBy("rank").collect()] == [(20, round(1 / 61 + 1 / 62, 8)), (10, round(1 / 61, 8)), (30, round(1 / 62, 8))]
    parts = spark.createDataFrame([(10, "X", 1), (20, "X", 1), (30, "Y", 2)], "doc_id bigint, act string, section int")
    assert [(x.act, x.score) for x in r.collapse(a.unionAll(b), parts, "doc_id", ["act", "section"]).orderBy("rank").collect()] == [("X", 9.0), ("Y", 8.0)]
    texts = spark.createDataFrame([(10, "a"), (20, "abc")], "doc_id bigint, text string")
    queries = spark.createDataFrame([(1, "q")], "query bigint, text string")
    assert [x.doc_id for x in r.rerank(a, texts, queries, lambda q, t: F.length(t).cast("double"), k=1).collect()] == [20]
    docs = spark.createDataFrame([(1, "theft of a cow", "BNS"), (2, "theft", "BSA")], "doc_id bigint, text string, act string")
    asked = spark.createDataFrame([(7, "theft")], "query bigint, text string")
    assert [x.doc_id for x in r.search(docs, asked, k=2).orderBy("rank").collect()] == [2, 1]
    assert [x.doc_id for x in r.search(docs, asked, k=2, where=F.col("act") == "BNS").collect()] == [1]


def test_metrics_by_hand(spark):
    ranking = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "c", 3), (2, "z", 1), (2, "a", 7)], "query bigint, item string, rank int")
    gold = spark.createDataFrame([(1, "b"), (1, "x"), (2, "a"), (3, "a")], "query bigint, item string")
    got = {x["query"]: tuple(x)[1:] for x in e.ranking_metrics(ranking, gold, "item").collect()}
    assert got[1] == (0.5, 1, 0.5, round((1 / math.log2(3)) / (1 + 1 / math.log2(3)), 6))
    assert got[2] == (0.0, 0, round(1 / 7, 6), round(1 / math.log2(8), 6)) and got[3] == (0.0, 0, 0.0, 0.0)
    assert e.averages(e.ranking_metrics(ranking, gold, "item")).first()["n"] == 3


def test_bootstrap_split_sample_gate(spark):
    df = spark.range(400).select(F.col("id"), (F.col("id") % 10).cast("double").alias("v"))
    row = e.bootstrap(df, "v", "id", 100).first()
    assert row.n == 400 and row.mean == 4.5 and 4.0 < row.low < 4.5 < row.high < 5.0
    assert e.bootstrap(df.limit(0), "v", "id", 5).first()["n"] == 0
    split = e.stratified(df, F.col("id") % 2, "id", 4)
    assert split.where("split = 'test'").count() == e.stratified(df.repartition(7), F.col("id") % 2, "id", 4).where("split = 'test'").count() and 60 < split.where("split = 'test'").count() < 140
    assert [x.id for x in e.hash_sample(df, "id", 5).collect()] == [x.id for x in e.hash_sample(df.repartition(3), "id", 5).collect()]
    now, base = spark.createDataFrame([(0.5, 0.7)], "a double, b double"), spark.createDataFrame([(0.52, 0.75)], "a double, b double")
    assert {x.measure: x.passed for x in e.gate(now, base, ["a", "b"]).collect()} == {"a": True, "b": False}
    pairs = e.paired_difference(df, df.withColumn("v", F.col("v") - 1), "v", "id")
    assert {x.v for x in pairs.collect()} == {1.0}


def test_bootstrap_ci_rests_on_1000_resamples(spark, tmp_path):
    rows = [(k, "x", (k * 37) % 101) for k in range(60)]
    spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    cuts, means = (0.36787944, 0.73575888, 0.91969860, 0.98101184, 0.99634015, 0.99940582), []
    for j in range(1, 1001):
        times = [sum(int(hashlib.md5(f"42:{k}:{j}".encode()).hexdigest()[:8], 16) / 2**32 >= c for c in cuts) for k, _, _ in rows]
        means.append(sum(n * t for (_, _, n), t in zip(rows, times)) / sum(times))
    means.sort()
    at = lambda p: means[int(999 * p)] + (999 * p % 1) * (means[int(999 * p) + 1] - means[int(999 * p)])
    row = QUERIES["bootstrap_ci"](spark, str(tmp_path)).first()
    assert (row.n, row.low, row.high) == (60, pytest.approx(at(0.025), abs=1e-5), pytest.approx(at(0.975), abs=1e-5))


def test_every_stratum_has_its_exact_share(spark):
    sizes = {"a": 3, "b": 1, "c": 501, None: 7}
    df = spark.createDataFrame([(n, f"{s}{j}") for s, n in sizes.items() for j in range(n)], "size int, id string").withColumn("s", F.when(F.col("size") != 7, F.col("size")))
    got = e.stratified(df, F.col("s"), "id", 5)
    assert got.columns == ["size", "id", "s", "stratum", "split"] and got.count() == 512
    assert {x["size"]: x.n for x in got.groupBy("size").agg(F.count_if(F.col("split") == "test").alias("n")).collect()} == {3: 1, 1: 1, 501: 101, 7: 2}
    rows = [(hashlib.md5(f"42:501:c{j}".encode()).hexdigest()[:8], f"c{j}") for j in range(501)]
    assert {x.id for x in got.where("size = 501 and split = 'test'").collect()} == {i for _, i in sorted(rows)[::5]}


def test_citations_rates_latency_threshold(spark):
    answers = spark.createDataFrame([(1, "See BNS 103(1) and BSA 999. None here. BNS 103(2)!"), (2, None), (3, "")], "doc_id bigint, text string")
    corpus = spark.createDataFrame([("BNS", 103), ("BNS", 103)], "act string, section int")
    assert [tuple(x) for x in e.check_citations(answers, corpus).collect()] == [(1, 2, 1, 1)]
    assert [x.s for x in answers.select(e.cited_sentences(F.col("text")).alias("s")).collect()] == [pytest.approx(2 / 3), None, None]
    a = spark.createDataFrame([(True, False), (False, False), (True, True), (False, True), (False, True)], "refused boolean, ok boolean")
    assert tuple(e.rates(a, F.col("refused"), F.col("ok")).first()) == (5, 0.5, 0.333333)
    t = spark.createDataFrame([(k, float(k)) for k in range(13)], "k int, ms double")
    assert tuple(e.latency(t, "ms", "k").first()) == (10, 7.5, pytest.approx(11.55))
    scored = spark.createDataFrame([(1, k / 100) for k in range(100)] + [(0, 0.0)], "label int, probability double")
    assert e.threshold(scored, "label").first()["threshold"] == pytest.approx(0.05, abs=0.011)


def test_answerability_on_held_out_rows(spark):
    rows = [(k, float(k % 2), float(k % 2) * 3 + (k % 7) / 7, None if k % 50 == 0 else 1.0) for k in range(300)]
    df = spark.createDataFrame(rows, "id int, label double, a double, b double")
    got = e.answerability(df, ["a", "b"], "label", "id", F.col("id") < 200).where("id >= 200")
    assert got.where((F.col("probability") > 0.5) == (F.col("label") == 1)).count() >= 95


def test_dangling_fingerprint_ablations(spark):
    rows = spark.createDataFrame([("BNS", 1), ("BNS", 9), (None, 9), ("BNS", None)], "act string, section int")
    corpus = spark.createDataFrame([("BNS", 1), ("BNS", 1)], "act string, section int")
    assert [tuple(x) for x in e.dangling(rows, corpus, ["act", "section"]).collect()] == [("BNS", 9)]
    a = e.fingerprint(rows, ["act", "section"]).first()
    assert a == e.fingerprint(rows.repartition(3), ["act", "section"]).first() and a != e.fingerprint(rows.limit(3), ["act", "section"]).first()
    digest = lambda *values: e.fingerprint(spark.createDataFrame([(v,) for v in values], "v string"), ["v"]).first()
    assert digest("x", "x") != digest("y", "y") and digest("x", "x") != digest("x") and digest(None) != digest("n") and digest("x", "y") == digest("y", "x")
    results = spark.createDataFrame([("bm25", "dev", 0.5, 0.4, 0.3), ("bm25", "test", 0.6, 0.5, 0.4), ("rrf", "dev", 0.7, 0.6, 0.5)], "config string, split string, recall double, mrr double, ndcg double")
    got = {x.config: x for x in e.ablations(results).collect()}
    assert got["bm25"]["test_recall"] == 0.6 and got["rrf"]["test_recall"] is None
