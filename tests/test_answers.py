import pytest
from pyspark.sql import functions as F

from statuteloom import schemas
from statuteloom.operators import evaluation as e
from statuteloom.sources import readers

REFUSAL = "Cannot say."


def test_rules_of_answers(spark):
    answers = [
        (1, "It is theft BNS 303(2). See BNS 303."), (2, f" {REFUSAL} "), (3, "Theft. It is BNS 303."), (4, "See BNS 999."), (5, "See BNS 304."),
        (6, None), (7, ""), (8, "No citation at all."),
    ]
    corpus = spark.createDataFrame([("BNS", 303), ("BNS", 303), ("BNS", 304), (None, None)], "act string, section int")
    context = spark.createDataFrame([(k, "BNS", s) for k in range(1, 9) for s in (303, 303, 999)] + [(5, None, None)], "doc_id int, act string, section int")
    rows = spark.createDataFrame(answers, "doc_id int, text string").withColumn("act", F.lit("clash")).withColumn("n", F.lit(0))
    got = {r.doc_id: r for r in e.check_answers(rows, corpus, context, REFUSAL).collect()}
    assert {k for k, r in got.items() if r.compliant} == {1, 2} and len(got) == 8
    assert (got[1].n, got[1].share, got[3].share) == (1, 1.0, 0.5)
    assert [(got[k].unknown, got[k].outside) for k in (1, 4, 5)] == [(0, 0), (1, 0), (0, 1)]
    assert (got[6].n, got[6].share, got[7].share, got[8].share) == (0, None, None, 0.0)
    assert e.check_answers(rows.limit(0), corpus, context, REFUSAL).count() == 0
    assert not e.check_answers(rows.where("doc_id = 1"), corpus.limit(0), context, REFUSAL).first().compliant


def test_citations_out_of_range(spark):
    texts = ["BNS 359 and BNS 358, BSA 171(2), BNS 359", "BNSS 531", "BNS 0", None, ""]
    got = spark.createDataFrame(list(enumerate(texts)), "k int, t string").orderBy("k").select(e.out_of_range(F.col("t"), schemas.EXPECTED_SECTIONS).alias("w")).collect()
    assert [r.w for r in got] == [["BNS 359", "BSA 171(2)"], [], ["BNS 0"], None, []]


@pytest.mark.parametrize("answers, refusals, want", [(85, 100, 15), (85, 3, 3), (0, 5, 0), (17, 0, 0)])
def test_share_of_refusals(spark, answers, refusals, want):
    ids = lambda lo, n: spark.range(lo, lo + n).withColumnRenamed("id", "doc_id")
    got = e.with_refusals(ids(0, answers), ids(1000, refusals), "doc_id").groupBy("kind").count().collect()
    assert {r["kind"]: r["count"] for r in got} == {k: n for k, n in (("answer", answers), ("refusal", want)) if n}


def test_hash_rank_numbers_every_stratum(spark):
    df = spark.range(500).withColumn("s", F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 2 == 0, "cold"))
    for row in e.hash_rank(df, F.col("s"), "id").groupBy("stratum").agg(F.sort_array(F.collect_list("place")).alias("p")).collect():
        assert list(row.p) == list(range(1, len(row.p) + 1))


def test_hard_negatives_are_of_other_groups(spark):
    ranking = spark.createDataFrame([(1, i, i) for i in range(1, 60)] + [(2, 5, 1)], "query int, item int, rank int")
    groups = spark.createDataFrame([(i, "a" if i < 12 else "b" if i < 20 else None) for i in range(1, 60)], "item int, g string")
    own = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "query int, g string")
    assert [tuple(r) for r in e.hard_negatives(ranking, own, groups, "item", ["g"]).collect()] == [(1, 12, 12)]
    assert e.hard_negatives(ranking, own, groups.where("g = 'a'"), "item", ["g"]).count() == 0


def test_features_of_rankings(spark):
    asked = spark.createDataFrame([(1, "what of IPC 302"), (2, ""), (3, None)], "query int, text string")
    ranking = spark.createDataFrame([(1, 10, 4.0, 1), (1, 11, 3.0, 2), (1, 12, 2.0, 6)], "query int, item int, score double, rank int")
    groups = spark.createDataFrame([(10, "BNS"), (11, "BSA"), (12, "BNSS")], "item int, act string")
    got = {r["query"]: tuple(r)[1:] for r in e.ranking_features(asked, ranking, groups, "item").collect()}
    assert got[1] == (4.0, 1.0, 3.5, 1.0, 2, 4, True) and got[2] == got[3] == (0.0, 0.0, 0.0, 0.0, 0, 0, False)


def test_totals(spark):
    rows = [("e", "BSA", k % 170 + 1) for k in range(171)] + [("e", "BNS", 1), ("e", "BNS", None), ("f", "XYZ", 1)]
    got = {(r.edition, r.act): (r.sections, r.expected, r.state) for r in schemas.totals(spark.createDataFrame(rows, "edition string, act string, section int")).collect()}
    assert got == {("e", "BSA"): (170, 170, "ok"), ("e", "BNS"): (1, 358, "MISMATCH"), ("f", "XYZ"): (1, None, "MISMATCH")}


def test_values_of_json_lines(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"bns": "303", "status": "changed"}\n\n{"bns": "1", "status": null}\n')
    assert readers.map_rows(spark, str(tmp_path / "m.jsonl")).select("status").orderBy("status").collect()[1].status == "changed"
    (tmp_path / "w.jsonl").write_text('{"bns": "303", "status": "other"}\n')
    with pytest.raises(Exception, match="status: other"):
        readers.map_rows(spark, str(tmp_path / "w.jsonl")).collect()
