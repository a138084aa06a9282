import pytest
from pyspark.sql import functions as F

from statuteloom.operators import mapping as m

RAW = "row_id bigint, bns_section string, bns_title string, status string, ipc_section string, ipc_title string"


@pytest.fixture(scope="module")
def rows(spark):
    raw = spark.createDataFrame(
        [
            (1, "103(1)", "Murder", "", "302", "Murder"), (2, "2(8)", "Document", "Change", "29", "Document"), (3, "", "", "Deleted", "29A", "E-record"), (4, "86", "Cruelty", "New Section", "", ""),
            (5, "100", "Homicide", "", "299 & 300", "Homicide"), (6, "", "", "Deleted", "377", "Offences"), (7, "152", "Acts", "", "Sec. 124A", "Sedition"), (8, "64(2)", "R", "", "376(2) and 376(3)", "R"), (9, " ", None, "-", None, None),
        ],
        RAW,
    )
    info = spark.createDataFrame([("d", "Murder", "Death", "IPC_302"), ("d", "Other", "x", "IPC_302"), ("d", "nan", "nan", "IPC_34")], "description string, offense string, punishment string, section string")
    return m.load(raw, "row_id", m.details(info)).cache()


def test_load(rows):
    got = {r.ordinal: r for r in rows.collect()}
    assert set(got) == set(range(1, 9))
    assert (got[1].bns, got[1].ipc, got[1].status, got[1].ipc_offence) == ("103(1)", ["302"], "carried_over", "Murder")
    assert (got[2].status, got[3].status, got[4].status, got[4].ipc) == ("changed", "deleted", "new_section", []) and got[3].bns is None


def test_lookup(spark, rows):
    notes = spark.createDataFrame([("124a", "closest provision"), ("377", "see note")], "ipc string, note string")
    asked = spark.createDataFrame([("IPC 302",), ("s. 376(2)",), ("376(9)",), ("377",), ("999",), ("124A",), (None,), ("302",)], "query string")
    got = {r.query: r for r in m.lookup(rows, asked, notes=notes).collect()}
    assert len(got) == 7
    assert [x.bns for x in got["IPC 302"].matches] == ["103(1)"] and got["IPC 302"].message == "Old section 302 is now BNS 103(1)."
    assert [x.bns for x in got["s. 376(2)"].matches] == ["64(2)"]
    assert [(x.bns, x.times) for x in got["376(9)"].matches] == [("64(2)", 2)]  # under the base once for each reference, gathered once
    assert not got["377"].found and "was deleted" in got["377"].message and got["377"].message.endswith("Note: see note")
    assert not got["999"].found and "not found" in got["999"].message and got["999"].matches == []
    assert got["124A"].note == "closest provision"


def test_indexes_and_counts(rows):
    back = {r.ref: r.bns for r in m.reverse_index(rows).collect()}
    assert back["302"] == ["103(1)"] and back["377"] == [] and back["299"] == ["100"]
    assert {r.bns_section: r.refs for r in m.section_refs(rows).collect()}[64] == ["IPC 376(2)", "IPC 376(3)"]
    assert {(r.status, r.n, r.sections) for r in m.status_counts(rows).collect()} >= {("deleted", 2, 0), ("new_section", 1, 1)}
    assert m.reverse_index(rows.limit(0)).count() == 0


def test_agreement(spark, rows):
    ref = spark.createDataFrame([(103, ["302"]), (86, []), (100, ["304"]), (999, ["1"])], "section int, theirs array<string>")
    judged = m.agreement_rows(rows, ref, "section", "theirs", F.lit(False))
    assert {r.section: r.agrees for r in judged.collect()} == {103: True, 86: True, 100: False, 999: False}
    assert tuple(m.agreement(judged).first()) == (4, 2, 0.5) and tuple(m.agreement(judged.limit(0)).first()) == (0, 0, None)


def test_rows_of_one_act(spark):
    df = spark.createDataFrame([("BNS ", 1), (None, 2), ("BSA", 3)], "act string, n int")
    assert sorted(r.n for r in m.of_act(df).collect()) == [1, 2] and m.of_act(df.drop("act")).count() == 3


def test_patches_meet_exactly_one_row(spark, rows):
    good = spark.createDataFrame([("103(1)", "Murder (corrected)")], "bns string, bns_title string")
    out = m.patch(rows, ["bns"], good, ["bns_title"], rows.limit(1).withColumn("ordinal", F.lit(99)))
    assert out.where("bns_title = 'Murder (corrected)'").count() == 1 and out.count() == 9
    for bad in ("1", None):
        with pytest.raises(ValueError, match="exactly one"):
            m.patch(rows, ["bns"], spark.createDataFrame([(bad, "x")], "bns string, bns_title string"), ["bns_title"])
    with pytest.raises(ValueError, match="several"):
        m.patch(rows, ["bns"], good.union(good), ["bns_title"])


def test_lookup_gathers_distinct_rows(spark, rows):
    many = rows.where("ordinal = 1").withColumn("ordinal", F.explode(F.sequence(F.lit(50), F.lit(649)))).unionByName(rows)
    got = m.lookup(many, spark.createDataFrame([("302",)], "query string")).first()
    assert [(x.bns, x.ordinal, x.times) for x in got.matches] == [("103(1)", 1, 601)]


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, o int")
    assert sorted(r.o for r in m.first_per_key(df, ["k"], "o").collect()) == [1, 3] and sorted(r.o for r in m.first_per_key(df, ["k"], "o", last=True).collect()) == [2, 3]
