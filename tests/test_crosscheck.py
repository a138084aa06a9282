import random

from statuteloom.functions import similarity as s
from statuteloom.operators import crosscheck as c


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_similarity_against_dynamic_programming():
    rng = random.Random(1)
    for _ in range(400):
        a, b = ("".join(rng.choices("abcé ", k=rng.randint(0, 25))) for _ in "ab")
        assert s.common_subsequence(a, b) == lcs(a, b)
    assert round(s.indel_ratio("kitten", "sitting"), 2) == 61.54 and s.indel_ratio("", "") == 100.0
    assert s.token_set_ratio("punishment for murder", "murder punishment for all") == 100.0 and s.token_set_ratio("", "a") == 0.0


def test_flags_hints_and_notes(spark):
    cols = "act string, section int, title string, text string"
    ours = spark.createDataFrame([("BNS", 1, "Murder", "same text here"), ("BNS", 2, "Theft", "completely other"), ("BNS", 3, "Riot", "x"), ("BNSS", 1, "Bail", None), ("BNS", 4, None, "t"), ("BNS", 5, "P|Q", "t")], cols)
    theirs = spark.createDataFrame([("BNS", 1, "murder.", "Same  text — here"), ("BNS", 2, "Theft", "zzz qqq www kkk jjj"), ("BNS", 3, "Riot", ""), ("BNSS", 1, "Bail", ""), ("BNS", 4, "t", "t")], cols)
    got = {(r.act, r.section): r for r in c.compare(ours, theirs, ["act", "section"], ["BNSS"]).collect()}
    assert (got["BNS", 1].title_score, got["BNS", 1].body_score, got["BNS", 1].flagged, got["BNS", 1].hint) == (100.0, 100.0, False, "")
    assert got["BNS", 2].flagged and got["BNS", 2].hint.startswith("length ours/ref = ")
    assert got["BNS", 3].flagged and got["BNS", 3].hint == "reference body empty"
    assert not got["BNSS", 1].flagged and got["BNS", 4].title_score == 0.0 and got["BNS", 4].flagged
    assert got["BNS", 5].flagged and got["BNS", 5].hint == "no reference row" and got["BNS", 5].title_score is None
    compared = c.compare(ours, theirs, ["act", "section"], ["BNSS"])
    earlier = spark.createDataFrame([("BNS", 2, "theirs wrong", "n"), ("BNS", 3, "who knows", "m")], "act string, section int, verdict string, note string")
    kept = {r.section: r for r in c.carry_over(compared, earlier, ["act", "section"], ["theirs wrong"]).collect()}
    assert (kept[2].verdict, kept[3].verdict, kept[3].note) == ("theirs wrong", "", "m")
    lines = [r.line for r in c.report_lines(compared.where("section = 5")).collect()]
    assert lines == ["| BNS 5 | P/Q | n/a | n/a | no reference row |  |  |"]
    assert c.compare(ours.limit(0), theirs, ["act", "section"]).count() == 0
    assert {(r.act, r.sections, r.flagged) for r in c.summary(compared).collect()} == {("BNS", 5, 4), ("BNSS", 1, 0)}
