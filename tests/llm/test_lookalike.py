import unicodedata

from pyspark.sql import functions as F

from statuteloom.llm import lookalike as k


def form(spark, *texts):
    return [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(k.plain_form(F.col("t"))).collect()]


def test_forms(spark):
    got = form(spark, "Ｔｈｅｆｔ，　５", "ﬁnal oﬃce", "рау", "𝐛𝐨𝐥𝐝 𝚖𝚘𝚗𝚘 𝟓", "a​b­c﻿", "one two three", "  x \n", None, "", "x²—‐", "ɑɡο")
    assert got == ["Theft, 5", "final office", "pay", "bold mono 5", "abc", "one two three", "x", None, "", "x²—‐", "ago"]


def test_rule_made_tables_agree_with_unicode():
    wrong, right, unseen = k.tables()
    assert len(wrong) == len(right) and len(set(wrong + unseen)) == len(wrong + unseen) and not any(c.isascii() for c in wrong + unseen)
    assert all(unicodedata.category(c) != "Nd" or unicodedata.digit(c) == int(r) for c, r in zip(wrong, right) if r.isdigit())


def test_pairs(spark):
    s = spark.createDataFrame([(1, "E", "pay the café"), (2, "E", "pay"), (3, "E", "Pay"), (4, "E", None), (5, "E", "pay 5"), (6, None, "pay"), (7, "F", "pay"), (8, "E", "same"), (2, "E", "pay"), (9, "E", "a-b")], "sec_id bigint, e string, text string")
    t = spark.createDataFrame([(10, "E", "рay the café"), (11, "E", "рау"), (12, "E", "pay 6"), (13, "E", " same\n"), (14, None, "рау"), (15, "E", "cafe"), (16, "E", "a‐b"), (17, "E", "a\nb"), (18, "E", ""), (19, "E", "pay\n5")], "kb_id bigint, e string, text string")
    got = sorted(tuple(r) for r in k.same_look(s, t, ["e"], "sec_id", "text", "kb_id", "text").collect())
    assert got == [(1, 10), (2, 11), (2, 11)]
    assert k.same_look(s.limit(0), t, ["e"], "sec_id", "text", "kb_id", "text").count() == 0


def test_canonical_forms_keep_every_row(spark):
    df = spark.createDataFrame([(1, "A", "рау"), (2, "A", "pay"), (3, None, "pay"), (4, "A", None), (5, "A", " "), (6, "A", "café"), (7, "A", "café"), (8, "A", "Pay"), (8, "A", "Pay")], "id bigint, key string, text string").selectExpr("*", "'old' AS canonical", "'f' AS form")
    got = sorted(((r.id, r.canonical) for r in k.canonical_forms(df, ["key"]).collect()), key=str)
    byid = dict(got)
    assert len(got) == 9 and byid[1] == byid[2] == "pay" and byid[3] == "pay" and byid[4] is None and byid[5] == "" and byid[6] == byid[7] and byid[8] == "Pay"
    assert k.canonical_forms(df.limit(0), ["key"]).count() == 0 and k.canonical_forms(df, []).count() == 9


def test_long_texts(spark):
    a, b = "word " * 20_000 + "end", "wοrd " * 20_000 + "еnd"
    s = spark.createDataFrame([(1, "E", a)], "sec_id bigint, e string, text string")
    t = spark.createDataFrame([(2, "E", b)], "kb_id bigint, e string, text string")
    assert k.same_look(s, t, ["e"], "sec_id", "text", "kb_id", "text").count() == 1
