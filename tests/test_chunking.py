import re

from pyspark.sql import functions as F

from statuteloom.operators import chunking

COLUMNS = "sec_id bigint, act string, section int, title string, chapter_no string, chapter_title string, text string, page_start int, subsections array<struct<number:string,text:string,in_force:boolean>>"


def sections(spark, *rows):
    return spark.createDataFrame([(k, "BNS", 100 + k, "Title of it", "VI", "Of Matters", text, 1, subs or []) for k, (text, subs) in enumerate(rows)], COLUMNS)


def chunks(spark, text, budget, subs=None):
    return chunking.plan(sections(spark, (text, subs)), "sec_id", budget).orderBy(F.length("chunk_id"), "chunk_id").collect()


def words(n, word="word"):
    return " ".join([word] * n)


def test_header(spark):
    got = spark.range(1).select(
        chunking.header(F.lit("BNS"), F.lit(103), F.lit("Murder"), F.lit("VI"), F.lit("Of Body"), F.array(*[F.lit(f"IPC {k}") for k in range(6)])).alias("a"),
        chunking.header(F.lit("BNS"), F.lit(1), F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit("x"), F.array().cast("array<string>")).alias("b"),
    ).first()
    assert got.a == "[BNS 103] Murder | Chapter VI: Of Body | Formerly: IPC 0, IPC 1, IPC 2, IPC 3, IPC 4, …"
    assert got.b == "[BNS 1] "


def test_whole_section_is_one_chunk(spark):
    (c,) = chunks(spark, "(1) Whoever does.\n(2) And when.", 50)
    assert (c.chunk_id, c.chunk_type, c.subsections, c.in_force, c.over_budget) == ("BNS-100-c1", "section", ["1", "2"], True, False)
    assert c.text.startswith(c.header + "\n") and c.tokens == len(c.text.split())


def test_packing_clauses_and_force(spark):
    got = chunks(spark, "\n".join(f"({k}) {words(19)}" for k in range(1, 6)), 60)
    assert [c.subsections for c in got] == [["1", "2"], ["3", "4"], ["5"]] and {c.chunk_type for c in got} == {"subsections"}
    got = chunks(spark, "Definitions:\n" + "\n".join(f"({c}) {words(15, 'def')};" for c in "abcdefgh"), 50)
    assert {c.chunk_type for c in got} == {"clauses"} and all(c.tokens <= 50 for c in got)
    for letter in "abcdefgh":
        assert sum(f"({letter}) " in c.text for c in got) == 1
    subs = [("1", "(1) In force.", True), ("2", "(2) Not yet.", False)]
    got = chunks(spark, "(1) In force.\n(2) Not yet.", 200, subs)
    assert [(c.subsections, c.in_force) for c in got] == [(["1"], True), (["2"], False)]


def test_illustrations_last_and_words_as_a_last_resort(spark):
    got = chunks(spark, "(1) Whoever cheats.\nIllustrations\n(a) A cheats B.\n(b) C cheats D.\nExplanation.—More.", 200)
    assert [c.chunk_type for c in got] == ["section", "illustration"]
    assert "Explanation.—More." in got[0].text and got[1].text.endswith("Illustrations\n(a) A cheats B.\n(b) C cheats D.")
    got = chunks(spark, "(1) " + words(100), 30)
    assert all(c.tokens <= 30 for c in got) and sum(len(re.findall(r"\bword\b", c.text)) for c in got) == 100
    got = chunks(spark, "one", 3)
    assert [c.over_budget for c in got] == [True]


def test_null_blank_and_empty_tables(spark):
    df = sections(spark, (None, None), (" \n ", None))
    assert chunking.plan(df, "sec_id").count() == 0 and chunking.plan(df.limit(0), "sec_id").count() == 0
    assert chunking.stats(chunking.plan(df, "sec_id"), "act").count() == 0


def test_another_counter(spark):
    chars = lambda text: F.length(text)
    df = sections(spark, ("(1) " + words(40) + "\n(2) " + words(5), None))
    got = chunking.plan(df, "sec_id", 120, counter=chars).orderBy(F.length("chunk_id"), "chunk_id").collect()
    head = len(got[0].header)
    assert len(got) > 2 and not any(c.over_budget for c in got) and max(c.tokens for c in got) <= 120
    assert sum(len(re.findall(r"\bword\b", c.text)) for c in got) == 45 and all(c.tokens <= len(c.text) and c.tokens > head for c in got)


def test_statistics(spark):
    rows = [(k, "BNS", t, False) for k, t in enumerate([10, 20, 20, 40, 70])] + [(9, "BSA", 5, True)]
    df = spark.createDataFrame(rows, "key bigint, act string, tokens int, over_budget boolean")
    got = {r.act: r for r in chunking.stats(df, "act").collect()}
    assert (got["BNS"].p50, got["BNS"].p95, got["BNS"].mean_tokens, got["BNS"].max_tokens) == (20, 70, 32.0, 70) and got["BSA"].p50 == 5
    assert {(r.label, r.n) for r in chunking.histogram(df).collect()} == {("0-49", 5), ("50-99", 1)}


def test_every_word_is_kept(spark, sf_dir):
    from statuteloom.functions.text import normalise_text, word_count

    df = spark.read.parquet(f"{sf_dir}/sections.parquet").withColumn("subsections", F.array().cast("array<struct<number:string,text:string,in_force:boolean>>"))
    plan = chunking.plan(df, "sec_id", 60).withColumn("body", word_count(F.col("text")) - word_count(F.col("header")) - (F.col("chunk_type") == "illustration").cast("int"))
    got = plan.groupBy("key").agg(F.sum("body").alias("n"), F.max(F.when(~F.col("over_budget"), F.col("tokens"))).alias("most"))
    source = df.select(F.col("sec_id").alias("key"), word_count(normalise_text(F.col("text"))).alias("words"), F.size(F.regexp_extract_all("text", F.lit(r"(?im)^\s*Illustrations?"), F.lit(0))).alias("headings"))
    both = source.join(got, "key", "left")
    assert both.where("words > 0 and headings = 0 and n <> words").count() == 0 and both.where("most > 60").count() == 0
