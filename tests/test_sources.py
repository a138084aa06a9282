import hashlib

import pytest
from pyspark.sql import functions as F

from statuteloom import schemas
from statuteloom.operators import patching
from statuteloom.sources import readers, writers
from statuteloom.streaming import incremental


def test_csv_and_transcription(spark, tmp_path):
    (tmp_path / "b.csv").write_text("x\n1\n")
    (tmp_path / "a.csv").write_text('Chapter,Chapter_name,Chapter_subtype,Section,Section _name,Description\n6,Of Body,,103,"Murder. ","(1) Whoever date1.\n(2) When, ""so"""\nVII,x,,104,Theft,\n', encoding="utf-8")
    path = readers.first_csv(spark, str(tmp_path))
    assert path.endswith("a.csv")
    rows = readers.csv_strings(spark, path)
    assert rows.columns == ["chapter", "chapter_name", "chapter_subtype", "section", "section_name", "description"] and rows.where("description = ''").count() == 1
    got = {r.section: r for r in readers.transcription(rows, act="BNS").collect()}
    assert (got[103].title, got[103].chapter_no, got[103].text, [s.number for s in got[103].subsections]) == ("Murder", "VI", '(1) Whoever date.\n(2) When, "so"', ["1", "2"])
    assert got[104].empty and got[104].chapter_no == "VII"
    with pytest.raises(FileNotFoundError):
        (tmp_path / "none").mkdir()
        readers.first_csv(spark, str(tmp_path / "none"))


def test_jsonl_and_json(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, t string")
    assert writers.write_jsonl(df, str(tmp_path / "o")) == 2
    assert sorted(tuple(r) for r in readers.jsonl(spark, str(tmp_path / "o"), "id int, t string").collect()) == [(1, "a"), (2, None)]
    (tmp_path / "bad.jsonl").write_text('{"id": 1}\n\n{"id": \n')
    with pytest.raises(Exception):
        readers.jsonl(spark, str(tmp_path / "bad.jsonl"), "id int").collect()
    (tmp_path / "t.json").write_text('[{"section_no": "1", "title": "First"}, {"section_no": "1", "title": "Again"}, {"section_no": "2A", "title": "no"}, {"section_no": " 3 "}]')
    assert [tuple(r) for r in readers.json_titles(spark, str(tmp_path / "t.json"), "BNSS").orderBy("section").collect()] == [("BNSS", 1, "First"), ("BNSS", 3, "")]


def test_markdown_tokens_yaml_manifest(spark, tmp_path):
    (tmp_path / "r.md").write_text("# x\n| Section | a |\n|---|---|\n| BNS 5 | T | 80.0 | n/a | h | theirs wrong | my note |\n| BNS 6 | short |\n")
    assert [tuple(r) for r in readers.verdicts(spark, str(tmp_path / "r.md")).collect()] == [("BNS", 5, "theirs wrong", "my note")]
    d = tmp_path / "tok"
    d.mkdir()
    for name, data in (("a", " k1 \n".encode("utf-8-sig")), ("b", "k2".encode("utf-16")), ("c", b"k3\n")):
        (d / name).write_bytes(data)
    assert sorted(r.text for r in readers.decoded_files(spark, str(d)).collect()) == ["k1", "k2", "k3"]
    (tmp_path / "n.yaml").write_text("- ipc: 124A\n  note: closest\n")
    assert [tuple(r) for r in readers.yaml_rows(spark, str(tmp_path / "n.yaml"), "ipc string, note string").collect()] == [("124A", "closest")]
    assert readers.yaml_rows(spark, str(tmp_path / "missing.yaml"), "ipc string, note string").count() == 0
    got = {r.path[-1]: r for r in writers.manifest(spark, str(d)).collect()}
    assert (got["c"].sha256, got["c"].bytes) == (hashlib.sha256(b"k3\n").hexdigest(), 3)


def test_reports(spark, tmp_path):
    rates = spark.createDataFrame([(2, 1, 0.5)], "n int, agree int, rate double")
    judged = spark.createDataFrame([(5, ["302"], ["34"], False), (6, ["1"], ["1"], True)], "section int, theirs array<string>, ours array<string>, agrees boolean")
    writers.agreement_report(rates, judged, str(tmp_path / "rep"), "table")
    lines = [r.value for r in spark.read.text(str(tmp_path / "rep")).collect()]
    assert "**Agreement: 1/2 (50.0%)**" in lines and "| 5 | 302 | 34 |" in lines
    writers.write_map(spark.createDataFrame([("302", ["103(1)"])], "ref string, bns array<string>"), "ref", "bns", str(tmp_path / "map"))
    assert spark.read.text(str(tmp_path / "map")).first()["value"] == '{"302":["103(1)"]}'


def test_patching(spark):
    cols = "sec_id bigint, title string, text string, chapter_title string, in_force boolean, subsections array<struct<number:string,text:string,in_force:boolean>>"
    s = spark.createDataFrame([(1, "T", "x", None, True, [("1", "a", True), ("2", "b", True)]), (2, "U", "y", None, True, [])], cols)
    p = spark.createDataFrame([(1, "2", "in_force", "false"), (2, None, "text", "(1) new\n(2) cut"), (2, None, "title", "V")], "sec_id bigint, subsection string, field string, value string")
    got = {r.sec_id: r for r in patching.patch_sections(s, p).collect()}
    assert not got[1].in_force and [x.in_force for x in got[1].subsections] == [True, False]
    assert (got[2].title, got[2].in_force, [x.number for x in got[2].subsections]) == ("V", True, ["1", "2"])
    twice = spark.createDataFrame([(2, "zzz first", 1), (2, "aaa second", 2)], "sec_id bigint, value string, o int").selectExpr("sec_id", "NULL AS subsection", "'title' AS field", "value", "o")
    assert {r.title for r in patching.patch_sections(s, twice, order="o").collect()} == {"T", "aaa second"}
    with pytest.raises(ValueError, match="order"):
        patching.patch_sections(s, twice)
    for bad in ((9, None, "title", "x"), (1, "7", "in_force", "true"), (1, None, "page", "3"), (1, None, "in_force", "false"), (1, "2", "title", "x")):
        with pytest.raises(ValueError, match="patches"):
            patching.patch_sections(s, spark.createDataFrame([bad], p.schema))


def test_checks(spark):
    s = spark.createDataFrame([("E", "BNS", 1, "a", "t"), ("E", "BNS", 3, "", None), ("E", "BNS", 3, "b", "t")], "edition string, act string, section int, title string, text string")
    assert tuple(schemas.violations(s).first()) == ("E", "BNS", 3, 1, 3, 1, 1, 1, 1)
    assert s.select(schemas.one_of("act", schemas.ACTS)).count() == 3
    with pytest.raises(Exception, match="title"):
        s.select(schemas.one_of("title", ("a",))).collect()


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(6).write.parquet(str(tmp_path / "in"))
    live = incremental.stream(spark, str(tmp_path / "in"), events.schema, 2)
    query = incremental.windowed(live, late="60 days").writeStream.outputMode("complete").format("memory").queryName("daily").option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    key = lambda df: sorted((str(r.window_start), r.event_type, r.n, round(r.total, 6)) for r in df.collect())
    assert key(spark.table("daily")) == key(incremental.windowed(events))
    own = incremental.distinct_entries(incremental.stream(spark, str(tmp_path / "in"), events.schema), ["user_id", "event_type"], "ts", "90 days")
    query = own.writeStream.outputMode("append").format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "cp2")).start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("once").count() == events.select("user_id", "event_type").distinct().count()
    assert incremental.sessions(events).agg(F.sum("n")).first()[0] == events.count()
