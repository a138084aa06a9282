"""Scans: everything comes in as strings or under a stated schema, never by inference."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuteloom.functions.folds import subsections
from statuteloom.functions.numerals import to_roman
from statuteloom.functions.text import clean_title, drop_stray_footnotes, normalise_columns, normalise_text
from statuteloom.schemas import ACTS, CHUNK, CHUNK_TYPES, MAP_ROW, SECTION, STATUSES, one_of


def csv_strings(spark: SparkSession, path: str, normalise: bool = True) -> DataFrame:
    """All cells as strings, empty ones "" and not NULL, quoted cells over several lines, header names normalised."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8").na.fill("")
    return df.toDF(*(normalise_columns(df.columns) if normalise else [c.strip().lower() for c in df.columns]))


def first_csv(spark: SparkSession, folder: str) -> str:
    """Path of the first CSV file under a folder, by name; an error if there is none. Only names are listed, not contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(folder).select("path")
    path = files.agg(F.min("path")).first()[0]
    if path is None:
        raise FileNotFoundError(f"no CSV under {folder}")
    return path


def jsonl(spark: SparkSession, path: str, schema: str, allowed: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Records of a JSON Lines path under a schema; a malformed line is an error, blank lines are skipped.

    allowed names the values that coded fields may have; any other one is an error once its column is read, NULL passes.
    """
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return rows.select(*(one_of(c, allowed[c]) if allowed and c in allowed else F.col(c) for c in rows.columns))


def json_titles(spark: SparkSession, path: str, act: str) -> DataFrame:
    """(act, section, title) of a JSON array; only whole section numbers count, and of repeated ones the first."""
    rows = spark.read.schema("section_no string, title string").option("multiLine", "true").json(path).withColumn("_o", F.monotonically_increasing_id())
    rows = rows.where(F.trim("section_no").rlike("^[0-9]+$"))
    first = rows.groupBy(F.trim("section_no").cast("int").alias("section")).agg(F.min_by("title", "_o").alias("title"))
    return first.select(F.lit(act).alias("act"), "section", normalise_text(F.coalesce("title", F.lit(""))).alias("title"))


def markdown_rows(spark: SparkSession, path: str, first_cell: str, least: int) -> DataFrame:
    """(cells array<string>) of the table rows of Markdown files whose first cell matches and that have enough cells."""
    line = F.trim("value")
    cells = F.transform(F.split(F.regexp_replace(line, r"^\||\|$", ""), r"\|"), lambda c: F.trim(c))
    return spark.read.text(path).where(line.startswith("|")).select(cells.alias("cells")).where(F.col("cells")[0].rlike(first_cell) & (F.size("cells") >= least))


def verdicts(spark: SparkSession, path: str) -> DataFrame:
    """(act, section, verdict, note) of an earlier cross-check report."""
    rows = markdown_rows(spark, path, r"^(?:BNS|BNSS|BSA) [0-9]+$", 7)
    key = F.split(F.col("cells")[0], " ")
    return rows.select(key[0].alias("act"), key[1].cast("int").alias("section"), F.col("cells")[5].alias("verdict"), F.col("cells")[6].alias("note"))


def decoded_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of small text files in UTF-8 or UTF-16 with a byte order mark, stripped."""
    files = spark.read.format("binaryFile").load(path)
    mark = F.hex(F.substring("content", 1, 2))
    text = F.when(mark.isin("FFFE", "FEFF"), F.decode("content", "UTF-16")).otherwise(F.regexp_replace(F.decode("content", "UTF-8"), "^\ufeff", ""))
    return files.select("path", F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "").alias("text"))


def yaml_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a reviewed YAML list (patches, notes), which is written by hand; no file or an empty one gives no rows."""
    import os

    import yaml

    entries = (yaml.safe_load(open(path, encoding="utf-8")) or []) if os.path.exists(path) else []
    names = [part.split()[0] for part in schema.split(",")]
    return spark.createDataFrame([tuple(None if e.get(n) is None else str(e.get(n)) for n in names) for e in entries], schema)


def transcription(raw: DataFrame, keep: Sequence[str] = (), act: str | None = None) -> DataFrame:
    """Section records (with `empty` for those without text) of a section transcription whose cells are strings.

    Stray footnote digits go, Arabic chapter numbers become Roman, titles lose their closing marks.
    """
    text = drop_stray_footnotes(normalise_text(F.coalesce("description", F.lit(""))))
    chapter = F.trim(F.coalesce("chapter", F.lit("")))
    roman = F.when(chapter.rlike("^[0-9]+$"), to_roman(F.nullif(F.regexp_extract(chapter, "^([0-9]+)$", 1), F.lit("")).cast("int"))).otherwise(F.nullif(chapter, F.lit("")))
    rows = raw.select(
        *keep, F.col("act") if act is None else F.lit(act).alias("act"), F.trim("section").try_cast("int").alias("section"), clean_title(F.coalesce("section_name", F.lit(""))).alias("title"),
        roman.alias("chapter_no"), F.nullif(normalise_text(F.coalesce("chapter_name", F.lit(""))), F.lit("")).alias("chapter_title"), text.alias("text"),
    )
    force = F.transform(subsections(F.col("text")), lambda s: F.struct(s["number"].alias("number"), s["text"].alias("text"), F.lit(True).alias("in_force")))
    return rows.select("*", force.alias("subsections"), F.lit("kaggle").alias("source"), (F.col("text") == "").alias("empty"))


def sections(spark: SparkSession, path: str) -> DataFrame:
    return jsonl(spark, path, SECTION, {"act": ACTS})


def map_rows(spark: SparkSession, path: str) -> DataFrame:
    return jsonl(spark, path, MAP_ROW, {"status": STATUSES})


def chunks(spark: SparkSession, path: str) -> DataFrame:
    return jsonl(spark, path, CHUNK, {"act": ACTS, "chunk_type": CHUNK_TYPES})
