"""Sinks: JSON Lines, report text, and a manifest of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from statuteloom.session import small_side


def write_jsonl(df: DataFrame, path: str) -> int:
    """Writes JSON Lines and returns the number of rows, counted while they are written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return seen.get["rows"]


def write_map(df: DataFrame, key: str, value: str, path: str) -> None:
    """One JSON object a line, {key: value}, for key-value results such as the reverse index."""
    df.select(F.to_json(F.create_map(key, value)).alias("value")).write.mode("overwrite").text(path)


def manifest(spark: SparkSession, path: str, sources: DataFrame | None = None, glob: str = "*") -> DataFrame:
    """(path, sha256, bytes, source) of every file under a path but a manifest itself; sources(path, source) is optional.

    Files are read and hashed where they lie, one task a file.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    rows = files.where(~F.col("path").rlike(r"/manifest[^/]*$")).select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))
    if sources is None:
        return rows.withColumn("source", F.lit(None).cast("string"))
    return rows.join(small_side(sources), "path", "left")


def agreement_report(rates: DataFrame, judged: DataFrame, path: str, reference: str) -> None:
    """A Markdown report of agreement() and the disagreements of agreement_rows(), written as text by Spark."""
    row = rates.first()
    head = ["# Agreement with an independent table", "", f"Reference: {reference}", "", f"**Agreement: {row['agree']}/{row['n']} ({(row['rate'] or 0):.1%})**", "", "| Section | Theirs | Ours |", "|---|---|---|"]
    spark = rates.sparkSession
    top = spark.createDataFrame([(k, line) for k, line in enumerate(head)], "k bigint, value string")
    table = F.concat(F.lit("| "), F.concat_ws(" | ", F.col("section").cast("string"), F.array_join("theirs", ", "), F.coalesce(F.nullif(F.array_join("ours", ", "), F.lit("")), F.lit("(none)"))), F.lit(" |"))
    lines = judged.where(~F.col("agrees")).select((F.lit(len(head)) + F.col("section")).cast("bigint").alias("k"), table.alias("value"))
    top.unionAll(lines).orderBy("k", "value").select("value").write.mode("overwrite").text(path)
