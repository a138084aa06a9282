"""Reconciliation of two versions of the same sections: scores, flags, and notes carried over from an earlier report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuteloom.functions.similarity import indel_score, token_set_score
from statuteloom.functions.text import compare_key, score_text

THRESHOLD = 90.0


def compare(ours: DataFrame, theirs: DataFrame, keys: Sequence[str], title_only: Sequence[str] = (), act: str = "act", threshold: float = THRESHOLD) -> DataFrame:
    """ours(keys, title, text) beside theirs(keys, title, text): title_score, body_score, flagged and a hint, a row for each of ours.

    theirs has one row a key. Scores have one decimal before they meet the threshold. A missing title or body (NULL or
    empty) has a NULL score and is flagged; acts in title_only are judged by their titles alone.
    """
    other = theirs.select(*keys, F.nullif("title", F.lit("")).alias("_title"), F.nullif("text", F.lit("")).alias("_text"), F.lit(True).alias("_there"))
    rows = ours.join(other, list(keys), "left")
    bodies = ~F.col(act).isin(*title_only) if title_only else F.lit(True)
    rows = rows.withColumn("title_score", token_set_score(compare_key(F.coalesce("title", F.lit(""))), compare_key(F.col("_title"))))
    rows = rows.withColumn("body_score", indel_score(compare_key(F.coalesce("text", F.lit(""))), compare_key(F.when(bodies, F.col("_text")))))
    low = lambda c: F.col(c).isNull() | (F.col(c) < threshold)
    ratio = F.length(F.coalesce("text", F.lit(""))) / F.greatest(F.lit(1), F.length("_text"))
    hint = (
        F.when(F.col("_there").isNull(), "no reference row")
        .when(bodies & F.col("_text").isNull(), "reference body empty")
        .when(F.col("body_score") < threshold, F.format_string("length ours/ref = %.2f", ratio.cast("double")))
        .otherwise("")
    )
    return rows.select(*ours.columns, "title_score", "body_score", (low("title_score") | (bodies & low("body_score"))).alias("flagged"), hint.alias("hint"))


def summary(compared: DataFrame, by: str = "act") -> DataFrame:
    """(by, sections, flagged, mean_title, mean_body)."""
    return compared.groupBy(by).agg(
        F.count(F.lit(1)).alias("sections"), F.count_if("flagged").alias("flagged"), F.round(F.avg("title_score"), 2).alias("mean_title"), F.round(F.avg("body_score"), 2).alias("mean_body")
    )


def carry_over(compared: DataFrame, earlier: DataFrame, keys: Sequence[str], allowed: Sequence[str]) -> DataFrame:
    """Flagged rows with the verdict and note given to their key before; an unknown verdict counts as none."""
    old = earlier.select(*keys, "verdict", "note").dropDuplicates(list(keys))
    kept = compared.where("flagged").join(old, list(keys), "left")
    return kept.withColumn("verdict", F.when(F.col("verdict").isin(*allowed), F.col("verdict")).otherwise("")).withColumn("note", F.coalesce("note", F.lit("")))


def report_lines(flagged: DataFrame, act: str = "act", section: str = "section") -> DataFrame:
    """(act, section, line): a Markdown table row of each flagged section."""
    cells = [F.concat_ws(" ", act, F.col(section).cast("string")), F.replace("title", F.lit("|"), F.lit("/")), score_text(F.col("title_score")), score_text(F.col("body_score")), F.col("hint")]
    cells += [F.col(c) if c in flagged.columns else F.lit("") for c in ("verdict", "note")]
    return flagged.select(act, section, F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))
