"""Record schemas and the checks that rows must pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The acts, and the allowed values of coded fields.
ACTS = ("BNS", "BNSS", "BSA")
STATUSES = ("carried_over", "changed", "deleted", "new_section", "new_subsection")
CHUNK_TYPES = ("section", "subsections", "clauses", "illustration")
EXPECTED_SECTIONS = {"BNS": 358, "BNSS": 531, "BSA": 170}

SUBSECTION = "number string, text string, in_force boolean"
SECTION = (
    "act string, section int, title string, chapter_no string, chapter_title string, part string, text string, "
    "subsections array<struct<number:string,text:string,in_force:boolean>>, page_start int, in_force boolean, source string"
)
MAP_ROW = (
    "bns string, bns_section int, ipc array<string>, bns_title string, ipc_title string, status string, ipc_offence string, ipc_punishment string, source string"
)
CHUNK = (
    "chunk_id string, act string, section int, subsections array<string>, title string, chapter string, chunk_type string, old_refs array<string>, "
    "in_force boolean, tokens int, page int, header string, text string"
)


def one_of(column: str, allowed: Sequence[str]) -> Column:
    """The column, or an error for a value that is not allowed; NULL passes."""
    c = F.col(column)
    return F.when(c.isNull() | c.isin(*allowed), c).otherwise(F.raise_error(F.concat(F.lit(f"{column}: "), c)).cast("string")).alias(column)


def violations(sections: DataFrame, keys: Sequence[str] = ("edition", "act")) -> DataFrame:
    """(keys, sections, lowest, highest, gaps, repeats, untitled, empty): how far each document is from a whole numbering.

    Sections are counted by number first, so that a document is summed from one row a number.
    """
    by_number = sections.groupBy(*keys, "section").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.trim(F.coalesce("title", F.lit(""))) == "").alias("untitled"), F.count_if(F.trim(F.coalesce("text", F.lit(""))) == "").alias("empty")
    )
    out = by_number.groupBy(*keys).agg(
        F.sum("n").alias("sections"), F.min("section").alias("lowest"), F.max("section").alias("highest"), F.count(F.lit(1)).alias("_d"),
        F.sum(F.col("n") - 1).alias("repeats"), F.sum("untitled").alias("untitled"), F.sum("empty").alias("empty"),
    )
    return out.withColumn("gaps", F.col("highest") - F.col("lowest") + 1 - F.col("_d")).select(*keys, "sections", "lowest", "highest", "gaps", "repeats", "untitled", "empty")


def totals(sections: DataFrame, expected: Mapping[str, int] = EXPECTED_SECTIONS, keys: Sequence[str] = ("edition",)) -> DataFrame:
    """(keys, act, sections, expected, state): distinct section numbers of each act beside the expected total, `ok` or `MISMATCH`.

    An act without an expected total has NULL there and is a mismatch.
    """
    most = F.create_map(*[F.lit(v) for pair in expected.items() for v in pair])
    counted = sections.where("section IS NOT NULL").groupBy(*keys, "act", "section").agg(F.lit(1).alias("n")).groupBy(*keys, "act").agg(F.sum("n").alias("sections"))
    out = counted.withColumn("expected", F.try_element_at(most, F.col("act")))
    return out.withColumn("state", F.when(F.col("sections") == F.col("expected"), "ok").otherwise("MISMATCH"))
