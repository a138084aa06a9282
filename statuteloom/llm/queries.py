"""Registered queries of the llm operators, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuteloom.llm import bpe, canonical, lookalike, mixing, scanned, subjects
from statuteloom.session import keep, read_table

Query = Callable[[SparkSession, str], DataFrame]


def _p2(spark: SparkSession, d: str) -> DataFrame:
    return canonical.map_to_list(read_table(spark, d, "mapping_sample"), "row_id", "status", read_table(spark, d, "status_ref"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _p2(spark, d).select("row_id", F.col("code").alias("status_code"))


def p2_misses(spark: SparkSession, d: str) -> DataFrame:
    return canonical.misses(_p2(spark, d))


def _p4(spark: SparkSession, d: str) -> DataFrame:
    return scanned.repair_corpus(read_table(spark, d, "sections"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return scanned.noise(_p4(spark, d)).where("kind <> 'spacing'")  # a space inside a word is none of the kinds asked for


def p4_repaired(spark: SparkSession, d: str) -> DataFrame:
    return _p4(spark, d).select("sec_id", "field", "repaired")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    sections = read_table(spark, d, "sections").withColumn("section", F.col("section").cast("string"))
    return lookalike.same_look(sections, read_table(spark, d, "kaggle_bns_sample"), ["edition", "act", "section"], "sec_id", "text", "kb_id", "description")


def p5_forms(spark: SparkSession, d: str) -> DataFrame:
    keys = ["edition", "act", "section"]
    sections = read_table(spark, d, "sections").select(*keys[:2], F.col("section").cast("string"), F.lit("sections").alias("tbl"), F.col("sec_id").alias("id"), "text")
    notes = read_table(spark, d, "kaggle_bns_sample").select(*keys, F.lit("kaggle_bns_sample").alias("tbl"), F.col("kb_id").alias("id"), F.col("description").alias("text"))
    return lookalike.canonical_forms(sections.unionAll(notes), keys).select("tbl", "id", "canonical")


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_texts(read_table(spark, d, "documents"))


def _p7(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = mixing.usable(read_table(spark, d, "documents"))
    sized = keep(bpe.encode_texts(docs, count_only=True, carry=["source"]))
    rated = mixing.rates(sized, read_table(spark, d, "mix_targets"))
    return mixing.mix(sized, rated), rated


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    return _p7(spark, d)[0]


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.report(*_p7(spark, d))


def _p7_chars(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The same mix with documents sized by their characters, which SQL can count too."""
    sized = mixing.usable(read_table(spark, d, "documents")).select("doc_id", "source", F.length("text").cast("bigint").alias("tokens"))
    rated = mixing.rates(sized, read_table(spark, d, "mix_targets"))
    return mixing.mix(sized, rated), rated


def p7_mix_chars(spark: SparkSession, d: str) -> DataFrame:
    return _p7_chars(spark, d)[0]


def p7_shares_chars(spark: SparkSession, d: str) -> DataFrame:
    return mixing.report(*_p7_chars(spark, d)).withColumn("actual_share", F.round("actual_share", 9)).withColumn("rate", F.round("rate", 9))


def _p8(spark: SparkSession, d: str) -> DataFrame:
    return subjects.document_subjects(read_table(spark, d, "documents"), read_table(spark, d, "doc_labels"), read_table(spark, d, "subjects"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _p8(spark, d).select("doc_id", "subject")


def p8_composition(spark: SparkSession, d: str) -> DataFrame:
    return subjects.composition(_p8(spark, d))


def queries() -> dict[str, Query]:
    own = (p2_found, p2_misses, p4_found, p4_repaired, p5_found, p5_forms, p6_ids, p7_mix, p7_shares, p7_mix_chars, p7_shares_chars, p8_found, p8_composition)
    return {q.__name__: q for q in own}


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle_sql() -> dict[str, str]:
    wrong, right, unseen = lookalike.tables()

    def form(column: str) -> str:
        out = f"translate({column}, {_sql_text(wrong + unseen)}, {_sql_text(right)})"
        for ligature, letters in lookalike.LIGATURES.items():
            out = f"replace({out}, {_sql_text(ligature)}, {_sql_text(letters)})"
        return f"regexp_replace({out}, '^\\s+|\\s+$', '', 'g')"

    mixed = r"""
        WITH sized AS (SELECT doc_id, source, length(text) AS tokens FROM documents WHERE source IS NOT NULL AND regexp_matches(text, '[^\s\p{Z}]')),
        sums AS (SELECT source, target_share, coalesce(max_repeats, 0) AS max_repeats, CAST(coalesce(t, 0) AS BIGINT) AS tokens FROM mix_targets LEFT JOIN (SELECT source, sum(tokens) AS t FROM sized GROUP BY source) USING (source)),
        level AS (SELECT min(max_repeats * tokens / target_share) AS level FROM sums WHERE tokens > 0 AND target_share > 0 AND max_repeats > 0),
        rated AS (SELECT *, CASE WHEN tokens > 0 AND target_share > 0 AND max_repeats > 0 THEN least(CAST(max_repeats AS DOUBLE), level * target_share / tokens) ELSE 0.0 END AS rate FROM sums, level),
        drawn AS (SELECT doc_id, source, s.tokens, CAST(least(floor(rate) + (CAST('0x' || substring(md5('17:' || doc_id), 1, 8) AS BIGINT) / 4294967296.0 < rate - floor(rate))::INT, max_repeats) AS INT) AS times
            FROM sized s JOIN (SELECT source, rate, max_repeats FROM rated WHERE rate > 0) USING (source)),
        mixed AS (SELECT doc_id, source, tokens, CAST(unnest(range(1, times + 1)) AS INT) AS copy FROM drawn)"""
    trim = r"regexp_replace({}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
    return {
        "p7_mix_chars": f"{mixed} SELECT * FROM mixed",
        "p7_shares_chars": f"""{mixed}, used AS (SELECT source, count(*) AS used_docs, sum(tokens) AS used_tokens FROM mixed GROUP BY source)
            SELECT source, target_share, max_repeats, tokens, round(rate, 9) AS rate, coalesce(used_docs, 0) AS used_docs, CAST(coalesce(used_tokens, 0) AS BIGINT) AS used_tokens,
                   round(CAST(coalesce(used_tokens, 0) AS DOUBLE) / (SELECT sum(used_tokens) FROM used), 9) AS actual_share FROM rated LEFT JOIN used USING (source)""",
        "p5_found": f"""
            WITH s AS (SELECT sec_id, edition, act, CAST(section AS VARCHAR) AS section, {trim.format("text")} AS stored, nfc_normalize({form("text")}) AS form FROM sections WHERE text IS NOT NULL),
                 k AS (SELECT kb_id, edition, act, section, {trim.format("description")} AS stored, nfc_normalize({form("description")}) AS form FROM kaggle_bns_sample WHERE description IS NOT NULL)
            SELECT s.sec_id, k.kb_id FROM s JOIN k ON s.edition = k.edition AND s.act = k.act AND s.section = k.section
            WHERE s.form = k.form AND s.stored <> k.stored
        """,
        "p5_forms": f"""
            WITH v AS (SELECT 'sections' AS tbl, sec_id AS id, edition, act, CAST(section AS VARCHAR) AS section, {form("text")} AS form FROM sections
                       UNION ALL SELECT 'kaggle_bns_sample', kb_id, edition, act, section, {form("description")} FROM kaggle_bns_sample)
            SELECT tbl, id, min(form) OVER (PARTITION BY edition, act, section, nfc_normalize(form)) AS canonical FROM v
        """,
    }
