"""Registered queries of the text, reference, fold and chunk operators, with their SQL checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuteloom.functions import folds, numerals, refs, text
from statuteloom.operators import chunking, mapping
from statuteloom.session import read_table
from statuteloom.sources import readers



def norm_text(spark: SparkSession, d: str) -> DataFrame:
    norm = text.normalise_text(F.col("text"))
    return read_table(spark, d, "documents").select("doc_id", norm.alias("norm"), F.size(text.paragraphs(norm)).alias("paras"))


def stray_digits(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "kaggle_bns_sample").select("kb_id", text.drop_stray_footnotes(F.col("description")).alias("clean"))


def smart_titles(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "sections").where("chapter_title is not null").groupBy("chapter_title").agg(F.count(F.lit(1)).alias("n")).select("chapter_title", text.smart_title(F.col("chapter_title")).alias("title"), "n")


def clean_cells(spark: SparkSession, d: str) -> DataFrame:
    c = lambda n: text.clean_cell(F.col(n)).alias(n)
    return read_table(spark, d, "mapping_sample").select("row_id", c("bns_section"), c("status"), c("ipc_section"), text.compare_key(F.coalesce("bns_title", F.lit(""))).alias("title_key"))


def numerals_both_ways(spark: SparkSession, d: str) -> DataFrame:
    roman = numerals.to_roman(F.col("section"))
    rows = read_table(spark, d, "sections").select("sec_id", "section", roman.alias("roman"), numerals.from_roman(roman).alias("back"), numerals.from_roman(F.col("chapter_no")).alias("chapter"))
    return rows


def letter_labels(spark: SparkSession, d: str) -> DataFrame:
    refs_in = read_table(spark, d, "map_row").select(F.explode("ipc").alias("ref"))
    labels = refs_in.select(F.lower(F.regexp_extract("ref", r"^\s*[0-9]+([A-Za-z]+)", 1)).alias("label")).where("label <> ''")
    return labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")).select("label", "n", numerals.letter_index(F.col("label")).alias("idx"))


def parse_refs(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "mapping_sample").select("row_id", refs.old_refs(F.col("ipc_section")).alias("refs"))


def canonical_queries(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "mapping_sample").where("ipc_section is not null").select("row_id", refs.canonical_query(F.col("ipc_section")).alias("key"))


def _normal(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "sections").select("sec_id", text.normalise_text(F.col("text")).alias("norm"))


def subsections(spark: SparkSession, d: str) -> DataFrame:
    cut = _normal(spark, d).select("sec_id", F.posexplode_outer(folds.subsections(F.col("norm"))).alias("k", "u")).where("k IS NOT NULL")
    return cut.select("sec_id", "k", "u.number", F.md5("u.text").alias("digest"))


def blocks(spark: SparkSession, d: str) -> DataFrame:
    cut = _normal(spark, d).select("sec_id", F.posexplode_outer(folds.blocks(F.col("norm"))).alias("k", "b")).where("k IS NOT NULL")
    return cut.select("sec_id", "k", "b.kind", "b.label", F.md5("b.text").alias("digest"))


def illustrations(spark: SparkSession, d: str) -> DataFrame:
    shown = _normal(spark, d).select("sec_id", F.explode_outer(folds.blocks(F.col("norm"))).alias("b")).where("b.kind = 'illustration'")
    items = shown.select("sec_id", F.size(folds.illustrations(F.col("b.text"))).alias("items"), F.length("b.text").alias("chars"))
    return items.groupBy("sec_id").agg(F.count(F.lit(1)).alias("blocks"), F.sum("items").alias("items"), F.sum("chars").alias("chars"))


def pack_groups(spark: SparkSession, d: str) -> DataFrame:
    lines = text.paragraphs(text.normalise_text(F.col("text")))
    counts = F.transform(lines, text.word_count)
    return read_table(spark, d, "documents").where("text is not null").select("doc_id", chunking.pack_groups(counts, 60).alias("groups"))


def _chunks(spark: SparkSession, d: str, budget: int = 60) -> DataFrame:
    rows = mapping.section_refs(read_table(spark, d, "map_row")).select(F.lit("BNS").alias("act"), F.col("bns_section").alias("section"), "refs")
    return chunking.plan(read_table(spark, d, "sections"), "sec_id", budget, rows)


def chunk_plan(spark: SparkSession, d: str) -> DataFrame:
    return _chunks(spark, d).drop("clause_split")


def chunk_stats(spark: SparkSession, d: str) -> DataFrame:
    return chunking.stats(_chunks(spark, d), "act")


def chunk_histogram(spark: SparkSession, d: str) -> DataFrame:
    return chunking.histogram(_chunks(spark, d, 350))


def headers(spark: SparkSession, d: str) -> DataFrame:
    cols = [F.col(c) for c in ("act", "section", "title", "chapter_no", "chapter_title")]
    rows = mapping.section_refs(read_table(spark, d, "map_row")).withColumn("_act", F.lit("BNS"))
    s = read_table(spark, d, "sections").join(rows, (F.col("section") == F.col("bns_section")) & (F.col("act") == F.col("_act")), "left")
    return s.select("sec_id", chunking.header(*cols, F.coalesce("refs", F.array().cast("array<string>"))).alias("header"))


def transcriptions(spark: SparkSession, d: str) -> DataFrame:
    rows = readers.transcription(read_table(spark, d, "kaggle_bns_sample"), ["kb_id"])
    return rows.select("kb_id", "act", "section", "title", "chapter_no", "chapter_title", F.md5("text").alias("digest"), F.size("subsections").alias("units"), "empty")


QUERIES = {
    q.__name__: q
    for q in (
        norm_text, stray_digits, smart_titles, clean_cells, numerals_both_ways, letter_labels, parse_refs, canonical_queries, subsections, blocks, illustrations, pack_groups,
        chunk_plan, chunk_stats, chunk_histogram, headers, transcriptions,
    )
}

_NULLS = "('', 'nan', 'none', '-', '—', 'na', 'n/a')"
_STRIP = r"'^[\s\p{Z}]+|[\s\p{Z}]+$'"


def norm(c: str) -> str:
    lines = rf"string_split(replace(replace(regexp_replace({c}, '\r\n?', chr(10), 'g'), chr(65279), ''), chr(160), ' '), chr(10))"
    return rf"array_to_string(list_filter(list_transform({lines}, lambda x: regexp_replace(regexp_replace(x, '[ \t]+', ' ', 'g'), {_STRIP}, '', 'g')), lambda x: x <> ''), chr(10))"


def cell(c: str) -> str:
    flat = rf"regexp_replace(regexp_replace({c}, '[\s\p{{Z}}]+', ' ', 'g'), {_STRIP}, '', 'g')"
    return f"CASE WHEN lower({flat}) IN {_NULLS} THEN NULL ELSE {flat} END"


def key(c: str) -> str:
    return f"trim(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g'))"


def old_refs(c: str) -> str:
    """References of a cell. The engine has no look-ahead, so what a small letter behind it forbids is taken out beforehand."""
    words = rf"regexp_replace(regexp_replace(coalesce({cell(c)}, ''), '(?i)\b(?:sections?|secs?\.?|s\.)\s*', ' ', 'g'), '\band\b|&', ',', 'g')"
    apart = rf"regexp_replace(regexp_replace({words}, '[A-Z]{{1,2}}([a-z])', ';\1', 'g'), '[0-9]([a-z])', ' \1', 'g')"
    found = rf"list_transform(regexp_extract_all({apart}, '[0-9]{{1,3}}\s?(?:-\s?)?(?:[A-Z]{{1,2}})?(?:\([0-9]+\))*'), lambda r: regexp_replace(r, '[\s-]', '', 'g'))"
    return f"list_reduce(list_prepend([], list_transform({found}, lambda r: [r])), lambda a, r: CASE WHEN list_contains(a, r[1]) THEN a ELSE list_concat(a, r) END)"


_LINES = f"(SELECT sec_id, string_split({norm('text')}, chr(10)) AS p FROM sections WHERE text IS NOT NULL)"
_LETTER = "CASE WHEN {0} <> '' AND replace({0}, {0}[1], '') = '' THEN (length({0}) - 1) * 26 + ascii({0}) - 96 END"
_UNITS = rf"""
    WITH RECURSIVE l AS (SELECT sec_id, list_filter(p, lambda x: x <> '') AS p FROM {_LINES}),
    walk AS (
        SELECT sec_id, p, 0 AS i, 1 AS nxt, -1 AS unit, CAST(NULL AS VARCHAR) AS number, FALSE AS starts FROM l
        UNION ALL
        SELECT sec_id, p, i + 1, nxt + s::INT, unit + (s OR unit < 0)::INT, CASE WHEN s THEN regexp_extract(p[i + 1], '^\(([0-9]{{1,3}})\)', 1) WHEN unit < 0 THEN NULL ELSE number END, s
        FROM (SELECT *, coalesce(TRY_CAST(nullif(regexp_extract(p[i + 1], '^\(([0-9]{{1,3}})\)', 1), '') AS INT) = nxt, FALSE) AS s FROM walk WHERE i < len(p)))
    SELECT sec_id, CAST(unit AS INT) AS k, number, md5(string_agg(p[i], chr(10) ORDER BY i)) AS digest FROM walk WHERE i > 0 GROUP BY sec_id, unit, number
"""
_BLOCK_WALK = rf"""
    WITH RECURSIVE l AS (SELECT sec_id, list_filter(p, lambda x: x <> '') AS p FROM {_LINES}),
    walk AS (
        SELECT sec_id, p, 0 AS i, 1 AS nxt, -1 AS unit, CAST(NULL AS VARCHAR) AS kind, CAST(NULL AS VARCHAR) AS label FROM l
        UNION ALL
        SELECT sec_id, p, i + 1, nxt + clause::INT, unit + (opens OR resumes OR clause OR unit < 0)::INT,
               CASE WHEN opens THEN 'illustration' WHEN clause THEN 'clause' WHEN resumes OR unit < 0 THEN 'preamble' ELSE kind END,
               CASE WHEN clause THEN lab WHEN opens OR resumes OR unit < 0 THEN NULL ELSE label END
        FROM (SELECT *, (NOT opens AND kind = 'illustration' AND regexp_matches(line, '(?i)^(?:Explanation|Exception|Provided\b|\([0-9]{{1,3}}\)\s)')) IS TRUE AS resumes,
                     (NOT opens AND kind IS DISTINCT FROM 'illustration' AND {_LETTER.format("lab")} = nxt) IS TRUE AS clause
              FROM (SELECT *, p[i + 1] AS line, regexp_extract(p[i + 1], '^\(([a-z]{{1,3}})\)', 1) AS lab,
                           regexp_matches(p[i + 1], '(?i)^Illustrations?\b\.?\s*$|^Illustrations?\s*[.:—–-]') AS opens FROM walk WHERE i < len(p))))
"""
_REFS_OF_SECTION = """
    (SELECT bns_section, list('IPC ' || ref ORDER BY o, k) AS refs FROM (
        SELECT bns_section, ref, min_by(ordinal, ordinal * 1000 + k) AS o, min_by(k, ordinal * 1000 + k) AS k
        FROM (SELECT bns_section, ordinal, unnest(ipc) AS ref, generate_subscripts(ipc, 1) AS k FROM map_row WHERE bns_section IS NOT NULL) GROUP BY bns_section, ref) GROUP BY bns_section)
"""
ORACLES = {
    "norm_text": f"SELECT doc_id, n AS norm, CAST(CASE WHEN n IS NULL THEN NULL WHEN n = '' THEN 0 ELSE len(string_split(n, chr(10))) END AS INT) AS paras FROM (SELECT doc_id, {norm('text')} AS n FROM documents)",
    "stray_digits": r"SELECT kb_id, regexp_replace(description, '([a-z]{3})[0-9]{1,2}([\s.,;:)]|$)', '\1\2', 'g') AS clean FROM kaggle_bns_sample",
    "smart_titles": r"""SELECT chapter_title, n, array_to_string(list_transform(list_filter(regexp_split_to_array(lower(chapter_title), '\s+'), lambda w: w <> ''), lambda w, k:
        CASE WHEN k > 1 AND w IN ('a', 'an', 'and', 'as', 'at', 'by', 'for', 'from', 'in', 'into', 'of', 'on', 'or', 'the', 'to', 'with') THEN w
        ELSE array_to_string(list_transform(string_split(w, '-'), lambda x: upper(x[1]) || x[2:]), '-') END), ' ') AS title
        FROM (SELECT chapter_title, count(*) AS n FROM sections WHERE chapter_title IS NOT NULL GROUP BY 1)""",
    "clean_cells": f"SELECT row_id, {cell('bns_section')} AS bns_section, {cell('status')} AS status, {cell('ipc_section')} AS ipc_section, {key('coalesce(bns_title, chr(32))')} AS title_key FROM mapping_sample",
    "numerals_both_ways": """
        WITH RECURSIVE steps(sign, val, k) AS (VALUES ('M', 1000, 1), ('CM', 900, 2), ('D', 500, 3), ('CD', 400, 4), ('C', 100, 5), ('XC', 90, 6), ('L', 50, 7), ('XL', 40, 8), ('X', 10, 9), ('IX', 9, 10), ('V', 5, 11), ('IV', 4, 12), ('I', 1, 13)),
        table_of(n, rest, roman) AS (
            SELECT n, n, '' FROM range(1, 1001) t(n)
            UNION ALL SELECT n, rest - (SELECT max(val) FROM steps WHERE val <= rest), roman || (SELECT max_by(sign, val) FROM steps WHERE val <= rest) FROM table_of WHERE rest > 0),
        numbers AS (SELECT n, roman FROM table_of WHERE rest = 0)
        SELECT sec_id, section, a.roman, CAST(a.n AS INT) AS back, CAST(b.n AS INT) AS chapter FROM sections LEFT JOIN numbers a ON a.n = section LEFT JOIN numbers b ON b.roman = chapter_no""",
    "letter_labels": f"SELECT label, count(*) AS n, CAST({_LETTER.format('label')} AS INT) AS idx FROM (SELECT lower(regexp_extract(unnest(ipc), '^\\s*[0-9]+([A-Za-z]+)', 1)) AS label FROM map_row) WHERE label <> '' GROUP BY label",
    "canonical_queries": r"""
        WITH q AS (SELECT row_id, ipc_section AS raw, regexp_replace(regexp_replace(regexp_replace(ipc_section, '(?i)\b(?:ipc|indian penal code|sections?|secs?\.?|s\.)', ' ', 'g'), '^\s+', ''), '(?i)^\s*ipc', '') AS x FROM mapping_sample WHERE ipc_section IS NOT NULL),
        m AS (SELECT *, regexp_extract(x, '([0-9]{1,3})\s*-?\s*([A-Za-z]{1,2})?\s*((?:\([0-9]+\))*)', ['n', 'l', 'g']) AS h FROM q)
        SELECT row_id, CASE WHEN h.n <> '' THEN h.n || upper(h.l) || h.g ELSE upper(regexp_replace(raw, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) END AS key FROM m""",
    "subsections": _UNITS,
    "blocks": _BLOCK_WALK + " SELECT sec_id, CAST(unit AS INT) AS k, kind, label, md5(string_agg(p[i], chr(10) ORDER BY i)) AS digest FROM walk WHERE i > 0 GROUP BY sec_id, unit, kind, label",
    "illustrations": _BLOCK_WALK
    + f"""
        , b AS (SELECT sec_id, unit, list(p[i] ORDER BY i) AS p FROM walk WHERE i > 0 AND kind = 'illustration' GROUP BY sec_id, unit),
        items AS (
            SELECT sec_id, unit, p, 1 AS i, 1 AS nxt, 0 AS items FROM b
            UNION ALL
            SELECT sec_id, unit, p, i + 1, nxt + s::INT, items + (s OR items = 0)::INT
            FROM (SELECT *, ({_LETTER.format("lab")} = nxt) IS TRUE AS s FROM (SELECT *, regexp_extract(p[i + 1], '^\\(([a-z]{{1,3}})\\)', 1) AS lab FROM items WHERE i < len(p))))
        SELECT sec_id, count(*) AS blocks, sum(items)::BIGINT AS items, sum(length(array_to_string(p, chr(10))))::BIGINT AS chars FROM items WHERE i = len(p) GROUP BY sec_id""",
    "parse_refs": f"SELECT row_id, {old_refs('ipc_section')} AS refs FROM mapping_sample",
    "pack_groups": rf"""
        WITH RECURSIVE c AS (SELECT doc_id, list_transform(list_filter(string_split({norm("text")}, chr(10)), lambda x: x <> ''), lambda x: len(list_filter(regexp_split_to_array(x, '[\s\p{{Z}}]+'), lambda w: w <> ''))) AS n FROM documents WHERE text IS NOT NULL),
        walk AS (SELECT doc_id, n, 0 AS i, 0 AS total, 0 AS grp FROM c
                 UNION ALL SELECT doc_id, n, i + 1, CASE WHEN grp > 0 AND total + n[i + 1] <= 60 THEN total + n[i + 1] ELSE n[i + 1] END, CASE WHEN grp > 0 AND total + n[i + 1] <= 60 THEN grp ELSE grp + 1 END FROM walk WHERE i < len(n))
        SELECT doc_id, coalesce(list(grp ORDER BY i) FILTER (i > 0), []) AS groups FROM walk GROUP BY doc_id""",
    "transcriptions": rf"""
        WITH RECURSIVE steps(sign, val) AS (VALUES ('M', 1000), ('CM', 900), ('D', 500), ('CD', 400), ('C', 100), ('XC', 90), ('L', 50), ('XL', 40), ('X', 10), ('IX', 9), ('V', 5), ('IV', 4), ('I', 1)),
        romans(n, rest, roman) AS (SELECT n, n, '' FROM range(1, 1001) t(n)
            UNION ALL SELECT n, rest - (SELECT max(val) FROM steps WHERE val <= rest), roman || (SELECT max_by(sign, val) FROM steps WHERE val <= rest) FROM romans WHERE rest > 0),
        k AS (SELECT *, regexp_replace({norm("coalesce(description, '')")}, '([a-z]{{3}})[0-9]{{1,2}}([\s.,;:)]|$)', '\1\2', 'g') AS t FROM kaggle_bns_sample),
        l AS (SELECT kb_id, list_filter(string_split(t, chr(10)), lambda x: x <> '') AS p FROM k),
        walk AS (SELECT kb_id, p, 0 AS i, 1 AS nxt, 0 AS unit FROM l
            UNION ALL SELECT kb_id, p, i + 1, nxt + s::INT, unit + (s OR unit = 0)::INT
            FROM (SELECT *, coalesce(TRY_CAST(nullif(regexp_extract(p[i + 1], '^\(([0-9]{{1,3}})\)', 1), '') AS INT) = nxt, FALSE) AS s FROM walk WHERE i < len(p))),
        u AS (SELECT kb_id, max(unit) AS units FROM walk GROUP BY kb_id)
        SELECT kb_id, act, TRY_CAST(trim(section) AS INT) AS section, regexp_replace({norm("coalesce(section_name, '')")}, '[ .—-]+$', '') AS title,
               CASE WHEN regexp_full_match(trim(coalesce(chapter, '')), '[0-9]+') THEN roman ELSE nullif(trim(coalesce(chapter, '')), '') END AS chapter_no,
               nullif({norm("coalesce(chapter_name, '')")}, '') AS chapter_title, md5(t) AS digest, CAST(units AS INT) AS units, t = '' AS empty
        FROM k LEFT JOIN (SELECT n, roman FROM romans WHERE rest = 0) r ON r.n = TRY_CAST(trim(chapter) AS INT) LEFT JOIN u USING (kb_id)""",
    "headers": f"""SELECT sec_id, concat('[', act, ' ', section, '] ', coalesce(title, '')) || coalesce(' | Chapter ' || nullif(chapter_no, '') || coalesce(': ' || nullif(chapter_title, ''), ''), '')
        || CASE WHEN len(refs) > 0 THEN ' | Formerly: ' || array_to_string(refs[1:5], ', ') || CASE WHEN len(refs) > 5 THEN ', …' ELSE '' END ELSE '' END AS header
        FROM sections LEFT JOIN {_REFS_OF_SECTION} r ON r.bns_section = section AND act = 'BNS'""",
}
