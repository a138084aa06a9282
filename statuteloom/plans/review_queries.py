"""Registered queries of the checks of answers, the choice of training rows, and reviewed corrections, with their SQL checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuteloom import schemas
from statuteloom.operators import evaluation, mapping, patching, retrieval
from statuteloom.plans.table_queries import _HASH, _bm25, _compared, _search
from statuteloom.plans.text_queries import key, norm
from statuteloom.session import read_table

#: What an answer says that gives none.
REFUSAL = "The sections at hand do not answer this."


def _answers(spark: SparkSession, d: str) -> DataFrame:
    """Documents as answers; the section each is filed under (law_ref) is the context it may cite."""
    docs = read_table(spark, d, "documents")
    context = docs.select("doc_id", F.regexp_extract("law_ref", r"^(BNSS|BNS|BSA) [0-9]+$", 1).alias("act"), F.regexp_extract("law_ref", r" ([0-9]+)$", 1).try_cast("int").alias("section"))
    return evaluation.check_answers(docs, read_table(spark, d, "sections"), context, REFUSAL)


def answer_rules(spark: SparkSession, d: str) -> DataFrame:
    return _answers(spark, d)


def sft_rows(spark: SparkSession, d: str) -> DataFrame:
    """Documents that cite known sections only, and as many that cite none as make up 15 % of all."""
    judged = _answers(spark, d)
    kept = judged.where("n > 0 AND unknown = 0").select("doc_id")
    return evaluation.with_refusals(kept, judged.where("n = 0").select("doc_id"), "doc_id")


def out_of_range(spark: SparkSession, d: str) -> DataFrame:
    wrong = evaluation.out_of_range(F.col("text"), schemas.EXPECTED_SECTIONS)
    return read_table(spark, d, "documents").select("doc_id", wrong.alias("refs")).where(F.size("refs") > 0)


def answer_features(spark: SparkSession, d: str) -> DataFrame:
    docs, asked = _search(spark, d)
    s = read_table(spark, d, "sections")
    titles = s.where("title is not null and sec_id % 20 = 0").select(F.col("sec_id").alias("query"), F.col("title").alias("text"))
    return evaluation.ranking_features(titles, retrieval.bm25(docs, asked, 5, doc_id="sec_id"), s.select("sec_id", "act"), "sec_id")


def hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    """For each section title asked, the best section text from rank 10 to 50 that is of another section."""
    docs, asked = _search(spark, d)
    s = read_table(spark, d, "sections").select("sec_id", "act", "section")
    return evaluation.hard_negatives(retrieval.bm25(docs, asked, 50, doc_id="sec_id"), s.withColumnRenamed("sec_id", "query"), s, "sec_id", ["act", "section"])


def section_totals(spark: SparkSession, d: str) -> DataFrame:
    return schemas.totals(read_table(spark, d, "sections"))


def chapters_patched(spark: SparkSession, d: str) -> DataFrame:
    """Chapter titles that a section lacks, set as patches from the last transcription of the same edition, act and section."""
    keys = ["edition", "act", "section"]
    theirs = mapping.first_per_key(read_table(spark, d, "kaggle_bns_sample").withColumn("section", F.trim("section").try_cast("int")), keys, "kb_id", last=True)
    s = read_table(spark, d, "sections")
    lacking = s.where("chapter_title IS NULL").select("sec_id", *keys).join(theirs.where("trim(chapter_name) <> ''"), keys)
    patches = lacking.select("sec_id", F.lit(None).cast("string").alias("subsection"), F.lit("chapter_title").alias("field"), F.trim("chapter_name").alias("value"))
    return patching.patch_sections(s, patches).select("sec_id", "chapter_title", "title", F.size("subsections").alias("units"), "in_force")


def crosscheck_titles(spark: SparkSession, d: str) -> DataFrame:
    """What the cross-check says of titles, missing rows and acts judged by titles alone: the part whose scores SQL can count."""
    judged = F.when(F.col("act") == "BNSS", F.col("flagged"))
    return _compared(spark, d).select("sec_id", "title_score", (F.col("hint") == "no reference row").alias("missing"), F.col("body_score").isNull().alias("no_body"), judged.alias("flagged"))


QUERIES = {q.__name__: q for q in (crosscheck_titles, answer_rules, sft_rows, out_of_range, answer_features, hard_negatives, section_totals, chapters_patched)}

_CITED = r"regexp_extract_all(text, '\b(?:BNSS|BNS|BSA)\s+[0-9]{1,3}(?:\([0-9a-z]+\))*')"
_JUDGED = rf"""
    c AS (SELECT DISTINCT doc_id, regexp_extract(x, '(BNSS|BNS|BSA)', 1) AS act, CAST(regexp_extract(x, '\s([0-9]{{1,3}})', 1) AS INT) AS section FROM (SELECT doc_id, unnest({_CITED}) AS x FROM documents)),
    own AS (SELECT doc_id, string_split(law_ref, ' ')[1] AS act, TRY_CAST(string_split(law_ref, ' ')[2] AS INT) AS section FROM documents),
    t AS (SELECT c.doc_id, count(*) AS n, count(*) FILTER (NOT EXISTS (SELECT 1 FROM sections s WHERE s.act = c.act AND s.section = c.section)) AS unknown,
                 count(*) FILTER (o.doc_id IS NULL) AS outside
          FROM c LEFT JOIN own o ON o.doc_id = c.doc_id AND o.act = c.act AND o.section = c.section GROUP BY c.doc_id),
    p AS (SELECT doc_id, text, list_filter(string_split(regexp_replace(text, '([.?!])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: regexp_matches(x, '\S')) AS p FROM documents),
    judged AS (SELECT doc_id, coalesce(trim(text, ' ') = '{REFUSAL}', FALSE) AS refused, coalesce(n, 0) AS n, coalesce(unknown, 0) AS unknown, coalesce(outside, 0) AS outside,
                      round(CASE WHEN len(p) > 0 THEN len(list_filter(p, lambda x: regexp_matches(x, '\b(BNSS|BNS|BSA)\s+([0-9]{{1,3}})'))) / CAST(len(p) AS DOUBLE) END, 6) AS share
               FROM p LEFT JOIN t USING (doc_id))"""
ORACLES = {
    "crosscheck_titles": rf"""
        WITH RECURSIVE k AS (
            SELECT *, row_number() OVER (PARTITION BY edition, act, section ORDER BY kb_id DESC) AS nth FROM (
                SELECT kb_id, edition, act, TRY_CAST(trim(section) AS INT) AS section, regexp_replace({norm("coalesce(section_name, '')")}, '[ .—-]+$', '') AS title,
                       regexp_replace({norm("coalesce(description, '')")}, '([a-z]{{3}})[0-9]{{1,2}}([\s.,;:)]|$)', '\1\2', 'g') AS body FROM kaggle_bns_sample)),
        both_sides AS (
            SELECT s.sec_id, s.act, k.kb_id IS NULL AS missing, {key("coalesce(s.title, '')")} AS a, {key("nullif(k.title, '')")} AS b
            FROM sections s LEFT JOIN k ON k.edition = s.edition AND k.act = s.act AND k.section = s.section AND nth = 1 AND body <> ''),
        sets AS (SELECT a, b, list_distinct(list_filter(string_split(a, ' '), lambda w: w <> '')) AS x, list_distinct(list_filter(string_split(b, ' '), lambda w: w <> '')) AS y FROM (SELECT DISTINCT a, b FROM both_sides WHERE b IS NOT NULL)),
        shared AS (SELECT *, list_sort(list_intersect(x, y)) AS z FROM sets),
        forms AS (SELECT a, b, x, y, z, array_to_string(z, ' ') AS core, array_to_string(list_concat(z, list_sort(list_filter(x, lambda w: NOT list_contains(y, w)))), ' ') AS l,
                         array_to_string(list_concat(z, list_sort(list_filter(y, lambda w: NOT list_contains(x, w)))), ' ') AS r FROM shared),
        pairs AS (SELECT l AS p, r AS q FROM forms UNION SELECT core, l FROM forms WHERE core <> '' UNION SELECT core, r FROM forms WHERE core <> ''),
        common AS (
            SELECT p, q, 0 AS i, list_transform(range(0, length(q) + 1), lambda j: 0) AS v FROM pairs
            UNION ALL
            SELECT p, q, i + 1, list_transform(range(1, len(t) + 1), lambda j: list_max(t[1 : j]))
            FROM (SELECT *, list_transform(range(1, len(v) + 1), lambda j: CASE WHEN j > 1 AND q[j - 1] = p[i + 1] THEN v[j - 1] + 1 ELSE v[j] END) AS t FROM common WHERE i < length(p))),
        ratios AS (SELECT p, q, CASE WHEN p = q THEN 100.0::DOUBLE ELSE 200.0::DOUBLE * v[len(v)] / (length(p) + length(q)) END AS ratio FROM common WHERE i = length(p)),
        scores AS (
            SELECT f.a, f.b, round_even(CASE WHEN len(x) = 0 OR len(y) = 0 THEN 0 WHEN len(z) > 0 AND (len(z) = len(x) OR len(z) = len(y)) THEN 100
                   ELSE greatest(m.ratio, coalesce(n.ratio, 0), coalesce(o.ratio, 0)) END, 1) AS score
            FROM forms f JOIN ratios m ON m.p = l AND m.q = r LEFT JOIN ratios n ON n.p = core AND n.q = l AND core <> '' LEFT JOIN ratios o ON o.p = core AND o.q = r AND core <> '')
        SELECT sec_id, score AS title_score, missing, missing OR act = 'BNSS' AS no_body, CASE WHEN act = 'BNSS' THEN coalesce(score < 90, TRUE) END AS flagged
        FROM both_sides c LEFT JOIN scores s ON s.a = c.a AND s.b = c.b""",
    "answer_rules": f"WITH {_JUDGED} SELECT *, refused OR (n > 0 AND unknown = 0 AND outside = 0 AND coalesce(share, 0) >= 0.8) AS compliant FROM judged",
    "sft_rows": f"""WITH {_JUDGED},
        kept AS (SELECT doc_id FROM judged WHERE n > 0 AND unknown = 0),
        none AS (SELECT doc_id, row_number() OVER (ORDER BY {_HASH.format("concat('42:refusal:', doc_id)")}, doc_id) AS place FROM judged WHERE n = 0)
        SELECT doc_id, 'answer' AS kind FROM kept UNION ALL SELECT doc_id, 'refusal' FROM none WHERE place <= (SELECT round(count(*) * (0.15 / 0.85)) FROM kept)""",
    "out_of_range": rf"""
        SELECT doc_id, list_distinct_in_order AS refs FROM (
            SELECT doc_id, list(x ORDER BY k) AS list_distinct_in_order FROM (
                SELECT doc_id, x, min(k) AS k FROM (SELECT doc_id, unnest({_CITED}) AS x, generate_subscripts({_CITED}, 1) AS k FROM documents)
                WHERE CAST(regexp_extract(x, '\s([0-9]{{1,3}})', 1) AS INT) NOT BETWEEN 1 AND CASE regexp_extract(x, '[A-Z]+') WHEN 'BNS' THEN 358 WHEN 'BNSS' THEN 531 ELSE 170 END
                GROUP BY doc_id, x) GROUP BY doc_id)""",
    "answer_features": rf"""WITH {_bm25(5)},
        q AS (SELECT sec_id AS query, title, len(list_filter(regexp_split_to_array(title, '[\s\p{{Z}}]+'), lambda w: w <> '')) AS words FROM sections WHERE title IS NOT NULL AND sec_id % 20 = 0),
        f AS (SELECT query, max(score) FILTER (rank = 1) AS best, max(score) FILTER (rank = 2) AS second, avg(score) AS mean_best, count(DISTINCT act) AS acts FROM ranked JOIN sections USING (sec_id) GROUP BY query)
        SELECT query, coalesce(best, 0.0) AS best, round(coalesce(best, 0.0) - coalesce(second, 0.0), 4) AS margin, round(coalesce(mean_best, 0.0), 4) AS mean_best,
               round(coalesce(best / nullif(words, 0), 0.0), 4) AS per_word, coalesce(acts, 0) AS acts, CAST(words AS INT) AS words,
               regexp_matches(title, '(?i)\b(IPC|CrPC|Indian Penal Code|Code of Criminal Procedure|Evidence Act)\b') AS old_law FROM q LEFT JOIN f USING (query)""",
    "hard_negatives": f"""WITH {_bm25(50)}
        SELECT query, min_by(r.sec_id, rank) AS sec_id, min(rank) AS rank FROM ranked r JOIN sections a ON a.sec_id = query JOIN sections b ON b.sec_id = r.sec_id
        WHERE rank >= 10 AND (a.act, a.section) <> (b.act, b.section) GROUP BY query""",
    "section_totals": """
        SELECT *, CASE WHEN sections = expected THEN 'ok' ELSE 'MISMATCH' END AS state FROM (
            SELECT edition, act, count(DISTINCT section) AS sections, CASE act WHEN 'BNS' THEN 358 WHEN 'BNSS' THEN 531 WHEN 'BSA' THEN 170 END AS expected
            FROM sections WHERE section IS NOT NULL GROUP BY edition, act)""",
    "chapters_patched": """
        WITH k AS (SELECT edition, act, TRY_CAST(trim(section) AS INT) AS section, arg_max_null(trim(chapter_name, ' '), kb_id) AS name FROM kaggle_bns_sample GROUP BY ALL)
        SELECT sec_id, coalesce(s.chapter_title, nullif(k.name, '')) AS chapter_title, title, CAST(len(subsections) AS INT) AS units, in_force
        FROM sections s LEFT JOIN k ON k.edition = s.edition AND k.act = s.act AND k.section = s.section""",
}
