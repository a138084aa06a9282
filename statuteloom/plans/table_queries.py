"""Registered queries of the mapping, reconciliation, layout, retrieval and evaluation operators, with their SQL checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuteloom import schemas
from statuteloom.functions import refs
from statuteloom.functions.text import clean_cell, normalise_text
from statuteloom.operators import crosscheck as cc
from statuteloom.operators import evaluation, layout, mapping, retrieval
from statuteloom.plans.text_queries import cell, norm, old_refs
from statuteloom.session import read_table
from statuteloom.sources import readers, writers
from statuteloom.streaming import incremental

#: The cosine from which on a vector counts as leaked into a query set.
CLOSE = 0.9
_ENTRY = ("bns", "bns_section", "ipc", "bns_title", "ipc_title", "status", "ipc_offence", "ipc_punishment")


def _entries(spark: SparkSession, d: str) -> DataFrame:
    """Entered rows read leniently: those with an unreadable section are left out, unknown statuses are NULL."""
    info = mapping.details(read_table(spark, d, "ipc_details"))
    return mapping.load(read_table(spark, d, "mapping_sample"), "row_id", info, strict=False)


def map_load(spark: SparkSession, d: str) -> DataFrame:
    return _entries(spark, d).select("ordinal", *_ENTRY)


def map_lookup(spark: SparkSession, d: str) -> DataFrame:
    asked = read_table(spark, d, "ipc_details").select(F.col("section").alias("query"))
    out = mapping.lookup(read_table(spark, d, "map_row"), asked)
    n = F.aggregate("matches", F.lit(0).cast("bigint"), lambda a, m: a + m["times"]).cast("int")
    return out.select("query", "key", "found", n.alias("n"), F.try_element_at("matches", F.lit(1))["bns"].alias("first"))


def reverse_index(spark: SparkSession, d: str) -> DataFrame:
    return mapping.reverse_index(read_table(spark, d, "map_row").where("ipc is not null"))


def section_refs(spark: SparkSession, d: str) -> DataFrame:
    return mapping.section_refs(read_table(spark, d, "map_row"))


def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return mapping.status_counts(read_table(spark, d, "map_row"))


def agreement(spark: SparkSession, d: str) -> DataFrame:
    entered = read_table(spark, d, "mapping_sample").select("row_id", F.regexp_extract(F.coalesce("bns_section", F.lit("")), r"^\s*([0-9]{1,3})", 1).alias("s"), refs.old_refs(F.col("ipc_section")).alias("theirs"))
    reference = entered.where("s <> ''").select("row_id", F.col("s").cast("int").alias("section"), "theirs")
    judged = mapping.agreement_rows(read_table(spark, d, "map_row"), reference, "section", "theirs", F.lit(False))
    return mapping.agreement(judged)


def _compared(spark: SparkSession, d: str) -> DataFrame:
    theirs = mapping.first_per_key(readers.transcription(read_table(spark, d, "kaggle_bns_sample"), ["kb_id", "edition"]), ["edition", "act", "section"], "kb_id", last=True)
    ours = read_table(spark, d, "sections").select("sec_id", "edition", "act", "section", "title", "text")
    return cc.compare(ours, theirs.where("not empty"), ["edition", "act", "section"], title_only=("BNSS",))


def crosscheck(spark: SparkSession, d: str) -> DataFrame:
    return _compared(spark, d).select("sec_id", "title_score", "body_score", "flagged", "hint")


def crosscheck_summary(spark: SparkSession, d: str) -> DataFrame:
    return cc.summary(_compared(spark, d))


def crosscheck_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Sections without, with an empty, and with a usable transcription: the part of the check that SQL can state."""
    k = read_table(spark, d, "kaggle_bns_sample").groupBy("edition", "act", "section").agg(F.max_by("description", "kb_id").alias("body"))
    s = read_table(spark, d, "sections").select("act", "edition", F.col("section").cast("string").alias("section"))
    state = F.when(F.col("there").isNull(), "none").when(F.coalesce(normalise_text(F.col("body")), F.lit("")) == "", "empty").otherwise("text")
    return s.join(k.withColumn("there", F.lit(1)), ["edition", "act", "section"], "left").groupBy("act", state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


def numbering(spark: SparkSession, d: str) -> DataFrame:
    return schemas.violations(read_table(spark, d, "sections"))


def handcheck_sample(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.hash_sample(read_table(spark, d, "map_row"), "ordinal", 40).select("ordinal", "bns", "status", "bns_title")


def line_rebuild(spark: SparkSession, d: str) -> DataFrame:
    """Titles set as inked glyphs on drifting baselines and read back as lines, their spaces from the gaps between glyphs."""
    glyphs = layout.typeset(read_table(spark, d, "sections").where("title is not null"), "sec_id", "title").where(F.col("c").rlike(r"(?U)\S"))
    read = layout.lines(layout.visible(glyphs).withColumn("col", layout.column(F.col("x0"))))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "row", "part", "text"))), lambda x: x["text"]), "\n")
    return read.groupBy(F.col("doc").cast("bigint").alias("sec_id")).agg(F.count(F.lit(1)).alias("lines"), F.md5(text).alias("digest"))


def _search(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    s = read_table(spark, d, "sections")
    docs = s.where("text is not null").select("sec_id", retrieval.tokens(F.col("text")).alias("toks"))
    asked = s.where("title is not null and sec_id % 20 = 0").select(F.col("sec_id").alias("query"), retrieval.tokens(F.col("title")).alias("toks"))
    return docs, asked


def bm25_topk(spark: SparkSession, d: str) -> DataFrame:
    docs, asked = _search(spark, d)
    return retrieval.bm25(docs, asked, 5, doc_id="sec_id")


def _vectors(spark: SparkSession, d: str, k: int, **kw) -> DataFrame:
    v = read_table(spark, d, "embeddings")
    return retrieval.dense(v, v.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query"), k, **kw)


def dense_topk(spark: SparkSession, d: str) -> DataFrame:
    return _vectors(spark, d, 5)


def rank_fusion(spark: SparkSession, d: str) -> DataFrame:
    docs, asked = _search(spark, d)
    return retrieval.bm25_fused(docs, asked, [(1.2, 0.75), (0.9, 0.4)], 5, doc_id="sec_id")


def collapse_sections(spark: SparkSession, d: str) -> DataFrame:
    """The 20 best distinct sections of each query; copies of a section in other editions use up no places."""
    docs, asked = _search(spark, d)
    keys = read_table(spark, d, "sections").where("text is not null").select("sec_id", "act", "section", retrieval.tokens(F.col("text")).alias("toks"))
    return retrieval.bm25(keys, asked, 20, doc_id="sec_id", group=["act", "section"])


def _gold(spark: SparkSession, d: str) -> DataFrame:
    v = read_table(spark, d, "embeddings")
    asked = v.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query"), "label")
    return asked.join(v.select("vec_id", "label"), "label").where("query <> vec_id").select("query", "vec_id")


def ir_metrics(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.ranking_metrics(_vectors(spark, d, 10, without_self=True), _gold(spark, d), "vec_id")


def bootstrap_ci(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.bootstrap(read_table(spark, d, "documents").where("text is not null").select("doc_id", F.col("n_chars").cast("double").alias("n")), "n", "doc_id", 1000)


def split_stratified(spark: SparkSession, d: str) -> DataFrame:
    rows = evaluation.stratified(read_table(spark, d, "documents"), F.coalesce("source", F.lit("none")), "doc_id", 5)
    return rows.groupBy("stratum", "split").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))


def leakage_guard(spark: SparkSession, d: str) -> DataFrame:
    """All vectors that are too close to a query vector other than themselves."""
    v = read_table(spark, d, "embeddings")
    return retrieval.close(v, v.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query"), CLOSE)


def citation_validate(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.check_citations(read_table(spark, d, "documents"), read_table(spark, d, "sections"))


def dangling_refs(spark: SparkSession, d: str) -> DataFrame:
    """New references of the table that no edition of the code has."""
    rows = read_table(spark, d, "map_row").select(F.lit("BNS").alias("act"), F.col("bns_section").alias("section"), "ordinal")
    return evaluation.dangling(rows, read_table(spark, d, "sections"), ["act", "section"]).groupBy("section").agg(F.count(F.lit(1)).alias("n"), F.min("ordinal").alias("first"))


def citation_density(spark: SparkSession, d: str) -> DataFrame:
    shares = read_table(spark, d, "documents").select("source", evaluation.cited_sentences(F.col("text")).alias("share"))
    return shares.groupBy("source").agg(F.count("share").alias("n"), F.count_if(F.col("share") > 0).alias("citing"), F.count_if(F.col("share") >= 0.8).alias("well_cited"))


def refusal_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Lookups of entered references: an answer is refused if the table has no row, and answerable if the details list knows the base."""
    asked = _entries(spark, d).select("ordinal", F.explode("ipc").alias("ref"))
    known = read_table(spark, d, "map_row").select(F.explode("ipc").alias("ref")).select(refs.base_ref(F.col("ref")).alias("b")).distinct().withColumn("_t", F.lit(1))
    info = mapping.details(read_table(spark, d, "ipc_details")).select(F.col("key").alias("b")).withColumn("_d", F.lit(1))
    rows = asked.withColumn("b", refs.base_ref(F.col("ref"))).groupBy("b").agg(F.count(F.lit(1)).alias("asked")).join(known, "b", "left").join(info, "b", "left")
    return evaluation.rates(rows, F.col("_t").isNull(), F.col("_d").isNotNull())


def answerability(spark: SparkSession, d: str) -> DataFrame:
    """Probability that a document is about procedure or evidence, from counts of its own text; fitted on labelled documents."""
    about = read_table(spark, d, "doc_labels").groupBy("doc_id").agg(F.max(F.col("subject").isin("procedure", "evidence").cast("double")).alias("label"))
    words = F.lower(F.coalesce("text", F.lit("")))
    features = {n: F.size(F.regexp_extract_all(words, F.lit(p), F.lit(0))).cast("double") for n, p in (("court", r"\b(?:court|judge|bench|bail|custody)"), ("proof", r"\b(?:witness|proof|proved|statement|signature)"), ("words", r"\S+"), ("digits", r"[0-9]+"))}
    rows = read_table(spark, d, "documents").select("doc_id", *[v.alias(k) for k, v in features.items()]).join(about, "doc_id", "left")
    scored = evaluation.answerability(rows, list(features), "label", "doc_id", F.col("label").isNotNull())
    return scored.select("doc_id", F.round("probability", 3).alias("probability"))


def file_manifest(spark: SparkSession, d: str) -> DataFrame:
    files = writers.manifest(spark, d, glob="*.parquet")
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "sha256", "bytes")


def event_windows(spark: SparkSession, d: str) -> DataFrame:
    return incremental.windowed(read_table(spark, d, "events")).withColumn("total", F.round("total", 4))


def event_sessions(spark: SparkSession, d: str) -> DataFrame:
    return incremental.sessions(read_table(spark, d, "events"), gap="6 hours")


QUERIES = {
    q.__name__: q
    for q in (
        map_load, map_lookup, reverse_index, section_refs, status_counts, agreement, crosscheck, crosscheck_summary, crosscheck_coverage, numbering, handcheck_sample, line_rebuild,
        bm25_topk, dense_topk, rank_fusion, collapse_sections, ir_metrics, bootstrap_ci, split_stratified, leakage_guard, citation_validate, dangling_refs, citation_density, refusal_metrics,
        answerability, file_manifest, event_windows, event_sessions,
    )
}

_TOKS = r"list_filter(regexp_extract_all(lower({0}), '[0-9]+[a-z]{{0,2}}(?:\([0-9a-z]+\))*|[a-z]+'), lambda t: t NOT IN ('a', 'an', 'and', 'any', 'are', 'as', 'at', 'be', 'by', 'for', 'from', 'has', 'he', 'in', 'is', 'it', 'of', 'on', 'or', 'shall', 'such', 'that', 'the', 'this', 'to', 'was', 'who', 'with'))"


def _bm25(k: int, name: str = "ranked", k1: float = 1.2, b: float = 0.75) -> str:
    return f"""
    d_{name} AS (SELECT sec_id, {_TOKS.format("text")} AS toks FROM sections WHERE text IS NOT NULL),
    q_{name} AS (SELECT DISTINCT sec_id AS query, unnest({_TOKS.format("title")}) AS term FROM sections WHERE title IS NOT NULL AND sec_id % 20 = 0),
    tf_{name} AS (SELECT sec_id, term, count(*) AS tf FROM (SELECT sec_id, unnest(toks) AS term FROM d_{name}) GROUP BY ALL),
    df_{name} AS (SELECT term, count(*) AS df FROM tf_{name} GROUP BY term),
    st_{name} AS (SELECT count(*) AS n, avg(len(toks)) AS mean FROM d_{name}),
    sc_{name} AS (SELECT query, t.sec_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * ({k1} + 1) / (tf + {k1} * (1 - {b} + {b} * len(toks) / mean))), 4) AS score
        FROM q_{name} q JOIN tf_{name} t USING (term) JOIN df_{name} USING (term) JOIN d_{name} d ON d.sec_id = t.sec_id, st_{name} GROUP BY query, t.sec_id),
    {name} AS (SELECT * FROM (SELECT query, sec_id, score, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, sec_id) AS INT) AS rank FROM sc_{name} WHERE score > 0) WHERE rank <= {k})"""


def _cosine(k: int, others: bool) -> str:
    return f"""
    near AS (SELECT a.vec_id AS query, b.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 4) AS score
        FROM embeddings a JOIN embeddings b ON a.vec_id % 20 = 0 {"AND a.vec_id <> b.vec_id" if others else ""}),
    ranked AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS INT) AS rank FROM near) WHERE rank <= {k})"""


_DETAILS = f"""(SELECT upper(regexp_replace(trim(section), '(?i)^ipc_?', '')) AS key, min(struct_pack(o := coalesce({cell("offense")}, chr(1)), p := coalesce({cell("punishment")}, chr(1)))) AS d FROM ipc_details GROUP BY 1)"""
_ENTRIES = rf"""
    e AS (SELECT row_id AS ordinal, {cell("bns_section")} AS b, {old_refs("ipc_section")} AS ipc, {cell("bns_title")} AS bns_title, {cell("ipc_title")} AS ipc_title, lower(coalesce({cell("status")}, '')) AS s FROM mapping_sample),
    entries AS (SELECT ordinal, CAST(TRY_CAST(regexp_extract(b, '^[0-9]+') AS INT) AS VARCHAR) || regexp_replace(regexp_replace(b, '^[0-9]+', ''), '\s', '', 'g') AS bns, TRY_CAST(regexp_extract(b, '^[0-9]+') AS INT) AS bns_section, ipc, bns_title, ipc_title,
        CASE s WHEN '' THEN 'carried_over' WHEN 'change' THEN 'changed' WHEN 'changed' THEN 'changed' WHEN 'deleted' THEN 'deleted' WHEN 'new section' THEN 'new_section' WHEN 'new sub-section' THEN 'new_subsection' WHEN 'new subsection' THEN 'new_subsection' END AS status
        FROM e WHERE (b IS NULL OR regexp_full_match(b, '[0-9]{{1,3}}\s*(\(\s*[0-9a-z]+\s*\)\s*)*')) AND (b IS NOT NULL OR len(ipc) > 0))"""
_HASH = "CAST(('0x' || substring(md5({0}), 1, 8)) AS BIGINT)"
ORACLES = {
    "reverse_index": """
        SELECT ref, coalesce(list(bns ORDER BY o) FILTER (bns IS NOT NULL), []) AS bns
        FROM (SELECT ref, bns, min(ordinal) AS o FROM (SELECT unnest(ipc) AS ref, bns, ordinal FROM map_row) GROUP BY ref, bns) GROUP BY ref""",
    "section_refs": """
        SELECT bns_section, list('IPC ' || ref ORDER BY o, k) AS refs FROM (
            SELECT bns_section, ref, min_by(ordinal, ordinal * 1000 + k) AS o, min_by(k, ordinal * 1000 + k) AS k
            FROM (SELECT bns_section, ordinal, unnest(ipc) AS ref, generate_subscripts(ipc, 1) AS k FROM map_row WHERE bns_section IS NOT NULL) GROUP BY bns_section, ref) GROUP BY bns_section""",
    "status_counts": "SELECT status, count(*) AS n, count(DISTINCT bns_section) AS sections FROM map_row GROUP BY status",
    "map_lookup": r"""
        WITH asked AS (SELECT DISTINCT section AS query, regexp_extract(x, '([0-9]{1,3})', 1) || upper(regexp_extract(x, '[0-9]{1,3}\s*-?\s*([A-Za-z]{1,2})', 1)) AS key
            FROM (SELECT section, regexp_replace(section, '(?i)^\s*ipc_?', '') AS x FROM ipc_details WHERE section IS NOT NULL)),
        refs AS (SELECT ordinal, bns, unnest(ipc) AS ref FROM map_row),
        idx AS (SELECT ordinal, bns, unnest(list_distinct([ref, regexp_replace(ref, '\(.*', '')])) AS key FROM refs)
        SELECT query, asked.key, coalesce(count(idx.bns) > 0, FALSE) AS found, CAST(count(idx.bns) AS INT) AS n, min_by(idx.bns, idx.ordinal) FILTER (idx.bns IS NOT NULL) AS first
        FROM asked LEFT JOIN idx ON idx.key = asked.key GROUP BY query, asked.key""",
    "crosscheck_coverage": f"""
        SELECT s.act, CASE WHEN k.section IS NULL THEN 'none' WHEN coalesce({norm("k.body")}, '') = '' THEN 'empty' ELSE 'text' END AS state, count(*) AS n
        FROM sections s LEFT JOIN (SELECT edition, act, section, arg_max_null(description, kb_id) AS body FROM kaggle_bns_sample GROUP BY ALL) k
        ON s.edition = k.edition AND s.act = k.act AND CAST(s.section AS VARCHAR) = k.section GROUP BY ALL""",
    "numbering": """
        SELECT edition, act, count(*) AS sections, min(section) AS lowest, max(section) AS highest, max(section) - min(section) + 1 - count(DISTINCT section) AS gaps,
               count(*) - count(DISTINCT section) AS repeats, count(*) FILTER (trim(coalesce(title, '')) = '') AS untitled, count(*) FILTER (trim(coalesce(text, '')) = '') AS empty
        FROM sections GROUP BY edition, act""",
    "handcheck_sample": f"SELECT ordinal, bns, status, bns_title FROM map_row ORDER BY {_HASH.format(chr(39) + '42:' + chr(39) + ' || ordinal')}, ordinal LIMIT 40",
    "line_rebuild": r"""
        SELECT sec_id, len(l) AS lines, md5(array_to_string(l, chr(10))) AS digest FROM (
            SELECT sec_id, list_filter(list_transform(range(0, length(title), 60), lambda k: regexp_replace(regexp_replace(title[k + 1 : k + 60], '[\s\p{Z}]+', ' ', 'g'), '^ | $', '', 'g')), lambda x: x <> '') AS l
            FROM sections WHERE title IS NOT NULL) WHERE len(l) > 0""",
    "bm25_topk": f"WITH {_bm25(5)} SELECT * FROM ranked",
    "dense_topk": f"WITH {_cosine(5, False)} SELECT * FROM ranked",
    "rank_fusion": f"""WITH {_bm25(1_000_000_000, "a")}, {_bm25(1_000_000_000, "b", 0.9, 0.4)},
        f AS (SELECT query, sec_id, round(sum(1.0 / (60 + rank)), 8) AS score FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY query, sec_id)
        SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, sec_id) AS INT) AS rank FROM f) WHERE rank <= 5""",
    "collapse_sections": f"""WITH {_bm25(1)}, best AS (SELECT query, act, section, max(score) AS score FROM sc_ranked JOIN sections USING (sec_id) WHERE score > 0 GROUP BY query, act, section)
        SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, act, section) AS INT) AS rank FROM best) WHERE rank <= 20""",
    "ir_metrics": f"""WITH {_cosine(10, True)},
        gold AS (SELECT a.vec_id AS query, b.vec_id FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0),
        n AS (SELECT query, count(*) AS n FROM gold GROUP BY query),
        h AS (SELECT query, count(*) FILTER (rank <= 5) AS found, min(rank) AS first, sum(1.0 / log2(rank + 1)) AS gain FROM ranked JOIN gold USING (query, vec_id) GROUP BY query)
        SELECT query, round(coalesce(found, 0) / n, 6) AS recall, CAST(coalesce(found, 0) > 0 AS INT) AS hit, round(coalesce(1.0 / first, 0.0), 6) AS mrr,
               round(coalesce(gain, 0) / list_sum(list_transform(range(1, least(n, 10) + 1), lambda r: 1.0 / log2(r + 1))), 6) AS ndcg FROM n LEFT JOIN h USING (query)""",
    "bootstrap_ci": f"""
        WITH v AS (SELECT doc_id, CAST(n_chars AS DOUBLE) AS v FROM documents WHERE text IS NOT NULL AND n_chars IS NOT NULL),
        r AS (SELECT r, v, {_HASH.format("concat('42:', doc_id, ':', r)")} / 4294967296.0 AS u FROM v, range(1, 1001) t(r)),
        t AS (SELECT r, v, (u >= 0.36787944)::INT + (u >= 0.73575888)::INT + (u >= 0.91969860)::INT + (u >= 0.98101184)::INT + (u >= 0.99634015)::INT + (u >= 0.99940582)::INT AS k FROM r),
        m AS (SELECT r, sum(v * k) / sum(k) AS m FROM t GROUP BY r)
        SELECT (SELECT count(*) FROM v) AS n, round((SELECT avg(v) FROM v), 6) AS mean, round(quantile_cont(m, 0.025), 6) AS low, round(quantile_cont(m, 0.975), 6) AS high FROM m""",
    "citation_density": r"""
        WITH s AS (SELECT source, list_filter(string_split(regexp_replace(text, '([.?!])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: regexp_matches(x, '\S')) AS p FROM documents),
        c AS (SELECT source, CASE WHEN len(p) > 0 THEN len(list_filter(p, lambda x: regexp_matches(x, '\b(BNSS|BNS|BSA)\s+([0-9]{1,3})'))) / CAST(len(p) AS DOUBLE) END AS share FROM s)
        SELECT source, count(share) AS n, count(*) FILTER (share > 0) AS citing, count(*) FILTER (share >= 0.8) AS well_cited FROM c GROUP BY source""",
    "split_stratified": f"""SELECT stratum, split, count(*) AS n, min(doc_id) AS first FROM (SELECT stratum, doc_id,
        CASE WHEN (row_number() OVER (PARTITION BY stratum ORDER BY {_HASH.format("concat_ws(':', '42', stratum, doc_id)")}, doc_id) - 1) % 5 = 0 THEN 'test' ELSE 'dev' END AS split
        FROM (SELECT coalesce(source, 'none') AS stratum, doc_id FROM documents)) GROUP BY ALL""",
    "leakage_guard": f"WITH {_cosine(1, True)} SELECT vec_id, count(*) AS queries, max(score) AS closest FROM near WHERE score >= {CLOSE} GROUP BY vec_id",
    "citation_validate": r"""
        WITH c AS (SELECT DISTINCT doc_id, regexp_extract(x, '(BNSS|BNS|BSA)', 1) AS act, CAST(regexp_extract(x, '\s([0-9]{1,3})', 1) AS INT) AS section
            FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\b(?:BNSS|BNS|BSA)\s+[0-9]{1,3}(?:\([0-9a-z]+\))*')) AS x FROM documents)),
        s AS (SELECT DISTINCT act, section, 1 AS i FROM sections)
        SELECT doc_id, count(*) AS n, count(i) AS known, count(*) - count(i) AS unknown FROM c LEFT JOIN s USING (act, section) GROUP BY doc_id""",
    "dangling_refs": "SELECT bns_section AS section, count(*) AS n, min(ordinal) AS first FROM map_row WHERE bns_section IS NOT NULL AND bns_section NOT IN (SELECT section FROM sections WHERE act = 'BNS') GROUP BY bns_section",
    "map_load": f"""WITH {_ENTRIES}
        SELECT ordinal, bns, bns_section, ipc, bns_title, ipc_title, status, nullif(d.o, chr(1)) AS ipc_offence, nullif(d.p, chr(1)) AS ipc_punishment
        FROM entries LEFT JOIN {_DETAILS} k ON k.key = regexp_replace(ipc[1], '\\(.*', '')""",
    "agreement": rf"""
        WITH t AS (SELECT CAST(s AS INT) AS section, theirs FROM (SELECT regexp_extract(coalesce(bns_section, ''), '^\s*([0-9]{{1,3}})', 1) AS s, {old_refs("ipc_section")} AS theirs FROM mapping_sample) WHERE s <> ''),
        o AS (SELECT bns_section AS section, list(DISTINCT b) FILTER (b IS NOT NULL) AS ours FROM (SELECT bns_section, regexp_replace(unnest(CASE WHEN len(ipc) > 0 THEN ipc ELSE [NULL] END), '\(.*', '') AS b FROM map_row WHERE bns_section IS NOT NULL) GROUP BY 1),
        j AS (SELECT o.section IS NOT NULL AND ((len(theirs) = 0 AND coalesce(len(ours), 0) = 0) OR coalesce(list_has_any(ours, list_transform(theirs, lambda r: regexp_replace(r, '\(.*', ''))), FALSE)) AS ok FROM t LEFT JOIN o USING (section))
        SELECT count(*) AS n, count(*) FILTER (ok) AS agree, round(CAST(count(*) FILTER (ok) AS DOUBLE) / nullif(count(*), 0), 4) AS rate FROM j""",
    "refusal_metrics": rf"""WITH {_ENTRIES},
        a AS (SELECT DISTINCT regexp_replace(unnest(ipc), '\(.*', '') AS b FROM entries),
        r AS (SELECT b, b NOT IN (SELECT regexp_replace(x, '\(.*', '') FROM (SELECT unnest(ipc) AS x FROM map_row) WHERE x IS NOT NULL) AS refused, b IN (SELECT key FROM {_DETAILS}) AS ok FROM a)
        SELECT count(*) AS n, round(CAST(count(*) FILTER (refused AND NOT ok) AS DOUBLE) / nullif(count(*) FILTER (NOT ok), 0), 6) AS refusal_recall,
               round(CAST(count(*) FILTER (refused AND ok) AS DOUBLE) / nullif(count(*) FILTER (ok), 0), 6) AS false_refusals FROM r""",
    "event_windows": "SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
    "event_sessions": """
        SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, count(*) AS n FROM (
            SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
                SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, s""",
}
