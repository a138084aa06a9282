"""Registered queries of the general data-preparation operators, with their SQL checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuteloom.operators import bad_records, packed_values
from statuteloom.session import read_table, short_list


def _records(spark: SparkSession, d: str) -> DataFrame:
    labels = short_list(read_table(spark, d, "status_ref"), "label")
    return bad_records.parse_records(read_table(spark, d, "mapping_raw"), "raw_id", "raw_line", labels)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return bad_records.rejected(_records(spark, d), "raw_id")


def p1_rows(spark: SparkSession, d: str) -> DataFrame:
    return bad_records.loaded(_records(spark, d), "raw_id")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    sample, rows = read_table(spark, d, "mapping_sample"), read_table(spark, d, "map_row")
    known = short_list(packed_values.dictionary((sample, "ipc_section"), (rows, "ipc")), "value", packed_values.MOST_VALUES)
    parts = [
        packed_values.split_packed(df, key, field, known).where("packed").select(F.lit(name).alias("tbl"), F.col(key).alias("row_id"), "pos", "ipc_ref")
        for df, key, field, name in ((sample, "row_id", "ipc_section", "mapping_sample"), (rows, "ordinal", "ipc", "map_row"))
    ]
    return parts[0].unionAll(parts[1])


QUERIES = {q.__name__: q for q in (p1_found, p1_rows, p3_found)}

_CELL = r'(?:"(?:[^"]|"")*"|[^",]*)'
_GROUPED = r'("(?:[^"]|"")*"|[^",]*)'
_NULLS = "('', 'nan', 'none', '-', '—', 'na', 'n/a')"
_RECORDS = rf"""
    WITH cut AS (
        SELECT raw_id, raw_line,
               coalesce(regexp_full_match(raw_line, '(?s){_CELL}(?:,{_CELL})*'), TRUE) AS quoted,
               coalesce(regexp_full_match(raw_line, '(?s){_CELL}(?:,{_CELL}){{4}}'), FALSE) AS five,
               regexp_extract(raw_line, '(?s)^{_GROUPED},{_GROUPED},{_GROUPED},{_GROUPED},{_GROUPED}$', ['a', 'b', 'c', 'd', 'e']) AS x
        FROM mapping_raw),
    cells AS (
        SELECT raw_id, quoted, five, list_transform([x.a, x.b, x.c, x.d, x.e], lambda v:
            CASE WHEN v LIKE '"%' THEN replace(v[2:-2], '""', '"') ELSE v END) AS c FROM cut),
    flat AS (SELECT *, list_transform(c, lambda v: trim(regexp_replace(v, '[\s\p{{Z}}]+', ' ', 'g'))) AS f FROM cells),
    judged AS (SELECT raw_id, c, f, CASE
        WHEN NOT quoted THEN 'quoting' WHEN NOT five THEN 'column_count'
        WHEN NOT (lower(f[1]) IN {_NULLS} OR (regexp_full_match(f[1], '[0-9]{{1,3}} ?(\( ?[0-9a-z]+ ?\) ?)*')
             AND TRY_CAST(regexp_extract(f[1], '^[0-9]{{1,3}}') AS INT) BETWEEN 1 AND 358)) THEN 'bns_section'
        WHEN NOT (lower(f[3]) IN {_NULLS} OR lower(f[3]) IN (SELECT lower(regexp_replace(label, '\s+', ' ', 'g')) FROM status_ref)) THEN 'status' END AS reason
        FROM flat)
"""
_REMARK = r"\(?\[?\{?(old no\. as on [0-9/]+|w\.e\.f\. [0-9.]+|para [0-9]+ at p\. [0-9]+|see note [0-9]+|note [0-9]+|Ch\. [0-9]+|vol\. [0-9]+|p\. [0-9]+|sr\. no\. [0-9]+|fine up to Rs [0-9]+|[0-9]+ copies|IPC 1860|1860 Code)[\)\]\}]?"
_REF = r"[0-9]{1,3}(?:(?:\s?-\s?|\s)?[A-Z]{1,2}\b|-?[a-z]{1,2}\b)?(?:\s*\((?:[0-9]+|[a-z])(?:,\s?[a-z])*\))*"
ORACLES = {
    "p1_found": _RECORDS + "SELECT raw_id, reason FROM judged WHERE reason IS NOT NULL",
    "p1_rows": _RECORDS
    + rf"""SELECT raw_id, replace(a[1], ' ', '') AS bns, TRY_CAST(regexp_extract(a[1], '^[0-9]+') AS INT) AS bns_section, a[2] AS bns_title, a[3] AS status, a[4] AS ipc_section, a[5] AS ipc_title
        FROM (SELECT raw_id, list_transform(f, lambda v: CASE WHEN lower(v) IN {_NULLS} THEN NULL ELSE v END) AS a FROM judged WHERE reason IS NULL)""",
    "p3_found": rf"""
        WITH fields AS (
            SELECT 'mapping_sample' AS tbl, row_id, [ipc_section] AS elements FROM mapping_sample UNION ALL SELECT 'map_row', ordinal, ipc FROM map_row),
        refs AS (SELECT tbl, row_id, list_transform(list_filter(elements, lambda e: e IS NOT NULL), lambda e:
            regexp_extract_all(regexp_replace(e, '{_REMARK}', ' ; ', 'g'), '{_REF}')) AS found FROM fields),
        packed AS (SELECT tbl, row_id, flatten(found) AS found FROM refs WHERE len(list_filter(found, lambda x: len(x) > 1)) > 0)
        SELECT tbl, row_id, CAST(pos AS INT) AS pos,
               concat(regexp_extract(r, '^[0-9]+'), upper(regexp_extract(regexp_replace(r, '[\s-]', '', 'g'), '^[0-9]+([A-Za-z]*)', 1)), regexp_extract(regexp_replace(r, '\s', '', 'g'), '\(.*$')) AS ipc_ref
        FROM (SELECT tbl, row_id, unnest(found) AS r, generate_subscripts(found, 1) AS pos FROM packed)
    """,
}
