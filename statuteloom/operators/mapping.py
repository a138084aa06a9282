"""The correspondence table of the old and the new code: loading, lookup, reverse index, agreement, patches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statuteloom.functions.refs import base_ref, canonical_query, new_ref, old_refs, status_code
from statuteloom.functions.text import clean_cell
from statuteloom.session import small_side

MAP_FIELDS = ("bns", "bns_section", "ipc", "bns_title", "ipc_title", "status", "ipc_offence", "ipc_punishment", "source")


def details(raw: DataFrame, order: str | None = None) -> DataFrame:
    """(key, offence, punishment) of old-code sections; of repeated keys the first wins (by `order`, else the least row)."""
    key = F.upper(F.regexp_replace(F.trim("section"), r"(?i)^ipc_?", ""))
    rows = raw.select(key.alias("key"), clean_cell(F.col("offense")).alias("offence"), clean_cell(F.col("punishment")).alias("punishment"), *([F.col(order).alias("_o")] if order else []))
    first = F.min_by(F.struct("offence", "punishment"), "_o") if order else F.min(F.struct("offence", "punishment"))
    return rows.where(F.col("key") != "").groupBy("key").agg(first.alias("d")).select("key", "d.offence", "d.punishment")


def load(raw: DataFrame, ordinal: str, info: DataFrame | None = None, source: str = "table", strict: bool = True) -> DataFrame:
    """Typed correspondence rows (ordinal and MAP_FIELDS) of raw cells; spacer rows, without any reference, are left out.

    strict raises an error on an unreadable new-code reference or unknown status; otherwise such a row has a NULL status
    or is left out. Offence and punishment come from `info` by the base of the first old reference.
    """
    readable = F.coalesce(clean_cell(F.col("bns_section")), F.lit("1")).rlike(r"^[0-9]{1,3}\s*(\(\s*[0-9a-z]+\s*\)\s*)*$")
    kept = raw if strict else raw.where(readable)
    rows = kept.select(
        F.col(ordinal).alias("ordinal"),
        new_ref(F.col("bns_section")).alias("r"),
        old_refs(F.col("ipc_section")).alias("ipc"),
        clean_cell(F.col("bns_title")).alias("bns_title"),
        clean_cell(F.col("ipc_title")).alias("ipc_title"),
        status_code(F.col("status"), strict).alias("status"),
    )
    rows = rows.select("ordinal", "r.bns", "r.bns_section", "ipc", "bns_title", "ipc_title", "status").where(F.col("bns").isNotNull() | (F.size("ipc") > 0))
    if info is None:
        rows = rows.withColumns({"ipc_offence": F.lit(None).cast("string"), "ipc_punishment": F.lit(None).cast("string")})
    else:
        named = small_side(info).select(F.col("key").alias("_k"), F.col("offence").alias("ipc_offence"), F.col("punishment").alias("ipc_punishment"))
        rows = rows.withColumn("_b", base_ref(F.try_element_at("ipc", F.lit(1)))).join(named, F.col("_b") == F.col("_k"), "left")
    return rows.withColumn("source", F.lit(source)).select("ordinal", *MAP_FIELDS)


def keyed(rows: DataFrame) -> DataFrame:
    """Rows once for each of their references and once for its base if that differs: the lookup index, duplicates kept."""
    refs = rows.where(F.size("ipc") > 0).withColumn("_ref", F.explode("ipc"))
    return refs.withColumn("key", F.explode(F.array_distinct(F.array("_ref", base_ref(F.col("_ref")))))).drop("_ref")


def lookup(rows: DataFrame, queries: DataFrame, query: str = "query", notes: DataFrame | None = None) -> DataFrame:
    """(query, key, found, matches, message) of each distinct query.

    A query is canonicalised and looked up as it stands, else by its base; matches are the rows with a new-code section, in
    table order, equal ones once (with their first ordinal and their number `times`). Queries without a row are kept, with a
    message that tells deleted from unknown. Rows are made distinct, with partial counts, before anything is gathered, so a
    query's array holds distinct provisions and does not grow with repeated rows.
    """
    asked = queries.select(F.col(query).alias("query")).where(F.col(query).isNotNull()).distinct().withColumn("key", canonical_query(F.col("query")))
    tries = asked.select("query", "key", F.posexplode(F.array_distinct(F.array("key", base_ref(F.col("key"))))).alias("rank", "try"))
    fields = ("bns", "bns_section", "bns_title", "status", "ipc_title", "ipc_offence", "ipc_punishment")
    index = keyed(rows).groupBy(F.col("key").alias("_key"), *fields).agg(F.min("ordinal").alias("ordinal"), F.count(F.lit(1)).alias("times"))
    match = F.when(F.col("bns").isNotNull(), F.struct("ordinal", *fields, "times"))
    whole = index.groupBy("_key").agg(F.array_sort(F.collect_list(match)).alias("matches"), F.sum("times").alias("rows"))
    hits = tries.join(whole, F.col("try") == F.col("_key"))
    per = hits.groupBy("query").agg(F.min_by(F.struct("matches", "rows"), "rank").alias("m")).select("query", "m.*")  # exact if there is any, else the base
    out = asked.join(per, "query", "left")
    if notes is None:
        out = out.withColumn("note", F.lit(None).cast("string"))
    else:
        few = small_side(notes.select(F.upper("ipc").alias("_n"), "note"))
        out = out.join(few.toDF("_n1", "note1"), F.col("key") == F.col("_n1"), "left").join(few.toDF("_n2", "note2"), base_ref(F.col("key")) == F.col("_n2"), "left")
        out = out.withColumn("note", F.coalesce("note1", "note2"))
    found = F.coalesce(F.size("matches") > 0, F.lit(False))
    listed = F.array_join(F.array_distinct(F.transform("matches", lambda m: F.concat(F.lit("BNS "), m["bns"]))), ", ")
    told = (
        F.when(found, F.format_string("Old section %s is now %s.", "key", listed))
        .when(F.col("rows") > 0, F.format_string("Old section %s was deleted; no new section takes its place.", "key"))
        .otherwise(F.format_string("Old section %s was not found.", "key"))
    )
    message = F.when(F.col("rows") > 0, F.concat(told, F.coalesce(F.concat(F.lit(" Note: "), "note"), F.lit("")))).otherwise(told)
    return out.select("query", "key", found.alias("found"), F.coalesce("matches", F.array().cast("array<struct<ordinal:bigint,bns:string,bns_section:int,bns_title:string,status:string,ipc_title:string,ipc_offence:string,ipc_punishment:string,times:bigint>>")).alias("matches"), "note", message.alias("message"))


def reverse_index(rows: DataFrame) -> DataFrame:
    """(ref, bns): distinct new references of each old one, in table order; an empty array if all its rows are deleted.

    Pairs are made distinct before they are gathered, so an array holds references, never rows.
    """
    pairs = rows.select(F.explode("ipc").alias("ref"), "bns", "ordinal").groupBy("ref", "bns").agg(F.min("ordinal").alias("first"))
    listed = F.array_sort(F.collect_list(F.when(F.col("bns").isNotNull(), F.struct("first", "bns"))))
    return pairs.groupBy("ref").agg(listed.alias("p")).select("ref", F.col("p.bns").alias("bns"))


def section_refs(rows: DataFrame) -> DataFrame:
    """(bns_section, refs): distinct old references of each new section with their prefix, in table order."""
    pairs = rows.where(F.col("bns_section").isNotNull()).select("bns_section", F.posexplode("ipc").alias("k", "ref"), "ordinal")
    firsts = pairs.groupBy("bns_section", "ref").agg(F.min(F.struct("ordinal", "k")).alias("first"))
    return firsts.groupBy("bns_section").agg(F.array_sort(F.collect_list(F.struct("first", F.concat(F.lit("IPC "), "ref").alias("ref")))).alias("p")).select("bns_section", F.col("p.ref").alias("refs"))


def status_counts(rows: DataFrame) -> DataFrame:
    """(status, n, sections): rows and distinct new sections of each status."""
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("bns_section").alias("sections"))


def agreement_rows(rows: DataFrame, reference: DataFrame, section: str, refs: str, is_new: Column) -> DataFrame:
    """Each reference row with `ours` (distinct base references of its section in our table) and `agrees`.

    It agrees if it says the provision is new (or names no reference) and ours has none, or if the two overlap.
    """
    base = rows.where(F.col("bns_section").isNotNull()).select("bns_section", F.explode_outer(F.transform("ipc", base_ref)).alias("b"))
    ours = base.groupBy("bns_section").agg(F.array_sort(F.collect_set("b")).alias("ours"))
    theirs = F.transform(F.col(refs), base_ref)
    joined = reference.join(ours, reference[section] == ours["bns_section"], "left").drop(ours["bns_section"])
    new = is_new | (F.size(theirs) == 0)
    ok = F.col("ours").isNotNull() & ((new & (F.size("ours") == 0)) | F.arrays_overlap("ours", theirs))
    return joined.withColumn("agrees", F.coalesce(ok, F.lit(False)))


def of_act(reference: DataFrame, act: str = "BNS", column: str = "act") -> DataFrame:
    """Rows of one act; without such a column, or with NULL in it, a row counts as that act's."""
    return reference.where(F.coalesce(F.trim(column), F.lit(act)) == act) if column in reference.columns else reference


def agreement(judged: DataFrame) -> DataFrame:
    """(n, agree, rate) of agreement_rows; the rate has four places and is NULL without rows."""
    out = judged.agg(F.count(F.lit(1)).alias("n"), F.count_if("agrees").alias("agree"))
    return out.withColumn("rate", F.bround(F.try_divide(F.col("agree").cast("double"), F.col("n")), 4))


def patch(rows: DataFrame, match: Sequence[str], patches: DataFrame, set_fields: Sequence[str], additions: DataFrame | None = None) -> DataFrame:
    """rows with each patch applied to the one row that equals it in the match fields (NULL equals NULL); additions appended.

    A patch that meets no row, or more than one, is an error, and so are two patches of one row. NULL in a set field leaves the value as it is.
    """
    new = patches.select(*(F.col(m).alias(f"_m_{m}") for m in match), *(F.col(s).alias(f"_s_{s}") for s in set_fields))
    # a patch is known by what it matches, the same in every action
    new = small_side(new.withColumn("_id", F.xxhash64(*[F.coalesce(F.col(f"_m_{m}").cast("string"), F.lit("\u0000")) for m in match])))
    if new.count() != new.select("_id").distinct().count():
        raise ValueError("several patches of the same row")
    on = F.lit(True)
    for m in match:
        on = on & F.col(m).eqNullSafe(F.col(f"_m_{m}"))
    hits = {r["_id"]: r["n"] for r in rows.join(new, on).groupBy("_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    wrong = [r["_id"] for r in new.select("_id").collect() if hits.get(r["_id"], 0) != 1]
    if wrong:
        raise ValueError(f"{len(wrong)} patches do not match exactly one row")
    out = rows.join(new, on, "left").select(*(F.coalesce(f"_s_{c}", c).alias(c) if c in set_fields else F.col(c) for c in rows.columns))
    return out if additions is None else out.unionByName(additions, allowMissingColumns=True)


def first_per_key(df: DataFrame, keys: Sequence[str], order: str, last: bool = False) -> DataFrame:
    """One row a key, the first (or last) by `order`."""
    sort = F.col(order).desc() if last else F.col(order).asc()
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(sort))).where("_rn = 1").drop("_rn")
