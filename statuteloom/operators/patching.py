"""Reviewed corrections of section records, each of which must meet exactly one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuteloom.functions.folds import subsections
from statuteloom.session import small_side

FIELDS = ("title", "text", "chapter_title", "in_force")


def patch_sections(sections: DataFrame, patches: DataFrame, key: str = "sec_id", order: str | None = None) -> DataFrame:
    """sections with patches(key, subsection, field, value[, order]) applied; of several for one field the last in order counts.

    A new text is cut into sub-sections again; in_force needs a sub-section and changes that one, and the section is in force
    if all of its sub-sections are. A patch of an unknown section, sub-section or field, of in_force without a sub-section, or
    of another field with one, is an error, and so are several for one field without an order.
    """
    new = small_side(patches.select(F.col(key), "subsection", "field", "value", (F.col(order) if order else F.lit(0)).alias("_order")))
    force = F.col("field") == "in_force"
    bad = new.where(F.col("field").isNull() | ~F.col("field").isin(*FIELDS) | (force != F.col("subsection").isNotNull())).count()
    known = sections.select(key, F.transform("subsections", lambda s: s["number"]).alias("numbers"), F.lit(1).alias("_there"))
    met = new.join(known, key, "left").where(F.col("_there").isNull() | (F.col("subsection").isNotNull() & (F.coalesce(F.size(F.filter("numbers", lambda n: n == F.col("subsection"))), F.lit(0)) != 1))).count()
    if order is None and new.count() != new.select(key, "subsection", "field").distinct().count():
        raise ValueError("several patches of one field need an order")
    if bad or met:
        raise ValueError(f"{bad} patches of unknown or unfit fields, {met} of unknown sections or sub-sections")
    value = lambda f: F.max_by("value", F.when(F.col("field") == f, F.col("_order"))).alias(f"_{f}")
    last = new.where(force).groupBy(key, "subsection").agg(F.max_by("value", "_order").alias("value"))
    forces = last.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("subsection", F.lower("value") == "true"))).alias("_force"))
    by_key = new.groupBy(key).agg(value("title"), value("text"), value("chapter_title")).join(forces, key, "left")
    rows = sections.join(by_key, key, "left")
    cut = F.transform(subsections(F.col("_text")), lambda s: F.struct(s["number"].alias("number"), s["text"].alias("text"), F.lit(True).alias("in_force")))
    subs = F.when(F.col("_text").isNotNull(), cut).otherwise(F.col("subsections"))
    subs = F.transform(subs, lambda s: F.struct(s["number"].alias("number"), s["text"].alias("text"), F.coalesce(F.try_element_at("_force", F.coalesce(s["number"], F.lit(""))), s["in_force"]).alias("in_force")))
    touched = F.size(F.coalesce("_force", F.create_map().cast("map<string,boolean>"))) > 0
    out = rows.withColumn("subsections", subs)
    out = out.withColumn("in_force", F.when(touched, F.forall("subsections", lambda s: s["in_force"])).otherwise(F.col("in_force")))
    for f in ("title", "text", "chapter_title"):
        out = out.withColumn(f, F.coalesce(f"_{f}", f))
    return out.select(*sections.columns)
