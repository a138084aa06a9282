"""Section-aware chunks under a token budget, planned inside each row.

A section's sub-sections, blocks and units are arrays of its row; splitting and packing are folds over them. The plan is one
narrow stage (the reference join aside), however many sections there are. Tokens are words parted by white space unless another counter is given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuteloom.functions.folds import blocks, halved, illustrations, subsections
from statuteloom.functions.text import clause_sentences, normalise_text, paragraphs, word_count

#: Tokens of a text, as an expression.
Counter = Callable[[Column], Column]
SHOWN_REFS = 5
_UNIT = "array<struct<text:string,subs:array<string>,in_force:boolean,kind:string>>"
_CHUNK = "array<struct<body:string,subs:array<string>,in_force:boolean,kind:string,tokens:int>>"


def header(act: Column, section: Column, title: Column, chapter_no: Column, chapter_title: Column, refs: Column) -> Column:
    """`[ACT n] title | Chapter X: title | Formerly: refs`, parts left out where NULL or empty; at most five references shown."""
    chapter = F.concat(F.lit("Chapter "), F.nullif(chapter_no, F.lit("")), F.coalesce(F.concat(F.lit(": "), F.nullif(chapter_title, F.lit(""))), F.lit("")))
    more = F.when(F.size(refs) > SHOWN_REFS, ", …").otherwise("")
    formerly = F.when(F.size(refs) > 0, F.concat(F.lit("Formerly: "), F.array_join(F.slice(refs, 1, SHOWN_REFS), ", "), more))
    return F.concat_ws(" | ", F.format_string("[%s %s] %s", act, section.cast("string"), F.coalesce(title, F.lit(""))), chapter, formerly)


def split_to_fit(text: Column, room: Column, counter: Counter = word_count) -> Column:
    """array<string>: a text in pieces of at most `room` tokens: whole, else its paragraphs, their sentences, halves of words."""

    def sentence(s: Column) -> Column:
        return F.when(counter(s) <= room, F.array(s)).otherwise(halved(F.split(s, " "), room, None if counter is word_count else counter))

    def paragraph(p: Column) -> Column:
        return F.when(counter(p) <= room, F.array(p)).otherwise(F.flatten(F.transform(clause_sentences(p), sentence)))

    return F.when(counter(text) <= room, F.array(text)).otherwise(F.flatten(F.transform(paragraphs(text), paragraph)))


def pack(units: Column, used: Column, budget: int, prefix: str = "", counter: Counter = word_count) -> Column:
    """Chunks of neighbouring units, greedily: a new one where the next unit differs in force or kind or does not fit."""

    def step(out: Column, u: Column) -> Column:
        last = F.try_element_at(out, F.lit(-1))
        words = counter(u["text"])
        joins = F.coalesce((last["in_force"] == u["in_force"]) & (last["kind"] == u["kind"]) & (last["tokens"] + words <= budget), F.lit(False))
        grown = F.struct(
            F.concat(last["body"], F.lit("\n"), u["text"]).alias("body"), F.concat(last["subs"], u["subs"]).alias("subs"), last["in_force"].alias("in_force"),
            last["kind"].alias("kind"), (last["tokens"] + words).alias("tokens"),
        )
        fresh = F.struct(F.concat(F.lit(prefix), u["text"]).alias("body"), u["subs"].alias("subs"), u["in_force"].alias("in_force"), u["kind"].alias("kind"), (used + words).alias("tokens"))
        return F.when(joins, F.concat(F.slice(out, 1, F.size(out) - 1), F.array(grown))).otherwise(F.concat(out, F.array(fresh)))

    return F.aggregate(units, F.array().cast(_CHUNK), step)


def plan(sections: DataFrame, key: str, budget: int = 350, refs: DataFrame | None = None, counter: Counter = word_count) -> DataFrame:
    """Chunks of sections(key, act, section, title, chapter_no, chapter_title, text, page_start[, subsections]).

    One chunk if all of it is equally in force and fits; else whole sub-sections packed in order, one too long being split at
    its clauses, paragraphs, sentences and at last words; illustrations last, in chunks of their own. `over_budget` marks what
    could not be split, `clause_split` sections where a clause was cut below its paragraphs. Sections with a NULL or blank text
    have no chunks. refs (act, section, refs) adds old references to the header. counter is any
    expression of a text that counts its tokens, words by default.
    """
    rows = sections
    if refs is None:
        rows = rows.withColumn("_refs", F.array().cast("array<string>"))
    else:
        rows = rows.join(refs.select(F.col("act").alias("_a"), F.col("section").alias("_s"), F.col("refs").alias("_refs")), (F.col("act") == F.col("_a")) & (F.col("section") == F.col("_s")), "left")
        rows = rows.withColumn("_refs", F.coalesce("_refs", F.array().cast("array<string>")))
    given = F.transform("subsections", lambda s: F.struct(s["number"].alias("number"), normalise_text(s["text"]).alias("text"), F.coalesce(s["in_force"], F.lit(True)).alias("in_force")))
    cut = F.transform(subsections(normalise_text(F.col("text"))), lambda s: F.struct(s["number"].alias("number"), s["text"].alias("text"), F.lit(True).alias("in_force")))
    subs = F.when(F.size("subsections") > 0, given).otherwise(cut) if "subsections" in sections.columns else cut
    head = header(F.col("act"), F.col("section"), F.col("title"), F.col("chapter_no"), F.col("chapter_title"), F.col("_refs"))
    rows = rows.select(F.col(key).alias("key"), "act", "section", "page_start", F.col("_refs").alias("old_refs"), head.alias("header"), subs.alias("subs"))
    parts = F.transform("subs", lambda s: F.struct(s["number"].alias("number"), s["in_force"].alias("in_force"), blocks(s["text"]).alias("blocks")))
    rows = rows.withColumn("parts", parts).withColumn("used", counter(F.col("header")))

    def label(number: Column) -> Column:
        return F.filter(F.array(number), lambda n: n.isNotNull())

    def main(p: Column) -> Column:
        kept = F.filter(p["blocks"], lambda b: b["kind"] != "illustration")
        return F.struct(p["number"].alias("number"), p["in_force"].alias("in_force"), kept.alias("blocks"), F.array_join(F.transform(kept, lambda b: b["text"]), "\n").alias("text"))

    rows = rows.withColumn("mains", F.filter(F.transform("parts", main), lambda m: m["text"].rlike(r"(?U)\S")))
    room = F.lit(budget) - F.col("used")

    def units(m: Column) -> Column:
        whole = F.struct(m["text"].alias("text"), label(m["number"]).alias("subs"), m["in_force"].alias("in_force"), F.lit("subsections").alias("kind"))
        split = F.flatten(F.transform(m["blocks"], lambda b: F.transform(split_to_fit(b["text"], room, counter), lambda t: F.struct(t.alias("text"), label(m["number"]).alias("subs"), m["in_force"].alias("in_force"), F.lit("clauses").alias("kind")))))
        return F.when(counter(m["text"]) <= room, F.array(whole)).otherwise(split)

    all_main = F.array_join(F.transform("mains", lambda m: m["text"]), "\n")
    one_force = F.size(F.array_distinct(F.transform("mains", lambda m: m["in_force"]))) <= 1
    single = F.array(F.struct(
        all_main.alias("body"), F.flatten(F.transform("mains", lambda m: label(m["number"]))).alias("subs"), F.col("mains")[0]["in_force"].alias("in_force"),
        F.lit("section").alias("kind"), (F.col("used") + counter(all_main)).alias("tokens"),
    ))
    packed = pack(F.flatten(F.transform("mains", units)).cast(_UNIT), F.col("used"), budget, counter=counter)
    body = F.when(F.size("mains") == 0, F.array().cast(_CHUNK)).when(one_force & (counter(all_main) <= room), single.cast(_CHUNK)).otherwise(packed)

    def items(p: Column) -> Column:
        shown = F.filter(p["blocks"], lambda b: b["kind"] == "illustration")
        pieces = F.flatten(F.transform(F.flatten(F.transform(shown, lambda b: illustrations(b["text"]))), lambda t: split_to_fit(t, room - 1, counter)))
        return F.transform(pieces, lambda t: F.struct(t.alias("text"), label(p["number"]).alias("subs"), p["in_force"].alias("in_force"), F.lit("illustration").alias("kind")))

    extra = pack(F.flatten(F.transform("parts", items)).cast(_UNIT), F.col("used") + 1, budget, "Illustrations\n", counter)
    cut_clause = F.exists("mains", lambda m: (counter(m["text"]) > room) & F.exists(m["blocks"], lambda b: (b["kind"] == "clause") & F.exists(paragraphs(b["text"]), lambda p: counter(p) > room)))
    rows = rows.withColumn("chunks", F.concat(body, extra)).withColumn("clause_split", ~(one_force & (counter(all_main) <= room)) & cut_clause)
    out = rows.select("key", "act", "section", "page_start", "old_refs", "header", "clause_split", F.posexplode_outer("chunks").alias("k", "c")).where("c IS NOT NULL")  # outer: else the plan repeats the array in a filter
    return out.select(
        "key", F.format_string("%s-%s-c%d", "act", F.col("section").cast("string"), F.col("k") + 1).alias("chunk_id"), "act", "section", F.array_distinct("c.subs").alias("subsections"),
        F.col("c.kind").alias("chunk_type"), "old_refs", F.col("c.in_force").alias("in_force"), F.col("c.tokens").alias("tokens"), F.col("page_start").alias("page"), "header",
        F.concat("header", F.lit("\n"), "c.body").alias("text"), (F.col("c.tokens") > budget).alias("over_budget"), "clause_split",
    )


def pack_groups(counts: Column, budget: int) -> Column:
    """array<int>: number of the group, from 1, that each count falls into when packed greedily under a budget."""
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("group"), F.array().cast("array<int>").alias("out"))

    def step(s: Column, n: Column) -> Column:
        joins = (s["group"] > 0) & (s["sum"] + n <= budget)
        group = F.when(joins, s["group"]).otherwise(s["group"] + 1)
        return F.struct(F.when(joins, s["sum"] + n).otherwise(n).alias("sum"), group.alias("group"), F.concat(s["out"], F.array(group)).alias("out"))

    return F.aggregate(counts, start, step, lambda s: s["out"])


def stats(chunks: DataFrame, by: str) -> DataFrame:
    """Per group: chunks, sections, most and mean tokens, and the p50 and p95 at index floor(p * n) of the sorted counts.

    Counts of equal token numbers are summed first and the index is found in their running sum, so that no group is gathered.
    """
    from pyspark.sql import Window

    tally = chunks.groupBy(by, "tokens").agg(F.count(F.lit(1)).alias("n"))
    run = tally.withColumn("upto", F.sum("n").over(Window.partitionBy(by).orderBy("tokens").rowsBetween(Window.unboundedPreceding, 0))).withColumn("all", F.sum("n").over(Window.partitionBy(by)))

    def at(p: float) -> Column:
        return F.min(F.when(F.col("upto") > F.least(F.col("all") - 1, F.floor(F.lit(p) * F.col("all"))), F.col("tokens")))

    quantiles = run.groupBy(by).agg(at(0.5).alias("p50"), at(0.95).alias("p95"))
    sums = chunks.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_chunks"), F.countDistinct("key").alias("n_sections"), F.max("tokens").alias("max_tokens"), F.bround(F.avg("tokens"), 1).alias("mean_tokens"),
        F.count_if("over_budget").alias("over_budget"),
    )
    return sums.join(quantiles, by)


def histogram(chunks: DataFrame, width: int = 50) -> DataFrame:
    """(label, n): chunks by token count in bins of `width`."""
    low = (F.floor(F.col("tokens") / width) * width).cast("int")
    return chunks.groupBy(low.alias("low")).agg(F.count(F.lit(1)).alias("n")).select(F.format_string("%d-%d", "low", F.col("low") + width - 1).alias("label"), "n")
