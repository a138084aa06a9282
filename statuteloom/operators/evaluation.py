"""Measures of rankings and answers, resampling, splits, gates and checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statuteloom.functions.text import word_count
from statuteloom.session import small_side


def shared_hash(*parts: Column, seed: int = 42) -> Column:
    """A number in [0, 2^32) from MD5, the same in every engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts])), 1, 8), 16, 10).cast("bigint")


def ranking_metrics(ranking: DataFrame, gold: DataFrame, item: str, k: int = 5, depth: int = 10) -> DataFrame:
    """(query, recall, hit, mrr, ndcg) of each query with gold items: recall and hit within k, the others within depth.

    gold(query, item) holds distinct pairs; queries that found nothing score 0. The ideal gain is that of all gold items first.
    """
    wanted = gold.groupBy("query").agg(F.count(F.lit(1)).alias("n"))
    hits = ranking.where(F.col("rank") <= max(k, depth)).join(gold, ["query", item]).groupBy("query").agg(
        F.count_if(F.col("rank") <= k).alias("found"), F.min("rank").alias("first"), F.sum(F.when(F.col("rank") <= depth, 1.0 / F.log2(F.col("rank") + 1.0))).alias("gain")
    )
    ideal = F.aggregate(F.sequence(F.lit(1), F.least("n", F.lit(depth)).cast("int")), F.lit(0.0), lambda a, r: a + 1.0 / F.log2(r + 1.0))
    out = wanted.join(hits, "query", "left").na.fill(0, ["found"]).na.fill(0.0, ["gain"])
    return out.select(
        "query", F.round(F.col("found") / F.col("n"), 6).alias("recall"), (F.col("found") > 0).cast("int").alias("hit"),
        F.round(F.when(F.col("first") <= depth, 1.0 / F.col("first")).otherwise(0.0), 6).alias("mrr"), F.round(F.col("gain") / ideal, 6).alias("ndcg"),
    )


def averages(metrics: DataFrame, names: Sequence[str] = ("recall", "hit", "mrr", "ndcg")) -> DataFrame:
    """One row: the number of queries and the mean of each measure."""
    return metrics.agg(F.count(F.lit(1)).alias("n"), *[F.round(F.avg(m), 6).alias(m) for m in names])


def bootstrap(values: DataFrame, value: str, key: str, resamples: int = 1000, seed: int = 42) -> DataFrame:
    """One row: n, mean, and the 2.5 and 97.5 percentiles of the mean over Poisson resamples.

    Each row draws, for each resample, how often it counts (a Poisson(1) number from a hash of key and resample), so rows are
    resampled where they lie and only sums per resample are shuffled.
    """
    draw = shared_hash(F.col(key), F.col("resample"), seed=seed) / F.lit(float(2**32))
    # cumulative Poisson(1): 0.367879, 0.735759, 0.919699, 0.981012, 0.996340, 0.999406
    times = sum((draw >= c).cast("int") for c in (0.36787944, 0.73575888, 0.91969860, 0.98101184, 0.99634015, 0.99940582))
    rows = values.where(F.col(value).isNotNull()).select(key, F.col(value).alias("v"))
    drawn = rows.withColumn("resample", F.explode(F.sequence(F.lit(1), F.lit(resamples)))).withColumn("times", times)
    means = drawn.groupBy("resample").agg((F.sum(F.col("v") * F.col("times")) / F.sum("times")).alias("m"))
    bounds = means.agg(F.percentile("m", F.array(F.lit(0.025), F.lit(0.975))).alias("p"))
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean"))
    return total.join(bounds).select("n", F.round("mean", 6).alias("mean"), F.round(F.col("p")[0], 6).alias("low"), F.round(F.col("p")[1], 6).alias("high"))


def paired_difference(a: DataFrame, b: DataFrame, value: str, key: str) -> DataFrame:
    """(key, value): differences of two systems on the queries that both were measured on; bootstrap() gives the interval."""
    return a.select(key, F.col(value).alias("_a")).join(b.select(key, F.col(value).alias("_b")), key).select(key, (F.col("_a") - F.col("_b")).alias(value))


def hash_rank(df: DataFrame, by: Column, key: str, seed: int = 42) -> DataFrame:
    """df with `stratum` and `place`, the place of each row, from 1, in the hashed order of its stratum.

    Strata may hold a third of all rows: rows are numbered within buckets of the hash and the buckets of a stratum are offset
    by their counts, so no stratum is sorted in one task.
    """
    hashed = df.withColumn("stratum", by).withColumn("_h", shared_hash(F.col("stratum"), F.col(key), seed=seed)).withColumn("_b", F.shiftright("_h", 20))
    before = Window.partitionBy("stratum").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = hashed.groupBy("stratum", "_b").agg(F.count(F.lit(1)).alias("_n")).select(F.col("stratum").alias("_s"), F.col("_b").alias("_c"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    numbered = hashed.withColumn("_r", F.row_number().over(Window.partitionBy("stratum", "_b").orderBy("_h", key)))
    ranked = numbered.join(offsets, F.col("stratum").eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_c")))
    return ranked.withColumn("place", F.col("_o") + F.col("_r")).drop("_h", "_b", "_r", "_s", "_c", "_o")


def stratified(df: DataFrame, by: Column, key: str, parts: int, seed: int = 42) -> DataFrame:
    """df with `split`: `test` for the first of every `parts` rows of each stratum in hashed order, else `dev`.

    A stratum of n rows has exactly ceil(n / parts) test rows.
    """
    split = F.when((F.col("place") - 1) % parts == 0, "test").otherwise("dev")
    return hash_rank(df, by, key, seed).withColumn("split", split).drop("place")


def with_refusals(answers: DataFrame, refusals: DataFrame, key: str, share: float = 0.15, seed: int = 42) -> DataFrame:
    """The answers and as many refusals, first in hashed order, as make up `share` of the whole, with `kind`.

    All answers are kept; with too few refusals all of them are. The two have the same columns. Only the number of answers,
    one row, meets the refusals.
    """
    wanted = answers.agg(F.round(F.count(F.lit(1)) * F.lit(share / (1 - share))).cast("bigint").alias("_most"))
    placed = hash_rank(refusals, F.lit("refusal"), key, seed).join(F.broadcast(wanted)).where("place <= _most").drop("stratum", "place", "_most")
    return answers.withColumn("kind", F.lit("answer")).unionByName(placed.withColumn("kind", F.lit("refusal")))


def hard_negatives(ranking: DataFrame, own: DataFrame, groups: DataFrame, item: str, keys: Sequence[str], first: int = 10, last: int = 50) -> DataFrame:
    """(query, item, rank): of the items ranked first to last, the best one that is not of the query's own group.

    own(query, keys) and groups(item, keys) name the groups; a query without such an item has no row.
    """
    mine = own.select("query", F.struct(*keys).alias("_own"))
    theirs = groups.select(item, F.struct(*keys).alias("_group"))
    others = ranking.where(F.col("rank").between(first, last)).join(mine, "query").join(theirs, item).where("NOT (_own <=> _group)")
    return others.groupBy("query").agg(F.min_by(item, "rank").alias(item), F.min("rank").alias("rank"))


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """The n rows of least hash, in key order: the same rows on any engine and partitioning."""
    return df.withColumn("_h", shared_hash(F.col(key), seed=seed)).orderBy("_h", key).limit(n).drop("_h").orderBy(key)


def gate(now: DataFrame, baseline: DataFrame, names: Sequence[str], drop: float = 0.03) -> DataFrame:
    """(measure, now, baseline, passed): a measure fails if it falls more than `drop` below its baseline. One-row inputs."""
    long = lambda df, name: df.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[F.col(n).cast("double") for n in names])))).toDF("measure", name)
    return long(now, "now").join(long(baseline, "baseline"), "measure").withColumn("passed", F.col("now") >= F.col("baseline") - drop)


def rates(df: DataFrame, refused: Column, answerable: Column, by: Sequence[str] = ()) -> DataFrame:
    """(by, n, refusal_recall, false_refusals) of answers: shares of the unanswerable refused and of the answerable refused."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.try_divide(F.count_if(refused & ~answerable).cast("double"), F.count_if(~answerable)), 6).alias("refusal_recall"),
        F.round(F.try_divide(F.count_if(refused & answerable).cast("double"), F.count_if(answerable)), 6).alias("false_refusals"),
    )


def latency(df: DataFrame, ms: str, order: str, warm_up: int = 3) -> DataFrame:
    """(n, p50, p95) with interpolation, the first `warm_up` rows left out."""
    cold = df.orderBy(order).limit(warm_up).select(order)
    return df.join(F.broadcast(cold), order, "left_anti").agg(F.count(F.lit(1)).alias("n"), F.percentile(ms, F.lit(0.5)).alias("p50"), F.percentile(ms, F.lit(0.95)).alias("p95"))


#: A citation: an act and a number of one to three digits, perhaps in brackets, with its groups.
CITATION = r"\b(BNSS|BNS|BSA)\s+([0-9]{1,3})((?:\([0-9a-z]+\))*)"


def citations(text: Column) -> Column:
    """array<struct<act, section, ref>> of the citations in a text, in order."""
    found = F.regexp_extract_all(text, F.lit(CITATION), F.lit(0))
    return F.transform(found, lambda c: F.struct(F.regexp_extract(c, CITATION, 1).alias("act"), F.regexp_extract(c, CITATION, 2).cast("int").alias("section"), c.alias("ref")))


def cited_sentences(text: Column) -> Column:
    """Share of a text's sentences that hold a citation; NULL for a blank text."""
    parts = F.filter(F.split(text, r"(?<=[.?!])\s+"), lambda s: s.rlike(r"\S"))
    return F.try_divide(F.size(F.filter(parts, lambda s: s.rlike(CITATION))).cast("double"), F.size(parts))


def check_citations(answers: DataFrame, corpus: DataFrame, answer: str = "doc_id", text: str = "text") -> DataFrame:
    """(answer, n, known, unknown): distinct sections cited by each answer that the corpus (act, section) has or lacks.

    Citations become rows, are made distinct and joined to the distinct sections of the corpus; a hot citation is one key
    of a join whose right side has one row for it.
    """
    cited = answers.select(F.col(answer), F.explode_outer(citations(F.col(text))).alias("c")).where("c IS NOT NULL").select(answer, "c.act", "c.section").distinct()
    have = corpus.select("act", "section", F.lit(1).alias("_in")).distinct()
    return cited.join(have, ["act", "section"], "left").groupBy(answer).agg(F.count(F.lit(1)).alias("n"), F.count("_in").alias("known"), F.count_if(F.col("_in").isNull()).alias("unknown"))


def check_answers(answers: DataFrame, corpus: DataFrame, context: DataFrame, refusal: str, answer: str = "doc_id", text: str = "text", least: float = 0.8) -> DataFrame:
    """(answer, refused, n, unknown, outside, share, compliant) of every answer, whose key is unique.

    n distinct cited sections, of which the corpus (act, section) lacks `unknown` and the answer's context (answer, act,
    section) `outside`; share of the sentences that hold a citation (NULL without text). An answer complies if it is the
    refusal, or cites something, nothing unknown or outside, in at least `least` of its sentences.
    The sections of the corpus are broadcast if they are few; the context meets the citations by the answer's key.
    """
    cited = F.array_distinct(F.transform(citations(F.col(text)), lambda c: F.struct(c["act"].alias("act"), c["section"].alias("section"))))
    rows = answers.select(F.col(answer), F.coalesce(F.trim(text) == refusal, F.lit(False)).alias("refused"), F.round(cited_sentences(F.col(text)), 6).alias("share"), F.explode_outer(cited).alias("c"))
    rows = rows.select(answer, "refused", "share", "c.act", "c.section")
    have = small_side(corpus.select("act", "section").distinct().withColumn("_in", F.lit(1)))
    given = context.select(answer, "act", "section").distinct().withColumn("_given", F.lit(1))
    named = F.col("act").isNotNull()
    out = rows.join(have, ["act", "section"], "left").join(given, [answer, "act", "section"], "left").groupBy(answer).agg(
        F.max("refused").alias("refused"), F.count_if(named).alias("n"), F.count_if(named & F.col("_in").isNull()).alias("unknown"),
        F.count_if(named & F.col("_given").isNull()).alias("outside"), F.max("share").alias("share"),
    )
    meets = (F.col("n") > 0) & (F.col("unknown") == 0) & (F.col("outside") == 0) & (F.coalesce("share", F.lit(0.0)) >= least)
    return out.withColumn("compliant", F.col("refused") | meets)


def out_of_range(text: Column, totals: Mapping[str, int]) -> Column:
    """array<string>: the citations, in order and once each, whose number their act, with that many sections, cannot have."""
    most = F.create_map(*[F.lit(v) for pair in totals.items() for v in pair])
    wrong = F.filter(citations(text), lambda c: (c["section"] < 1) | (c["section"] > F.try_element_at(most, c["act"])))
    return F.array_distinct(F.transform(wrong, lambda c: c["ref"]))


#: Words that name the old law in a question.
OLD_LAW = r"(?i)\b(?:IPC|CrPC|Indian Penal Code|Code of Criminal Procedure|Evidence Act)\b"


def ranking_features(queries: DataFrame, ranking: DataFrame, groups: DataFrame, item: str, text: str = "text") -> DataFrame:
    """(query, best, margin, mean_best, per_word, acts, words, old_law) of every query(query, text), from a ranking by scores.

    best score, its lead over the second, the mean of the first five, the best one per word of the question, the number of
    acts among the first five (groups(item, act)), words of the question, and whether it names the old law. A query that
    found nothing has zeros.
    """
    top = ranking.where("rank <= 5").join(groups.select(item, "act"), item).groupBy("query").agg(
        F.max(F.when(F.col("rank") == 1, F.col("score"))).alias("best"), F.max(F.when(F.col("rank") == 2, F.col("score"))).alias("_next"),
        F.avg("score").alias("mean_best"), F.countDistinct("act").alias("acts"),
    )
    asked = queries.select("query", word_count(F.coalesce(text, F.lit(""))).alias("words"), F.coalesce(F.col(text).rlike(OLD_LAW), F.lit(False)).alias("old_law"))
    rows = asked.join(top, "query", "left").na.fill(0, ["acts"]).na.fill(0.0, ["best", "_next", "mean_best"])
    per_word = F.coalesce(F.try_divide("best", F.col("words")), F.lit(0.0))
    return rows.select(
        "query", "best", F.round(F.col("best") - F.col("_next"), 4).alias("margin"), F.round("mean_best", 4).alias("mean_best"), F.round(per_word, 4).alias("per_word"), "acts", "words", "old_law"
    )


def answerability(features: DataFrame, names: Sequence[str], label: str, key: str, train: Column, weight: str | None = None) -> DataFrame:
    """(key, label, probability): logistic regression on scaled features, fitted on the training rows, given for all rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    model = Pipeline(stages=[
        VectorAssembler(inputCols=list(names), outputCol="_raw", handleInvalid="keep"), StandardScaler(inputCol="_raw", outputCol="_x", withMean=True),
        LogisticRegression(featuresCol="_x", labelCol=label, maxIter=50, regParam=0.01, probabilityCol="_p", **({"weightCol": weight} if weight else {})),
    ])
    full = features.na.fill(0.0, list(names))
    return model.fit(full.where(train)).transform(full).select(key, label, vector_to_array("_p")[1].alias("probability"))


def threshold(scored: DataFrame, label: str, most_false: float = 0.05, bins: int = 1000) -> DataFrame:
    """One row: the highest refusal threshold at which no more than `most_false` of the answerable rows are refused.

    Rows are counted in bins of probability first, so the search runs over at most `bins` rows.
    """
    tally = scored.groupBy(F.floor(F.col("probability") * bins).alias("bin")).agg(F.count_if(F.col(label) == 1).alias("good"))
    w = Window.partitionBy(F.lit(0))
    below = tally.withColumn("below", F.sum("good").over(w.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))).withColumn("all", F.sum("good").over(w))
    return below.where(F.coalesce(F.col("below"), F.lit(0)) <= F.lit(most_false) * F.col("all")).agg((F.max("bin") / bins).alias("threshold"))


def dangling(rows: DataFrame, corpus: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose keys the corpus lacks (NULL keys lack nothing): what a validator of questions or references reports."""
    whole = F.lit(True)
    for c in on:
        whole = whole & F.col(c).isNotNull()
    return rows.where(whole).join(corpus.select(*on).distinct(), list(on), "left_anti")


def fingerprint(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(n, digest): number of rows and a digest of their contents that does not depend on order or partitioning.

    The digest is made of sums of parts of one SHA-256 a row, so repeated rows count each time.
    """
    text = F.concat_ws("\u001f", *[F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in columns])
    digest = F.sha2(text, 256)
    # four numbers of 30 bits: their sums stay exact for 2^33 rows
    parts = [F.sum(F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("bigint") % (1 << 30)).alias(f"_{k}") for k in range(4)]
    sums = df.agg(F.count(F.lit(1)).alias("n"), *parts)
    return sums.select("n", F.concat(*[F.lpad(F.lower(F.hex(F.coalesce(f"_{k}", F.lit(0)) % (1 << 32))), 8, "0") for k in range(4)]).alias("digest"))


def ablations(results: DataFrame, config: str = "config", measures: Sequence[str] = ("recall", "mrr", "ndcg")) -> DataFrame:
    """One row a configuration and one column a split and measure, from rows (config, split, measures...)."""
    return results.groupBy(config).pivot("split", ["dev", "test"]).agg(*[F.round(F.max(m), 4).alias(m) for m in measures])
