"""Mixing of sources to target weights by repetition rates.

Tokens are summed per source (partial sums first, so a source that holds a third of all rows costs no more than
another), a rate per source follows from the few sums, and every document is emitted floor(rate) times plus once
more with the remaining probability, drawn from a hash of its id. No row is moved for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from statuteloom.session import small_side


def _sources() -> WindowSpec:
    """One window over the handful of sources, never over documents."""
    return Window.partitionBy(F.lit(0))



def usable(df: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """Documents with a source and a text that is not blank; the others take no part."""
    return df.where(F.col(source).isNotNull() & F.col(text).rlike(r"(?U)\S"))


def rates(sized: DataFrame, targets: DataFrame, source: str = "source", size: str = "tokens", total: float | None = None) -> DataFrame:
    """(source, target_share, max_repeats, docs, tokens, rate): how often each document of a source is to be used.

    Shares are taken over the sources that have tokens and a positive target. Without `total`, the mix is made as large
    as it can be with every such source exactly at its share: the first source to reach its max_repeats sets the size.
    With a larger `total`, sources at their cap stay there and the others fill up in proportion to their targets, round by
    round, until no further one is capped. Sources without a target, with a NULL one, or without tokens get rate 0.
    """
    sums = sized.groupBy(source).agg(F.count(F.lit(1)).alias("docs"), F.sum(size).cast("bigint").alias("tokens"))
    goal = targets.select(source, F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.coalesce("max_repeats", F.lit(0)).alias("max_repeats"))
    joined = goal.join(sums, source, "left").na.fill({"docs": 0, "tokens": 0})
    live = (F.col("tokens") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)
    most = F.col("max_repeats") * F.col("tokens")
    # level: tokens per unit of share; a source is at its cap once the level passes its reach
    joined = joined.withColumn("_share", F.when(live, F.col("target_share")).otherwise(0.0)).withColumn("_reach", F.when(live, most / F.col("target_share")))
    if total is None:
        level = F.min("_reach").over(_sources())
    else:
        before = _sources().orderBy(F.col("_reach").asc_nulls_last(), source).rowsBetween(Window.unboundedPreceding, -1)
        spent = F.coalesce(F.sum(F.when(live, most)).over(before), F.lit(0))
        share_left = F.sum("_share").over(_sources()) - F.coalesce(F.sum("_share").over(before), F.lit(0.0))
        joined = joined.withColumn("_level", F.try_divide(F.lit(float(total)) - spent, share_left))
        # of the levels at which a source and all of longer reach are open, the first that is no higher than that reach
        level = F.min_by(F.when(F.col("_level") <= F.col("_reach"), F.col("_level")), F.when(F.col("_level") <= F.col("_reach"), F.col("_reach"))).over(_sources())
        level = F.coalesce(level, F.max("_reach").over(_sources()))
    rate = F.least(F.col("max_repeats").cast("double"), level * F.col("target_share") / F.col("tokens"))
    return joined.withColumn("rate", F.when(live, rate).otherwise(0.0)).select(source, "target_share", "max_repeats", "docs", "tokens", "rate")


def draw(id_col: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone, the same in any engine with MD5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), id_col.cast("string"))), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def copies(rate: Column, id_col: Column, seed: int) -> Column:
    whole = F.floor(rate)
    return (whole + F.when(draw(id_col, seed) < rate - whole, 1).otherwise(0)).cast("int")


def mix(sized: DataFrame, rated: DataFrame, id_col: str = "doc_id", source: str = "source", seed: int = 17) -> DataFrame:
    """(id, source, tokens, copy): one row per use of a document, copy counted from 1.

    The rates are one row per source of the target table, broadcast once their number has been checked, so that a source
    that holds a third of all documents is spread over the tasks of the scan like any other.
    """
    few = small_side(rated.where("rate > 0").select(source, "rate", "max_repeats"))
    times = F.least(copies(F.col("rate"), F.col(id_col), seed), F.col("max_repeats"))
    return sized.join(few, source).withColumn("_times", times).where("_times > 0").select(id_col, source, "tokens", F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("copy"))


def report(mixed: DataFrame, rated: DataFrame, source: str = "source") -> DataFrame:
    """(source, target_share, max_repeats, tokens, rate, used_docs, used_tokens, actual_share) of every target source."""
    used = mixed.groupBy(source).agg(F.count(F.lit(1)).alias("used_docs"), F.sum("tokens").alias("used_tokens"))
    out = rated.join(used, source, "left").na.fill({"used_docs": 0, "used_tokens": 0})
    share = F.try_divide(F.col("used_tokens").cast("double"), F.sum("used_tokens").over(_sources()))
    return out.select(source, "target_share", "max_repeats", "tokens", "rate", "used_docs", "used_tokens", share.alias("actual_share"))
