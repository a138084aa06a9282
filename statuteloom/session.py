"""Session settings and table access shared by every query."""

from __future__ import annotations

import os
import tempfile
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

__all__ = ["build_session", "keep", "read_table", "short_list", "small_side", "stable_cut"]


def build_session(app: str = "statuteloom", cores: int = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """A local session with the settings the jobs are tuned for; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stable_cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, so that lost executors cost one stage and not the whole job.

    The folder is the cluster's spark.checkpoint.dir; only where that is unset and all of Spark runs on this machine (tests)
    is a temporary one chosen. A cluster without it is an error: a folder of one machine is none that the others can read.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR", "/tmp")))
    return df.checkpoint(eager=True)


def keep(df: DataFrame) -> DataFrame:
    """Keep a result that several branches of one job read; blocks that do not fit go to disk, lost ones are recomputed."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def short_list(df: DataFrame, column: str, most: int = 10_000) -> list[Any]:
    """The distinct values of a column that is known to be short, NULL left out; an error if there are more than `most`."""
    rows = df.where(F.col(column).isNotNull()).select(column).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{column} has more than {most} distinct values")
    return sorted(r[0] for r in rows)


def small_side(df: DataFrame, rows: int = 10_000) -> DataFrame:
    """df ready to be broadcast if it has at most `rows` rows (counted, not estimated), else df as it is for a shuffle join.

    For tables of a few short fields: the rows are read once and come back as a local relation.
    """
    head = df.limit(rows + 1).toArrow()
    return F.broadcast(df.sparkSession.createDataFrame(head, df.schema)) if head.num_rows <= rows else df
