"""Helpers shared by the operators: reading the tables, writing what two steps need, null-safe keys."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import folioworks

from folioworks.session import work_folder
from folioworks.sources.landing import write_table

# A word is a run of anything but the space and the five control characters for white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    What several steps need is computed once, later joins know real sizes, and a lost executor costs no replay.
    """
    return write_table(df, work_folder(df.sparkSession))


def no_null(column: Column, prefix: str = "v") -> Column:
    """A text key that is never null, so that null keys join and group like any other value."""
    return F.coalesce(F.concat(F.lit(prefix), column.cast("string")), F.lit("null"))


def partitions(spark: SparkSession) -> int:
    """How many partitions the session deals shuffles into."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def for_workers(spark: SparkSession) -> SparkSession:
    """Let Python workers on this machine import the package from where the driver did.

    On a cluster the package is installed or passed with ``--py-files``; the path then finds nothing more.
    """
    home = os.path.dirname(os.path.dirname(os.path.abspath(folioworks.__file__)))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*known, home]))
    return spark


def small(df: DataFrame, rows: int = 400_000) -> DataFrame:
    """``df`` marked for broadcasting if it has at most ``rows`` narrow rows; Spark's own choice beyond that.

    For tables already written, so that counting reads no data.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
