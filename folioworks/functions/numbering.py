"""Row numbers inside groups that may be arbitrarily large."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from folioworks.functions.binding import free_names
from folioworks.session import work_folder
from folioworks.sources.landing import write_table


def number_in_groups(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, name: str
) -> DataFrame:
    """Add ``name`` = 1, 2, ... by ``order`` within ``keys`` without sorting a whole group in one task.

    ``bucket`` must rise with ``order`` (an hour for a timestamp, a block for a number). Rows are numbered inside
    (keys, bucket); the start of each bucket comes from a running sum over bucket sizes, which are pre-aggregated
    before their shuffle. A hot group is thereby spread over as many tasks as it has buckets. Null keys and buckets
    are values like others.
    """
    keyed = df.withColumn("_bucket", bucket)
    cell = [*keys, "_bucket"]
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        keyed.groupBy(*cell)
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        .drop("_size")
    )
    inside = Window.partitionBy(*cell).orderBy(*order)
    starts = starts.withColumnsRenamed({column: f"_of_{column}" for column in cell})
    same = F.lit(True)
    for column in cell:
        same = same & F.col(column).eqNullSafe(F.col(f"_of_{column}"))
    return (
        keyed.withColumn("_inside", F.row_number().over(inside))
        .join(starts, same)
        .drop(*(f"_of_{column}" for column in cell))
        .withColumn(name, F.col("_inside") + F.col("_start"))
        .drop("_inside", "_start", "_bucket")
    )


def in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: str, place: str) -> DataFrame:
    """``df`` written in ranges of (keys, order), with its range as ``block`` and its place in the sort as ``place``.

    Ranges are cut by a sample of all rows, rows that are equal in everything by their place in the input, so that no
    key, and no value of ``order``, fills more than its share of a range.
    """
    spark = df.sparkSession
    (tie,) = free_names([*df.columns, block, place], "_tie")
    sorting = [*keys, *order, tie]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (
        df.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(tasks, *sorting).sortWithinPartitions(*sorting).drop(tie)
        .withColumn(block, F.spark_partition_id()).withColumn(place, F.monotonically_increasing_id())
    )
    return write_table(dealt, work_folder(spark))


def number_by_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Add ``name`` = 1, 2, ... by ``order`` within ``keys``, whatever share of the rows one key or one value holds.

    Rows are sorted in ranges of (keys, order), written once; a row's number is its distance from the first row of its
    key in the range, plus the rows of the key in the ranges before. These counts are pre-aggregated and there are at
    most as many per key as there are ranges. Null keys are values like others, nulls come first in the order; rows that
    are equal in keys and order are numbered as they come. Helper columns take names that ``df`` does not have.
    """
    block, place, first, rows, start = free_names([*df.columns, name], "_block", "_place", "_first", "_rows", "_start")
    sorted_rows = in_ranges(df, keys, order, block, place)
    cell = [*keys, block]
    of = free_names([*df.columns, name, block, place, first, rows, start], *(f"_of_{column}" for column in cell))
    before = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sorted_rows.groupBy(*cell).agg(F.min(place).alias(first), F.count(F.lit(1)).alias(rows))
        .withColumn(start, F.coalesce(F.sum(rows).over(before), F.lit(0)))
        .select(*(F.col(c).alias(o) for c, o in zip(cell, of, strict=True)), first, start)
    )
    same = F.lit(True)
    for column, other in zip(cell, of, strict=True):
        same = same & F.col(column).eqNullSafe(F.col(other))
    return sorted_rows.join(starts, same).select(
        *df.columns, (F.col(place) - F.col(first) + F.col(start) + 1).alias(name))
