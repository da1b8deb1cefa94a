"""URL list files: one document URL per line, UTF-8."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def read_url_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines of the files as ``(file, pos, line)``; ``pos`` counts from 0 in the order of the given paths, the names of
    the files below one of them, and their lines.

    Spark packs files and pieces of files into tasks as it likes, so a first pass counts the lines of each piece; the
    pieces, few and narrow rows, are put in order and get running offsets. The place within a piece is taken straight
    after the scan, before anything can move rows. A byte-order mark is dropped.
    """
    given = [paths] if isinstance(paths, str) else list(paths)

    def piece(number: int, path: str) -> DataFrame:
        return spark.read.text(path).select(
            F.lit(number).alias("path"), F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))

    lines = reduce(DataFrame.unionByName, (piece(n, path) for n, path in enumerate(given)))
    lines = lines.withColumn("_at", F.monotonically_increasing_id())
    key = ["path", "file", "block"]
    so_far = Window.orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        lines.groupBy(*key).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_lines"))
        .select(*key, "_first", F.coalesce(F.sum("_lines").over(so_far), F.lit(0)).alias("_before"))
    )
    return lines.join(F.broadcast(offsets), key).select(
        "file", (F.col("_before") + F.col("_at") - F.col("_first")).alias("pos"), "line")
