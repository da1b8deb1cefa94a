"""Mixing sources to target weights along a curriculum.

Sizes are counted in words. Every source asks for a share of all words by its weight, at most ``max_repeats`` times
what it has; what it cannot use goes to the others by weight. When a word of a source is wanted follows from the
source's schedule, a weight that changes linearly over training: its integral is the demand up to a moment, and the
inverse of that integral is the moment at which the n-th word is due. Documents, in an order drawn from their ids, get
the moments of their first words as positions and are sorted into ranges by them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from folioworks.llm.common import WORD, no_null, staged


@dataclass(frozen=True)
class Mix:
    """Weights and schedules go round the sources in code point order, null last.

    ``schedules`` are the relative weights at the start and at the end of training.
    """

    weights: Sequence[float] = (5, 2, 1)
    schedules: Sequence[tuple[float, float]] = ((0.5, 1.5), (1.0, 1.0), (1.5, 0.5))
    max_repeats: int = 3
    cells: int = 3  # hex digits of the order that name a cell; 16 ** cells cells in each source


def _turn(values: Sequence[float], rank: Column) -> Column:
    """The value whose turn it is at ``rank``."""
    return F.get(F.array(*(F.lit(float(v)) for v in values)), F.pmod(rank, F.lit(len(values))))


def source_targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """One row per source from (source, size): source_size, target, and its schedule.

    Targets are min(cap, level * weight) at the one level where they add up to all words. Caps are met in the order of
    cap / weight, so the level follows from running sums over that order. Only the table of sources, one row each, is
    ordered as a whole.
    """
    sources = sizes.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("source_size"))
    named = Window.orderBy(F.asc_nulls_last("source"))
    rank = F.row_number().over(named) - 1
    every = Window.partitionBy()
    filled = Window.orderBy("_ratio", "_rank").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        sources.withColumn("_rank", rank)
        .withColumn("_weight", _turn(mix.weights, F.col("_rank")))
        .withColumn("_cap", F.col("source_size") * float(mix.max_repeats))
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
        .withColumn("_total", F.sum("source_size").over(every).cast("double"))
        .withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_cap").over(filled), F.lit(0.0)))
                    / (F.sum("_weight").over(every) - F.coalesce(F.sum("_weight").over(filled), F.lit(0.0))))
        .withColumn("_level", F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_rank", "_level")))
                    .over(every)["_level"])
    )
    return ranked.select(
        "source",
        "source_size",
        F.least("_cap", F.col("_level") * F.col("_weight")).alias("target"),
        _turn([start for start, _ in mix.schedules], F.col("_rank")).alias("_start"),
        _turn([end for _, end in mix.schedules], F.col("_rank")).alias("_end"),
    )


def moment(offset: Column, demand: Column, start: Column, end: Column) -> Column:
    """When, from 0 to 1, a source is due its word number ``offset``.

    The share due at t is (start * t + (end - start) * t^2 / 2) over its value at 1; this is its inverse, in the form
    that holds for a level schedule too.
    """
    due = offset / demand * (start + end) / 2
    return 2 * due / (start + F.sqrt(start * start + 2 * (end - start) * due))


def mixed(docs: DataFrame, mix: Mix = Mix(), id_column: str = "doc_id", text_column: str = "text",
          source_column: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, taken, position, positions.

    ``taken`` is in words, repeats counted. Whole passes over a source take each of its documents; the pass that is
    cut short takes documents in their drawn order until the demand is met, the last one in part, so a source's words
    add up to its rounded target. ``positions`` has one moment per copy, ``position`` the first; both are null for a
    document not taken, and rows come in ranges of ``position``. Order within a source is that of the MD5 of the id;
    equal ids follow by size, and rows equal in both are alike. Null text has size 0. Null and repeated ids are rows
    like others, an empty table gives no rows, other columns are not read.

    A source may hold most rows: its running sums are taken per cell of the order and shifted by the sums of the cells
    before, which are aggregated before they are shuffled.
    """
    sized = staged(
        docs.select(
            F.col(id_column).alias("doc_id"),
            F.col(source_column).cast("string").alias("source"),
            F.regexp_count(F.coalesce(F.col(text_column), F.lit("")), F.lit(WORD)).cast("bigint").alias("size"),
            F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit(""))).alias("_order"),
        )
        .withColumn("_source", no_null(F.col("source")))
        .withColumn("_cell", F.substring("_order", 1, mix.cells))
    )
    before = Window.partitionBy("_source").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        sized.groupBy("_source", "_cell")
        .agg(F.sum("size").alias("_words"))
        .withColumn("_cell_start", F.coalesce(F.sum("_words").over(before), F.lit(0)))
        .drop("_words")
    )
    inside = (
        Window.partitionBy("_source", "_cell").orderBy("_order", "size", "doc_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    targets = source_targets(sized, mix).withColumn("_source", no_null(F.col("source"))).drop("source")
    size, demand, source_size = F.col("size"), F.col("_demand"), F.col("source_size")
    rest = F.when(source_size > 0, demand % source_size).otherwise(0)
    passes = F.when(source_size > 0, F.floor(demand / source_size)).otherwise(0)
    positions = F.transform(
        F.sequence(F.lit(0), F.col("_copies") - 1),
        lambda copy: F.round(
            moment(copy * source_size + F.col("_before"), demand, F.col("_start"), F.col("_end")), 9),
    )
    return (
        sized.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(cells, ["_source", "_cell"])
        .join(targets, "_source")
        .withColumn("_before", F.col("_cell_start") + F.col("_inside"))
        .withColumn("_demand", F.round("target").cast("bigint"))
        .withColumn("_cut", F.greatest(F.lit(0), F.least(size, rest - F.col("_before"))))
        .withColumn("taken", (passes * size + F.col("_cut")).cast("bigint"))
        .withColumn("_copies", (passes + (F.col("_cut") > 0).cast("bigint")).cast("int"))
        .withColumn("positions", F.when(F.col("taken") > 0, positions))
        .withColumn("position", F.get("positions", F.lit(0)))
        .orderBy(F.asc_nulls_last("position"), "_order", "size")
        .select("doc_id", "source", "size", "source_size", "target", "taken", "position", "positions")
    )
