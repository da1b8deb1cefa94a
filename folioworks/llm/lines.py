"""Line dedup: runs of lines that occur earlier in the corpus are deleted.

Documents are sequences of line ids. Suffixes of these sequences are ranked by distributed prefix doubling: the rank at
depth 2h of a place is that of the pair of its rank at depth h and the rank h lines on. Places with one rank at a depth
are an interval of the suffix array whose longest common prefix is at least that depth; a place whose rank is its own
leaves the race, so later rounds only carry what repeats, and the rounds end when nothing does. Neighbouring places whose
intervals begin at neighbouring places are one run, and runs within longer ones are dropped.

Texts are written once, in chunks of the order they were read in, and stay there: only hashes and places are shuffled,
and what is to be deleted comes back to the chunks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from folioworks.functions.binding import computed_once, free_names
from folioworks.llm.common import WORD, no_null, partitions, staged
from folioworks.sources.landing import bucketed_copy

PLACE = ("doc_id", "key", "text_key", "at")
# Rows of a chunk, as a power of two: a chunk is one file at least, and its deletions are one row.
CHUNK_BITS = 10


@dataclass(frozen=True)
class Repeats:
    """Runs of at least ``lines`` lines count, and single lines of at least ``words`` words."""

    lines: int = 2
    words: int = 10


def _ranked(places: DataFrame, name: list[str]) -> DataFrame:
    """``places`` that share their ``name`` with another, with its rank in the order of names and the first place.

    Distinct names are sorted into ranges and numbered in order; a name that very many places share is aggregated
    before it is shuffled and joined back as one row.
    """
    spark = places.sparkSession
    shared = (
        places.groupBy(*name)
        .agg(F.count(F.lit(1)).alias("places"), F.min(F.struct(*PLACE)).alias("first"))
        .filter("places > 1").drop("places")
    )
    ordered = (
        shared.repartitionByRange(partitions(spark), *name).sortWithinPartitions(*name)
        .withColumn("rank", F.monotonically_increasing_id())
    )
    return places.join(staged(ordered), name).drop(*name)


def _later() -> Column:
    return ~F.struct(*PLACE).eqNullSafe(F.col("first"))


def _shared_lines(docs: DataFrame, rule: Repeats, id_column: str, text_column: str) -> DataFrame:
    """The places of lines that occur more than once, with their ranks."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    line = F.transform(
        F.split(text, "\n"),
        lambda x, i: F.struct(
            i.alias("line"),
            F.regexp_replace(x, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "").alias("said"),
        ),
    )
    lines = (
        docs.select(F.col(id_column).alias("doc_id"), no_null(F.col(id_column)).alias("key"),
                    F.xxhash64(text).alias("text_key"), F.filter(line, lambda x: x["said"] != "").alias("lines"))
        .select(
            "doc_id", "key", "text_key",
            F.transform("lines", lambda x: F.struct(
                x["line"].alias("line"),
                F.xxhash64(x["said"]).alias("a"),
                F.xxhash64(F.lit(1), x["said"]).alias("b"),
                (F.regexp_count(x["said"], F.lit(WORD)) >= rule.words).alias("long"),
            )).alias("lines"))
        .dropDuplicates(["key", "text_key"])
        .select("doc_id", "key", "text_key", F.posexplode("lines").alias("at", "x"))
        .select(*PLACE, "x.*")
    )
    return staged(_ranked(staged(lines), ["a", "b"]))


def _pairs(places: DataFrame, step: int) -> DataFrame:
    """The places with their own rank as ``behind`` and that of the place ``step`` lines on, if it is one, as ``ahead``."""
    there = Window.partitionBy("key", "text_key").orderBy("at").rangeBetween(step, step)
    return (
        places.select(*PLACE, F.col("rank").alias("behind"), F.max("rank").over(there).alias("ahead"))
        .filter("ahead IS NOT NULL")
    )


def _runs(places: DataFrame, rule: Repeats) -> DataFrame:
    """(doc_id, key, text_key, at, size, first) of each run that starts earlier too, out of the places of shared lines."""
    place = [*PLACE, F.lit(0).alias("size"), "first"]
    found = places.limit(0).select(place)
    depth = 1
    while not places.isEmpty():
        if depth >= rule.lines:
            found = found.union(places.filter(_later()).select(*PLACE, F.lit(depth), "first"))
        step = depth if depth >= rule.lines else min(depth, rule.lines - depth)
        places = staged(_ranked(staged(_pairs(places, step)), ["behind", "ahead"]))
        depth += step
    # All of this stays with the document: one shuffle.
    document = Window.partitionBy("key", "text_key")
    in_step = document.orderBy("size", "at")
    before = F.lag(F.struct("size", "at", "first")).over(in_step)
    goes_on = F.struct(
        before["size"], before["at"] + 1, before["first"]["key"], before["first"]["text_key"], before["first"]["at"] + 1
    ).eqNullSafe(F.struct("size", "at", "first.key", "first.text_key", "first.at"))
    chained = found.withColumn("new", F.when(goes_on, 0).otherwise(1)).withColumn("run", F.sum("new").over(in_step))
    runs = chained.groupBy("key", "text_key", "run").agg(
        F.first("doc_id").alias("doc_id"), F.min("at").alias("at"),
        (F.max("at") - F.min("at") + F.first("size")).alias("size"), F.min_by("first", "at").alias("first"))
    reached = F.max(F.col("at") + F.col("size")).over(
        document.orderBy("at", F.desc("size"), "run").rowsBetween(Window.unboundedPreceding, -1))
    return (
        runs.withColumn("reached", F.coalesce(reached, F.lit(0))).filter(F.col("at") + F.col("size") > F.col("reached"))
        .select(*PLACE, "size", "first")
    )


def repeated_runs(docs: DataFrame, rule: Repeats = Repeats(), id_column: str = "doc_id",
                  text_column: str = "text") -> DataFrame:
    """The runs of at least ``rule.lines`` lines that start earlier too: doc_id, start, size, first_doc, first_start.

    Starts count lines that are not blank from 0; the run at ``first_start`` of ``first_doc`` is the same, and earlier.
    No run lies within another of its document. Parts whose earliest places do not follow each other, as in a periodic
    text, are runs of their own that overlap. What is earlier, and which lines are equal, is said at :func:`repeated_lines`; rows alike in id and text
    are one document here.
    """
    return _runs(_shared_lines(docs, rule, id_column, text_column), rule).select(
        "doc_id", F.col("at").alias("start"), F.col("size").cast("int").alias("size"),
        F.col("first.doc_id").alias("first_doc"), F.col("first.at").alias("first_start"))


def repeated_lines(docs: DataFrame, rule: Repeats = Repeats(), id_column: str = "doc_id",
                   text_column: str = "text") -> DataFrame:
    """(key, text_key, removed) for every document with lines to delete: their sorted numbers from 0.

    A line is deleted if it lies in a run of at least ``rule.lines`` lines, or is a single line of at least
    ``rule.words`` words, that starts earlier too: in a document of a smaller id or further up in the same one. What
    is earlier is judged on the input, and runs may overlap. Lines are compared without outer white space; blank lines
    are passed over, so they neither count in a run nor break one, and are never deleted. Null ids are the smallest;
    documents of one id are ordered by a hash of their texts, rows alike in both are one document.
    """
    places = _shared_lines(docs, rule, id_column, text_column)
    single = places.filter(_later() & F.col("long")).select("key", "text_key", "line")
    covered = _runs(places, rule).select(
        "key", "text_key", F.explode(F.sequence("at", (F.col("at") + F.col("size") - 1).cast("int"))).alias("at"))
    # Every line of a repeated run is itself repeated, so its number is among the places of the first round.
    numbers = places.select("key", "text_key", "at", "line")
    every = single.union(covered.join(numbers, ["key", "text_key", "at"]).select("key", "text_key", "line"))
    return every.groupBy("key", "text_key").agg(F.array_sort(F.collect_set("line")).alias("removed"))


def without_repeated_lines(docs: DataFrame, rule: Repeats = Repeats(), id_column: str = "doc_id",
                           text_column: str = "text") -> DataFrame:
    """``docs`` with repeated lines deleted from the text, and n_lines, n_removed, n_runs added (replaced, if there).

    Null text stays null and has no lines; empty text has one. ``n_runs`` counts maximal stretches of deleted lines. A
    document that loses all its lines keeps an empty text. An empty table gives no rows.
    """
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed", "n_runs")]
    names = free_names(docs.columns, "chunk_of_copy", "row_of_copy", "key_of_repeats", "text_key_of_repeats",
                       "lines_repeated", "lines_of_text")
    chunk, row, *same = names[:4]
    rows = bucketed_copy(
        docs.select("*", no_null(F.col(id_column)).alias(same[0]),
                    F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias(same[1]),
                    F.monotonically_increasing_id().alias(row))
        .withColumn(chunk, F.shiftright(row, CHUNK_BITS)),
        chunk, partitions(docs.sparkSession), compression="zstd")
    removed = repeated_lines(rows, rule, id_column, text_column).toDF(*same, names[4])
    by_row = F.map_from_entries(F.collect_list(F.struct(row, names[4])))
    told = staged(rows.select(chunk, row, *same).join(removed, same).groupBy(chunk).agg(by_row.alias(names[4])))
    joined = rows.join(told.hint("shuffle_hash"), chunk, "left").select(
        *columns, F.try_element_at(names[4], F.col(row)).alias(names[4]))
    # A projection of its own, so that no text is split once per mention.
    gone, lines = F.col(names[4]), F.col(names[5])
    bounds = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(lines)))
    kept = F.flatten(F.transform(
        F.sequence(F.lit(0), F.size(gone)),
        lambda i: F.slice(lines, F.get(bounds, i) + 2, F.get(bounds, i + 1) - F.get(bounds, i) - 1)))
    runs = F.size(F.filter(gone, lambda x, i: (i == 0) | (F.get(gone, i - 1) != x - 1)))
    added = {
        "n_lines": F.coalesce(F.size(lines), F.lit(0)).cast("bigint"),
        "n_removed": F.coalesce(F.size(gone), F.lit(0)).cast("bigint"),
        "n_runs": F.coalesce(runs, F.lit(0)).cast("bigint"),
        text_column: F.when(gone.isNotNull(), F.array_join(kept, "\n")).otherwise(F.col(text_column)),
    }
    return (
        computed_once(joined, **{names[5]: F.split(F.col(text_column), "\n")})
        .select(*(added[c].alias(c) if c in added else F.col(c) for c in columns),
                *(added[c].alias(c) for c in ("n_lines", "n_removed", "n_runs")))
    )
