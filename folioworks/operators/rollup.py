"""Page outcomes to documents, documents to the run."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Pages of one document that travel together; a longer document is spread over several tasks.
_BLOCK = 4096


def document_outcomes(outcomes: DataFrame, page_counts: DataFrame | None = None) -> DataFrame:
    """``doc_key, page_index, outcome`` to ``doc_key, succeeded, failed, unattempted``.

    A failed page does not stop a document; the first exception does, and counts as failed. Pages after it are
    unattempted, whatever the log says about them. With ``page_counts(doc_key, page_count)`` pages the log does not
    mention count as unattempted too, and documents without attempts appear.

    The first exception of each document is a pre-aggregated minimum. It is sent to the attempts once per block of
    pages, so a document holding most of the attempts is spread over as many tasks as it has blocks.
    """
    is_exception = F.col("outcome") == "exception"
    whole = outcomes.groupBy("doc_key").agg(
        F.count(F.lit(1)).alias("_pages"),
        F.count_if(F.col("outcome") == "ok").alias("_ok"),
        F.count_if(F.col("outcome") == "failed").alias("_failed"),
        F.min(F.when(is_exception, F.col("page_index"))).alias("_stop"),
    )
    block = F.floor((F.col("page_index") - 1) / _BLOCK)
    # Blocks of the log up to the stop; everything later is unattempted without being looked at.
    stops = whole.filter(F.col("_stop").isNotNull()).select("doc_key", "_stop")
    reach = (
        outcomes.select("doc_key", block.alias("_block")).distinct().join(stops, "doc_key")
        .filter(F.col("_block") <= F.floor((F.col("_stop") - 1) / _BLOCK))
    )
    before = (
        outcomes.withColumn("_block", block)
        .join(reach, ["doc_key", "_block"])
        .filter(F.col("page_index") <= F.col("_stop"))
        .groupBy("doc_key")
        .agg(
            F.count_if(F.col("outcome") == "ok").alias("_ok_before"),
            F.count_if(F.col("outcome") != "ok").alias("_failed_before"),
        )
    )
    counted = whole.join(before, "doc_key", "left")
    pages = F.col("_pages")
    if page_counts is not None:
        counted = page_counts.select("doc_key", "page_count").join(counted, "doc_key", "left")
        pages = F.greatest(F.col("page_count"), F.coalesce("_pages", F.lit(0)))
    stopped = F.col("_stop").isNotNull()
    succeeded = F.coalesce(F.when(stopped, F.col("_ok_before")).otherwise(F.col("_ok")), F.lit(0))
    failed = F.coalesce(F.when(stopped, F.col("_failed_before")).otherwise(F.col("_failed")), F.lit(0))
    return counted.select(
        "doc_key",
        succeeded.alias("succeeded"),
        failed.alias("failed"),
        (pages - succeeded - failed).alias("unattempted"),
    )


def library_order(urls: DataFrame) -> DataFrame:
    """``library_name, library_first``: input position at which each library was first seen.

    At most one row per registered library.
    """
    return (
        urls.filter(F.col("library_name").isNotNull())
        .groupBy("library_name")
        .agg(F.min("pos").alias("library_first"))
    )


def failed_documents(
    failures: DataFrame, documents: DataFrame, outcomes: DataFrame, libraries: DataFrame
) -> DataFrame:
    """All failed documents with their place in the report: ``phase, library_first, pos``.

    ``failures`` are the preprocessing rejects, ``documents`` carry ``dir_granted``, ``outcomes`` come from
    ``document_outcomes``. Phase 0 is an unsupported library, 1 any other reject, 2 a document that failed while it
    was processed. Counts are NULL where no page was reached.
    """
    no_count = F.lit(None).cast("bigint")
    columns = ["phase", "library_first", "pos", "url", "reason", "succeeded", "failed", "unattempted"]
    rejected = failures.select(
        F.when(F.col("reason") == "unsupported_library", 0).otherwise(1).alias("phase"),
        F.lit(-1).cast("bigint").alias("library_first"),
        "pos",
        "url",
        "reason",
        no_count.alias("succeeded"),
        no_count.alias("failed"),
        no_count.alias("unattempted"),
    )
    processed = documents.join(outcomes, "doc_key", "left")
    processed = processed.filter(
        ~F.col("dir_granted") | (F.col("failed") > 0) | (F.col("unattempted") > 0)
    ).join(libraries, "library_name")
    granted = F.col("dir_granted")
    failed = processed.select(
        F.lit(2).alias("phase"),
        "library_first",
        F.col("doc_key").alias("pos"),
        F.col("source_url").alias("url"),
        F.when(granted, "pages").otherwise("dir_exists").alias("reason"),
        F.when(granted, F.col("succeeded")).alias("succeeded"),
        F.when(granted, F.col("failed")).alias("failed"),
        F.when(granted, F.col("unattempted")).alias("unattempted"),
    )
    return rejected.select(columns).unionByName(failed.select(columns))


def library_documents(documents: DataFrame, libraries: DataFrame) -> DataFrame:
    """``library_name, library_first, documents``: documents attached per library, also for libraries with none."""
    attached = documents.groupBy("library_name").agg(F.count(F.lit(1)).alias("documents"))
    return libraries.join(attached, "library_name", "left").withColumn(
        "documents", F.coalesce("documents", F.lit(0))
    )


def run_summary(urls: DataFrame, failed: DataFrame) -> DataFrame:
    """One verdict row: ``input_count, failed_count, exit_code``; 1 iff any document failed, 0 on empty input."""
    ones = urls.select(F.lit(1).alias("input"), F.lit(0).alias("failed")).unionByName(
        failed.select(F.lit(0).alias("input"), F.lit(1).alias("failed"))
    )
    return ones.agg(
        F.coalesce(F.sum("input"), F.lit(0)).alias("input_count"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("failed_count"),
    ).withColumn("exit_code", F.when(F.col("failed_count") > 0, 1).otherwise(0))
