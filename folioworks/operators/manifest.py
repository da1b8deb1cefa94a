"""Per-document page lists and the document manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def page_lists(documents: DataFrame) -> DataFrame:
    """``doc_key, page_ids, page_count`` per document; an empty list for a document without pages.

    The list is the one its source delivered in one bounded answer, so it is never gathered from page rows.
    """
    ids = F.coalesce("page_ids", F.array().cast("array<string>"))
    return documents.select("doc_key", ids.alias("page_ids"), F.size(ids).cast("bigint").alias("page_count"))


def manifest_rows(documents: DataFrame, tool_path: str, written_at: str) -> DataFrame:
    """One row per document with the 13 recorded properties.

    ``documents`` carries ``page_ids`` and the effective options. Recorded arguments are the configured ones,
    without the switch that is added for a download. ``written_at`` is ``yyyy-MM-dd HH:mm:ss``.
    """
    return documents.select(
        "library_name",
        "doc_key",
        "source_url",
        F.col("document_id").alias("document_uuid"),
        "title",
        "subtitle",
        "part_title",
        "part_subtitle",
        F.coalesce("page_ids", F.array().cast("array<string>")).alias("pages"),
        F.coalesce(F.size("page_ids"), F.lit(0)).cast("bigint").alias("page_count"),
        F.lit(tool_path).alias("tool_path"),
        F.array_join("args", " ").alias("args"),
        F.col("allow_insecure").cast("string").alias("allow_insecure"),
        F.coalesce("subfolder", F.lit("")).alias("subfolder"),
        F.lit(written_at).alias("written_at"),
    )


def with_text(rows: DataFrame) -> DataFrame:
    """Add ``text``, the text form of the properties in ``manifest_rows``."""

    def line(label: str, column: str):
        return F.concat(F.lit(label + ": "), F.col(column).cast("string"), F.lit("\n"))

    page_lines = F.array_join(F.transform("pages", lambda page: F.concat(F.lit("    "), page, F.lit("\n"))), "")
    # Labels and order are fixed values of the properties file.
    text = F.concat(
        line("Source URL", "source_url"),
        line("Document_uuid", "document_uuid"),
        line("Title", "title"),
        line("Subtitle", "subtitle"),
        line("Part title", "part_title"),
        line("Part subtitle", "part_subtitle"),
        F.lit("pages:\n"),
        page_lines,
        line("Page count", "page_count"),
        line("Dezoomify-rs path", "tool_path"),
        line("Dezoomify-rs args", "args"),
        line("Allow insecure", "allow_insecure"),
        line("Images subfolder", "subfolder"),
        line("Date", "written_at"),
    )
    return rows.withColumn("text", text)


def document_manifest(documents: DataFrame, tool_path: str, written_at: str) -> DataFrame:
    """One row per document with the 13 recorded properties and their text form."""
    return with_text(manifest_rows(documents, tool_path, written_at))
