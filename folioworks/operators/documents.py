"""Documents from resolved URLs, and their page tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from folioworks.config import METADATA_FIELDS

# ---- fixed values -------------------------------------------------------------------------------------------
_PAGE_QUERY = "?page="
_DOWNLOAD_HEAD = "search/zoomify/"
_DOWNLOAD_TAIL = "/ImageProperties.xml"
_FILE_NAME = "page_%03d_%s"
_FILE_NAME_LENGTH = 64


def assemble_documents(urls: DataFrame, resolved: DataFrame) -> DataFrame:
    """Every URL with its document, or with the ``reason`` it has none; one pass, nothing dropped.

    ``urls`` comes from ``document_ids``, ``resolved`` holds one row per document id. ``reason`` is NULL for an
    accepted document, else the first failing stage. ``doc_key`` is the input position: copies of a URL stay apart.
    """
    # URLs without an id get a key of their own: they match nothing and do not pile up in one partition.
    spread = F.coalesce("document_id", F.concat(F.lit("\u0000"), F.col("pos").cast("string")))
    right = resolved.withColumnRenamed("document_id", "_id")
    joined = urls.withColumn("_key", spread).join(right, F.col("_key") == F.col("_id"), "left")
    reason = (
        F.when(F.col("library_name").isNull(), "unsupported_library")
        .when(F.col("document_id").isNull(), "no_identifier")
        .when(F.col("failure_class").isNotNull(), F.col("failure_class"))
        .when(F.col("pages_source").isNull(), "no_pages")
    )
    return joined.select(
        F.col("pos").alias("doc_key"),
        F.col("url").alias("source_url"),
        "library_pos",
        "library_name",
        "page_detail_url",
        "document_id",
        "pages_source",
        "page_count",
        *METADATA_FIELDS,
        reason.alias("reason"),
    )


def accepted(labelled: DataFrame) -> DataFrame:
    """Documents of ``assemble_documents``."""
    return labelled.filter(F.col("reason").isNull()).drop("reason")


def preprocess_failures(labelled: DataFrame) -> DataFrame:
    """Rejects of ``assemble_documents`` as ``pos, url, library_name, reason``."""
    return labelled.filter(F.col("reason").isNotNull()).select(
        F.col("doc_key").alias("pos"), F.col("source_url").alias("url"), "library_name", "reason"
    )


def page_file_name(page_index: Column, page_id: Column) -> Column:
    """File name of a page image, without extension."""
    return F.substring(F.format_string(_FILE_NAME, page_index, page_id), 1, _FILE_NAME_LENGTH)


def page_table(documents: DataFrame) -> DataFrame:
    """One row per page from documents with ``page_ids`` and, where planned, ``output_dir`` and ``subfolder``.

    ``page_index`` counts from 1 in list order and comes with the explode: no window, no shuffle.
    """
    present = set(documents.columns)
    # The outer form keeps Catalyst from testing the size of the list, and so building it, a second time.
    exploded = documents.select(
        *(c for c in documents.columns if c != "page_ids"), F.posexplode_outer("page_ids").alias("_pos", "page_id")
    )
    rows = exploded.filter(F.col("_pos").isNotNull()).withColumn("page_index", F.col("_pos") + 1)
    name = page_file_name(F.col("page_index"), F.col("page_id"))
    columns = [
        F.col("doc_key"),
        F.col("document_id"),
        F.col("page_index"),
        F.col("page_id"),
        F.concat("source_url", F.lit(_PAGE_QUERY), "page_id").alias("page_url"),
        F.concat("page_detail_url", F.lit(_DOWNLOAD_HEAD), "page_id", F.lit(_DOWNLOAD_TAIL)).alias("download_url"),
        name.alias("file_name"),
    ]
    if "output_dir" in present:
        folder = F.nullif(F.col("subfolder"), F.lit("")) if "subfolder" in present else F.lit(None).cast("string")
        columns.append(F.concat_ws("/", "output_dir", folder, name).alias("output_base"))
    carried = [c for c in ("library_name", "args", "allow_insecure") if c in present]
    return rows.select(*columns, *carried)
