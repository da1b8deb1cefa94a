"""Output folders: their names, and who may have them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from folioworks.functions.text import clean_file_name, clean_path

_NAME_LENGTH = 255


def folder_name(document_id: Column, title: Column) -> Column:
    """Folder name of a document from its id and title."""
    between = F.when((document_id != "") & (title != ""), "_").otherwise("")
    raw = F.concat(F.replace(document_id, F.lit(":"), F.lit("_")), between, title)
    return F.substring(clean_file_name(raw), 1, _NAME_LENGTH)


def document_path(base: Column, document_id: Column, title: Column) -> Column:
    """Folder path below ``base``; the base itself when nothing is left of the name.

    A name never leads out of the base, since cleaning it takes the dots at its end.
    """
    return clean_path(F.concat_ws("/", base, F.nullif(folder_name(document_id, title), F.lit(""))))


def output_dirs(documents: DataFrame, output: str = "output") -> DataFrame:
    """Add ``output_dir``: base, library, cleaned id and title."""
    base = F.concat(F.lit(output + "/"), F.col("library_name"))
    return documents.withColumn(
        "output_dir", document_path(base, F.coalesce("document_id", F.lit("")), F.coalesce("title", F.lit("")))
    )


def dir_conflicts(documents: DataFrame, existing_dirs: DataFrame | None = None) -> DataFrame:
    """Add ``dir_granted``: true for the first document, by ``doc_key``, claiming a folder not there before.

    The claim is a ``min`` per folder, combined before its shuffle, and comes back over the unique ``doc_key``: no
    task ever holds all copies of a document, and no window is needed.
    """
    winners = documents.groupBy("output_dir").agg(F.min("doc_key").alias("doc_key"))
    if existing_dirs is not None:
        winners = winners.join(existing_dirs.select("output_dir").distinct(), "output_dir", "left_anti")
    granted = winners.select("doc_key", F.lit(True).alias("dir_granted"))
    return documents.join(granted, "doc_key", "left").withColumn(
        "dir_granted", F.coalesce("dir_granted", F.lit(False))
    )
