"""Shapes of the landed tables, readers that prune to them, and the result sinks.

Landed responses hold a row per request: ``attempt`` counts the tries for one document, and the last one decides (a
table without it holds one row per document). Attempt logs hold one row per document and page. Bucketing them by their key when they are
written lets the joins of the jobs start without an exchange; ``write_bucketed`` does that.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioworks.session import work_folder

DOCUMENT_RESPONSES = "document_id string, attempt int, status int, error_class string, body string"
PAGE_RESPONSES = DOCUMENT_RESPONSES
HTML_PAGES = "document_id string, attempt int, status int, error_class string, html string"
ATTEMPTS = (
    "doc_key bigint, page_index bigint, tool_found boolean, timed_out boolean, returncode int, stdout string, "
    "stderr string, exception boolean"
)
EXISTING_DIRS = "output_dir string"
ERROR_NODES = "error_id bigint, error_class string"
ERROR_EDGES = "from_id bigint, to_id bigint"


def read_landed(spark: SparkSession, path: str, schema: str, source_format: str = "parquet") -> DataFrame:
    """Read one landed table with a declared schema; nothing is inferred, so nothing is scanned twice."""
    return spark.read.format(source_format).schema(schema).load(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Save a landed table bucketed and sorted by its join key."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def bucketed_copy(df: DataFrame, key: str, buckets: int, **options: str) -> DataFrame:
    """``df`` written to a new folder in buckets by ``key``, and read back: joins by that key move none of it.

    The table's name is only needed to write it and is given up again; the files stay. ``options`` are the writer's.
    """
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    df.write.options(**options).option("path", work_folder(spark)).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    table = spark.table(name)
    table.schema  # resolved to the files while the name stands
    spark.sql(f"DROP TABLE {name}")
    return table


def write_manifest(manifest: DataFrame, path: str, finish: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Write the document manifest, one folder per library.

    Files are staged and the folders of the libraries in ``manifest`` are replaced as a whole when all are written: a
    run that fails leaves what was there, one that is repeated leaves no row twice, and other libraries stay.
    Rebalancing gathers small libraries into few files and splits one that holds most documents over many tasks.
    ``finish`` adds columns that follow from the others behind that exchange, which then carries none of them.
    """
    dealt = manifest.hint("rebalance", "library_name")
    (
        (finish(dealt) if finish else dealt).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("library_name").parquet(path)
    )


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate table and read it back, which also cuts its lineage. Ids are hexadecimal digits for the most
    part, which only a codec that weighs its symbols makes shorter."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
