"""URL lists: cleaning, assignment to libraries, document identifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from folioworks.config import DEFAULT_API, DOCUMENT_ID_PATTERN, ApiTemplates, Library
from folioworks.functions.binding import free_names
from folioworks.functions.text import strip, url_path


def url_manifest(lines: DataFrame) -> DataFrame:
    """``(pos, line)`` to ``(pos, url)``: trimmed lines that are neither blank nor comments, duplicates kept."""
    return lines.select("pos", strip(F.col("line")).alias("url")).filter(
        (F.col("url") != "") & ~F.col("url").startswith("#")
    )


def _owner(url: Column, libraries: Sequence[Library]) -> Column:
    """Struct of the first registered prefix the URL starts with, NULL when there is none."""

    def entry(position: int, library: Library, prefix: str) -> Column:
        return F.struct(
            F.lit(position).alias("library_pos"),
            F.lit(library.name).alias("library_name"),
            F.lit(prefix).alias("base_url"),
            F.lit(library.page_detail_url).alias("page_detail_url"),
        )

    registry = F.array(
        *(
            entry(position, library, prefix)
            for position, library in enumerate(libraries)
            for prefix in library.prefixes
        )
    )
    return F.get(F.filter(registry, lambda e: url.startswith(e["base_url"])), F.lit(0))


# Prefixes that a URL is held against one by one.
_FEW_PREFIXES = 200


def _longest(url: Column, prefixes: Sequence[str]) -> Column:
    """The longest of the prefixes that the URL starts with; one lookup in a set per length."""
    lengths = sorted({len(prefix) for prefix in prefixes}, reverse=True)
    found = []
    for length in lengths:
        start = F.substring(url, 1, length)
        found.append(F.when(start.isin([prefix for prefix in prefixes if len(prefix) == length]), start))
    return F.coalesce(*found)


def _winners(libraries: Sequence[Library]) -> dict[str, tuple[int, str, str, str]]:
    """For each prefix the first entry of the registry among those that a URL with this prefix starts with."""
    first: dict[str, tuple[int, tuple[int, str, str, str]]] = {}
    entries = [(position, library, prefix) for position, library in enumerate(libraries) for prefix in library.prefixes]
    for order, (position, library, prefix) in enumerate(entries):
        first.setdefault(prefix, (order, (position, library.name, prefix, library.page_detail_url)))
    lengths = sorted({len(prefix) for prefix in first})
    return {
        prefix: min(first[prefix[:n]] for n in lengths if n <= len(prefix) and prefix[:n] in first)[1] for prefix in first}


def assign_library(urls: DataFrame, libraries: Sequence[Library]) -> DataFrame:
    """Add ``library_pos, library_name, base_url, page_detail_url``; NULL marks an unsupported URL.

    The registry is configuration: a small one becomes an expression of the scan stage. With many prefixes a URL is
    looked up by its longest registered prefix, which settles what else it starts with and so whose it is; that table
    is as large as the registry and is broadcast. Neither shuffles a URL.
    """
    if not any(library.prefixes for library in libraries):
        raise ValueError("the registry holds no prefix")
    if sum(len(library.prefixes) for library in libraries) > _FEW_PREFIXES:
        winners = _winners(libraries)
        (key,) = free_names(urls.columns, "prefix_of_url")
        table = urls.sparkSession.createDataFrame(
            [(prefix, *owner) for prefix, owner in winners.items()],
            f"{key} string, library_pos int, library_name string, base_url string, page_detail_url string")
        keyed = urls.withColumn(key, _longest(F.col("url"), sorted(winners)))
        return keyed.join(F.broadcast(table), key, "left").select(
            *urls.columns, "library_pos", "library_name", "base_url", "page_detail_url")
    return urls.withColumn("_owner", _owner(F.col("url"), libraries)).select(
        *urls.columns,
        "_owner.library_pos",
        "_owner.library_name",
        "_owner.base_url",
        "_owner.page_detail_url",
    )


def document_ids(urls: DataFrame, pattern: str = DOCUMENT_ID_PATTERN, api: ApiTemplates = DEFAULT_API) -> DataFrame:
    """Add ``document_id`` from the URL path (NULL when there is none) and the two request addresses."""
    found = F.regexp_extract(url_path(F.col("url")), pattern, 1)
    return request_urls(urls.withColumn("document_id", F.nullif(found, F.lit(""))), api)


def request_urls(identified: DataFrame, api: ApiTemplates = DEFAULT_API) -> DataFrame:
    """Add the two request addresses of ``document_id``."""

    def request(template: str, identifier: Column) -> Column:
        head, tail = (api.base + template).split("{}")
        return F.concat(F.lit(head), identifier, F.lit(tail))

    identifier = F.col("document_id")
    return identified.select(
        "*",
        request(api.document, F.replace(identifier, F.lit(":"), F.lit("\\:"))).alias("document_request_url"),
        request(api.pages, identifier).alias("pages_request_url"),
    )
