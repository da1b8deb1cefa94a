"""Which source supplies the pages and each metadata field of a document."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from folioworks.config import METADATA_FIELDS


def first_answer(sources: Sequence[tuple[str, Column]]) -> tuple[Column, Column]:
    """``(source, failure_class)`` from the kinds (``ok``, ``empty``, ``error``, ``cert``) of sources in their order.

    If the first source answers, that ends the search, also with an empty list. If it failed, the first of the others
    that has pages supplies them. Without pages the failure is ``certificate`` if certificates were all that failed on
    the way, and ``no_pages`` otherwise.
    """
    kinds = F.array(*(kind for _, kind in sources))
    names = F.array(*(F.lit(name) for name, _ in sources))
    at = F.array_position(kinds, "ok").cast("int")
    ended = F.get(kinds, F.lit(0)) == "empty"
    source = F.when(~ended & (at > 0), F.get(names, at - 1))
    certificate = ~ended & F.array_contains(kinds, "cert") & ~F.array_contains(kinds, "error")
    return source, F.when(source.isNull(), F.when(certificate, "certificate").otherwise("no_pages"))


def resolve_pages(documents: DataFrame, explicit: Sequence[str] | None = None) -> DataFrame:
    """Add ``pages_source`` (``explicit``, ``rest``, ``dom``) or ``failure_class`` (``certificate``, ``no_pages``).

    Reads ``rest_status, rest_pages_kind, dom_kind``; a document without landed HTML counts as ``empty`` there.
    An answered but empty REST list ends the search; only a failed REST source lets HTML speak.
    """
    if explicit is not None:
        return documents.withColumn("pages_source", F.lit("explicit")).withColumn(
            "failure_class", F.lit(None).cast("string")
        )
    rest = F.when(F.col("rest_status") == "ok", F.coalesce("rest_pages_kind", F.lit("error"))).otherwise(
        F.coalesce("rest_status", F.lit("error"))
    )
    dom = F.coalesce("dom_kind", F.lit("empty"))
    source, failure = first_answer([("rest", rest), ("dom", dom)])
    return documents.withColumn("pages_source", source).withColumn("failure_class", failure)


def needs_dom() -> Column:
    """True where landed HTML can still matter: REST pages failed, or some REST field is no string."""
    rest_usable = (F.col("rest_status") == "ok") & F.col("rest_pages_kind").isin("ok", "empty")
    invalid = F.lit(False)
    for field in METADATA_FIELDS:
        invalid = invalid | (F.coalesce(F.col(f"{field}_kind"), F.lit("missing")) == "invalid")
    return ~F.coalesce(rest_usable, F.lit(False)) | invalid


def resolve_metadata(documents: DataFrame) -> DataFrame:
    """Replace the REST fields by the final texts, with ``<field>_source`` (``rest`` or ``dom``) beside each.

    Fields are read in order and a source that failed once stays out: from the first invalid REST field on, every
    field comes from HTML. Pages that came from HTML or from an explicit list never used REST, so neither do their
    fields. A missing text stays empty and is not looked up elsewhere.
    """
    from_rest = F.coalesce(F.col("pages_source") == "rest", F.lit(False))
    columns = []
    for field in METADATA_FIELDS:
        from_rest = from_rest & (F.coalesce(F.col(f"{field}_kind"), F.lit("missing")) != "invalid")
        rest_text = F.coalesce(F.col(field), F.lit(""))
        dom_text = F.coalesce(F.col(f"dom_{field}"), F.lit(""))
        columns += [
            F.when(from_rest, rest_text).otherwise(dom_text).alias(field),
            F.when(from_rest, "rest").otherwise("dom").alias(f"{field}_source"),
        ]
    touched = {name for f in METADATA_FIELDS for name in (f, f"{f}_kind", f"dom_{f}")}
    return documents.select(*(c for c in documents.columns if c not in touched), *columns)


def resolved_page_lists(
    documents: DataFrame, lists: Mapping[str, DataFrame], explicit: Sequence[str] | None = None
) -> DataFrame:
    """Add ``page_ids`` (ordered array) from the source each document settled on.

    ``documents`` needs ``document_id`` and ``pages_source``; ``lists`` holds ``document_id, page_ids`` by source. An
    explicit list is one constant for all of them, and needs no source. Each source's lists meet only the documents
    that settled on it.
    """
    if explicit is not None:
        constant = F.array(*(F.lit(page) for page in explicit)) if explicit else F.array()
        return documents.withColumn("page_ids", constant.cast("array<string>"))
    source = F.coalesce("pages_source", F.lit("none"))
    found = documents.filter(~source.isin(*lists)).withColumn("page_ids", F.lit(None).cast("array<string>"))
    for name, pages in lists.items():
        settled = documents.filter(source == name).join(pages, "document_id", "left")
        found = found.unionByName(settled.select(found.columns))
    return found
