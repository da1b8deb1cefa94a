"""Landed JSON responses: admission, metadata, ordered page lists.

Bodies are parsed where they are scanned and only the extracted values travel on, so no join ever moves a body. A
column ``LANDED``, by which attempts are told apart, is passed on beside the values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from folioworks.config import DEFAULT_REST, METADATA_FIELDS, RestSearch
from folioworks.functions.binding import computed_once, let
from folioworks.functions.variants import text_at, type_of, variant_path

# Doubles below this magnitude are converted to whole numbers exactly.
_EXACT_LONG = 9.0e18

_NONE, _NUMBER, _TEXT, _UNUSABLE = 0, 1, 2, 3


def request_state(status: Column, error_class: Column) -> Column:
    """``cert``, ``error`` or ``ok`` for one landed request; an error raised before an answer counts first."""
    return (
        F.when(error_class == "cert", "cert")
        .when(error_class.isNotNull() | status.isNull() | (status >= 400), "error")
        .otherwise("ok")
    )


LANDED = "_landed"


def _repeated(responses: DataFrame) -> DataFrame:
    """Ids with several rows, from that narrow column alone."""
    return (
        responses.groupBy("document_id").agg(F.count(F.lit(1)).alias("_rows"))
        .filter("_rows > 1").select(F.col("document_id").alias("_repeated"))
    )


def _last(rows: DataFrame, several: DataFrame, order: Column) -> DataFrame:
    """One row per document, the largest by ``order``; rows of ids that are not repeated pass untouched."""
    same = F.col("document_id").eqNullSafe(F.col("_repeated"))
    columns = [F.col(c) for c in rows.columns if c != "document_id"]
    last = rows.join(several, same, "left_semi").groupBy("document_id").agg(
        F.max_by(F.struct(*columns), order).alias("_last"))
    single = rows.join(several, same, "left_anti")
    return single.unionByName(last.select("document_id", "_last.*"))


def deciding(responses: DataFrame) -> DataFrame:
    """One landed row per document: the last attempt; of rows of one attempt, the largest by status and content. Rows
    without an attempt number come before all others. For whole bodies; :func:`decided_facts` leaves those in place."""
    if "attempt" not in responses.columns:
        return responses
    order = F.struct("attempt", *(c for c in responses.columns if c not in ("document_id", "attempt")))
    return _last(responses, _repeated(responses), order).drop("attempt")


def decided_facts(
    responses: DataFrame, read: Callable[[DataFrame], DataFrame], ids: DataFrame | None = None, few: bool = False
) -> DataFrame:
    """What ``read`` finds in the deciding response of each document, of ``ids`` only if given.

    The last attempt decides; of rows of one attempt the largest by status and error, then by a hash of the content.
    Responses are read where they are scanned and only what was found is moved, so no exchange carries a body. ``few``
    ids, which the caller has measured, are broadcast first, and nothing else is read.
    """
    if ids is not None and few:
        responses = responses.join(F.broadcast(ids), "document_id", "left_semi")
    tried = "attempt" in responses.columns
    several = _repeated(responses) if tried else None
    if tried:
        content = F.xxhash64(*(c for c in responses.columns if c in ("body", "html")))
        responses = responses.withColumn(LANDED, F.struct("attempt", "status", "error_class", content.alias("content")))
    facts = read(responses)
    if ids is not None and not few:
        facts = facts.join(ids, "document_id", "left_semi")
    return _last(facts, several, F.col(LANDED)).drop(LANDED) if tried else facts


# A filter of ids has so many bits for each, and so many at most: 32 MB. They lie in blocks of so many.
_BITS_PER_ID, _MOST_BITS, _BLOCK_BITS = 16, 1 << 28, 1 << 15


def likely_of(responses: DataFrame, ids: DataFrame, count: int) -> DataFrame:
    """Rows of ``responses`` with one of the ``count`` ids, and some others: about every twentieth of the rest as long as the filter is not at its bound.

    Each id sets one bit of a filter by its hash; the filter is broadcast, in a size that does not grow beyond a bound.
    No row with an id is lost, and no row is moved. What else comes through has to be sorted out by a later join.
    """
    bits = min(_MOST_BITS, max(_BLOCK_BITS, 1 << (_BITS_PER_ID * count - 1).bit_length()))
    at = F.pmod(F.xxhash64("document_id"), F.lit(bits))
    block, place = F.floor(at / _BLOCK_BITS).cast("int"), F.pmod(at, F.lit(_BLOCK_BITS))
    # Dealt by block first, so that no task writes more than the bits of its ids.
    blocks = (
        ids.filter(F.col("document_id").isNotNull()).select(block.alias("_block"), place.alias("_place"))
        .repartition("_block").groupBy("_block").agg(F.bitmap_construct_agg(F.col("_place")).alias("_bits"))
    )
    byte = F.conv(F.hex(F.substring("_bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = byte.bitwiseAND(F.element_at(F.array(*(F.lit(1 << n) for n in range(8))), (place % 8 + 1).cast("int"))) != 0
    return responses.filter(F.col("document_id").isNotNull()).join(
        F.broadcast(blocks), (block == F.col("_block")) & is_set, "left_semi")


def rest_metadata(responses: DataFrame, search: RestSearch = DEFAULT_REST) -> DataFrame:
    """Document responses to ``document_id, doc_state, doc_parsed`` and ``<field>_kind, <field>`` per field.

    A kind is ``string``, ``missing`` (absent, JSON null, a broken path) or ``invalid`` (any other type, or a root
    that is no object).
    """
    root = F.col("_root")
    carried = [c for c in (LANDED,) if c in responses.columns]
    parsed = responses.select(
        "document_id",
        *carried,
        request_state(F.col("status"), F.col("error_class")).alias("doc_state"),
        F.try_parse_json("body").alias("_root"),
        F.col("body").rlike(r"^[ \t\r\n]*+\{").alias("_is_object"),
    )
    seen: dict[tuple, str] = {}
    columns = []
    for field in METADATA_FIELDS:
        path = tuple(search.metadata[field])
        kind, text = text_at(root, F.col("_is_object"), path)
        seen.setdefault(path, field)
        columns += [kind.alias(f"{field}_kind"), text.alias(field)] if seen[path] == field else []
    found = parsed.select("document_id", *carried, "doc_state", root.isNotNull().alias("doc_parsed"), *columns)
    return found.select(
        "document_id",
        *carried,
        "doc_state",
        "doc_parsed",
        *(
            F.col(seen[tuple(search.metadata[field])] + suffix).alias(field + suffix)
            for field in METADATA_FIELDS
            for suffix in ("_kind", "")
        ),
    )


def _entries(root: Column, search: RestSearch) -> Column:
    """Array of ``(PID, number)`` variants; NULL when the page list is no array."""
    shape = f"array<struct<`{search.page_id_key}`: variant, `{search.page_number_key}`: variant>>"
    return F.try_variant_get(root, variant_path(search.page_items), shape)


def _number_key(holder: Column, search: RestSearch) -> Column:
    """Sort key of one entry: its group, and a number or a text. A missing number is one key like any other.

    A number is its whole part, exact up to 38 digits, and a fraction between 0 and 1: no two numbers share a key. A
    whole number of more digits cannot be told from its neighbours once it is parsed, so it is unusable.
    """
    at = variant_path((search.page_number_item,))

    def key(leaf_type: Column) -> Column:
        letter = F.substring(F.try_variant_get(holder, "$", "string"), search.page_number_item + 1, 1)
        nothing = F.lit(None)

        def made(group: int | Column, whole: Column = nothing, fraction: Column = nothing, text: Column = nothing) -> Column:
            return F.struct(
                whole.cast("decimal(38,0)").alias("page_number"),
                fraction.cast("double").alias("page_fraction"),
                text.cast("string").alias("page_text"),
                (group if isinstance(group, Column) else F.lit(group)).alias("group"),
            )

        def from_double(number: Column) -> Column:
            whole = F.when(F.abs(number) < _EXACT_LONG, F.floor(number).cast("decimal(38,0)")).otherwise(
                number.try_cast("decimal(38,0)"))
            fraction = F.when(F.abs(number) < _EXACT_LONG, number - F.floor(number)).otherwise(0.0)
            group = F.when(whole.isNull(), _UNUSABLE).otherwise(_NUMBER)
            return made(group, whole, fraction)

        is_whole = (leaf_type == "BIGINT") | leaf_type.rlike(r"^DECIMAL\([0-9]+,0\)$")
        is_number = leaf_type.isin("DOUBLE", "FLOAT", "BOOLEAN") | leaf_type.startswith("DECIMAL")
        return (
            F.when(is_whole, made(_NUMBER, F.try_variant_get(holder, at, "decimal(38,0)"), F.lit(0.0)))
            .when(is_number, let(F.try_variant_get(holder, at, "double"), from_double))
            .when(leaf_type == "STRING", made(_TEXT, text=F.try_variant_get(holder, at, "string")))
            .when(leaf_type == "VOID", made(_NONE))
            .when(leaf_type.isNotNull(), made(_UNUSABLE))
            .when((type_of(holder) == "STRING") & (letter != ""), made(_TEXT, text=letter))
            .otherwise(made(_NONE))
        )

    return let(type_of(F.variant_get(holder, at, "variant")), key)


def _page(entry: Column, pos: Column, search: RestSearch) -> Column:
    """Sort key, place and id of one entry; the id is NULL unless it is a string."""
    identifier = entry[search.page_id_key]
    page_id = F.when(type_of(identifier) == "STRING", F.try_variant_get(identifier, "$", "string"))
    return let(
        _number_key(entry[search.page_number_key], search),
        lambda key: F.struct(
            key["page_number"].alias("page_number"),
            key["page_fraction"].alias("page_fraction"),
            key["page_text"].alias("page_text"),
            pos.alias("pos"),
            page_id.alias("page_id"),
            key["group"].alias("group"),
        ),
    )


def rest_page_lists(responses: DataFrame, search: RestSearch = DEFAULT_REST) -> DataFrame:
    """Page responses to one row per document with its ordered page list; no shuffle.

    Output: ``document_id, page_state, page_parsed, rest_pages_kind, rest_pages, maybe_truncated``. A response is
    one bounded answer of the catalogue, so last-wins and order are settled inside its row: the kind is ``error``
    when the list is no array, an id is no string, or page numbers cannot be put in one order; ``empty`` is not an
    error. The list holds ``(page_number, page_fraction, page_text, page_id)`` with ascending
    keys; a page's number is the sum of the first two.
    """
    carried = [c for c in (LANDED,) if c in responses.columns]
    parsed = responses.select(
        "document_id",
        *carried,
        request_state(F.col("status"), F.col("error_class")).alias("page_state"),
        F.try_parse_json("body").alias("_root"),
    )
    entries = parsed.select(
        "document_id",
        *carried,
        "page_state",
        F.col("_root").isNotNull().alias("page_parsed"),
        _entries(F.col("_root"), search).alias("_entries"),
    )
    ranked = computed_once(
        entries, _ranked=F.sort_array(F.transform("_entries", lambda entry, pos: _page(entry, pos, search)))
    )
    following = F.slice("_ranked", F.lit(2), F.greatest(F.size("_ranked"), F.lit(1)))
    last_of_key = F.zip_with(
        "_ranked",
        following,
        lambda page, after: F.when(
            after.isNull()
            | ~page["page_number"].eqNullSafe(after["page_number"])
            | ~page["page_fraction"].eqNullSafe(after["page_fraction"])
            | ~page["page_text"].eqNullSafe(after["page_text"]),
            F.struct(page["page_number"], page["page_fraction"], page["page_text"], page["page_id"]),
        ),
    )
    groups = F.array_distinct(F.transform("_ranked", lambda page: page["group"]))
    kind = (
        F.when(F.col("_ranked").isNull(), "error")
        .when(F.size("_ranked") == 0, "empty")
        .when(F.exists("_ranked", lambda page: page["page_id"].isNull()), "error")
        .when((F.size(groups) > 1) | F.array_contains(groups, _UNUSABLE), "error")
        .otherwise("ok")
    )
    return ranked.select(
        "document_id",
        *carried,
        "page_state",
        "page_parsed",
        kind.alias("rest_pages_kind"),
        F.filter(last_of_key, lambda page: page.isNotNull()).alias("_pages"),
        (F.size("_ranked") == search.page_limit).alias("maybe_truncated"),
    ).select(
        "document_id",
        *carried,
        "page_state",
        "page_parsed",
        "rest_pages_kind",
        F.when(F.col("rest_pages_kind") == "ok", F.col("_pages")).alias("rest_pages"),
        F.coalesce("maybe_truncated", F.lit(False)).alias("maybe_truncated"),
    )


def rest_pages(page_lists: DataFrame) -> DataFrame:
    """One row per page: ``document_id, page_number, page_fraction, page_text, page_index, page_id``.

    ``page_index`` is 1-based.
    """
    # The outer form keeps Catalyst from testing the size of the list, and so building it, a second time.
    exploded = page_lists.select("document_id", F.posexplode_outer("rest_pages").alias("_pos", "_page"))
    return exploded.filter(F.col("_pos").isNotNull()).select(
        "document_id",
        "_page.page_number",
        "_page.page_fraction",
        "_page.page_text",
        (F.col("_pos") + 1).alias("page_index"),
        "_page.page_id",
    )


def admit_responses(documents: DataFrame, document_side: DataFrame, page_side: DataFrame) -> DataFrame:
    """Add ``rest_status`` (``ok``, ``error``, ``cert``) to documents, with whatever else the two sides carry.

    ``document_side`` brings ``doc_state, doc_parsed`` and ``page_side`` ``page_state, page_parsed``, one row per
    document. The page request only happens after a good document request, and bodies are parsed after both.
    """
    joined = documents.join(document_side, "document_id", "left").join(page_side, "document_id", "left")
    status = (
        F.when(F.col("doc_state") == "cert", "cert")
        .when(F.col("doc_state").isNull() | (F.col("doc_state") == "error"), "error")
        .when(F.col("page_state") == "cert", "cert")
        .when(F.col("page_state").isNull() | (F.col("page_state") == "error"), "error")
        .when(F.col("doc_parsed") & F.col("page_parsed"), "ok")
        .otherwise("error")
    )
    return joined.withColumn("rest_status", status).drop("doc_state", "doc_parsed", "page_state", "page_parsed")
