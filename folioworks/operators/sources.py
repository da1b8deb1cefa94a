"""Any number of sources in their order: what each says about a document, and whose word counts.

Every source answers the same questions with a kind and a value: ``ok`` with a value, ``empty`` without one, ``error``
or ``cert`` if it failed. What sources say is joined by document, and the search is one fold over their kinds. It
remembers the source it is with: that one is asked first and its word counts, also if it has nothing to say. Once it
fails, all sources are asked in their order until one has a value; the search stays with the last one that did not
fail.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from folioworks.config import METADATA_FIELDS
from folioworks.functions.binding import computed_once
from folioworks.operators.rest import admit_responses

QUESTIONS = ("pages", *METADATA_FIELDS)
_NOBODY = -1


@dataclass(frozen=True)
class Source:
    """A source and what it says: ``said`` holds ``document_id, answers, page_count, maybe_truncated``, the answers in
    the order of ``QUESTIONS``. Documents it has no row of get ``absent`` on every question. A ``complete`` source was
    asked for every document of the search and has one row for each, so that nobody else's ids need be joined to it."""

    name: str
    said: DataFrame | None
    absent: str = "empty"
    complete: bool = False


def _answer(kind: Column, value: Column | None = None) -> Column:
    return F.struct(kind.alias("kind"), F.coalesce(value if value is not None else F.lit(""), F.lit("")).alias("value"))


def _text_answer(failed: Column, text: Column) -> Column:
    """Answer to a text question: ``failed`` is NULL where the source works."""
    said = F.coalesce(text, F.lit(""))
    return _answer(F.coalesce(failed, F.when(said == "", "empty").otherwise("ok")), F.when(failed.isNull(), said))


def rest_answers(ids: DataFrame, document_facts: DataFrame, page_facts: DataFrame) -> DataFrame:
    """What landed REST responses say, for ``Source.said``; a field of another type than text is a failure.

    One row for each id: the joins leave the rows of an id in one place, so that a second one is dropped there.
    """
    admitted = admit_responses(ids, document_facts, page_facts.drop("rest_pages"))
    unusable = F.when(F.col("rest_status") != "ok", F.col("rest_status"))
    pages = _answer(F.coalesce(unusable, F.col("rest_pages_kind"), F.lit("error")))
    texts = [
        _text_answer(F.coalesce(unusable, F.when(F.col(f"{name}_kind") == "invalid", "error")), F.col(name))
        for name in METADATA_FIELDS
    ]
    return admitted.select(
        "document_id", F.array(pages, *texts).alias("answers"),
        F.col("rest_page_count").alias("page_count"), "maybe_truncated").dropDuplicates(["document_id"])


def html_answers(html_facts: DataFrame, reports_failures: bool) -> DataFrame:
    """What landed HTML says, for ``Source.said``.

    A plain request that failed fails every question; a browser that could not load a page shows an empty one, so only
    its page list tells of the failure.
    """
    failed = F.when(F.col("dom_kind").isin("error", "cert"), F.col("dom_kind"))
    no_text = failed if reports_failures else F.lit(None).cast("string")
    texts = [_text_answer(no_text, F.col(f"dom_{name}")) for name in METADATA_FIELDS]
    return html_facts.select(
        "document_id", F.array(_answer(F.col("dom_kind")), *texts).alias("answers"),
        F.col("dom_page_count").alias("page_count"), F.lit(False).alias("maybe_truncated"))


def _asked(active: Column, kinds: Column, count: int) -> tuple[Column, Column]:
    """One question: the source it leaves the search with, and whether it is open, from the source the search is with
    and the kinds of all answers."""
    usable = F.coalesce(F.get(kinds, active).isin("ok", "empty"), F.lit(False))
    first = F.array_position(kinds, "ok").cast("int") - 1
    last = F.when(F.get(kinds, F.lit(count - 1)) == "empty", count - 1).otherwise(_NOBODY)
    after = F.when(usable, active).when(first >= 0, first).otherwise(last)
    return after.cast("int"), ~usable & (first < 0)


_SAID = "struct<answers:array<struct<kind:string,value:string>>,page_count:int,maybe_truncated:boolean>"


def _gathered(ids: DataFrame, sources: Sequence[Source]) -> DataFrame:
    """``document_id`` and what each source says as ``_said_<n>``, for every id: one join per source, all dealt by
    document once."""
    start = next((pos for pos, source in enumerate(sources) if source.complete), None)

    def said(pos: int) -> DataFrame:
        row = F.struct("answers", F.col("page_count").cast("int").alias("page_count"), "maybe_truncated")
        return sources[pos].said.select("document_id", row.cast(_SAID).alias(f"_said_{pos}"))

    together = ids.select("document_id") if start is None else said(start)
    for pos, source in enumerate(sources):
        if source.said is not None and pos != start:
            # Dealt first, so that what comes for a document a second time is dropped where its rows are joined.
            once = said(pos).repartition("document_id").dropDuplicates(["document_id"])
            together = together.join(once, "document_id", "left")

    def of(pos: int, source: Source) -> Column:
        nothing = F.array(*[F.struct(F.lit(source.absent).alias("kind"), F.lit("").alias("value"))] * len(QUESTIONS))
        default = F.struct(nothing.alias("answers"), F.lit(0).cast("int").alias("page_count"),
                           F.lit(False).alias("maybe_truncated")).cast(_SAID)
        return F.coalesce(f"_said_{pos}", default) if source.said is not None else default

    return together.select("document_id", *(of(pos, source).alias(f"_said_{pos}") for pos, source in enumerate(sources)))


def _folded(gathered: DataFrame, count: int, explicit: bool) -> DataFrame:
    """Add what became of each question, in order: ``_active_<q>``, the source the search is with after it, and
    ``_open_<q>``. With explicit pages that question is not asked, and the search is with nobody when the first text is."""
    # A projection for each question: the few questions are known, so no loop over an array is needed. Only kinds are
    # looked at; texts are taken from the source that is found.
    said = [F.col(f"_said_{pos}")["answers"]["kind"] for pos in range(count)]
    asked, active = gathered, F.lit(_NOBODY if explicit else 0)
    for question in range(1 if explicit else 0, len(QUESTIONS)):
        kinds = F.array(*(F.get(kinds, F.lit(question)) for kinds in said))
        asked = asked.withColumn(f"_kinds_{question}", kinds)
        after, open_ = _asked(active, F.col(f"_kinds_{question}"), count)
        # Each is mentioned several times in the next: a filter on the last would be written out over all of them.
        asked = computed_once(asked, **{f"_active_{question}": after, f"_open_{question}": open_})
        active = F.col(f"_active_{question}")
    return asked


def unsettled(ids: DataFrame, sources: Sequence[Source], explicit: bool = False) -> DataFrame:
    """Ids of the documents for which some question is still open after the given sources: only they need another."""
    if not sources:
        return ids.select("document_id")
    folded = _folded(_gathered(ids, sources), len(sources), explicit)
    still = [F.col(f"_open_{question}") for question in range(1 if explicit else 0, len(QUESTIONS))]
    return folded.filter(reduce(Column.__or__, still)).select("document_id")


def resolve_sources(ids: DataFrame, sources: Sequence[Source], explicit: Sequence[str] | None = None) -> DataFrame:
    """One row per id: ``pages_source`` or ``failure_class``, ``page_count``, ``maybe_truncated``, each metadata field
    and ``<field>_source``, the source the search was with after asking for it (NULL if all failed).

    ``failure_class`` is ``certificate`` if certificates were all that failed, else ``no_pages``. Texts nobody has are
    empty, whatever failed. With ``explicit`` pages nobody is asked for pages.
    """
    given = explicit is not None
    folded = _folded(_gathered(ids, sources), len(sources), given)
    names = F.array(*(F.lit(source.name) for source in sources))
    by_source = F.array(*(F.col(f"_said_{pos}") for pos in range(len(sources))))
    if given:
        pages_source, failure = F.lit("explicit"), F.lit(None).cast("string")
        count, truncated = F.lit(len(explicit)), F.lit(False)
    else:
        active, kinds = F.col("_active_0"), F.col("_kinds_0")
        found = F.coalesce(F.get(kinds, active) == "ok", F.lit(False))
        certificate = F.col("_open_0") & F.array_contains(kinds, "cert") & ~F.array_contains(kinds, "error")
        settled = F.get(by_source, active)
        pages_source = F.when(found, F.get(names, active))
        failure = F.when(~found, F.when(certificate, "certificate").otherwise("no_pages"))
        count = F.when(found, settled["page_count"])
        truncated = F.coalesce(settled["maybe_truncated"], F.lit(False))
    texts = []
    for question, field in enumerate(METADATA_FIELDS, 1):
        active = F.col(f"_active_{question}")
        value = F.get(F.get(by_source, active)["answers"], F.lit(question))["value"]
        texts += [F.when(F.col(f"_open_{question}"), "").otherwise(F.coalesce(value, F.lit(""))).alias(field),
                  F.get(names, active).alias(f"{field}_source")]
    return folded.select(
        "document_id", pages_source.alias("pages_source"), failure.alias("failure_class"), count.alias("page_count"),
        truncated.alias("maybe_truncated"), *texts)
