"""Landed HTML: page ids from element attributes, texts from elements."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from folioworks.config import DEFAULT_DOM, METADATA_FIELDS, DomSearch, Step
from folioworks.functions.binding import computed_once
from folioworks.functions.html import attribute, contents, outline, pieces_of, raw_of, start_tags, text_of, without_noise
from folioworks.operators.rest import LANDED

_STEPS = 3  # of a walk in one expression


def page_ids(html: Column, tag: str, attribute_name: str, pattern: str) -> Column:
    """Ordered distinct group-1 matches of ``pattern`` in one attribute of all ``tag`` elements."""
    values = F.transform(start_tags(html, tag), lambda attributes: attribute(attributes, attribute_name))
    matching = F.filter(values, lambda value: value.rlike(pattern))
    return F.array_distinct(F.transform(matching, lambda value: F.regexp_extract(value, pattern, 1)))


def _with_texts(pages: DataFrame, selectors: Mapping[str, Sequence[Step]]) -> DataFrame:
    """Add one text column per selector over ``_html``, from one cut of the page.

    Every stage on the way that several selectors share is walked once.
    """
    if not selectors:
        return pages
    tags = sorted({tag for steps in selectors.values() for step in steps for tag in (step.tag, *step.outside)})
    walked = computed_once(pages, _pieces=pieces_of(F.col("_html"), tags))
    walked = computed_once(walked, _at_=F.array(outline(F.col("_pieces"), tags)))
    paths = {tuple(steps): name for name, steps in selectors.items()}
    shared = _shared_starts(list(paths))
    names = {(): "_at_"}
    for start in sorted(shared, key=len):
        at = max((known for known in names if start[: len(known)] == known), key=len)
        walked, last, rest = _advanced(walked, names[at], start[len(at) :], tags)
        names[start] = f"_at_{len(names)}"
        walked = computed_once(walked, **{names[start]: _walk(F.col(last), rest, tags)})
    raw = []
    for steps in paths:
        at = max((known for known in names if steps[: len(known)] == known), key=len)
        walked, last, rest = _advanced(walked, names[at], steps[len(at) :], tags)
        raw.append(raw_of(_walk(F.col(last), rest, tags), F.col("_pieces"), tags))
    # One expression for all texts.
    read = computed_once(walked, _texts=F.transform(F.array(*raw), lambda found: F.coalesce(text_of(found), F.lit(""))))
    places = {steps: place for place, steps in enumerate(paths)}
    texts = (F.get("_texts", F.lit(places[tuple(steps)])).alias(name) for name, steps in selectors.items())
    return read.select(*pages.columns, *texts)


def _advanced(
    walked: DataFrame, at: str, steps: Sequence[Step], tags: Sequence[str]
) -> tuple[DataFrame, str, Sequence[Step]]:
    """``walked`` with what all but the last steps from column ``at`` reach, its name, and the steps that are left.

    A projection for every few steps: the analyzer resolves an expression level by level, and only so many levels.
    """
    while len(steps) > _STEPS:
        reached = f"_at_step_{len(walked.columns)}"
        walked = walked.withColumn(reached, _walk(F.col(at), steps[:_STEPS], tags))
        at, steps = reached, steps[_STEPS:]
    return walked, at, steps


def _walk(scopes: Column, steps: Sequence[Step], tags: Sequence[str]) -> Column:
    """Parts of a page reached by walking ``steps`` from outer containers inwards."""
    for step in steps:
        scopes = contents(scopes, step, F.col("_pieces"), tags)
    return scopes


def _shared_starts(paths: Sequence[tuple[Step, ...]]) -> set[tuple[Step, ...]]:
    """The longest common beginning of every two paths, where it saves more steps than keeping it costs."""
    shared = set()
    for i, one in enumerate(paths):
        for other in paths[:i]:
            length = next((n for n, (a, b) in enumerate(zip(one, other)) if a != b), min(len(one), len(other)))
            if length > 2:
                shared.add(one[:length])
    return shared


def _loaded(pages: DataFrame) -> DataFrame:
    """Cleaned HTML of pages that loaded; NULL for the others. An HTTP error is an empty page."""
    loaded = F.col("error_class").isNull() & (F.coalesce("status", F.lit(0)) < 400)
    carried = [c for c in (LANDED,) if c in pages.columns]
    return pages.select("document_id", *carried, "error_class", F.when(loaded, without_noise(F.col("html"))).alias("_html"))


def dom_facts(pages: DataFrame, search: DomSearch = DEFAULT_DOM, fields: Sequence[str] = METADATA_FIELDS) -> DataFrame:
    """Landed HTML to ``document_id, dom_kind, dom_pages`` and one ``dom_<field>`` text per field, in one pass.

    ``dom_pages`` holds the ids in page order. A failed connection is ``cert`` or ``error``; a page without ids,
    or one answered with an HTTP error, is ``empty``.
    """
    found = page_ids(F.col("_html"), search.page_tag, search.page_attribute, search.page_pattern)
    kind = (
        F.when(F.col("error_class") == "cert", "cert")
        .when(F.col("error_class").isNotNull(), "error")
        .when(F.size("_found") == 0, "empty")
        .otherwise("ok")
    )
    texts = _with_texts(_loaded(pages), {f"dom_{name}": search.metadata[name] for name in fields})
    found = computed_once(texts, _found=F.coalesce(found, F.array().cast("array<string>")))
    return found.select(
        "document_id",
        *(c for c in (LANDED,) if c in found.columns),
        kind.alias("dom_kind"),
        F.when(F.col("error_class").isNull(), F.col("_found")).alias("dom_pages"),
        *(f"dom_{name}" for name in fields),
    )


def dom_pages(pages: DataFrame, search: DomSearch = DEFAULT_DOM) -> DataFrame:
    """Only the page ids of landed HTML: ``document_id, dom_kind, dom_pages``."""
    return dom_facts(pages, search, fields=())


def dom_text(pages: DataFrame, selectors: Mapping[str, Sequence[Step]]) -> DataFrame:
    """One text column per selector; ``''`` when nothing matches or the page did not load."""
    return _with_texts(_loaded(pages), selectors).drop("_html", "error_class")
