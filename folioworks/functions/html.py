"""Reads from landed HTML that need not be well formed.

A page is cut once, by one pattern, into pieces: a tag and the text behind it. Its tags are then written down as one
short string, a letter and the number of the piece for each, and elements are found in that string by patterns, in time
by its length. All loops in the patterns are possessive: they run in constant stack on attributes and elements of any
length.
"""

from __future__ import annotations

import re
import string
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from folioworks.config import Step
from folioworks.functions.binding import let
from folioworks.functions.text import strip, unescape

_ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_ATTRIBUTE = r"""([^\s"'>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]*+))?+"""
# Whatever opens first counts: a comment mark inside a script is script, a script inside a comment is comment.
_NOISE = r"(?is)(<!--).*?(-->)|<script\b.*?</script\s*+>|<style\b.*?</style\s*+>"


def without_noise(html: Column) -> Column:
    """Empty comments (they still separate text) and no script or style; pages with none of these pass untouched."""
    noisy = html.contains("<!--") | html.rlike(r"(?i)<s(?:cript|tyle)\b")
    return F.when(noisy, F.regexp_replace(html, _NOISE, "$1$2")).otherwise(html)


def start_tags(html: Column, tag: str) -> Column:
    """Attribute parts of all start tags of ``tag``, in page order."""
    return F.regexp_extract_all(html, F.lit(rf"(?i)<{re.escape(tag)}(?=[\s/>])({_ATTRIBUTES})>"), F.lit(1))


def attribute(attributes: Column, name: str) -> Column:
    """Value of one attribute, NULL when it is not there; of repeated ones the last counts.

    The attribute part is cut into names and values first, so text inside another value cannot be mistaken for it. One
    that is spelled plainly (values in double quotes, the name once, no reference in its value) takes a single pattern.
    """
    other = rf"""(?:\s++(?!(?i:{re.escape(name)})=)[A-Za-z0-9_:.-]++="[^"]*+")*+"""
    plain = rf"""^{other}\s++(?i:{re.escape(name)})="([^"&]*+)"{other}\s*+/?+\z"""
    pairs = F.regexp_extract_all(attributes, F.lit(_ATTRIBUTE), F.lit(0))
    named = F.filter(pairs, lambda pair: F.lower(pair).rlike(rf"^{re.escape(name)}(?:[\s=]|\z)"))
    raw = F.regexp_extract(F.try_element_at(named, F.lit(-1)), _ATTRIBUTE, 2)
    cut = unescape(F.regexp_replace(raw, r"""^["']|["']\z""", ""))
    return F.when(attributes.rlike(plain), F.regexp_extract(attributes, plain, 1)).otherwise(cut)


def _opening(tag: str, class_part: str | None = None) -> str:
    """Pattern of a start tag, optionally only with ``class_part`` in its class attribute."""
    guard = ""
    if class_part is not None:
        part = re.escape(class_part)
        before = r"""(?:[^>"'\s]++|\s(?!class\s*+=)|"[^"]*+"|'[^']*+')*+"""
        guard = rf"""(?={before}\sclass\s*+=\s*+(?:"[^"]*?{part}|'[^']*?{part}|[^\s"'>]*?{part}))"""
    return rf"<{re.escape(tag)}(?=[\s/>]){guard}{_ATTRIBUTES}>"


def _known(tags: Sequence[str]) -> str:
    """Pattern of how a start or end tag of ``tags`` begins; group 1 is its name, with the slash of an end tag."""
    names = "|".join(re.escape(tag) for tag in tags)
    return rf"<(/?(?:{names}))(?=[\s/>])"


def pieces_of(html: Column, tags: Sequence[str]) -> Column:
    """The page cut once, from left to right: each start and end tag of ``tags`` with all that stands before the next.

    The first piece may have no tag. Other tags are text, and what stands in their attributes is no tag.
    """
    known = _known(tags)
    text = rf"(?:[^<]++|<!---->|(?!{known})</?[A-Za-z]{_ATTRIBUTES}>|(?!{known}{_ATTRIBUTES}>)<)"
    return F.regexp_extract_all(html, F.lit(rf"(?is){known}{_ATTRIBUTES}>{text}*+|{text}++"), F.lit(0))


# A tag in an outline is a letter and the number of its piece. This letter stands for the text of a piece without its tag.
_TEXT = "-"
# Letters of tags that are hidden for a while.
_HIDDEN = "()"
_ALPHABET = string.ascii_letters
# Levels of one tag that a pattern sees.
_LEVELS = 8


def _letters(place: int) -> tuple[str, str]:
    """Letters of the start and end tags of one name."""
    first, last = (_ALPHABET[n] if n < len(_ALPHABET) else chr(0xC0 + n - len(_ALPHABET)) for n in (2 * place, 2 * place + 1))
    return first, last


def outline(pieces: Column, tags: Sequence[str]) -> Column:
    """The tags of a page as one string that starts and ends like the page."""
    named = {f"{slash}{tag}": letter for place, tag in enumerate(tags) for slash, letter in zip(("", "/"), _letters(place))}
    names, letters = (F.array(*map(F.lit, listed)) for listed in (named, named.values()))

    def token(piece: Column, at: Column) -> Column:
        # The first piece may be text, and begin with the name of a tag that never ends. All others begin with a tag.
        whole = F.regexp_extract(piece, rf"(?is)^{_known(tags)}{_ATTRIBUTES}>", 1)
        name = F.lower(F.when(at == 0, whole).otherwise(F.regexp_extract(piece, r"^<(/?[^\s/>]++)", 1)))
        letter = F.get(letters, (F.array_position(names, name) - 1).cast("int"))
        return F.concat(F.coalesce(letter, F.lit(_TEXT)), at.cast("string"))

    return F.array_join(F.transform(pieces, token), "")


def _piece(pieces: Column, number: Column) -> Column:
    return F.get(pieces, number.cast("int"))


def _shown(scope: Column, first: str, last: str) -> Column:
    """``scope`` with the hidden letters of a tag back in their places."""
    return F.when(scope.contains(_HIDDEN[0]), F.translate(scope, _HIDDEN, first + last)).otherwise(scope)


def _inside(first: str, last: str) -> str:
    """Pattern of what an element holds, with elements of its tag up to so many levels; one never closed ends with the text."""
    inner = rf"[^{first}{last}]*+"
    for _ in range(_LEVELS):
        inner = rf"(?:[^{first}{last}]++|{first}{inner}(?:{last}|\z))*+"
    return inner


def _levelled(scope: Column, first: str, last: str) -> Column:
    """``scope`` without more levels of a tag than a pattern sees: the letters of inner ones are hidden if there are."""
    runs = F.regexp_extract_all(scope, F.lit(rf"[{first}{last}][^{first}{last}]*+|[^{first}{last}]++"), F.lit(0))

    def state(depth: Column, out: Column) -> Column:
        return F.struct(depth.cast("int").alias("depth"), out.alias("out"))

    def walk(now: Column, run: Column) -> Column:
        depth, rest = now["depth"], F.substring(run, 2, 1 << 30)
        shown = F.concat(now["out"], run)
        return (
            F.when(run.startswith(first), state(depth + 1, F.when(depth == 0, shown).otherwise(
                F.concat(now["out"], F.lit(_HIDDEN[0]), rest))))
            .when(run.startswith(last) & (depth > 0), state(depth - 1, F.when(depth == 1, shown).otherwise(
                F.concat(now["out"], F.lit(_HIDDEN[1]), rest))))
            .otherwise(state(depth, shown))
        )

    # So few elements cannot lie deeper, which costs no pattern.
    several = F.substring_index(scope, first, _LEVELS + 1) != scope
    deeper = several & scope.rlike(rf"^(?:[^{first}]++|{first}{_inside(first, last)}(?:{last}|\z))*+{first}")
    hidden = F.aggregate(runs, state(F.lit(0), F.lit("")), walk, lambda end: end["out"])
    return F.when(deeper, hidden).otherwise(scope)


def contents(scopes: Column, step: Step, pieces: Column, tags: Sequence[str]) -> Column:
    """Contents of the elements ``step`` picks in each of the given parts of a page, in page order.

    Parts are outlines of ``pieces``, made with the same ``tags``. The outermost elements of a tag count; one that is
    never closed ends with its part, but is not taken out of it.
    """
    if step.class_part is not None and step.nth is not None:
        raise ValueError("a step picks by class or by place, not both")

    def without(scope: Column, tag: str) -> Column:
        first, last = _letters(tags.index(tag))
        closed = rf"{first}{_inside(first, last)}{last}"

        def kept(levelled: Column) -> Column:
            head = F.regexp_extract(levelled, rf"^(?:[^{first}]++|{closed})*+", 0)
            # Of an element the text behind it is left.
            left = F.regexp_replace(head, rf"{closed}([0-9]++)", rf"{_TEXT}$1")
            rest = F.concat(left, F.substr(levelled, F.length(head) + 1))
            return let(rest, lambda out: _shown(out, first, last))

        return F.when(scope.contains(first), let(_levelled(scope, first, last), kept)).otherwise(scope)

    def picked(scope: Column) -> Column:
        first, last = _letters(tags.index(step.tag))
        element = F.lit(rf"{first}({_inside(first, last)})(?:{last}|\z)")
        found = F.regexp_extract_all(_levelled(scope, first, last), element, F.lit(1))
        if step.class_part is not None:
            opening = rf"(?is)^{_opening(step.tag, step.class_part)}"
            found = F.filter(found, lambda e: _piece(pieces, F.regexp_extract(e, "^[0-9]+", 0)).rlike(opening))
        elif step.nth is not None:
            found = F.slice(found, step.nth, 1)
        return F.transform(found, lambda e: _shown(F.concat(F.lit(_TEXT), e), first, last))

    def left(scope: Column, outside: Sequence[str]) -> Column:
        return let(without(scope, outside[0]), lambda rest: left(rest, outside[1:])) if outside else picked(scope)

    return F.flatten(F.transform(scopes, lambda scope: left(scope, step.outside)))


def raw_of(scopes: Column, pieces: Column, tags: Sequence[str]) -> Column:
    """What stands in parts of a page, tags included; between two parts a control character that HTML cannot hold."""

    def raw(token: Column) -> Column:
        piece = _piece(pieces, F.substring(token, 2, 1 << 30))
        text = F.regexp_replace(piece, rf"(?is)^{_known(tags)}{_ATTRIBUTES}>", "")
        return F.when(token.startswith(_TEXT), text).otherwise(piece)

    listed = lambda scope: F.regexp_extract_all(scope, F.lit("[^0-9][0-9]++"), F.lit(0))
    return F.array_join(F.transform(scopes, lambda scope: F.array_join(F.transform(listed(scope), raw), "")), "\x01")


def text_of(raw: Column) -> Column:
    """Text nodes of parts of a page (:func:`raw_of`), each stripped, joined by one space; blank nodes leave their separators."""
    # Tags become a control character too, so that a resolved &lt; is never taken for one.
    marked = F.regexp_replace(raw, rf"(?s)<!---->|</?[A-Za-z]{_ATTRIBUTES}>", "\x01")
    nodes = F.filter(F.split(unescape(marked), "\x01"), lambda node: node != "")
    return strip(F.array_join(F.transform(nodes, strip), " "))
