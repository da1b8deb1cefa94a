"""String expressions: Unicode trimming, URL paths, character references, file names."""

from __future__ import annotations

import html.entities
import json

from pyspark.sql import Column, functions as F

from folioworks.functions.binding import let

# Every character Unicode or the ASCII separators count as white space, in code point order.
_SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Group 1 is the path: scheme, authority, parameters of the last segment, query and fragment stay outside.
_URL_PATH = r"(?s)^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*+)?((?:[^?#;]++|;(?![^/?#]*+(?:[?#]|\z)))*+)"

_REFERENCE = r"&(?:#[0-9]++|#[xX][0-9a-fA-F]++|[A-Za-z][A-Za-z0-9]*+);?"


def strip(column: Column) -> Column:
    """Trim every kind of white space from both ends."""
    return F.btrim(column, F.lit(_SPACES))


def is_blank(column: Column) -> Column:
    """True when nothing but white space is left."""
    return strip(column) == ""


def url_path(url: Column) -> Column:
    """Path of a URL; tolerates characters a strict URL parser rejects."""
    return F.regexp_extract(F.translate(url, "\t\r\n", ""), _URL_PATH, 1)


def _code_point(number: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")


def _windows() -> dict[int, str]:
    """What numeric references between 128 and 159 mean: characters of Windows-1252, where it has one."""
    return {n: text for n in range(0x80, 0xA0) if (text := bytes([n]).decode("cp1252", "ignore"))}


def _numbered(point: Column) -> Column:
    """Text of a numeric reference; no character at all is the replacement character."""
    windows = F.create_map(*(F.lit(x) for pair in _windows().items() for x in pair))
    usable = (point > 0) & (point <= 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
    return (
        F.when(point.isin(*_windows()), F.try_element_at(windows, point.cast("int")))
        .when(point == 13, "\r")
        .when(usable, _code_point(point))
        .otherwise("\ufffd")
    )


def unescape(column: Column) -> Column:
    """Resolve HTML 5 character references, named and numeric, in one left-to-right pass.

    The old names also count without their semicolon and at the beginning of a longer name. Texts without an ampersand
    are passed on untouched.
    """
    full = {name[:-1]: text for name, text in html.entities.html5.items() if name.endswith(";")}
    old = {name: text for name, text in html.entities.html5.items() if not name.endswith(";")}
    by_name, by_old_name = (F.from_json(F.lit(json.dumps(t)), "map<string,string>") for t in (full, old))
    lengths = range(max(map(len, old)), min(map(len, old)) - 1, -1)

    def named(piece: Column) -> Column:
        name = F.rtrim(F.substring(piece, 2, 1 << 30), F.lit(";"))
        starts = [
            F.when(F.length(name) >= n, F.concat(
                F.try_element_at(by_old_name, F.substring(name, 1, n)), F.substring(piece, n + 2, 1 << 30)))
            for n in lengths
        ]
        ends = piece.endswith(";")
        exact = F.when(ends, F.try_element_at(by_name, name)).otherwise(F.try_element_at(by_old_name, name))
        return F.coalesce(exact, *starts, piece)

    def resolve(piece: Column) -> Column:
        # Numbers too long to be converted are no code points either.
        decimal = F.coalesce(F.regexp_extract(piece, "^&#([0-9]+)", 1).try_cast("bigint"), F.lit(0))
        digits = F.regexp_extract(piece, "^&#[xX]0*+([0-9a-fA-F]{1,8})(?![0-9a-fA-F])", 1)
        hexadecimal = F.coalesce(F.conv(digits, 16, 10).try_cast("bigint"), F.lit(0))
        return (
            F.when(~piece.startswith("&") | (piece == "&"), piece)
            # The most frequent ones need no search among all names.
            .when(piece == "&amp;", "&").when(piece == "&lt;", "<").when(piece == "&gt;", ">").when(piece == "&quot;", '"')
            .when(piece.rlike("^&#[xX]"), _numbered(hexadecimal))
            .when(piece.startswith("&#"), _numbered(decimal))
            .otherwise(named(piece))
        )

    def resolve_all(text: Column) -> Column:
        pieces = F.regexp_extract_all(text, F.lit(rf"(?s){_REFERENCE}|[^&]++|&"), F.lit(0))
        return F.when(F.instr(text, "&") == 0, text).otherwise(F.array_join(F.transform(pieces, resolve), ""))

    return let(column, resolve_all)


# A character that may stand in a name.
_CLEAN = r"""[^\\/:*?"<>|\x00-\x1f\x7f]"""


def clean_file_name(column: Column) -> Column:
    """Drop what no common file system allows in a name, then trailing spaces and dots."""
    return F.regexp_replace(F.regexp_replace(column, r'[\\/:*?"<>|\x00-\x1f\x7f]', ""), r"[ .]+\z", "")


def clean_path(column: Column) -> Column:
    """Clean every part of a path; empty parts vanish, a leading slash and the parts ``.`` and ``..`` stay.

    A path whose parts are clean already passes untouched."""
    clean = rf"{_CLEAN}*+(?<![ .])"
    parts = F.transform(
        F.split(column, r"[/\\]"), lambda part: F.when(part.isin(".", ".."), part).otherwise(clean_file_name(part)))
    joined = F.array_join(F.filter(parts, lambda part: part != ""), "/")
    cut = F.when(column.startswith("/"), F.concat(F.lit("/"), joined)).otherwise(joined)
    return F.when(column.rlike(rf"^/?+{_CLEAN}{clean}(?:/{_CLEAN}{clean})*+\z"), column).otherwise(cut)
