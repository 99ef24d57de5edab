"""Text clean-up expressions."""

from __future__ import annotations

from html.entities import html5
from zlib import crc32

from pyspark.sql import Column, functions as F

# The characters a Unicode-aware strip removes.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

_WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
# A map is searched entry by entry, so the named references lie in many small ones, by hash.
_NAME_LISTS = 512
_NAMED = [
    ",".join(
        f"{n.removesuffix(';')}:{' '.join(str(ord(c)) for c in text)}"
        for n, text in html5.items()
        if n.endswith(";") and crc32(n.removesuffix(";").encode()) % _NAME_LISTS == k
    )
    for k in range(_NAME_LISTS)
]
_ENTITY = r"^(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"


def strip(value: Column) -> Column:
    """Remove Unicode whitespace at both ends (``trim`` alone removes only spaces)."""
    return F.trim(value, F.lit(WHITESPACE))


def country_name(value: Column) -> Column:
    """Spelling used to compare countries: outer spaces removed, each word capitalised."""
    return F.initcap(F.trim(value))


def last_comma_split(value: Column, default: str = "Unknown") -> tuple[Column, Column]:
    """Split at the last comma, both parts stripped; ``default`` is the tail if there is no comma."""
    has_comma = F.contains(value, F.lit(","))
    tail = F.substring_index(value, ",", -1)
    head = F.substring(value, F.lit(1), F.length(value) - F.length(tail) - F.lit(1))
    return (
        F.when(has_comma, strip(head)).otherwise(value),
        F.when(has_comma, strip(tail)).otherwise(F.lit(default)),
    )


def _character(code_point: Column) -> Column:
    """The character of a code point; NULL where there is none."""
    valid = code_point.between(1, 0x10FFFF) & ~code_point.between(0xD800, 0xDFFF)
    utf32 = F.unhex(F.lpad(F.hex(F.when(valid, code_point)), 8, "0"))
    return F.decode(utf32, "UTF-32")


def _codes(name: Column, lists: Column) -> Column:
    """The code points of a named reference; NULL for an unknown one."""
    found = F.get(lists, F.pmod(F.crc32(name.cast("binary")), F.lit(_NAME_LISTS)).cast("int"))
    return F.str_to_map(found, F.lit(","), F.lit(":"))[name]


def _decoded_piece(piece: Column, names: Column) -> Column:
    """One piece of a text cut at ``&``: an entity and what follows it."""
    body = F.regexp_extract(piece, _ENTITY, 1)
    digits = F.regexp_replace(F.regexp_replace(body, "^#[xX]?", ""), "^0+(?=.)", "")
    code = (
        F.when(F.length(digits) > 7, F.lit(None))
        .when(body.rlike("^#[xX]"), F.conv(digits, 16, 10))
        .otherwise(digits)
    )
    named = F.array_join(
        F.transform(F.split(_codes(body, names), " "), lambda c: _character(c.try_cast("bigint"))), ""
    )
    character = F.when(F.startswith(body, F.lit("#")), _character(code.try_cast("bigint"))).otherwise(named)
    rest = F.substring(piece, F.length(body) + F.lit(2), F.length(piece))
    plain = F.concat(F.lit("&"), piece)
    return F.when(body == "", plain).otherwise(F.coalesce(F.concat(character, rest), plain))


def _decoded(value: Column) -> Column:
    names = F.split(F.lit(";".join(_NAMED)), ";")
    pieces = F.split(value, "&", -1)
    tail = F.transform(
        F.slice(pieces, F.lit(2), F.size(pieces)), lambda p: _decoded_piece(p, names)
    )
    return F.concat(pieces[0], F.array_join(tail, ""))


def decode_entities(value: Column) -> Column:
    """Decode numeric and named character references; unknown ones stay as they are."""
    return F.when(F.contains(value, F.lit("&")), _decoded(value)).otherwise(value)


def plain_text(text: Column, collapse: bool = True) -> Column:
    """Text without markup, as shown: references decoded, ends stripped.

    ``collapse`` also turns each run of whitespace into one space, as a rendered page shows it.
    """
    shown = decode_entities(text)
    return strip(F.regexp_replace(shown, _WHITESPACE_RUN, " ") if collapse else shown)


def element_text(inner_html: Column, collapse: bool = True) -> Column:
    """Text of an element: comments and tags removed, entities decoded, ends stripped.

    ``collapse`` also turns each run of whitespace into one space, as a rendered page shows it.
    """
    has_markup = F.contains(inner_html, F.lit("<"))
    text = F.when(
        has_markup, F.regexp_replace(inner_html, r"(?s)<!--.*?-->|<[^<>]*>", "")
    ).otherwise(inner_html)
    has_entity = F.contains(inner_html, F.lit("&"))
    text = F.when(has_entity, _decoded(text)).otherwise(text)
    return strip(F.regexp_replace(text, _WHITESPACE_RUN, " ") if collapse else text)
