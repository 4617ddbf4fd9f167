"""Text helpers as Column expressions: trimming, HTML to text, content hash."""

from __future__ import annotations

import html.entities
import json
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Unicode counts as white space, plus the four ASCII separators.
_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate value once and use it several times in body.

    A plain Python variable would paste the whole expression at every use and let
    nested rules grow the plan exponentially.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """Trim Unicode white space at both ends (Spark's default trims blanks only)."""
    return F.trim(c, F.lit(_WHITESPACE))


def non_empty(c: Column) -> Column:
    """Null for null and for the empty string."""
    return F.nullif(c, F.lit(""))


def lookup(table: dict[str, str], key: Column) -> Column:
    """Value of a fixed table, null where the key is absent.

    The table travels as one literal that the optimizer folds into a map.
    """
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")[key]


# --- HTML ---------------------------------------------------------------------------

# What separates two text nodes: comments, elements whose text is not page text, CDATA
# sections (group 2: their text), tags (quoted attribute values may hold '>'), declarations.
# Possessive loops, so that long attributes do not recurse.
_MARKUP = (
    r"(?is)<(?:"
    r"!--.*?--!?>"
    r"|(script|style|template|rt|rp)(?=[\s/>])[^>]*+>.*?(?:</\1\s*>|\z)"
    r"|!\[cdata\[(.*?)\]\s*\]\s*>"
    r"""|/?[a-z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
    r"|/?[a-z][^>]*+>"
    r"|[!?/][^>]*+>)"
)
_ENTITY = r"&(#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);?"


@cache
def _entity_tables() -> tuple[dict[str, str], dict[str, str]]:
    """Common names first, then the rest of HTML 5. Codes 128-159 mean windows-1252."""
    common = {n: chr(cp) for n, cp in html.entities.name2codepoint.items()}
    for code in range(128, 160):
        char = bytes([code]).decode("cp1252", errors="ignore")
        if char:
            common[f"#{code}"] = char
    rare = {n[:-1]: text for n, text in html.entities.html5.items()
            if n.endswith(";") and n[:-1] not in common}
    return common, rare


def _decode_entity(name: Column) -> Column:
    common, rare = _entity_tables()
    # Without leading zeros, seven digits hold every code in either base.
    digits = F.regexp_replace(name, "^#[xX]?0*", "")
    code = F.when(name.rlike("^#[xX]"), F.conv(F.substring(digits, 1, 7), 16, 10)).otherwise(
        F.substring(digits, 1, 7)).try_cast("bigint")
    replacement = F.lit("\ufffd")
    by_code = F.when(
        (F.length(digits) > 7) | code.isNull() | (code < 1) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF),
        replacement,
    ).otherwise(F.coalesce(
        lookup(common, F.concat(F.lit("#"), code.cast("string"))),
        F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"),
    ))
    by_name = F.coalesce(lookup(common, name), lookup(rare, name), F.concat(F.lit("&"), name))
    return F.when(name.startswith("#"), by_code).otherwise(by_name)


def unescape(c: Column) -> Column:
    """Decode character references once; unknown names keep their text."""
    plain = F.split(c, _ENTITY, -1)
    names = F.regexp_extract_all(c, F.lit(_ENTITY), F.lit(1))
    pieces = F.zip_with(
        plain, names,
        lambda text, name: F.when(name.isNull(), text).otherwise(
            F.concat(text, _decode_entity(name))))
    return F.when(c.contains("&"), F.array_join(pieces, "")).otherwise(c)


def html_to_text(c: Column, unescape_first: bool = False) -> Column:
    """Text nodes of an HTML fragment, each trimmed, blank ones dropped, one per line.

    Null and '' give null. One level of character references is decoded; a payload that
    holds entity-escaped markup therefore yields markup, unless unescape_first is set. A CDATA
    section is a text node of its own, in which nothing is decoded.
    """
    text = bind(unescape(c), _text_nodes) if unescape_first else _text_nodes(c)
    return F.when(non_empty(c).isNotNull(), text)


def _text_nodes(source: Column) -> Column:
    plain = F.transform(F.split(source, _MARKUP, -1), lambda t: strip(unescape(t)))
    sections = F.transform(F.regexp_extract_all(source, F.lit(_MARKUP), F.lit(2)), strip)
    # A section follows the text before its markup; the last text has none after it.
    mixed = F.flatten(F.zip_with(
        plain, sections, lambda text, cdata: F.array(text, F.coalesce(cdata, F.lit("")))))
    nodes = F.when(source.contains("<!["), mixed).otherwise(plain)
    return F.array_join(F.filter(nodes, lambda t: t != ""), "\n")


# --- content hash -------------------------------------------------------------------


def content_hash(title: Column, company: Column, location: Column,
                 description: Column | None = None) -> Column:
    """16 hex digits over title, company, location and the first 500 description characters."""
    parts = [strip(F.lower(F.coalesce(c, F.lit("")))) for c in (title, company, location)]
    if description is not None:
        parts.append(F.substring(non_empty(description), 1, 500))
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 16)
