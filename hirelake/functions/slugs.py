"""Company slugs: validity, decoding, extraction from URLs."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions.text import bind

# Names that are pages of a board site, not companies.
RESERVED_SLUGS = ("robots.txt", "sitemap.xml", "embed", "widget")
RESERVED_PREFIXES = ("api", "static", "assets", "favicon")

# All characters of Unicode numeric type decimal (\p{Nd}) or digit (the others).
_DIGITS = (
    "\\p{Nd}\u00b2\u00b3\u00b9\u1369-\u1371\u19da\u2070\u2074-\u2079\u2080-\u2089"
    "\u2460-\u2468\u2474-\u247c\u2488-\u2490\u24ea\u24f5-\u24fd\u24ff\u2776-\u277e"
    "\u2780-\u2788\u278a-\u2792\U00010a40-\U00010a43\U00010e60-\U00010e68"
    "\U00011052-\U0001105a\U0001f100-\U0001f10a"
)


def is_valid_slug(slug: Column) -> Column:
    """False for null, short, purely numeric and reserved slugs and for URL leftovers."""
    bad = (
        (F.length(slug) <= 1)
        | slug.rlike("[?&=# ]")
        | slug.rlike(f"^[{_DIGITS}]+\\z")
        | F.lower(slug).isin(*RESERVED_SLUGS)
        | slug.rlike("^(" + "|".join(RESERVED_PREFIXES) + ")")
    )
    return F.coalesce(~bad, F.lit(False))


def decode_slug(raw: Column) -> Column:
    """Percent-decode and lower-case. '+' stays, and so does a '%' without two hex digits."""
    def decoded(text: Column) -> Column:
        guarded = F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")
        return F.try_url_decode(F.regexp_replace(guarded, "\\+", "%2B"))

    return F.lower(bind(raw, lambda r: F.when(
        r.contains("%"), F.coalesce(decoded(r), r)).otherwise(r)))


def url_parts(url: Column) -> Column:
    """Struct (host, path) of a URL; both are '' where the URL names no authority.

    Read by pattern because Spark's URL functions reject hosts and escapes that occur in
    real redirects. Host: lower case, without user info and port. Path: without query,
    fragment and the parameters of the last segment.
    """
    clean = F.regexp_replace(url, "^[\\x00-\\x20]+|[\\t\\r\\n]", "")
    pattern = "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^?#]*)"

    def parts(u: Column) -> Column:
        authority = F.regexp_extract(u, pattern, 1)
        path = F.regexp_extract(u, pattern, 2)
        return F.struct(
            F.lower(F.regexp_extract(authority, "([^@:]*)(?::[^@]*)?$", 1)).alias("host"),
            F.regexp_replace(path, ";[^/]*$", "").alias("path"))

    return bind(clean, parts)


def _first_match(patterns: Mapping[str, str], test: Callable[[str], Column]) -> Column:
    # A short fixed list: an ordered CASE does what would be a nested-loop join.
    return F.coalesce(*[F.when(test(text), F.lit(name)) for text, name in patterns.items()],
                      F.lit(None).cast("string"))


def match_host(host: Column, patterns: Mapping[str, str]) -> Column:
    """Name of the first pattern (host text to name) the host contains, null if none."""
    return _first_match(patterns, host.contains)


def match_domain(host: Column, patterns: Mapping[str, str]) -> Column:
    """Like match_host, but the host must be the domain itself or lie below it."""
    return _first_match(patterns, lambda d: (host == d) | host.endswith("." + d))


def redirect_target(url: Column, patterns: Mapping[str, str],
                    exact_domain: bool = False) -> Column:
    """Struct (ats, slug) of a resolved redirect; null if the host or slug is not usable."""
    match = match_domain if exact_domain else match_host

    def target(u: Column) -> Column:
        segment = F.substring_index(F.trim(u["path"], F.lit("/")), "/", 1)
        return F.struct(match(u["host"], patterns).alias("ats"),
                        decode_slug(segment).alias("slug"))

    return bind(bind(url_parts(url), target), lambda t: F.when(
        t["ats"].isNotNull() & is_valid_slug(t["slug"]), t))


def redirect_targets(url: Column, patterns: Mapping[str, str],
                     exact_domain: bool = False) -> Column:
    """redirect_target as an array of at most one struct.

    Unnesting it drops unusable URLs; a filter on the struct would be pushed below the
    projection and read every URL twice.
    """
    return F.array_compact(F.array(redirect_target(url, patterns, exact_domain)))


def slug_in_line(line: Column, pattern: str) -> Column:
    """Decoded first match of a URL pattern anywhere in a line; '' if there is none."""
    return decode_slug(F.regexp_extract(line, pattern, 1))
