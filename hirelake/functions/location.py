"""Free-text job location to (city, state, country, is_remote)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions.text import bind, lookup, strip

# State name to code.
US_STATE_NAMES = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR", "california": "CA",
    "colorado": "CO", "connecticut": "CT", "delaware": "DE",
    "florida": "FL", "georgia": "GA", "hawaii": "HI", "idaho": "ID", "illinois": "IL",
    "indiana": "IN", "iowa": "IA", "kansas": "KS", "kentucky": "KY", "louisiana": "LA",
    "maine": "ME", "maryland": "MD", "massachusetts": "MA", "michigan": "MI",
    "minnesota": "MN", "mississippi": "MS", "missouri": "MO", "montana": "MT",
    "nebraska": "NE", "nevada": "NV", "new hampshire": "NH", "new jersey": "NJ",
    "new mexico": "NM", "new york": "NY", "north carolina": "NC", "north dakota": "ND",
    "ohio": "OH", "oklahoma": "OK", "oregon": "OR", "pennsylvania": "PA",
    "rhode island": "RI", "south carolina": "SC", "south dakota": "SD", "tennessee": "TN",
    "texas": "TX", "utah": "UT", "vermont": "VT", "virginia": "VA", "washington": "WA",
    "west virginia": "WV", "wisconsin": "WI", "wyoming": "WY",
    "district of columbia": "DC",
}
# Province codes, spellings of countries, words that are no place.
CA_PROVINCES = ("AB", "BC", "MB", "NB", "NL", "NS", "NT", "NU", "ON", "PE", "QC", "SK", "YT")
COUNTRY_NAMES = {
    "US": "US", "USA": "US", "UNITED STATES": "US", "UNITED STATES OF AMERICA": "US",
    "CANADA": "CA",
    "UK": "UK", "UNITED KINGDOM": "UK", "ENGLAND": "UK", "SCOTLAND": "UK", "WALES": "UK",
}
# State or province code to its country.
REGION_COUNTRIES = {**dict.fromkeys(US_STATE_NAMES.values(), "US"),
                    **dict.fromkeys(CA_PROVINCES, "CA")}
WORKPLACE_WORDS = ("remote", "hybrid", "on-site", "onsite")

LOCATION_TYPE = "struct<city:string,state:string,country:string,is_remote:int>"


def state_code(name: Column) -> Column:
    """Code of a US state name in any letter case, null if it is none."""
    return lookup(US_STATE_NAMES, F.lower(name))


def _tokens(raw: Column) -> Column:
    """Comma-separated parts without parentheses, blanks and workplace words.

    (?d): only a line feed ends a line, so a dot matches every other separator.
    """
    bare = F.regexp_replace(raw, r"(?d)\(.*?\)", "")
    parts = F.transform(F.split(bare, ","), strip)
    return F.filter(parts, lambda p: (p != "") & ~F.lower(p).isin(*WORKPLACE_WORDS))


def _last_token(tokens: Column) -> Column:
    """The last token in upper case and the country of the region it is a code of."""
    last = F.upper(F.get(tokens, F.size(tokens) - 1))
    return F.struct(tokens.alias("tokens"), last.alias("last"),
                    lookup(REGION_COUNTRIES, last).alias("region_of"))


def _with_country(end: Column) -> Column:
    """What the last token says: a country, or a region code that settles everything.

    A province code needs a token before it; alone it counts as a country code.
    """
    settles = (end["region_of"] == "US") | (F.size(end["tokens"]) >= 2)
    region_of = F.when(settles, end["region_of"])
    two_letters = F.when(end["last"].rlike(r"^\p{L}{2}\z"), end["last"])
    return F.struct(
        end["tokens"].alias("tokens"),
        F.when(region_of.isNotNull(), end["last"]).alias("code"),
        F.coalesce(lookup(COUNTRY_NAMES, end["last"]), region_of, two_letters).alias("country"))


def _with_state(head: Column) -> Column:
    """The last token left once the country is taken off, and what region it names."""
    n = F.size(head["tokens"])
    left = F.when(head["country"].isNotNull(), n - 1).otherwise(n)
    token = F.get(head["tokens"], left - 1)
    return F.struct(left.alias("left"), F.upper(token).alias("code"),
                    lookup(REGION_COUNTRIES, F.upper(token)).alias("region_of"),
                    state_code(token).alias("named"))


def _place(head: Column) -> Column:
    """A trailing code names the city right before it; otherwise the first token left does."""
    tokens = head["tokens"]

    def settle(tail: Column) -> Column:
        by_code = tail["region_of"].isNotNull()
        state = F.when(by_code, tail["code"]).otherwise(tail["named"])
        used = F.when(by_code | tail["named"].isNotNull(), 1).otherwise(0)
        return F.struct(
            F.when(tail["left"] > used, F.get(tokens, F.lit(0))).alias("city"),
            state.alias("state"),
            F.coalesce(head["country"], tail["region_of"],
                       F.when(tail["named"].isNotNull(), F.lit("US"))).alias("country"))

    settled = F.struct(F.get(tokens, F.size(tokens) - 2).alias("city"),
                       head["code"].alias("state"), head["country"].alias("country"))
    return F.when(head["code"].isNotNull(), settled).otherwise(bind(_with_state(head), settle))


def is_remote(raw: Column) -> Column:
    """1 if the text mentions remote work, parentheses included."""
    return F.coalesce(F.lower(raw).contains("remote").cast("int"), F.lit(0))


def parse_location(raw: Column) -> Column:
    """Struct of city, state, country and is_remote (int)."""
    tokens = _tokens(F.coalesce(raw, F.lit("")))
    place = bind(bind(bind(tokens, _last_token), _with_country), _place)
    return bind(place, lambda p: F.struct(
        p["city"].alias("city"), p["state"].alias("state"), p["country"].alias("country"),
        is_remote(raw).alias("is_remote")))
