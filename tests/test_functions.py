"""Goldens of the scalar functions."""

import sys
import unicodedata
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from hirelake.functions import labels, location, slugs, text


def values(spark, fn, inputs):
    """fn applied to each input, in input order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r.out for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


LOCATIONS = [
    # raw, city, state, country, is_remote
    ("San Francisco, CA", "San Francisco", "CA", "US", 0),
    ("New York, NY, US", "New York", "NY", "US", 0),
    ("Austin, Texas", "Austin", "TX", "US", 0),
    ("US, Remote", None, None, "US", 1),
    ("Toronto, ON, Canada", "Toronto", "ON", "CA", 0),
    ("London, England, United Kingdom", "London", None, "UK", 0),
    ("Jakarta, INDONESIA, Indonesia", "Jakarta", None, None, 0),
    (None, None, None, None, 0),
    ("", None, None, None, 0),
    ("New York, NY (HQ)", "New York", "NY", "US", 0),
    ("Berlin, DE", "Berlin", "DE", "US", 0),
    ("Vancouver, BC, CA", "BC", "CA", "US", 0),
    ("Amsterdam, NL", "Amsterdam", "NL", "CA", 0),
    ("New York", None, "NY", "US", 0),
    ("ON", None, None, "ON", 0),
    ("Paris, FR", "Paris", None, "FR", 0),
    ("Remote - US", "Remote - US", None, None, 1),
    ("(Remote)", None, None, None, 1),
    ("Hybrid, Austin, TX", "Austin", "TX", "US", 0),
    ("London, GB", "London", None, "GB", 0),
    ("Springfield, Greene, MO", "Greene", "MO", "US", 0),
    ("Springfield, Greene, Missouri", "Springfield", "MO", "US", 0),
    # the parenthesis spans a carriage return but no line feed
    ("Oslo (a\rb), NO", "Oslo", None, "NO", 0),
    (" Boston , MA ", "Boston", "MA", "US", 0),
    ("Lyon, FR, Remote, ", "Lyon", None, "FR", 1),
    ("QC, Canada", None, "QC", "CA", 0),
    ("Washington, usa", None, "WA", "US", 0),
    ("TX", None, "TX", "US", 0),
    ("Zürich, ÖÜ", "Zürich", None, "ÖÜ", 0),
]


def test_parse_location(spark):
    got = values(spark, location.parse_location, [row[0] for row in LOCATIONS])
    assert [tuple(g) for g in got] == [row[1:] for row in LOCATIONS]


EXPERIENCE = {
    "Senior Software Engineer": "senior", "Entry Level Developer": "entry",
    "Software Engineering Intern": "internship", "New Grad Software Engineer": "entry",
    "Staff Engineer": "senior", "Software Engineer": "unknown",
    "Director of Engineering": "executive", "Internal Auditor": "internship",
    "Carpentry": "entry", "Midwest Sales": "mid", "Sr. Director": "senior",
    "VP, Sales": "unknown", "VP Sales": "executive", "JR Dev": "junior",
    "Head of Data": "executive", "": "unknown", None: "unknown",
}


def test_experience_level(spark):
    got = values(spark, labels.experience_level, list(EXPERIENCE))
    assert got == list(EXPERIENCE.values())


EMPLOYMENT = {
    "Full Time": "full-time", "FullTime": "full-time", "PartTime": "part-time",
    "Intern": "internship", "Contract": "contract", "permanent": "full-time",
    None: "full-time", "": "full-time", "Temporary": "contract", "temporary": "full-time",
    "parttime": "full-time", " contract": "full-time", "CO-OP": "internship",
    "Part-Time": "part-time", "whatever": "full-time",
}


def test_employment_type(spark):
    got = values(spark, labels.employment_type, list(EMPLOYMENT))
    assert got == list(EMPLOYMENT.values())


SLUGS = {
    "figma": True, "1password": True, "air-tek": True, "perfect-venuehttps:": True,
    "1password?department=eng": False, "figma&utm_source=foo": False, "co=bar": False,
    "": False, "a": False, "12345": False, "113134": False, "robots.txt": False,
    "embed": False, "Embed": False, "WIDGET": False, "sitemap.xml": False,
    "api-docs": False, "static-files": False, "apiary": False, "Apiary": True,
    "my company": False, "figma#section": False, None: False, "²³": False, "١٢٣": False,
    "12a": True, "12\n": True,
}


def test_is_valid_slug(spark):
    got = values(spark, slugs.is_valid_slug, list(SLUGS))
    assert dict(zip(SLUGS, got)) == SLUGS


def test_digit_slugs_follow_unicode(spark):
    chars = [chr(c) for c in range(sys.maxunicode + 1)
             if unicodedata.category(chr(c)) in ("Nd", "No", "Nl")]
    # Java and Python ship different Unicode versions; compare characters Java knows.
    known = values(spark, lambda c: c.rlike(r"^[\p{N}]{2}\z"), [c * 2 for c in chars])
    got = values(spark, slugs.is_valid_slug, [c * 2 for c in chars])
    wrong = [c for c, k, g in zip(chars, known, got) if k and g == c.isdigit()]
    assert wrong == []


def test_decode_slug(spark):
    raw = ["my%20company", "My-Co", "a+b", "a%zzb", "%C3%A9t%C3%A9", "a%20b+%zz", "100%",
           "%2b", "%E2%82", "a%2Fb", "%%41"]
    assert values(spark, slugs.decode_slug, raw) == [unquote(r).lower() for r in raw]


HOSTS = {"lever.co": "lever", "greenhouse.io": "greenhouse", "ashbyhq.com": "ashby"}
REDIRECTS = {
    "https://jobs.lever.co/figma/abc-123": ("lever", "figma"),
    "https://boards.greenhouse.io/discord/jobs/456": ("greenhouse", "discord"),
    "https://jobs.ashbyhq.com/ramp/abc-def": ("ashby", "ramp"),
    "https://dollartree.wd5.myworkdayjobs.com/dollartreeus/job/blah": None,
    "https://careers.example.com/jobs/123": None,
    "https://jobs.lever.co/robots.txt": None,
    "https://jobs.lever.co/Figma/abc-123": ("lever", "figma"),
    "https://jobs.ashbyhq.com/my-company/abc": ("ashby", "my-company"),
    "https://jobs.ashbyhq.com/my%20company/abc": None,
    "https://JOBS.LEVER.CO:443//figma//x": ("lever", "figma"),
    "https://user:pw@jobs.lever.co/figma?x=/y#z": ("lever", "figma"),
    "//jobs.lever.co/figma;v=1": ("lever", "figma"),
    "https://jobs.lever.co/fig;ma/x;y": ("lever", "fig;ma"),
    "https://clever.com/school": ("lever", "school"),
    "https://clever.community/school": ("lever", "school"),
    "https://under_score.lever.co/ab%zz": ("lever", "ab%zz"),
    "jobs.lever.co/figma": None,
    "https://jobs.lever.co": None,
    None: None,
}


def test_redirect_target(spark):
    got = values(spark, lambda c: slugs.redirect_target(c, HOSTS), list(REDIRECTS))
    assert [tuple(g) if g else None for g in got] == list(REDIRECTS.values())


def test_redirect_target_exact_domain(spark):
    urls = ["https://clever.community/school", "https://jobs.lever.co/a1", "https://lever.co/a1"]
    got = values(spark, lambda c: slugs.redirect_target(c, HOSTS, exact_domain=True), urls)
    assert [tuple(g) if g else None for g in got] == [None, ("lever", "a1"), ("lever", "a1")]


def test_strip_equals_python(spark):
    chars = [c for c in map(chr, range(0x3100)) if c.isspace()] + ["​", "﻿", "᠎"]
    raw = [f"{c}x {c}y{c}" for c in chars]
    assert values(spark, text.strip, raw) == [r.strip() for r in raw]


def test_content_hash(spark):
    rows = [("Engineer", "Acme", "NYC", None), (" Ünï ", "A|b", "", ""),
            ("T", "c", "l", "é😀" * 400), (" T\n", "C", "L", " d ")]
    df = spark.createDataFrame(rows, "t string, c string, l string, d string")
    got = [r[0] for r in df.select(text.content_hash(
        F.col("t"), F.col("c"), F.col("l"), F.col("d"))).collect()]

    # sha256 of: engineer|acme|nyc; ünï|a|b|; t|c|l|é😀... (500 characters); t|c|l| d
    assert got == ["b1d02ff1e1812b27", "8e608f60ebb9104c",
                   "cddd65ad7a9d1e80", "d358a7a943f503fd"]
    assert len(set(got)) == len(rows)


HTML = {
    None: None, "": None,
    "<p>Hello <b>world</b></p>": "Hello\nworld",
    "plain": "plain",
    "  <p> </p> ": "",
    "a<!-- <p>x</p> -->b": "a\nb",
    "<script>var t='</p>';</script>x<style>p{}</style>": "x",
    "<SCRIPT type=a>1</script >y": "y",
    "<template><b>no</b></template>yes": "yes",
    '<a title="1 > 0" href=\'x\'>t</a>': "t",
    "1 < 2 and 3 > 2": "1 < 2 and 3 > 2",
    "<p>AT&amp;T &copy; &middot;&nbsp;</p>": "AT&T © ·",
    "&lt;p&gt;Hi&lt;/p&gt;": "<p>Hi</p>",
    "&amp;lt;": "&lt;",
    "&#39;&#x2019;&#128512;&#146;": "'’😀’",
    "&bogus; &apos;&hellip;": "&bogus '…",
    "AT&T & co": "AT&T & co",
    "<!DOCTYPE html><p>x</p><?pi?>": "x",
    "x<br/>y<br>z": "x\ny\nz",
    "&nbsp;<p> </p>": "",
}


def test_html_to_text(spark):
    got = values(spark, text.html_to_text, list(HTML))
    assert dict(zip(HTML, got)) == HTML


def test_html_unescape_first(spark):
    raw = ["&lt;p&gt;Hi &amp;amp; bye&lt;/p&gt;"]
    assert values(spark, lambda c: text.html_to_text(c, unescape_first=True), raw) == ["Hi & bye"]


def test_long_markup_does_not_overflow(spark):
    raw = ["<p " + 'a="b" ' * 50_000 + ">x</p>" + "<!--" + "y" * 500_000 + "-->z"]
    assert values(spark, text.html_to_text, raw) == ["x\nz"]


@pytest.mark.parametrize("name,code", [("Texas", "TX"), ("district of columbia", "DC"), ("x", None)])
def test_state_code(spark, name, code):
    assert values(spark, location.state_code, [name]) == [code]
