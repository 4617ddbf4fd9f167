"""HTML to text against a walk over the parser events of the standard library."""

import random
from html.entities import html5
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from hirelake.functions.text import html_to_text

HIDDEN = {"script", "style", "template", "rt", "rp"}


class TextNodes(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.nodes, self.run, self.hidden = [], [], []

    def end_node(self):
        if self.run and not self.hidden:
            self.nodes.append("".join(self.run))
        self.run = []

    def handle_starttag(self, tag, attrs):
        self.end_node()
        if tag in HIDDEN:
            self.hidden.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.end_node()

    def handle_endtag(self, tag):
        self.end_node()
        if self.hidden and self.hidden[-1] == tag:
            self.hidden.pop()

    def handle_data(self, data):
        self.run.append(data)

    def handle_entityref(self, name):
        self.run.append(html5.get(name + ";", "&" + name))

    def handle_charref(self, name):
        code = int(name[1:], 16) if name[0] in "xX" else int(name)
        try:
            char = bytes([code]).decode("cp1252") if code < 256 else chr(code)
        except (UnicodeDecodeError, ValueError, OverflowError):
            char = chr(code) if code < 256 else "�"
        self.run.append(char)

    def handle_comment(self, data):
        self.end_node()

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data):
        self.end_node()
        if not self.hidden and data[:6].lower() == "cdata[":
            self.nodes.append(data[6:])


def walked(html):
    if not html:
        return None
    parser = TextNodes()
    parser.feed(html)
    parser.close()
    parser.end_node()
    return "\n".join(t for t in (n.strip() for n in parser.nodes) if t)


def spark_text(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    return [r.t for r in df.select("i", html_to_text(F.col("html")).alias("t")).orderBy("i").collect()]


def test_pages(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
             .select("html").collect()]
    assert spark_text(spark, pages) == [walked(p) for p in pages]


PIECES = [
    "<p>", "</p>", "<b class='x'>", "</b>", "<br>", "<br/>", '<a href="1>2">', "</a>", " text ",
    "x & y", "&amp;", "&lt;p&gt;", "&copy;", "&hellip;", "&zzz; ", "&#39;", "&#x2019;", "&#150;",
    "&#128512;", "<!-- c <p> -->", "<script>if (a</b>1) '<p>'</script>", "<style>p > a {}</style>",
    "<template><i>no</i></template>", " ", "\n\t", "1 < 2", "é ß", "<!DOCTYPE html>",
    "<ruby>字<rt>zi</rt></ruby>", "&NotEqualTilde; ", "&apos;",
    "<![CDATA[ a < b > &amp; <p>c</p> ]]>", "<![cdata[]]>", "<![CDATA[x] ] >",
]


@pytest.mark.parametrize("seed", range(3))
def test_fragments(spark, seed):
    rng = random.Random(seed)
    pages = ["".join(rng.choices(PIECES, k=rng.randrange(1, 14))) for _ in range(400)]
    got = spark_text(spark, pages)
    wrong = [(p, g, walked(p)) for p, g in zip(pages, got) if g != walked(p)]
    assert wrong == []


def test_cdata_is_a_text_node_of_its_own(spark):
    pages = ["a<![CDATA[b &amp; <i>c</i> > d]]>e &amp; f", "<![CDATA[ ]]>", "<!-- <![CDATA[x]]> -->y",
             "<script><![CDATA[x]]></script>z", "&lt;![CDATA[x]]&gt;", "<![CDATA[one]]><![CDATA[two]]>"]
    assert spark_text(spark, pages) == [
        "a\nb &amp; <i>c</i> > d\ne & f", "", "y", "z", "<![CDATA[x]]>", "one\ntwo"]
