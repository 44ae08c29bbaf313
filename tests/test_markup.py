"""The page tokenizer against the standard library's parser and on odd pages."""

import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from civiclake.functions.markup import page, tokens
from civiclake.operators import text


class Plain(HTMLParser):
    """The library's tokens, texts joined."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out = []

    def handle_starttag(self, tag, attrs):
        kept = {}
        for k, v in attrs:
            kept.setdefault(k, v or "")
        self.out.append(("start", tag, kept))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.out.append(("end", tag, None))

    def handle_data(self, data):
        self.out.append(("text", data, None))

    def handle_comment(self, data):
        self.out.append(("cut", "", None))

    handle_decl = handle_pi = unknown_decl = handle_comment


def merged(items):
    out = []
    for kind, what, more in items:
        kind = "text" if kind == "raw" else kind
        if kind == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + what, None)
        elif kind != "cut":
            out.append((kind, what, more))
    return out


def library(html):
    p = Plain()
    p.feed(html)
    p.close()
    return merged([x for x in p.out if x[0] != "cut"])


PIECES = [
    "<p>", "</p>", "<br/>", "<a href=\"/x?a=1&amp;b=2\" title='x > y'>", "</a>", "text &amp; more &lt;b&gt; ", "&copy &eacute; &#233; &#xE9;", "<!-- a > b -->", "<!DOCTYPE html>", "<script>if (a < b && c) { '</p>' }</script>",
    "<style>p > a { }</style>", "a < b ", "<IMG SRC=x.png ALT=\"a 'b'\">", "<input disabled value = 7 >", "<h2 class=\"t\">", "</h2 >", "<td a=1 a=2>", "<x-y z='&quot;q&quot;'>", "\n\t", "é東😀", "<!---->", "<title>a &amp; b</title>", "<a\nhref=y\n>",
]


def test_tokens_are_the_library_s():
    rnd = random.Random(7)
    for _ in range(3000):
        html = "".join(rnd.choice(PIECES) for _ in range(rnd.randint(1, 12)))
        if html.rstrip(" \n\t").endswith("<"):
            continue
        assert merged(tokens(html)) == library(html), html


@pytest.mark.parametrize(
    "html, want",
    [
        ("", []), ("<", [("text", "<", None)]), ("a<3", [("text", "a<3", None)]), ("x<p", [("text", "x", None)]), ('x<p a="', [("text", "x", None)]), ("<p a='1' b=>t", [("start", "p", {"a": "1", "b": ""}), ("text", "t", None)]),
        ("</>x</ y>z", [("text", "x", None), ("text", "z", None)]), ("<?php a ?>z", [("text", "z", None)]), ("<!-->a<!--->b<!-- c --!>d<!-- e", [("text", x, None) for x in "abd"]),
        ("<script>a</scripty></SCRIPT >b", [("start", "script", {}), ("raw", "a</scripty>", None), ("end", "script", None), ("text", "b", None)]), ("<script>never", [("start", "script", {}), ("raw", "never", None)]),
        ("<p/a/b=1/>", [("start", "p", {"a": "", "b": "1/"})]), ("<p =x>", [("start", "p", {"=x": ""})]), ("x<p a= 'open", [("text", "x", None)]), ("&am", [("text", "&am", None)]), ("&amp", [("text", "&", None)]),
    ],
)
def test_odd_pages(html, want):
    assert list(tokens(html)) == want


def test_parts_of_odd_pages(spark):
    html = """<meta content='a > &quot;b&quot;' name="Description"><title>T &amp; &lt;b&gt;</title><title>no</title><body><h1>One <i>two</i>
    three</h1><noscript><a href="/no">n</a></noscript><a title="x > y" href="/q?a=1&amp;b=2">go <b>there</b></a><!-- <a href=c> --><a name=k>k</a><h3></h3><h2>open"""
    rows = [(1, "http://A.gov/x", html), (2, "u", None), (3, "u", ""), (4, None, "<a href=z>z</a> plain")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in text.page_parts(pages).collect()}
    r = got[1]
    assert (r.title, r.description, r.headings) == ("T & <b>", 'a > "b"', ["One two three", "open"])
    assert [tuple(x) for x in r.links] == [("/q?a=1&b=2", "go there")] and "n" not in r.text.split() and "no" in r.text.split()
    assert got[2].title is None and got[2].links is None and (got[3].title, got[3].text, got[3].links) == ("", "", [])
    links = text.page_links(pages).where("page_id = 1").collect()
    assert [(x.place, x.link, x.kind, x.told) for x in links] == [(0, "http://a.gov/q?a=1&b=2", "internal", "go there")]
    many = "".join(f"<a href=/{i % 3}#s{i}>{i}</a>" for i in range(9))
    rows = text.page_links(spark.createDataFrame([(1, "http://a.gov", many)], pages.schema)).orderBy("place").collect()
    assert [(x.place, x.link, x.told) for x in rows] == [(i, f"http://a.gov/{i}", str(i)) for i in range(3)]
    assert page("<a href=x>" * 5)[4] == [{"href": "x", "told": ""}] * 5
    assert text.page_parts(pages.where(F.lit(False))).count() == 0


def test_xml_replies_are_parsed_once_and_dealt_out(spark):
    from civiclake.sources import io

    texts = ["<r><t><SSL>7 <b>x</b>&amp;</SSL><WARD>Ward 2</WARD></t><SSL>8</SSL></r>", "<SSL><![CDATA[<1>]]><!-- no --></SSL>", '<r xmlns="u" xmlns:p="v"><p:SSL>1</p:SSL><SSL> 2 </SSL><WARD/></r>', None]
    tags = ("SSL", "WARD", "ZIP")
    rows = spark.createDataFrame([(x,) for x in texts * 20], "x string").coalesce(1)
    got = io.location_rows(rows, "x", tags)
    want = rows.select(*io.location_reply(F.col("x"), tags))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.columns == ["ssl", "ward", "zip"]
    # One task no longer holds all rows of a small file.
    assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_records_are_made_in_several_tasks(spark):
    from civiclake.operators import ingest

    rows = spark.range(400).select(F.col("id").alias("SSL"), F.lit("20001").alias("ZIPCODE"), F.lit("Ward 3").alias("WARD")).coalesce(1)
    good = ingest.ingest(rows, ingest.sources()["locations"])[0]
    assert good.count() == 400 and good.select(F.spark_partition_id().alias("p")).distinct().count() > 1
