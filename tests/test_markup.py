"""Body extraction in columns against the standard library's parser."""

import html as stdlib
import random

from pyspark.sql import functions as F

from tests.plain_html import extract_body
from wryspark.functions.markup import unescaped
from wryspark.operators.articles import extract_articles

PAGES = [None, "", "no tags", "<p>Hi <b>x</b> tail</p><div>no</div><p>Sign Up now</p><i>z</i>",
         "<html><head><title>T &amp; U</title><script>var t='</p>';</script></head><body><p><b>Head<br><p>Para one."
         "<!-- c --></p><p>HuffPost ad</p></body></html>",
         "<p>a < b Sign Up</p><p>kept < too</p>", "<p>one <!-- Sign Up --> two</p>", "<p>a<p", "<p>a</p", "<p>a<!-- x", "<p>a<",
         '<p>a<div class="x', "<p>a<!DOCTYPE", "<p>a<!x> b", "<p>a</ b>c", "<p>a</>c", "<p>1<2 <3>4", "<<b>x", "<p>a<script>x<p>",
         "<title> a</title>d<title>b </title>", '<p title="a>b">x', "<p/>z<br/>w<p>v<br/>u", "<p>a<P>b</P >c", "<p-x>a</p-x>",
         "<a\n href=x>y<i\n>z", "</p x>z", "<p>q<script>a</scripty></script >b", "<p>a<SCRIPT>a</Script>b", "<p><em>a</p>b</em>c",
         "<p>&lt;p&gt; &copyx; &#65;&#x41 &#128;&#0;&notit; &am", "<p>a&", "<p>&amp;amp; & &;&&amp</p>", "<b>" * 300 + "deep" + "</b>" * 299 + "x",
         "<p>" + "long " * 50_000 + "</p>", "<p " + "a='b' " * 3000 + ">many attributes", "<p " + "x" * 100_000, "<style>p{}</style><p>é ß 😀"]


def random_page(rng):
    parts = ["<p>", "</p>", "<b>", "</b>", "<i>", "</i>", "<em>", "</em>", "<div class='a>b'>", "</div>", "<br>", "<br/>", "<p/>", "<!-- c -->",
             "<title>", "</title>", "text ", " more", "&amp;", "&lt;b&gt;", "&#233;", "&eacute", "Sign Up", "<img src=\"x\">", "<a href=/x>", "</a>", "\n", "1 < 2"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))


def test_pages(spark):
    rng = random.Random(4)
    pages = PAGES + [random_page(rng) for _ in range(400)]
    df = spark.createDataFrame([(i, f"u{i}", h) for i, h in enumerate(pages)], "page_id long, url string, html string").repartition(4)
    got = {r.page_id: (r.title, r.body) for r in extract_articles(df).collect()}
    for i, h in enumerate(pages):
        assert got[i] == extract_body(h), h


def test_references(spark):
    texts = ["plain", "&amp;&lt", "&notin; &notit; &NotEqualTilde;", "&#x1F600;&#128512", "&#55296;&#x110000;&#99999999999999;", "&#150;&#x80;&#129;",
             "&#1;&#11;&#127;&#xFDD0;&#xFFFE;&#x1FFFF;&#9;&#10;&#13;", "&#x;&#;&a b&", "&#0065;&#x0041;&#000000000000000000000000065;", "&" * 50, "&amp" * 3]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.u for r in df.select("i", unescaped(F.col("t")).alias("u")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == stdlib.unescape(t), t
