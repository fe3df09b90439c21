from __future__ import annotations

import html
import random
from html import entities
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from tidemark.functions.expressions import join_tags, or_empty, strip_quotes
from tidemark.functions.markup import characters, resolve_link
from tidemark.operators import chains
from tidemark.workspace import written
from tidemark.operators.inventory import exists_in
from tidemark.operators.pages import (
    chained_records,
    existing_links,
    extract_records,
    follow_chain,
    next_links,
    page_links,
    parse_pages,
)

BASE = "https://site.example/list/page"
PAGE = """<html><body>
<div class="wide quote"><span class="text">“One &amp; <b>two</b> ”</span>
  <small class="author"> A. Author </small><div class="tags"><a class="tag">x</a> <a class="tag top"> y </a><a>no</a></div></div>
<div id='a>b' CLASS='quote'><span class=text>“No author<!-- c --> here”</span><div class="tags"></div></div>
<div class="quoted"><span class="text">no box of its own</span></div>
<script>var s = '<div class="quote"></div>';</script>
<ul><li class="next"><a href="/page/2/">Next</a></li></ul></body></html>"""


@pytest.fixture
def pages(spark):
    return lambda *rows: spark.createDataFrame(list(rows), "url string, html string")


def test_records(pages):
    given = pages((BASE, PAGE), ("https://e.example/", "<p>none"), ("https://n.example/", None), (None, PAGE))
    parsed = parse_pages(given)
    found = sorted((r.url or "", r.quote_text, r.author, r.tags) for r in extract_records(parsed).collect())
    records = [("One &two", "A. Author", "x, y"), ("No author here", "", "")]
    assert found == sorted((u, *r) for u in ("", BASE) for r in records)
    links = {(BASE, "https://site.example/page/2/"), ("https://e.example/", None), ("https://n.example/", None), (None, None)}
    assert {tuple(r) for r in parsed.select("url", "next_url").collect()} == links
    assert {tuple(r) for r in next_links(given).collect()} == links
    fixed = next_links(pages((BASE, PAGE)), base_url="https://other.example/").first()
    assert fixed.next_url == "https://other.example/page/2/"
    plan = parsed._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


SCOPE = [
    # A tag list beside the last quote, and tag links of a box outside its list.
    ("""<div class="quote"><span class="text">a</span><a class="tag">out</a><div><div class="tags"><a class="tag">in</a></div></div>
<a class="tag">out</a></div><div class="tags"><h2>Top</h2><a class="tag">love</a></div><a class="tag">x</a>""", [("a", "", "in")]),
    # No text or author in the box, but after it.
    ('<div class="quote"><div>b</div></div><span class="text">no</span><small class="author">no</small>', [("", "", "")]),
    ('<div class="quote"><span class="text">1</span></div><small class="author">no</small>'
     '<div class="quote"><small class="author">A</small></div>', [("1", "", ""), ("", "A", "")]),
    # A box in a box; what looks like a tag in a value; a tag that closes itself; one closing tag too many.
    ('<div class="quote"><div class="quote"><span class="text">in</span></div><small class="author">B</small></div>',
     [("in", "B", ""), ("in", "", "")]),
    ('<div class="quote"><p title="</div><div>"><span class="text">c</span></div><span class="author">no</span>', [("c", "", "")]),
    ('</div><div class="quote"><div/><span class="text">d</span></div><small class="author">no</small>', [("d", "", "")]),
    ('<div class="quote"/><span class="text">no</span>', [("", "", "")]),
    # A list around the box, a list in a list, a box that never closes.
    ('<div class="tags"><div class="quote"><a class="tag">e</a></div><a class="tag">no</a></div>', [("", "", "e")]),
    ('<DIV class="quote"><div class="tags"><div class="tags"><a class="tag">f</a></div><a class="tag">g</a></div></DIV >', [("", "", "f, g")]),
    ('<div class="quote"><div class="tags"><a class="tag">h</a>', [("", "", "h")]),
    # A field and a tag that never close; a quote sign that is no quoted value; a value that never closes.
    ('<div class="quote"><small class="author">i<b>j</b><div class="tags"><a class="tag">k</div></div><p>no', [("", "ijk", "k")]),
    ("<div class=quote><p don't><span class='big text'>l</span>it's</div>", [("l", "", "")]),
    ('<div class="quote"><span class="text">m</span></div><div class="quote><span class="text">no', [("m", "", "")]),
    # Words that only begin or end alike; brackets in prose.
    ('<div class="quote"><span class="texts">no</span><span class="a-text">no</span><span class=" x text ">1 < 2 > 0</span></div>', [("1 < 2 > 0", "", "")]),
]


def test_records_keep_to_their_box(pages):
    rows = [(f"{BASE}{i}", h) for i, (h, _) in enumerate(SCOPE)]
    found = {}
    for r in extract_records(parse_pages(pages(*rows))).collect():
        found.setdefault(r.url, []).append((r.quote_text, r.author, r.tags))
    assert [found[u] for u, _ in rows] == [records for _, records in SCOPE]


NEXT = [
    ('<a rel="next" href="p2">n</a><li class="next"><a href="/other"></a></li>', "https://site.example/list/p2"),
    ('<li class="next"><span><a href="/x"></a></span></li>', None),
    ('<a rel=next>n</a><li class="next"><a href="/x"></a></li>', None),
    ('<a rel="next nofollow" href="/x"></a>', None),
    ("", None),
    ('<li class="last next"><b>x</b><a href="../up?q=1#f">n', "https://site.example/up?q=1#f"),
    ("<A HREF='it&#39;s&amp;x' REL='next'>", "https://site.example/list/it's&x"),
    ("<!-- <a rel=next href=/no> --><a href=yes rel=next>", "https://site.example/list/yes"),
    ('<a title=" rel=next" href="/no"></a><li class="next"><i><b>x</b></i><br><img src="/"><a href="/deep"></a></li>', "https://site.example/deep"),
    ('<li class="next"><p><a href="/no"></a></p></li><a href="/no"></a><li class="next"><a href="/later"></a>', "https://site.example/later"),
    ('<li class="next"><ul><li class="next"></li></ul><a href="/outer"></a></li>', "https://site.example/outer"),
    ('<a rel="next">no link</a>', None),
]

LONG = 1_000_000


@pytest.mark.parametrize("markup, records, link", [
    ('<div class="quote"><span class="text">a</span></div><a ' + "x " * (LONG // 2), [("a", "", "")], None),
    ('<div class="quote"><span class="text">a</span></div>' + "<a " * (LONG // 3), [("a", "", "")], None),
    ('<li class="next">' + "text " * (LONG // 5) + '<a href="/n">', [], "https://site.example/n"),
    (f'<a title="{"y " * (LONG // 2)}" rel="next" href="/n">', [], "https://site.example/n"),
    (f'<a rel="next" href="/{"z" * LONG}">', [], f"https://site.example/{'z' * LONG}"),
    ('<div class="quote"><span class="text">a</span><a title="' + "v>" * (LONG // 2), [("a", "", "")], None),
    ('<div class="quote"><span class="text">' + " " * LONG + "b" + " " * LONG + "c</span></div>", [(f"b{' ' * LONG}c", "", "")], None),
    ("<!--" * (LONG // 4), [], None),
    ("<script>" * (LONG // 8), [], None),
    (f'<div class="{"w " * (LONG // 2)}quote"><small class="author">A', [("", "A", "")], None),
])
def test_long_pages(pages, markup, records, link):
    row = parse_pages(pages((BASE, markup))).first()
    assert [tuple(r) for r in row.records] == records and row.next_url == link


def test_long_anchors(spark):
    texts = ["<a " + "x" * LONG, "<a href=/1>" + "<a href='" * 1000 + "y" * LONG, f'<a class="{"q " * (LONG // 2)}" href="/2">', "<" * LONG]
    frame = spark.createDataFrame([(i, BASE, t) for i, t in enumerate(texts)], "page_id long, url string, html string")
    found = {(r.page_id, r.link[:24]) for r in page_links(frame).collect()}
    assert {(1, "https://site.example/1"), (2, "https://site.example/2")} <= found and {i for i, _ in found} == {1, 2}


def test_next_links(pages):
    rows = [(f"{BASE}{i}", h) for i, (h, _) in enumerate(NEXT)]
    found = {r.url: r.next_url for r in next_links(pages(*rows)).collect()}
    assert [found[u] for u, _ in rows] == [link for _, link in NEXT]


def test_page_links(spark):
    markup = """<a href="it's">1</a><A HREF=/two>2</A><a class='>' href='?x=1&amp;y=2'>3</a><!-- <a href="/no"> --><a name=x>4</a>"""
    frame = spark.createDataFrame([(1, "https://h.example/d/e?q", markup), (2, "https://h.example", None)], "page_id long, url string, html string")
    assert {r.link for r in page_links(frame).collect()} == {
        "https://h.example/d/it's", "https://h.example/two", "https://h.example/d/e?x=1&y=2"}


HREFS = ["/a", "//o.example/b", "http://x.example", "c", "mailto:a@b", "#top", "?p=2", "", "../c", "./d", "../../../e", "a/../b/./c/",
         "..", ".", "a//b", "/x/../y?z#w", "g;x=1", "?#", "/.", "./", "a/..", "https://h.example:8/q/../r"]


@pytest.mark.parametrize("base", ["https://h.example:8/d/e?x=/y/", "https://h.example/a/b/c/", "http://h.example"])
def test_resolve_link(spark, base):
    rows = spark.createDataFrame([(base, h) for h in HREFS], "base string, href string")
    found = {r.href: r.link for r in rows.select("href", resolve_link(F.col("base"), F.col("href")).alias("link")).collect()}
    hrefs = [h for h in HREFS if h not in ("?#",)]
    assert {h: found[h] for h in hrefs} == {h: urljoin(base, h) for h in hrefs}


def test_characters(spark):
    texts = ["a &amp; b", "&lt;b&gt;", "&#8220;x&#x201d;", "&copy 2", "&unknown; &", "&&amp;amp;", "&#0; &#xZZ;", "", "&#128512;!"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", characters(F.col("t")).alias("c")).collect()
    expected = {t: html.unescape(t) for t in texts} | {"&#0; &#xZZ;": "&#0; &#xZZ;"}
    assert {r.t: r.c for r in rows} == expected


def test_all_named_characters(spark):
    texts = [f"a&{name} b" for name in entities.html5] + [
        "&aacute;&iacute;&oacute;&uacute;&ecirc;&Eacute;&Uuml;&rarr;", "&aacute &iacute &Uuml &rarr &euro", "caf&eacutes &notit; &notin; &copy2"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", characters(F.col("t")).alias("c")).collect()
    assert {r.t: r.c for r in rows} == {t: html.unescape(t) for t in texts}


def test_named_characters_of_pages(pages, spark):
    page = '<div class="quote"><span class="text">caf&eacute; &Uuml;ber &aacute</span><small class="author">Jos&eacute; N&uacute;&ntilde;ez</small>' \
        '<div class="tags"><a class="tag">&ecirc;tre</a></div></div><a rel="next" href="/&Eacute;t&ecirc;?a=1&copy=2&notify=3&amp;b=&reg;&uuml">n</a>'
    row = parse_pages(pages((BASE, page))).first()
    assert tuple(row.records[0]) == ("café Über á", "José Núñez", "être")
    assert row.next_url == "https://site.example/Étê?a=1&copy=2&notify=3&b=®ü"


def test_text_expressions(spark):
    row = spark.sql("SELECT '“a”b”' AS q, array('x', 'y') AS t, CAST(NULL AS string) AS n").select(
        strip_quotes(F.col("q")), join_tags(F.col("t")), or_empty(F.col("n"))
    ).first()
    assert tuple(row) == ("a”b", "x, y", "")


def walk(seeds, links):
    result = set()
    for seed in seeds:
        page, depth, seen = seed, 0, set()
        while page is not None and page not in seen:
            result.add((seed, page, depth))
            seen.add(page)
            page, depth = links.get(page), depth + 1
    return result


@pytest.mark.parametrize("links, seeds", [
    ({1: 2, 2: 3, 3: None, 7: 8}, [1, 7, 9]),
    ({1: 2, 2: 3, 3: 1}, [1, 2]),                      # a circle
    ({1: 2, 2: 3, 3: 4, 4: 3, 9: 9}, [1, 9]),          # a walk into a circle, a page linking to itself
    ({i: 100 for i in range(1, 40)} | {100: 101}, list(range(1, 40))),   # many walks through one page
    ({i: i + 1 for i in range(45)}, [0, 20]),
    ({9: 9}, [9]),
    ({i: (i + 1) % 5 for i in range(5)} | {10: 11, 11: 3, 12: 11, 20: 20, 21: 20}, [0, 3, 10, 12, 21, 4]),   # circles with trees
    ({i: i + 1 for i in range(30)} | {100 + i: i for i in range(30)}, [100 + i for i in range(30)]),   # a walk entering at every page
    ({}, [5]),
    ({1: 2}, []),
])
def test_follow_chain(spark, links, seeds):
    found = follow_chain(
        spark.createDataFrame([(s,) for s in seeds], "page long"),
        spark.createDataFrame(list(links.items()), "page long, next_page long"),
    )
    assert sorted(map(tuple, found.collect())) == sorted(walk(seeds, links))


def test_follow_chain_on_random_links(spark):
    draw = random.Random(3)
    links = {f"p{i}": f"p{draw.randrange(60)}" for i in range(50)}
    seeds = [f"p{i}" for i in range(0, 60, 7)]
    found = follow_chain(
        spark.createDataFrame([(s,) for s in seeds], "page string"),
        spark.createDataFrame(list(links.items()), "page string, next_page string"),
    )
    assert sorted(map(tuple, found.collect())) == sorted(walk(seeds, links))


def test_walks_that_run_together_are_stored_once(spark, monkeypatch):
    rows = []

    def counted(df, path, **options):
        table = written(df, path, **options)
        rows.append(table.count())
        return table

    monkeypatch.setattr(chains, "written", counted)
    seeds = spark.range(10_000, 11_000).select(F.col("id").alias("page"))
    links = spark.range(1000).select(F.col("id").alias("page"), (F.col("id") + 1).alias("next_page")).unionByName(
        seeds.select("page", F.pmod("page", F.lit(1000)).alias("next_page")))
    found = chains.follow_chain(seeds, links)
    assert max(rows) <= 2001 and sum(rows[-3:]) <= 5000   # no table holds more than pages and seeds
    assert found.count() == 1000 * 2 + 1000 * 1001 // 2
    assert found.agg(F.max("depth")).first()[0] == 1001


def test_a_page_with_several_links_follows_the_smallest(spark):
    links = spark.createDataFrame([(1, 3), (1, 2), (1, 2), (2, None), (None, 1)], "page long, next_page long")
    seeds = spark.createDataFrame([(1,), (1,), (None,)], "page long")
    assert sorted(map(tuple, chains.follow_chain(seeds, links).collect())) == [(1, 1, 0), (1, 2, 1)]


def test_records_along_next_links(spark):
    def page(n, link):
        return (f"https://q.example/{n}", f'<div class="quote"><span class="text">“{n}”</span></div>{link}')

    pages = spark.createDataFrame([
        page(1, '<li class="next"><a href="/2">n</a></li>'), page(2, '<a rel="next" href="3">n</a>'),
        page(3, '<a rel="next" href="gone">n</a>'), page(9, ""), ("https://q.example/none", None),
    ], "url string, html string")
    seeds = spark.createDataFrame([("https://q.example/1",), ("https://q.example/unknown",)], "url string")
    found = chained_records(pages, seeds)
    assert sorted((r.depth, r.url[-1], r.quote_text) for r in found.collect()) == [
        (0, "1", "1"), (1, "2", "2"), (2, "3", "3")
    ]


def test_links_to_missing_pages_end_a_walk(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (3, None)], "page long, next_page long")
    pages = spark.createDataFrame([(1,), (2,)], "page long")
    assert [tuple(r) for r in existing_links(links, pages).collect()] == [(1, 2)]


def test_exists_in(spark):
    listed = spark.createDataFrame([("a",), ("a",), ("b",)], "key string")
    asked = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "key string")
    assert {tuple(r) for r in exists_in(asked, listed).collect()} == {("a", True), ("z", False), (None, False)}
