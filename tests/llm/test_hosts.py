from __future__ import annotations

import duckdb
import pytest

from tidemark.llm import hosts

URLS = [
    None, "", "no host", "://", "http://", "HTTP://WWW.Example.ORG/es/x", "https://example.org/en/12?q=/es/", "http://a.org",
    "http://a.org/", "http://org/x", "http://xorg/", "https://b.com/fr/1#top", "https://com/de/", "http://B.COM/de", "x://y.com/de/?a",
    "http://a://b.org/x", "http://É.org/é\nz", "http://a.com:80/fr/", "http://u@a.org/p?x#y", "http://b.com/de/2", "http://b.com/de/3", "http://b.com/",
    "http://b.com/de/4", "http://b.com/de/5",
]


def table(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, (u, h) in enumerate(rows)], "page_id long, url string, html string, verdict string")


def by_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", [(i, u, h) for i, (u, h) in enumerate(rows)])
    return sorted(con.execute(hosts.oracle()).fetchall())


def plain_rule(host, path):
    fits = [(len(r), r, v) for r, v in hosts.RULES
            if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
    return max(fits)[1:] if fits else (None, None)


def plain_address(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:end], rest[end:]
    stop = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail[:stop]


def test_addresses_and_rules(spark):
    rows = [(u, None) for u in URLS]
    found = {r.page_id: r for r in hosts.judged(table(spark, rows)).collect()}
    for i, (url, _) in enumerate(rows):
        host, path = plain_address(url)
        assert (found[i].host, found[i].path, (found[i].rule, found[i].ruled)) == (host, path, plain_rule(host, path))
    whole = hosts.filtered(table(spark, rows))
    assert whole.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(by_sql(rows), key=str)
    verdicts = {r.page_id: r.verdict for r in whole.collect()}
    assert verdicts[URLS.index("http://b.com/")] == "block" and verdicts[0] == "allow"


#: The rules as the query's contract lists them, written out here apart from the code's.
CONTRACT = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
RULED = [
    ("http://a.org/x", "org/", "allow"), ("http://example.org/en/2", "org/", "allow"), ("http://notexample.org/en/1", "org/", "allow"),
    ("http://example.org/es/1", "example.org/es/", "block"), ("http://www.example.org/es/", "example.org/es/", "block"),
    ("http://example.org/en/1", "example.org/en/1", "block"), ("https://M.Example.org/en/17?page=2", "example.org/en/1", "block"),
    ("http://b.com/fr/1", "com/fr/", "allow"), ("http://c.com/de/1", "com/de/", "block"),
]


def test_rules_are_those_of_the_contract(spark):
    assert sorted(hosts.RULES) == sorted(CONTRACT)
    rows = [(url, None) for url, _, _ in RULED]
    whole = sorted(hosts.filtered(table(spark, rows)).select("page_id", "rule", "verdict").collect())
    assert [tuple(r) for r in whole] == [(i, rule, verdict) for i, (_, rule, verdict) in enumerate(RULED)]
    assert [(r[0], *r[3:]) for r in by_sql(rows)] == [(i, rule, verdict) for i, (_, rule, verdict) in enumerate(RULED)]


def test_blocked_paths_count_against_their_host(spark):
    rows = [("http://example.org/en/1", None), ("http://example.org/en/12", None), ("http://example.org", None)]
    verdicts = [r.verdict for r in hosts.filtered(table(spark, rows)).orderBy("page_id").collect()]
    assert verdicts == ["block"] * 3 == [r[4] for r in by_sql(rows)]


def link(host):
    return f'<a href="http://{host}/x">'


GRAPH = (
    [("http://good.org/1", link("next.net") + link("next.net")), ("http://next.net/1", link("third.net")), ("http://third.net/1", "")]
    + [("http://bad.com/de/1", "<A HREF='//next.net'>")] * 3
    + [("http://farm.net/1", link("bad.com")), ("http://farm.net/2", "<a href = https://bad.com?x>" + '<a href="/local">'), ("http://farm.net/3", link("FARM.net"))]
    + [("http://both.net/1", link("bad.com")), ("http://both.net/2", link("good.org")), ("http://lone.net/", None), (None, link("bad.com"))]
)


def pagerank(seed, edges):
    given = {h: (1 - hosts.DAMPING) * s for h, s in seed.items()}
    scores = given
    for _ in range(300):
        passed = dict(given)
        for (a, b), n in edges.items():
            total = sum(x for (c, _), x in edges.items() if c == a)
            passed[b] = passed.get(b, 0.0) + hosts.DAMPING * scores.get(a, 0.0) * n / total
        scores = passed
    return scores


def test_trust_and_distrust_along_links(spark):
    pages = table(spark, GRAPH)
    ruled = hosts.judged(pages)
    links = hosts.host_links(pages)
    edges = {(r.src, r.dst): r.pages for r in links.collect()}
    assert edges == {
        ("good.org", "next.net"): 1, ("next.net", "third.net"): 1, ("bad.com", "next.net"): 3, ("farm.net", "bad.com"): 2,
        ("both.net", "bad.com"): 1, ("both.net", "good.org"): 1,
    }
    scores = {r.host: (r.trust, r.distrust) for r in hosts.host_scores(hosts.host_seeds(ruled), links).collect()}
    trust = pagerank({"good.org": 1.0}, edges)
    distrust = pagerank({"bad.com": 1.0}, {(b, a): n for (a, b), n in edges.items()})
    for host, (t, d) in scores.items():
        assert (t, d) == pytest.approx((trust.get(host, 0.0), distrust.get(host, 0.0)))
    verdicts = {r.host: r.verdict for r in hosts.filtered(pages).collect()}
    assert verdicts["farm.net"] == "block" and verdicts["next.net"] == verdicts["lone.net"] == verdicts["third.net"] == "allow"
    assert sorted(map(tuple, hosts.filtered(pages).collect()), key=str) == sorted(by_sql(GRAPH), key=str)


CHAIN = [(f"http://h{i:02}.net/", link(f"h{i + 1:02}.net")) for i in range(15)] + [("http://h15.net/", link("bad.com"))]
RING = [(f"http://r{i}.net/", link(f"r{(i + 1) % 4}.net")) for i in range(4)]


def test_scores_converge_along_chains_and_in_rings(spark):
    rows = CHAIN + RING + [("http://bad.com/de/1", ""), ("http://good.org/", link("r0.net")), ("http://r2.net/x", link("bad.com"))]
    pages = table(spark, rows)
    links = hosts.host_links(pages)
    edges = {(r.src, r.dst): r.pages for r in links.collect()}
    scores = {r.host: (r.trust, r.distrust) for r in hosts.host_scores(hosts.host_seeds(hosts.judged(pages)), links).collect()}
    trust = pagerank({"good.org": 1.0}, edges)
    distrust = pagerank({"bad.com": 1.0}, {(b, a): n for (a, b), n in edges.items()})
    assert set(trust) | set(distrust) == set(scores) and scores["h00.net"][1] > 0
    for host, (t, d) in scores.items():
        assert (t, d) == pytest.approx((trust.get(host, 0.0), distrust.get(host, 0.0)), abs=7 * hosts.TOLERANCE)
    assert sorted(map(tuple, hosts.filtered(pages).collect()), key=str) == sorted(by_sql(rows), key=str)


def test_no_pages_and_no_python(spark):
    pages = table(spark, GRAPH)
    assert hosts.filtered(pages.limit(0)).count() == 0
    plan = hosts.filtered(pages)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
