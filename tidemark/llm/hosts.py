"""URL filter: rules by host and path, and propagation over links between hosts.

A rule such as ``example.org/es/`` fits its host and all subdomains if the path starts with
the rule's; the longest rule wins. Pages without a rule follow their host: trust starts from
hosts by the share of their pages that rules allow and flows along links, distrust starts by
the share that rules block and flows against links (a page that links to blocked hosts is
suspect), both as personalised PageRank, for as many rounds as it takes until a round adds at most ``TOLERANCE`` to
all hosts together; what is left out is then at most 6 times that. A host is blocked when its distrust is greater
than its trust and at least ``THRESHOLD`` of what a host gets all of whose pages are blocked, both to 7 digits.

Everything is DataFrame expressions. Hosts and links are tables, of which nothing is
collected; rules are a parameter, so they are literals.

Defined results: null urls and urls without ``://`` have empty host and path, fit no rule
and are allowed; null html has no links; links within a host, links without a host and
repeated links of one page count once or not at all; an empty table gives no rows;
repeated rows are judged alike; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.workspace import Folder, fresh_folder, written

RULES = [
    ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
    ("com/fr/", "allow"), ("com/de/", "block"),
]
DAMPING, TOLERANCE, THRESHOLD = 0.85, 1e-9, 0.5
#: Rounds whose additions are kept apart before they are summed up.
FOLD = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hosts of links that name one.
LINK = r"""(?i)href[ \t\r\n]*=[ \t\r\n]*["']?[ \t\r\n]*(?:https?:)?//([^/?#"'<> \t\r\n]+)"""


def address(url: str = "url") -> tuple[Column, Column]:
    """Host and path of a url."""
    at = F.locate("://", F.col(url))
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(F.col(url))))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); of equally long ones the first by text."""
    chosen = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0]))[::-1]:
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(slash + rest))
        chosen = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def judged(pages: DataFrame, rules=RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """Key, host, path and the rule with its verdict, null where none fits."""
    host, path = address(url)
    cut = pages.select(F.col(key).alias(key), host.alias("host"), path.alias("path"))
    found = cut.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    return found.select(key, "host", "path", "found.rule", F.col("found.verdict").alias("ruled"))


def host_seeds(ruled: DataFrame) -> DataFrame:
    """Per host the shares of its pages that rules allow (``trust``) and block (``distrust``)."""
    return ruled.where("host != ''").groupBy("host").agg(
        F.avg(F.coalesce((F.col("ruled") == "allow").cast("int"), F.lit(0))).alias("trust"),
        F.avg(F.coalesce((F.col("ruled") == "block").cast("int"), F.lit(0))).alias("distrust"))


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Links between different hosts: src, dst, number of pages with such a link."""
    host, _ = address(url)
    targets = F.array_distinct(F.transform(
        F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1)), lambda h: F.translate(h, UPPER, LOWER)))
    found = pages.where(F.contains(F.col(html), F.lit("//"))).select(host.alias("src"), F.explode(targets).alias("dst"))
    return found.where("src != '' AND src != dst").groupBy("src", "dst").agg(F.count("*").alias("pages"))


def spread(seeds: DataFrame, links: DataFrame, start: str, source: str, target: str, damping: float, tolerance: float,
           folder: str) -> DataFrame:
    """Personalised PageRank (host, score) of ``start`` along links from ``source`` to ``target``.

    A round passes on only what the round before added, so a host takes part while something reaches it. What a round
    adds to all hosts is at most ``damping`` of the round before, so the rounds end.
    """
    totals = links.groupBy(source).agg(F.sum("pages").alias("all"))
    shares = links.join(totals, source).select(
        F.col(source).alias("host"), F.col(target).alias("next"), (F.col("pages") / F.col("all")).alias("part"))
    shares = written(shares, f"{folder}/shares")
    given = seeds.select("host", ((1 - F.lit(damping)) * F.col(start)).alias("score")).where("score > 0")
    added = written(given, f"{folder}/added-0")
    rounds, sums, number = [added], None, 0
    while (added.agg(F.sum("score")).first()[0] or 0.0) > tolerance:
        number += 1
        passed = added.join(shares, "host").groupBy("next").agg(
            F.sum(F.lit(damping) * F.col("score") * F.col("part")).alias("score"))
        added = written(passed.withColumnRenamed("next", "host"), f"{folder}/added-{number}")
        rounds.append(added)
        if len(rounds) > FOLD:
            before, sums = sums, written(summed(rounds[:-1], sums), f"{folder}/sums-{number}")
            for old in range(number - len(rounds) + 1, number):
                Folder(links.sparkSession, folder).remove(f"added-{old}")
            if before is not None:
                Folder(links.sparkSession, folder).remove(f"sums-{number - FOLD}")
            rounds = [added]
    return summed(rounds, sums)


def summed(rounds: list[DataFrame], sums: DataFrame | None) -> DataFrame:
    """Score per host over some rounds and the sum of those before."""
    every = reduce(DataFrame.unionByName, rounds if sums is None else [sums, *rounds])
    return every.groupBy("host").agg(F.sum("score").alias("score"))


def host_scores(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """Trust and distrust per host, up to what ``tolerance`` leaves out."""
    links = written(links, fresh_folder(links.sparkSession, "links"))
    seeds = written(seeds, fresh_folder(links.sparkSession, "seeds"))
    if links.isEmpty():  # nothing is passed on
        return seeds.select("host", ((1 - F.lit(damping)) * F.col("trust")).alias("trust"),
                            ((1 - F.lit(damping)) * F.col("distrust")).alias("distrust"))
    trust = spread(seeds, links, "trust", "src", "dst", damping, tolerance, fresh_folder(links.sparkSession, "trust"))
    against = spread(seeds, links, "distrust", "dst", "src", damping, tolerance, fresh_folder(links.sparkSession, "distrust"))
    return trust.withColumnRenamed("score", "trust").join(
        against.withColumnRenamed("score", "distrust"), "host", "full").select(
        "host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def blocked_hosts(scores: DataFrame, damping: float = DAMPING, threshold: float = THRESHOLD) -> DataFrame:
    trust, distrust = F.round("trust", 7), F.round("distrust", 7)
    return scores.where((distrust > trust) & (distrust >= F.round(F.lit((1 - damping) * threshold), 7))).select("host")


def filtered(pages: DataFrame, rules=RULES, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: key, host, path, rule (null: none), verdict (the rule's, else the host's)."""
    ruled = judged(pages, rules, key, url)
    scores = host_scores(host_seeds(ruled), host_links(pages, url, html))
    blocked = written(blocked_hosts(scores), fresh_folder(pages.sparkSession, "blocked")).withColumn("bad", F.lit(True))
    return ruled.join(blocked, "host", "left").select(
        key, "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict"))


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def oracle(rules=RULES, damping: float = DAMPING, tolerance: float = TOLERANCE, threshold: float = THRESHOLD) -> str:
    """The same in SQL."""
    fits = {"rule": [], "verdict": []}
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        test = f"(host = {_quoted(name)} OR suffix(host, {_quoted('.' + name)})) AND starts_with(path, {_quoted(slash + rest)})"
        fits["rule"].append(f"WHEN {test} THEN {_quoted(rule)}")
        fits["verdict"].append(f"WHEN {test} THEN {_quoted(verdict)}")

    def walk(name, source, target):
        return f"""{name}_shares AS (SELECT {source} AS host, {target} AS next,
    pages / sum(pages) OVER (PARTITION BY {source}) AS part FROM links),
{name}_walk AS (SELECT host, (1 - {damping}e0) * {name} AS score FROM seeds WHERE {name} > 0
    UNION ALL SELECT next, sum({damping}e0 * score * part) FROM
    (SELECT host, score, sum(score) OVER () AS added FROM {name}_walk) w JOIN {name}_shares USING (host)
    WHERE added > {tolerance!r} GROUP BY next),
{name}_all AS (SELECT host, sum(score) AS score FROM {name}_walk GROUP BY host)"""

    lower = f"translate(%s, '{UPPER}', '{LOWER}')"
    return f"""WITH RECURSIVE cut AS (SELECT page_id, html, CASE WHEN strpos(url, '://') > 0
                   THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, html, {lower % "regexp_extract(rest, '^[^/?#]*')"} AS host,
          regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (SELECT page_id, html, host, path, CASE {' '.join(fits['rule'])} END AS rule,
          CASE {' '.join(fits['verdict'])} END AS ruled FROM parts),
seeds AS (SELECT host, avg(coalesce(CAST(ruled = 'allow' AS INT), 0)) AS trust,
          avg(coalesce(CAST(ruled = 'block' AS INT), 0)) AS distrust FROM ruled WHERE host <> '' GROUP BY host),
targets AS (SELECT host AS src, unnest(list_distinct(list_transform(regexp_extract_all(html, {_quoted(LINK)}, 1),
            lambda h: {lower % 'h'}))) AS dst FROM ruled),
links AS (SELECT src, dst, count(*) AS pages FROM targets WHERE src <> '' AND src <> dst GROUP BY src, dst),
{walk('trust', 'src', 'dst')},
{walk('distrust', 'dst', 'src')},
bad AS (SELECT host FROM distrust_all d LEFT JOIN trust_all t USING (host)
        WHERE round(d.score, 7) > round(coalesce(t.score, 0), 7)
        AND round(d.score, 7) >= round({(1 - damping) * threshold!r}, 7))
SELECT page_id, ruled.host, path, rule,
       coalesce(ruled, CASE WHEN bad.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN bad ON ruled.host = bad.host"""
