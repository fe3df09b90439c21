"""Page records, links and chains; object inventory."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tidemark.functions.markup import tag
from tidemark.operators import pages as pg
from tidemark.operators.inventory import exists_in
from tidemark.plans.inputs import chained_pages, page_chain_links, table, user_events
from tidemark.plans.registry import query
from tidemark.schemas import RECORDS
from tidemark.sources.listing import list_objects
from tidemark.sources.readers import inventory, read_csv, read_inventory, read_pages
from tidemark.sources.writers import write_events, write_records
from tidemark.workspace import fresh_folder

# The stored pages hold one article each; their menu takes the place of tags.
SPEC = pg.RecordSpec(
    element="body",
    box=tag("body"),
    tag_list=None,
    text=pg.Field("h1", tag("h1"), behind=tag("article")),
    author=pg.Field("footer", tag("footer")),
    tags=pg.Field("a", tag("a"), behind=tag("li")),
    next_link=(*pg.RecordSpec().next_link, pg.Link(tag("a"), behind=tag("li"))),
)


def plain(markup: str) -> str:
    """SQL for the text of simple markup: the entities the pages use, outer spaces cut."""
    for name, character in {"copy": "©", "middot": "·", "quot": '"', "lt": "<", "gt": ">", "amp": "&"}.items():
        markup = f"regexp_replace({markup}, '&{name};?', '{character}', 'g')"
    return f"trim({markup})"


TITLE = "trim(" + plain("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)") + ", '“”')"
FOOTER = plain("regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1)")
MENU = "regexp_extract_all(html, '<li><a href=\"[^\"]*\">([^<]*)</a>', 1)"
TAGS = f"array_to_string(list_transform({MENU}, lambda x: {plain('x')}), ', ')"
RECORD = f"{TITLE} AS quote_text, {FOOTER} AS author, {TAGS} AS tags"
ORIGIN = "regexp_extract(url, '^[a-z]+://[^/?#]*')"


@query("page_links", f"""
SELECT page_id, {ORIGIN} || href AS link
FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages)""")
def page_links(spark, sf_dir):
    return pg.page_links(table(spark, sf_dir, "pages"))


@query("page_records", f"SELECT url, {RECORD} FROM pages")
def page_records(spark, sf_dir):
    return pg.extract_records(pg.parse_pages(read_pages(spark, f"{sf_dir}/pages.parquet"), SPEC))


@query("page_next_links", f"""
SELECT url, {ORIGIN} || regexp_extract(html, '<a href="([^"]*)"', 1) AS next_url FROM pages""")
def page_next_links(spark, sf_dir):
    return pg.next_links(table(spark, sf_dir, "pages"), SPEC)


@query("page_records_sql", f"SELECT url, {RECORD} FROM pages")
def page_records_sql(spark, sf_dir):
    """The same records in SQL."""
    return spark.sql(
        """SELECT url, quote_text, author, tags FROM {parsed}
        LATERAL VIEW OUTER inline(records) r AS quote_text, author, tags WHERE quote_text IS NOT NULL""",
        parsed=pg.parse_pages(table(spark, sf_dir, "pages"), SPEC),
    )


@query("page_records_csv", f"SELECT {RECORD} FROM pages")
def page_records_csv(spark, sf_dir):
    path = fresh_folder(spark, "records")
    write_records(page_records(spark, sf_dir), path)
    return read_csv(spark, path, RECORDS, multi_line=True, keep_empty=True)


def first_pages(spark, sf_dir):
    """The pages nothing links to."""
    targets = page_chain_links(spark, sf_dir).select(F.col("next_page").alias("page_id"))
    return table(spark, sf_dir, "pages").join(targets, "page_id", "left_anti")


@query("page_chain", """
SELECT page_id - page_id % 7 AS seed, page_id AS page, page_id % 7 AS depth FROM pages""")
def page_chain(spark, sf_dir):
    """Walks from every page nothing links to; the last link leads to no stored page."""
    links = page_chain_links(spark, sf_dir)
    links = pg.existing_links(links, links.select("page"))
    return pg.follow_chain(first_pages(spark, sf_dir).select(F.col("page_id").alias("page")), links)


@query("chain_records", f"""
SELECT s.url AS seed, p.page_id % 7 AS depth, p.url, {RECORD.replace('html', 'p.html')}
FROM pages p JOIN pages s ON s.page_id = p.page_id - p.page_id % 7""")
def chain_records(spark, sf_dir):
    """Records of all pages met by following next links from the first page of each run."""
    spec = replace(SPEC, next_link=pg.RecordSpec().next_link)
    return pg.chained_records(chained_pages(spark, sf_dir), first_pages(spark, sf_dir), spec)


@query("inventory_exists", """
SELECT DISTINCT d AS key, d IN (SELECT CAST(ts AS date)::varchar FROM events) AS found
FROM (SELECT unnest([CAST(ts AS date), CAST(ts AS date) + 20])::varchar AS d FROM events)""")
def inventory_exists(spark, sf_dir):
    """Which days have objects in the event table, asked for event days and days 20 later.

    The listing is read as the store would deliver it, a table.
    """
    path = fresh_folder(spark, "events-by-day")
    events = user_events(spark, sf_dir)
    write_events(events, f"{path}/events")
    inventory(spark, f"{path}/events", "*.parquet").write.parquet(f"{path}/listing")
    listed = read_inventory(spark, f"{path}/listing").select(
        F.regexp_extract("path", r"event_date=([^/]+)/", 1).alias("key")
    )
    day = F.to_date("event_time")
    asked = events.select(F.explode(F.array(day, F.date_add(day, 20))).alias("key"))
    return exists_in(asked.select(F.col("key").cast("string")), listed)


@query("inventory_listed", """
SELECT DISTINCT CAST(ts AS date)::varchar AS key, true AS found FROM events
UNION ALL SELECT DISTINCT (CAST(ts AS date) + 40000)::varchar, false FROM events""")
def inventory_listed(spark, sf_dir):
    """Which days have objects in the event table, by a listing that tasks make; asked for event days and days long after."""
    path = f"{fresh_folder(spark, 'events-listed')}/events"
    events = user_events(spark, sf_dir)
    write_events(events, path)
    days = list_objects(spark, path, "*.parquet").select(F.regexp_extract("path", r"event_date=([^/]+)/", 1).alias("key"))
    day = F.to_date("event_time")
    asked = events.select(F.explode(F.array(day, F.date_add(day, 40000))).alias("key"))
    return exists_in(asked.select(F.col("key").cast("string")), days)
