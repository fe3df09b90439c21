"""Daily aggregates from raw events, states and streams; retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import events as ev
from tidemark.operators import retention
from tidemark.plans.inputs import USER_EVENTS_SQL, user_events
from tidemark.plans.registry import query
from tidemark.sources.readers import read_events, stream_events
from tidemark.sources.writers import write_events
from tidemark.streaming.states import EventStates, expire_days
from tidemark.workspace import fresh_folder

WITH_EVENTS = f"WITH user_events AS ({USER_EVENTS_SQL})"
MEASURES = """count(DISTINCT user_id) AS unique_users, round(sum(points_spent), 2) AS total_points,
    count(*) AS total_actions"""
DAILY = f"""{WITH_EVENTS} SELECT CAST(event_time AS date) AS event_date, event_type, {MEASURES}
FROM user_events GROUP BY 1, 2 ORDER BY 1, 2"""
RAW_AS_OF = "2024-02-10 00:00:00"
DAILY_AS_OF = "2024-07-13"
FILES_PER_BATCH = 8


def rounded(df):
    return df.withColumn("total_points", F.round("total_points", 2))


@query("event_daily_exact", DAILY)
def event_daily_exact(spark, sf_dir):
    return rounded(ev.daily_exact(user_events(spark, sf_dir)))


@query("event_daily_states", DAILY)
def event_daily_states(spark, sf_dir):
    return rounded(ev.daily_report(ev.event_states(user_events(spark, sf_dir))))


@query("event_type_rollup", f"{WITH_EVENTS} SELECT event_type, {MEASURES} FROM user_events GROUP BY 1")
def event_type_rollup(spark, sf_dir):
    return rounded(ev.merge_states(ev.event_states(user_events(spark, sf_dir)), ["event_type"]))


@query("event_total_rollup", f"{WITH_EVENTS} SELECT {MEASURES} FROM user_events")
def event_total_rollup(spark, sf_dir):
    return rounded(ev.merge_states(ev.event_states(user_events(spark, sf_dir)), []))


@query("live_events", f"""{WITH_EVENTS}
SELECT * FROM user_events WHERE event_time + INTERVAL 30 DAY > TIMESTAMP '{RAW_AS_OF}'""")
def live_events(spark, sf_dir):
    return ev.live_events(user_events(spark, sf_dir), RAW_AS_OF)


@query("live_aggregates", f"""{WITH_EVENTS}, daily AS (
    SELECT CAST(event_time AS date) AS event_date, event_type, {MEASURES} FROM user_events GROUP BY 1, 2)
SELECT * FROM daily WHERE event_date + INTERVAL 180 DAY > DATE '{DAILY_AS_OF}'""")
def live_aggregates(spark, sf_dir):
    states = ev.event_states(user_events(spark, sf_dir))
    return rounded(ev.merge_states(ev.live_aggregates(states, DAILY_AS_OF)))


@query("event_expiry", f"""{WITH_EVENTS}
SELECT *, CAST(event_time AS date) AS event_date FROM user_events
WHERE event_time + INTERVAL 30 DAY > TIMESTAMP '{RAW_AS_OF}'""")
def event_expiry(spark, sf_dir):
    """Event table by day, expired days dropped, the boundary day filtered."""
    path = fresh_folder(spark, "events-by-day")
    write_events(user_events(spark, sf_dir), path)
    expire_days(spark, path, "2024-01-11")
    return ev.live_events(read_events(spark, path), RAW_AS_OF)


@query("first_events", f"{WITH_EVENTS} SELECT user_id, min(event_time) AS event_time FROM user_events GROUP BY 1")
def first_events(spark, sf_dir):
    return retention.first_events(user_events(spark, sf_dir))


def cohorts_sql(rows: str = "true") -> str:
    return f"""{WITH_EVENTS}, kept AS (SELECT * FROM user_events WHERE {rows}),
first_event AS (SELECT user_id, CAST(min(event_time) AS date) AS day_0 FROM kept GROUP BY 1),
pairs AS (
    SELECT f.user_id, f.day_0, CAST(k.event_time AS date) AS later
    FROM first_event f LEFT JOIN kept k ON f.user_id = k.user_id)"""


def cohort_counts(returned: str = "later > day_0 AND later <= day_0 + 7") -> str:
    return f"""count(DISTINCT user_id) AS total_users_day_0,
    count(DISTINCT CASE WHEN {returned} THEN user_id END) AS returned_in_7_days,
    round(100.0 * count(DISTINCT CASE WHEN {returned} THEN user_id END) / count(DISTINCT user_id), 2)
        AS retention_7d_percent"""


PURCHASES = "event_type = 'purchase'"


@query("retention_7d", f"{cohorts_sql()} SELECT day_0, {cohort_counts()} FROM pairs GROUP BY 1 ORDER BY 1")
def retention_7d(spark, sf_dir):
    return retention.retention_7d(user_events(spark, sf_dir))


@query("retention_7d_purchases", f"""{cohorts_sql(PURCHASES)}
SELECT day_0, {cohort_counts()}, day_0 + 7 < DATE '2024-01-09' AS complete FROM pairs GROUP BY 1 ORDER BY 1""")
def retention_7d_purchases(spark, sf_dir):
    purchases = user_events(spark, sf_dir).where(PURCHASES)
    return retention.retention_7d(purchases, complete_at="2024-01-09")


@query("retention_7d_live", f"""
{cohorts_sql(f"event_time + INTERVAL 30 DAY > TIMESTAMP '{RAW_AS_OF}'")}
SELECT day_0, {cohort_counts()} FROM pairs GROUP BY 1 ORDER BY 1""")
def retention_7d_live(spark, sf_dir):
    return retention.retention_7d(user_events(spark, sf_dir), as_of=RAW_AS_OF)


@query("retention_7d_total", f"{cohorts_sql()} SELECT {cohort_counts()} FROM pairs")
def retention_7d_total(spark, sf_dir):
    return retention.retention_7d_total(user_events(spark, sf_dir))


@query("retention_7d_total_purchases", f"{cohorts_sql(PURCHASES)} SELECT {cohort_counts()} FROM pairs")
def retention_7d_total_purchases(spark, sf_dir):
    return retention.retention_7d_total(user_events(spark, sf_dir).where(PURCHASES))


def streamed_states(spark, sf_dir) -> EventStates:
    """The event table by day, read back as a stream of a few micro-batches."""
    raw, work = fresh_folder(spark, "events-by-day"), fresh_folder(spark, "event-states")
    write_events(user_events(spark, sf_dir), raw)
    stream = stream_events(spark, raw, FILES_PER_BATCH)
    states = EventStates(spark, f"{work}/states")
    states.maintain(stream, f"{work}/checkpoint").awaitTermination()
    return states


@query("event_states_stream", DAILY)
def event_states_stream(spark, sf_dir):
    return rounded(ev.daily_report(streamed_states(spark, sf_dir).read()))


@query("event_states_backfill", DAILY)
def event_states_backfill(spark, sf_dir):
    """Later days through the stream, the days before it by backfill, then compacted."""
    raw, work = fresh_folder(spark, "events-by-day"), fresh_folder(spark, "event-states")
    events = user_events(spark, sf_dir)
    start = F.lit("2024-01-16").cast("timestamp_ntz")
    write_events(events.where(F.col("event_time") >= start), raw)
    states = EventStates(spark, f"{work}/states")
    states.maintain(stream_events(spark, raw), f"{work}/checkpoint").awaitTermination()
    states.backfill(events.where(F.col("event_time") < start), "before-the-stream")
    states.compact()
    return rounded(ev.daily_report(states.read()))


@query("event_states_two_checkpoints", DAILY)
def event_states_two_checkpoints(spark, sf_dir):
    """Two halves of the events through streams with checkpoints of their own, compacted in between."""
    work = fresh_folder(spark, "event-states")
    states, events = EventStates(spark, f"{work}/states"), user_events(spark, sf_dir)
    for half in (0, 1):
        write_events(events.where(F.col("user_id") % 2 == half), f"{work}/raw-{half}")
        states.maintain(stream_events(spark, f"{work}/raw-{half}"), f"{work}/checkpoint-{half}").awaitTermination()
        if half == 0:
            states.compact()
    return rounded(ev.daily_report(states.read()))


@query("event_states_compacted", DAILY)
def event_states_compacted(spark, sf_dir):
    states = streamed_states(spark, sf_dir)
    states.compact()
    states.retire()
    return rounded(ev.daily_report(states.read()))
