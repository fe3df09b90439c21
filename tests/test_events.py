from __future__ import annotations

import datetime
import random
import re

import pytest
from pyspark.errors import StreamingQueryException

from tidemark.operators import events as ev
from tidemark.operators.retention import first_events, retention_7d, retention_7d_total, user_cohorts
from tidemark.sources.readers import inventory, read_events, stream_events
from tidemark.sources.writers import write_events
from tidemark.streaming.states import EventStates, expire_days
from tidemark.workspace import fresh_folder, run_of

SCHEMA = "user_id long, event_type string, points_spent double, event_time timestamp_ntz"


def at(day, hour=0, user=1, kind="click", points=1.0):
    return (user, kind, points, datetime.datetime(2024, 1, 1) + datetime.timedelta(days=day, hours=hour))


@pytest.fixture
def frame(spark):
    return lambda rows: spark.createDataFrame(list(rows), SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, v) for v in r])


def test_states_of_any_split_merge_to_the_same(frame):
    draw = random.Random(5)
    data = [
        at(draw.randrange(4), draw.randrange(24), draw.randrange(9), draw.choice("ab"), float(draw.randrange(9)))
        for _ in range(300)
    ]
    expected = rows(ev.daily_exact(frame(data)))
    cut = sorted(draw.sample(range(1, 300), 2))
    parts = [data[: cut[0]], data[cut[0] : cut[1]], data[cut[1] :]]
    states = frame([]).transform(ev.event_states)
    for part in parts:
        states = states.unionByName(ev.event_states(frame(part).repartition(3), fan_in=1))
    assert rows(ev.merge_states(states)) == expected
    assert rows(ev.merge_states(ev.combine_states(states))) == expected
    assert rows(ev.merge_states(states, ["event_type"])) == rows(ev.daily_exact(frame(data), ["event_type"]))


def test_compact_sketch_is_close(spark):
    df = spark.range(40_000).selectExpr(
        "id % 20000 AS user_id", "'a' AS event_type", "1D AS points_spent", "TIMESTAMP_NTZ'2024-01-01' AS event_time"
    )
    states = ev.event_states(df, kind="hll").unionByName(ev.event_states(df.limit(500), kind="hll"))
    row = ev.merge_states(states, ["event_date"], kind="hll").first()
    assert abs(row.unique_users - 20_000) < 600 and row.total_actions == 40_500
    assert ev.merge_states(ev.event_states(df)).first().unique_users == 20_000


def test_many_users_of_one_group_stay_exact(spark):
    """300,000 users over batches that overlap, a backfill and a snapshot."""
    def users(first, last):
        return spark.range(first, last, 1, 4).selectExpr(
            "id - 100 AS user_id", "'a' AS event_type", "1D AS points_spent", "TIMESTAMP_NTZ'2024-01-01' AS event_time")

    states = states_folder(spark)
    for run, first, last in (("r", 0, 150_000), ("s", 100_000, 200_000)):
        ev.event_states(users(first, last)).write.parquet(states.batch_path(run, 0))
    states.compact()
    states.backfill(users(190_000, 300_000), "more")
    row = ev.merge_states(states.read()).first()
    assert (row.unique_users, row.total_actions) == (300_000, 360_000)
    assert ev.merge_states(states.read(), []).first().unique_users == 300_000


def test_sparse_users_of_one_group_stay_exact_and_small(spark):
    """300,000 random 64-bit ids over a stream, a backfill and a snapshot."""
    def users(first, last):
        return spark.range(first, last, 1, 4).selectExpr(
            "xxhash64(id) AS user_id", "'a' AS event_type", "1D AS points_spent", "TIMESTAMP_NTZ'2024-01-01' AS event_time")

    raw, checkpoint = fresh_folder(spark, "raw"), fresh_folder(spark, "checkpoint")
    states = states_folder(spark)
    users(0, 150_000).write.parquet(raw)
    states.maintain(stream_events(spark, raw, 2, SCHEMA), checkpoint).awaitTermination()
    states.backfill(users(100_000, 250_000), "some")
    states.compact()
    states.backfill(users(200_000, 300_000), "more")
    assert ev.merge_states(states.read()).select("unique_users", "total_actions").first() == (300_000, 400_000)
    states.compact()
    states.retire()
    assert ev.merge_states(states.read()).first().unique_users == 300_000
    size = sum(r.length for r in inventory(spark, f"{states.path}/snapshots", "*.parquet").collect())
    assert size < 32 * 300_000


def test_ids_of_every_sign_and_none(frame):
    ids = [0, 1, 63, 64, -1, -64, -65, 2**63 - 1, -(2**63), None, 0, None]
    row = ev.merge_states(ev.event_states(frame([at(0, user=i) for i in ids]))).first()
    assert (row.unique_users, row.total_actions) == (9, 12)
    assert rows(ev.merge_states(ev.event_states(frame([at(0, user=None)])))) == rows(ev.daily_exact(frame([at(0, user=None)])))


def test_compaction_rewrites_only_days_with_something_new(spark, frame):
    states, run = states_folder(spark), "r"
    written = lambda v: states._folder.names(f"snapshots/v={v}")
    first = [at(d, user=64 * u) for d in range(4) for u in range(50)] + [(1, "click", 1.0, None)]
    later = [at(2, user=7), at(9, user=1)]
    for number, data in enumerate((first, later)):
        ev.event_states(frame(data)).write.parquet(states.batch_path(run, number))
        assert states.compact() == number
        states.retire()
    days = [f"day=2024-01-0{d}" for d in (1, 2, 3, 4)]
    assert [n for n in written(0) if n.startswith("day=")] == [*days, "day=__HIVE_DEFAULT_PARTITION__"]
    # The late row is a part of its day; the 50 rows beside it stay as they are.
    assert [n for n in written(1) if n.startswith("day=")] == ["day=2024-01-03", "day=2024-01-10"]
    assert rows(states.read().groupBy("event_date").count().where("event_date = '2024-01-03'"))[0][1] == 51
    assert rows(ev.merge_states(states.read())) == rows(ev.daily_exact(frame(first + later)))
    # As many rows as a fourth of the first part are merged with both parts, which are then removed.
    more = [at(2, user=64 * u + 1) for u in range(15)]
    ev.event_states(frame(more)).write.parquet(states.batch_path(run, 2))
    states.compact()
    states.retire()
    assert "day=2024-01-03" not in written(0) + written(1) and "day=2024-01-01" in written(0)
    assert rows(states.read().groupBy("event_date").count().where("event_date = '2024-01-03'"))[0][1] == 50
    assert rows(ev.merge_states(states.read())) == rows(ev.daily_exact(frame(first + later + more)))
    # Nothing new: nothing is written.
    before = states._merged().folders()
    states.compact()
    assert states._merged().folders() == before


def test_expired_days_leave_the_snapshot_without_being_rewritten(spark, frame):
    states = states_folder(spark)
    ev.event_states(frame([at(0), at(5)])).write.parquet(states.batch_path("r", 0))
    states.compact()
    states.compact(as_of="2024-06-30")  # the 1st of January is 181 days before
    assert states._merged().folders() == ["v=0/day=2024-01-06"]
    states.retire()
    assert states._folder.names("snapshots/v=0")[-1] == "day=2024-01-06" and "day=2024-01-01" not in states._folder.names("snapshots/v=0")
    assert [r[0].day for r in rows(ev.merge_states(states.read()))] == [6]


def test_retention_periods_end_exactly(frame):
    as_of = "2024-01-31 00:00:00"
    kept = ev.live_events(frame([at(0), at(0, 1), at(3)]), as_of)
    assert len(rows(kept)) == 2
    states = ev.event_states(frame([at(0), at(1), at(2)]))
    kept = ev.live_aggregates(states, "2024-06-29")  # 180 days after 2024-01-01
    assert {r[0].day for r in rows(kept)} == {2, 3}


def test_cohorts_at_their_boundaries(frame):
    df = frame([
        at(0, user=1), at(0, 5, user=1),            # same day only
        at(0, user=2), at(7, 23, user=2),           # day 7 counts
        at(0, user=3), at(8, user=3),               # day 8 does not
        at(0, user=4), at(8, user=4), at(1, user=4),
        at(2, user=5),
        (None, "click", 1.0, datetime.datetime(2024, 1, 1)),
    ])
    first = datetime.date(2024, 1, 1)
    assert rows(retention_7d(df)) == [(first, 4, 2, 50.0), (datetime.date(2024, 1, 3), 1, 0, 0.0)]
    assert rows(retention_7d_total(df)) == [(5, 2, 40.0)]
    flags = retention_7d(df, complete_at="2024-01-10").collect()
    assert [r.complete for r in flags] == [True, False]
    assert rows(retention_7d_total(df.limit(0))) == []
    # with raw retention the first event is the first one still kept
    assert rows(retention_7d(df, as_of="2024-02-01"))[0] == (datetime.date(2024, 1, 3), 1, 0, 0.0)


def test_cohorts_against_brute_force(frame):
    draw, seen = random.Random(8), {}
    data = []
    for user in range(400):
        start = draw.randrange(-140, 140)
        for offset in draw.sample([0, 0, 1, 2, 6, 7, 8, 30, 62, 63, 64, 70, 126], draw.randrange(1, 5)):
            data.append(at(start + offset, draw.randrange(24), user))
            seen.setdefault(user, set()).add(start + offset)
    data += [(1000 + i, "a", 0.0, datetime.datetime(1969, 12, 30 + i % 2)) for i in range(3)]
    expected = {u: (min(d), any(min(d) < x <= min(d) + 7 for x in d)) for u, d in seen.items()}
    found = {r.user_id: r for r in user_cohorts(frame(data)).collect()}
    assert len(found) == 403 and str(found[1001].day_0) == "1969-12-31"
    first = datetime.date(2024, 1, 1)
    assert {u: ((found[u].day_0 - first).days, found[u].returned) for u in seen} == expected


def test_first_event(frame):
    assert rows(first_events(frame([at(3), at(1), at(2, user=2)])))[0][1].day == 2


def states_folder(spark):
    return EventStates(spark, f"{fresh_folder(spark, 'test')}/states")


def stream_of(spark, path):
    return stream_events(spark, path, 1, SCHEMA)


def test_stream_replay_backfill_compaction_and_expiry(spark, frame):
    raw, checkpoint = fresh_folder(spark, "raw"), fresh_folder(spark, "checkpoint")
    states = states_folder(spark)
    assert rows(ev.merge_states(states.read())) == []

    data = [at(d, user=u) for d in range(4) for u in range(d + 1)]
    frame(data[:5]).coalesce(1).write.parquet(raw)
    states.maintain(stream_of(spark, raw), checkpoint).awaitTermination()
    frame(data[5:]).coalesce(1).write.mode("append").parquet(raw)
    states.maintain(stream_of(spark, raw), checkpoint).awaitTermination()
    expected = rows(ev.daily_exact(frame(data)))
    assert rows(ev.merge_states(states.read())) == expected

    # a micro-batch that runs again replaces itself
    run = run_of(spark, checkpoint)
    ev.event_states(frame(data[5:])).write.mode("overwrite").parquet(states.batch_path(run, 1))
    assert rows(ev.merge_states(states.read())) == expected

    # late rows and a backfill add to their day
    late = [at(0, user=99)]
    states.backfill(frame(late), "late")
    states.backfill(frame(late), "late")
    expected = rows(ev.daily_exact(frame(data + late)))
    assert rows(ev.merge_states(states.read())) == expected

    assert states.compact() == 0
    assert rows(ev.merge_states(states.read())) == expected
    # a replay of a merged micro-batch and an unpublished snapshot are not counted again
    ev.event_states(frame(data[5:])).write.mode("overwrite").parquet(states.batch_path(run, 1))
    ev.event_states(frame(data)).write.parquet(f"{states.path}/snapshots/v=1")
    assert rows(ev.merge_states(states.read())) == expected
    with pytest.raises(ValueError):
        states.backfill(frame(late), "late")

    states.retire()
    assert states._batches() == [] and states._folder.names("backfills") == []
    assert rows(ev.merge_states(states.read())) == expected

    frame([at(9)]).coalesce(1).write.mode("append").parquet(raw)
    states.maintain(stream_of(spark, raw), checkpoint).awaitTermination()
    expected = rows(ev.daily_exact(frame([*data, *late, at(9)])))
    assert rows(ev.merge_states(states.read())) == expected
    kept = [r for r in expected if r[0] > datetime.date(2024, 1, 2)]
    assert rows(ev.merge_states(states.read(as_of="2024-06-30"))) == kept
    assert states.compact(as_of="2024-06-30") == 1
    states.retire()
    assert rows(ev.merge_states(states.read())) == kept


def test_a_micro_batch_that_fails_after_writing_is_counted_once(spark, frame, monkeypatch):
    raw, checkpoint = fresh_folder(spark, "raw"), fresh_folder(spark, "checkpoint")
    states, data = states_folder(spark), [at(d, user=u) for d in range(3) for u in range(4)]
    frame(data).coalesce(1).write.parquet(raw)

    def fail_late(batch):
        ev.event_states(batch).write.mode("overwrite").parquet(states.batch_path(run_of(spark, checkpoint), 0))
        raise RuntimeError("lost")

    monkeypatch.setattr("tidemark.streaming.states.event_states", fail_late)
    with pytest.raises(StreamingQueryException):
        states.maintain(stream_of(spark, raw), checkpoint).awaitTermination()
    monkeypatch.undo()
    states.maintain(stream_of(spark, raw), checkpoint).awaitTermination()
    assert states._batches() == [(run_of(spark, checkpoint), 0)]
    assert rows(ev.merge_states(states.read())) == rows(ev.daily_exact(frame(data)))


def test_event_table_by_day(spark, frame):
    path = fresh_folder(spark, "by-day")
    data = [at(d, h, u) for d in range(3) for h in range(3) for u in range(2)]
    write_events(frame(data), path)
    table = read_events(spark, path)
    assert rows(table.drop("event_date")) == sorted(data)
    one_day = table.where("event_date = '2024-01-02'")
    assert "PartitionFilters: [isnotnull(event_date" in one_day._jdf.queryExecution().toString()
    live = ev.live_events(table, "2024-02-01 12:00:00")
    assert re.search(r"PartitionFilters: \[[^]]*event_date\S* >= 2024-01-02", live._jdf.queryExecution().toString())
    assert sorted({r.event_date.day for r in live.collect()}) == [3]
    assert expire_days(spark, path, "2024-01-03") == ["event_date=2024-01-01", "event_date=2024-01-02"]
    assert len(rows(read_events(spark, path))) == 6


def test_a_hot_day_is_written_by_many_tasks(spark):
    path = fresh_folder(spark, "hot-day")
    events = spark.range(0, 200_000, 1, 8).selectExpr(
        "id AS user_id", "'click' AS event_type", "CAST(id AS double) AS points_spent",
        "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(IF(id % 3 = 0, 0, id % 20), 0, 0, id % 86400) AS event_time",
    )
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        write_events(events, path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    files = inventory(spark, path, "*.parquet")
    assert files.where("path LIKE '%event_date=2024-01-01/%'").count() > 3
    assert read_events(spark, path).count() == 200_000
