"""Event states kept up to date by a stream, with compaction and expiry.

Folder layout::

    batches/run=R/batch_id=N/   states of micro-batch N of the query R, replaced if N is replayed
    backfills/NAME/             states of an explicitly loaded range
    snapshots/v=V/day=D/        merged states of a day, a part of that day
    manifest/v=V/               what is merged by then, and the parts of each day

Batch numbers start again with a new checkpoint, so they are counted per query.

A reader takes the parts that the newest manifest lists plus everything it does not
contain yet. A compaction rewrites only days that have something new, and of such a day only the parts that are
not much larger than what comes to them: a late row does not rewrite a large day. So a day has a few parts, each some times
the size of the next, and a state row is rewritten a number of times that grows with the logarithm of its day. A
snapshot counts only once its manifest is written, so a failed compaction changes nothing. States need no
watermark: a late event adds to its day.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.events import combine_states, event_states, live_aggregates
from tidemark.schemas import EVENT_STATES
from tidemark.sources.writers import laid_out
from tidemark.workspace import DONE, NO_DAY, Folder, run_of

#: A part is merged with what is new if it has at most so many times its rows.
FACTOR = 4
MANIFEST = """upto array<struct<run: string, last: long>>, backfills array<string>,
    parts array<struct<day: string, version: int, rows: long>>"""


class Merged:
    """What the newest manifest says: its version, the last micro-batch of each run, backfills, parts by day."""

    def __init__(self, version: int | None = None, row=None):
        self.version = version
        self.upto: dict[str, int] = {r["run"]: r["last"] for r in row["upto"]} if row else {}
        self.backfills: list[str] = row["backfills"] if row else []
        self.parts: dict[str, list[tuple[int, int]]] = {}
        for part in row["parts"] if row else []:
            self.parts.setdefault(part["day"], []).append((part["version"], part["rows"]))

    def folders(self) -> list[str]:
        return [f"v={version}/day={day}" for day, parts in self.parts.items() for version, _ in parts]

    def absorbed(self, day: str, rows: int) -> list[tuple[int, int]]:
        """The parts of a day that so many new rows are merged with, newest first."""
        found = []
        for version, size in sorted(self.parts.get(day, []), reverse=True):
            if size > FACTOR * rows:
                break
            found.append((version, size))
            rows += size
        return found


class EventStates:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._folder = Folder(spark, self.path)

    def maintain(self, events: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        """Start the stream that appends the states of every micro-batch."""

        def store(batch: DataFrame, batch_id: int) -> None:
            run = run_of(self.spark, checkpoint)
            event_states(batch).write.mode("overwrite").parquet(self.batch_path(run, batch_id))

        return (
            events.writeStream.foreachBatch(store)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    def batch_path(self, run: str, batch_id: int) -> str:
        return f"{self.path}/batches/run={run}/batch_id={batch_id}"

    def backfill(self, events: DataFrame, name: str) -> None:
        """Load states of events the stream has not seen; the same name replaces its load.

        A name that a snapshot already contains is refused.
        """
        if name in self._merged().backfills:
            raise ValueError(f"backfill {name} is already part of a snapshot")
        event_states(events).write.mode("overwrite").parquet(f"{self.path}/backfills/{name}")

    def _merged(self) -> Merged:
        versions = sorted((int(v.removeprefix("v=")) for v in self._folder.names("manifest")), reverse=True)
        for version in versions:
            if self._folder.has(f"manifest/v={version}/{DONE}"):
                return Merged(version, self.spark.read.schema(MANIFEST).json(f"{self.path}/manifest/v={version}").first())
        return Merged()

    def _batches(self) -> list[tuple[str, int]]:
        """Runs and numbers of the micro-batches that are there, finished or not."""
        return [(run.removeprefix("run="), int(n.removeprefix("batch_id=")))
                for run in self._folder.names("batches") for n in self._folder.names(f"batches/{run}")]

    def _pending(self, merged: Merged) -> tuple[list[tuple[str, int]], list[str]]:
        """Finished micro-batches and backfills that are not merged yet; only these are looked into."""
        batches = [(run, i) for run, i in self._batches() if i > merged.upto.get(run, -1)]
        names = [n for n in self._folder.names("backfills") if n not in merged.backfills]
        return ([b for b in batches if self._folder.has(f"batches/run={b[0]}/batch_id={b[1]}/{DONE}")],
                [n for n in names if self._folder.has(f"backfills/{n}/{DONE}")])

    def _read(self, folders: list[str], batches: list[tuple[str, int]] = (), names: list[str] = ()) -> DataFrame:
        paths = [f"{self.path}/snapshots/{f}" for f in folders]
        paths += [self.batch_path(*b) for b in batches]
        paths += [f"{self.path}/backfills/{n}" for n in names]
        if not paths:
            return self.spark.createDataFrame([], EVENT_STATES)
        reader = self.spark.read.schema(EVENT_STATES).option("recursiveFileLookup", True)
        return reader.parquet(*paths)

    def read(self, as_of=None) -> DataFrame:
        """State rows; merge them with ``operators.events.merge_states``.

        ``as_of`` leaves out days past the retention of aggregates.
        """
        merged = self._merged()
        states = self._read(merged.folders(), *self._pending(merged))
        return states if as_of is None else live_aggregates(states, as_of)

    def compact(self, as_of=None) -> int:
        """Merge what is new into the parts of its days, publish them, return the version.

        With ``as_of`` expired days are no longer listed. What is replaced stays readable until ``retire``.
        """
        merged = self._merged()
        batches, names = self._pending(merged)
        new = 0 if merged.version is None else merged.version + 1
        pending = combine_states(self._read([], batches, names))
        if as_of is not None:
            pending = live_aggregates(pending, as_of)
            kept = live_aggregates(self._days(merged), as_of)
            live = {str(r["event_date"]) for r in kept.collect()}
            merged.parts = {day: parts for day, parts in merged.parts.items() if day in live}
        sizes = {self._name(r["event_date"]): r["count"] for r in pending.groupBy("event_date").count().collect()}
        absorbed = {day: merged.absorbed(day, rows) for day, rows in sizes.items()}
        old = self._read([f"v={version}/day={day}" for day, parts in absorbed.items() for version, _ in parts])
        target = f"{self.path}/snapshots/v={new}"
        laid_out(combine_states(pending.unionByName(old)), ["event_type", "user_bucket"]).withColumn(
            "day", F.col("event_date")).write.mode("overwrite").partitionBy("day").parquet(target)
        if sizes:
            for r in self._read([f"v={new}"]).groupBy("event_date").count().collect():
                day = self._name(r["event_date"])
                left = [p for p in merged.parts.get(day, []) if p not in absorbed[day]]
                merged.parts[day] = [*left, (new, r["count"])]
        for run, i in batches:
            merged.upto[run] = max(i, merged.upto.get(run, -1))
        parts = [(day, *part) for day, some in sorted(merged.parts.items()) for part in some]
        manifest = self.spark.createDataFrame([(list(merged.upto.items()), [*merged.backfills, *names], parts)], MANIFEST)
        manifest.coalesce(1).write.mode("overwrite").json(f"{self.path}/manifest/v={new}")
        return new

    def _days(self, merged: Merged) -> DataFrame:
        days = [(None if day == NO_DAY else datetime.date.fromisoformat(day),) for day in merged.parts]
        return self.spark.createDataFrame(days, "event_date date")

    @staticmethod
    def _name(day: datetime.date | None) -> str:
        return NO_DAY if day is None else str(day)

    def retire(self) -> None:
        """Remove what the newest snapshot contains or replaces, once no reader uses it."""
        merged = self._merged()
        if merged.version is None:
            return
        for run, i in self._batches():
            if i <= merged.upto.get(run, -1):
                self._folder.remove(f"batches/run={run}/batch_id={i}")
        for name in self._folder.names("backfills"):
            if name in merged.backfills:
                self._folder.remove(f"backfills/{name}")
        used = set(merged.folders())
        for version in self._folder.names("snapshots"):
            days = [n for n in self._folder.names(f"snapshots/{version}") if n.startswith("day=")]
            unused = [f"{version}/{day}" for day in days if f"{version}/{day}" not in used]
            for folder in [version] if len(unused) == len(days) else unused:
                if int(version.removeprefix("v=")) <= merged.version:
                    self._folder.remove(f"snapshots/{folder}")
        for name in self._folder.names("manifest"):
            if int(name.removeprefix("v=")) < merged.version:
                self._folder.remove(f"manifest/{name}")


def expire_days(spark: SparkSession, path: str, first_kept: str) -> list[str]:
    """Drop whole ``event_date=`` folders before ``first_kept``; returns their names.

    The filters in ``operators.events`` decide the rows of the boundary day.
    """
    folder = Folder(spark, path)
    old = [
        n for n in folder.names()
        if n.startswith("event_date=") and n.removeprefix("event_date=") < first_kept
    ]
    for name in old:
        folder.remove(name)
    return old
