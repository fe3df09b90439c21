"""The change log of a stream of versions, with the last version of each key kept as a table.

Folder layout::

    log/run=R/batch_id=N/      changes of micro-batch N of the query R, replaced if N is replayed
    latest/run=R/batch_id=N/   the last version of each key in that batch
    merged/v=V/                the last version of each key, of all batches that manifest V names
    manifest/v=V/              one row: the batches in V

Updates are logged in the order they arrive, as a trigger does: a version that comes late follows the one that is
kept. A batch reads the last versions of its own keys only. A merged table counts once its manifest is
written; what it contains stays until ``retire``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.operators.audit import consecutive, field_changes, versions_of
from tidemark.schemas import AUDIT
from tidemark.workspace import DONE, Folder, fresh_folder, run_of, written

MANIFEST = "number long, batches array<string>"


class ChangeHistory:
    """``fields`` of rows with the given schema are logged; ``number`` counts batches, so a later one wins."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, fields: list[str], at: str = "updated_at",
                 key: str = "id", changed_by=None):
        self.spark, self.path, self.fields, self.at, self.key = spark, path.rstrip("/"), fields, at, key
        self.changed_by = changed_by
        now = StructType([f for f in schema if f.name != key])
        self._kept = StructType([StructField("id", schema[key].dataType), StructField("number", LongType()), StructField("now", now)])
        self._folder = Folder(spark, self.path)

    def maintain(self, versions: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        """Start the stream that logs the changes of every micro-batch; one such stream runs at a time."""
        def store(batch: DataFrame, batch_id: int) -> None:
            self.store(batch, f"run={run_of(self.spark, checkpoint)}/batch_id={batch_id}")

        return (
            versions.writeStream.foreachBatch(store)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    def store(self, batch: DataFrame, name: str) -> None:
        """Log a batch and keep its last versions; the same name replaces what it logged before."""
        work = fresh_folder(self.spark, "history")
        given = written(versions_of(batch, self.at, self.key), f"{work}/versions")
        number, kept = self._before(name)
        before = kept.join(given.select("id").distinct(), "id", "left_semi").select(
            "id", F.struct(F.lit(0).alias("kind"), F.lit(None).cast(given.schema["turn"].dataType["at"].dataType).alias("at")).alias("turn"), "now")
        pairs = consecutive(before.unionByName(given)).withColumnRenamed("id", self.key)
        changes = field_changes(pairs, self.fields, F.col(f"new.{self.at}"), self.changed_by, self.key)
        changes.write.mode("overwrite").parquet(f"{self.path}/log/{name}")
        last = given.groupBy("id").agg(F.max_by("now", F.struct("turn", "now")).alias("now"))
        last.select("id", F.lit(number).cast("long").alias("number"), "now").write.mode("overwrite").parquet(f"{self.path}/latest/{name}")
        Folder(self.spark, work).remove("")

    def _batches(self) -> list[str]:
        found = [f"{run}/{n}" for run in self._folder.names("latest") for n in self._folder.names(f"latest/{run}")]
        return [name for name in found if self._folder.has(f"latest/{name}/{DONE}")]

    def _merged(self) -> tuple[int | None, int, list[str]]:
        """Newest merged version, its number, and the batches in it."""
        done = [v for v in self._folder.names("manifest") if self._folder.has(f"manifest/{v}/{DONE}")]
        if not done:
            return None, 0, []
        version = max(int(v.removeprefix("v=")) for v in done)
        row = self.spark.read.schema(MANIFEST).json(f"{self.path}/manifest/v={version}").first()
        return version, row["number"], row["batches"]

    def _before(self, name: str | None = None) -> tuple[int, DataFrame]:
        """The number of the next batch, and the last version of each key before the batch ``name``."""
        version, number, merged = self._merged()
        pending = [b for b in self._batches() if b not in merged and b != name]
        paths = [f"{self.path}/latest/{b}" for b in pending] + ([] if version is None else [f"{self.path}/merged/v={version}"])
        if not paths:
            return number + 1, self.spark.createDataFrame([], self._kept)
        rows = self.spark.read.schema(self._kept).parquet(*paths)
        return number + len(pending) + 1, rows.groupBy("id").agg(
            F.max("number").alias("number"), F.max_by("now", "number").alias("now"))

    def latest(self) -> DataFrame:
        """The last version of each key."""
        return self._before()[1].select(F.col("id").alias(self.key), "now.*")

    def log(self) -> DataFrame:
        """The changes of all batches."""
        if not self._folder.has("log"):
            return self.spark.createDataFrame([], AUDIT)
        reader = self.spark.read.schema(AUDIT).option("recursiveFileLookup", True)
        return reader.parquet(f"{self.path}/log")

    def merge(self) -> int:
        """Put the last versions of all batches into one table, publish it, return its version."""
        version, number, merged = self._merged()
        pending = [b for b in self._batches() if b not in merged]
        _, rows = self._before()
        new = 0 if version is None else version + 1
        rows.write.mode("overwrite").parquet(f"{self.path}/merged/v={new}")
        manifest = self.spark.createDataFrame([(number + len(pending), [*merged, *pending])], MANIFEST)
        manifest.coalesce(1).write.mode("overwrite").json(f"{self.path}/manifest/v={new}")
        return new

    def retire(self) -> None:
        """Remove what the newest merged table contains, once no reader uses it."""
        version, _, merged = self._merged()
        if version is None:
            return
        for name in self._batches():
            if name in merged:
                self._folder.remove(f"latest/{name}")
        for kind in ("manifest", "merged"):
            for name in self._folder.names(kind):
                if int(name.removeprefix("v=")) < version:
                    self._folder.remove(f"{kind}/{name}")
