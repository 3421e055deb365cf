"""Streams that run on: an end by silence, and models that are refreshed while requests are scored.

``run_until_idle`` keeps a stream running with processing-time triggers and ends it after a time without new rows, as a consumer's
time-out does. Spark reports a trigger without data as idle and one with data as progress; a listener notes the last report with rows.

``ModelShelf`` is a side input with versions: before a micro-batch is scored, the model folders found then are written down, and a
retry scores with those. Models are packed tables (``ensembles.packed_models``), so the scoring plan doesn't grow with their number.
"""

from __future__ import annotations

import json
import threading
import time
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators import ensembles, requests
from ..session import list_dir, path_exists
from ..sources.models import FOLDER_PREFIX, _identity


class Activity(StreamingQueryListener):
    """When one query last had rows."""

    def __init__(self, name: str) -> None:
        self.name, self.run = name, None
        self.last = time.monotonic()
        self.rows = 0
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            with self._lock:
                self.run, self.last = event.runId, time.monotonic()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name == self.name and p.numInputRows > 0:
            with self._lock:
                self.last, self.rows = time.monotonic(), self.rows + p.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def silent_for(self) -> float:
        with self._lock:
            return time.monotonic() - self.last


def run_until_idle(spark: SparkSession, writer, idle_s: float, trigger: str = "0 seconds", name: str = "idle", poll_s: float = 0.2):
    """Run a stream writer until no row came for ``idle_s`` seconds; what has arrived by then is written. Returns (query, rows read)."""
    activity = Activity(f"{name}_{uuid.uuid4().hex[:8]}")
    spark.streams.addListener(activity)
    query = writer.queryName(activity.name).trigger(processingTime=trigger).start()
    try:
        while query.isActive:
            if activity.silent_for() >= idle_s and not query.status["isTriggerActive"]:
                before = activity.rows
                query.processAllAvailable()  # rows that came in the meantime
                query.awaitTermination(poll_s)
                if activity.rows == before and activity.silent_for() >= idle_s:
                    break
            query.awaitTermination(poll_s)
        if query.exception():
            raise RuntimeError(str(query.exception()))
        return query, activity.rows
    finally:
        query.stop()
        spark.streams.removeListener(activity)


class ModelShelf:
    """The models of a folder as of each micro-batch; ``log`` keeps which ones a micro-batch was scored with."""

    def __init__(self, spark: SparkSession, models_dir: str, log: str):
        self.spark, self.models_dir, self.log = spark, models_dir.rstrip("/"), log.rstrip("/")
        self._packed: tuple[str, DataFrame] | None = None

    def found(self) -> dict[str, str]:
        """Complete model folders and the identity of their files (S15); a folder that is still being written has none."""
        out = {}
        for name, is_dir in sorted(list_dir(self.spark, self.models_dir)):
            path = f"{self.models_dir}/{name}"
            if is_dir and name.startswith(FOLDER_PREFIX) and path_exists(self.spark, f"{path}/metadata/_SUCCESS") and self._whole(path):
                out[name] = _identity(self.spark, path)
        return out

    def _whole(self, path: str) -> bool:
        """Every stage down to the last is written."""
        stages = [n for n, is_dir in list_dir(self.spark, f"{path}/stages") if is_dir]
        meta = json.loads(self.spark.read.text(f"{path}/metadata").first()[0])
        want = meta["paramMap"].get("stageUids", [])
        return len(stages) == len(want) and all(path_exists(self.spark, f"{path}/stages/{n}/metadata/_SUCCESS") for n in stages)

    def as_of(self, batch_id: int) -> dict[str, str]:
        """The folders a micro-batch is scored with: those written down at its first try, else those found now."""
        place = f"{self.log}/mb={batch_id}"
        if path_exists(self.spark, f"{place}/_SUCCESS"):
            return {r.folder: r.identity for r in self.spark.read.schema("folder STRING, identity STRING").json(place).collect()}
        now = self.found()
        self.spark.createDataFrame(list(now.items()), "folder STRING, identity STRING").coalesce(1).write.mode("overwrite").json(place)
        return now

    def models(self, batch_id: int) -> DataFrame:
        """Packed models of a micro-batch; kept while the folders stay the same."""
        folders = self.as_of(batch_id)
        key = json.dumps(folders, sort_keys=True)
        if self._packed is None or self._packed[0] != key:
            if self._packed is not None:
                self._packed[1].unpersist()
            packed = ensembles.packed_models(self.spark, [f"{self.models_dir}/{n}" for n in sorted(folders)])
            self._packed = (key, packed.persist(StorageLevel.MEMORY_AND_DISK))
        return self._packed[1]

    def close(self) -> None:
        if self._packed is not None:
            self._packed[1].unpersist()
            self._packed = None


def scoring_batch(shelf: ModelShelf, out: str):
    """``foreachBatch`` function: score requests with the models of the moment into ``<out>/mb=<id>``, with the versions that were known.

    Files that arrive differ in size, so rows are dealt out before they are parsed.
    """
    def score(batch: DataFrame, batch_id: int) -> None:
        models = shelf.models(batch_id)
        versions = sorted(r[0] for r in models.select("model_version").collect())  # a row a version
        spread = batch.repartition("request_id", "value")
        scored = requests.score(requests.with_status(requests.parsed(spread, versions=versions), versions), models)
        scored.drop("body").withColumn("known", F.array(*map(F.lit, versions)).cast("array<string>")).write.mode("overwrite").parquet(f"{out}/mb={batch_id}")
    return score
