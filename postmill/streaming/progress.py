"""Durations and rows of a stream's batches as stored steps."""

from __future__ import annotations

import json
import threading
import uuid
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from postmill.plans.store import Store
from postmill.schema import PROFILES, TIMINGS


class BatchTimes(StreamingQueryListener):
    """Collects what Spark reports of each batch of the streams that run meanwhile.

    ``with BatchTimes(spark) as times:`` listens; ``times.of(query)`` waits until all
    events of an ended query have come, since they are delivered later than it ends.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._batches: dict[str, list[dict]] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def __enter__(self) -> BatchTimes:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        self.spark.streams.removeListener(self)

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        batch = {
            "batch": progress.batchId,
            "lines": progress.numInputRows,
            "ms": dict(progress.durationMs),
            "at": datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00")),
        }
        with self._lock:
            self._batches.setdefault(str(progress.runId), []).append(batch)

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def of(self, query: StreamingQuery, seconds: float = 60) -> list[dict]:
        """The batches of a query that has ended, in order; empty triggers are left out."""
        run = str(query.runId)
        if not self._end(run).wait(seconds):
            raise TimeoutError(f"the end of stream {run} was not reported within {seconds} s")
        with self._lock:
            found = {batch["batch"]: batch for batch in self._batches.get(run, []) if "addBatch" in batch["ms"]}
        return [found[number] for number in sorted(found)]


def batch_steps(spark: SparkSession, batches: list[dict], name: str = "stream") -> tuple[DataFrame, DataFrame]:
    """The timings and the profile of one run of a stream: a root and a step per batch,
    whose ``custom`` holds the batch's number and the lines it read."""
    profile, root = str(uuid.uuid4()), str(uuid.uuid4())
    begin = min((batch["at"] for batch in batches), default=datetime.now(timezone.utc))

    def ms(value: float) -> Decimal:
        return Decimal(f"{value:.3f}")

    steps, total = [], 0.0
    for batch in batches:
        took, start = batch["ms"].get("triggerExecution", batch["ms"]["addBatch"]), (batch["at"] - begin).total_seconds() * 1000
        total = max(total, start + took)
        custom = json.dumps({"batch": batch["batch"], "lines": batch["lines"]}, sort_keys=True)
        steps.append((str(uuid.uuid4()), profile, root, "batch", ms(took), ms(start), False, 1, custom))
    rows = [(root, profile, None, name, ms(total), ms(0), True, 0, None), *steps]
    whole = [(profile, root, begin, Decimal(f"{total:.1f}"), None, None)]
    return spark.createDataFrame(rows, TIMINGS.ddl), spark.createDataFrame(whole, PROFILES.ddl)


def store_batches(store: Store, batches: list[dict]) -> None:
    """Publish the steps of a stream's run; a run without a batch leaves none."""
    if not batches:
        return
    with store.writing():
        marks = store.marks()
        numbers = {name: marks.get(name, 0) + 1 for name in (TIMINGS.name, PROFILES.name)}
        for name, rows in zip(numbers, batch_steps(store.spark, batches), strict=True):
            store.write(name, rows, numbers[name])
        store.publish(numbers)
