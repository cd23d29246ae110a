"""Counts, rates and step timings."""

from __future__ import annotations

import json
import time
import uuid
from contextlib import contextmanager
from datetime import datetime, timezone
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postmill.functions.scalar import rate_per_second
from postmill.schema import PROFILES, TIMINGS


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """A1: one row per table with its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("t"), "n") for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def max_by_group(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """The largest value of each group, largest first."""
    return df.groupBy(group).agg(F.max(value).alias(out)).orderBy(F.desc(out), group)


def distinct_compare(df: DataFrame, key: str, value: str, pairs_as: str = "pairs", keys_as: str = "users") -> DataFrame:
    """A4: distinct (key, value) pairs beside distinct keys; more pairs than
    keys means that some keys changed their value.

    Counted in steps over the distinct pairs, so no row is expanded and the
    second step only sees one row per pair.
    """
    per_key = df.select(key, value).distinct().groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias(pairs_as),
        F.count(key).alias(keys_as),
    )


def duplicate_count(df: DataFrame, keys: list[str], out: str = "dups") -> DataFrame:
    """Rows beyond the first of their key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias(out))


def throughput(df: DataFrame, group: str, elapsed_ms: Column, out: str = "rate") -> DataFrame:
    """Rows per second of each batch, from its largest elapsed time."""
    per_batch = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), F.max(elapsed_ms).alias("_ms"))
    return per_batch.select(group, rate_per_second(F.col("_n"), F.col("_ms")).alias(out))


def stored_rates(steps: DataFrame) -> DataFrame:
    """A7 over stored steps: ``id, name, batch, rows, duration_ms, rate`` of every load and
    every stream batch, from the rows noted with it and the time it took.

    A load is a root step; its rows are the posts its steps wrote. A batch of a
    stream is a step that noted the lines it read.
    """
    noted = F.from_json("custom", "map<string,bigint>")
    per_step = steps.select("*", noted.alias("_n"))
    posts = per_step.groupBy("profile_id").agg(F.max(F.col("_n")["posts_stage"]).alias("_posts"))
    loads = per_step.where("is_root").join(posts.where("_posts is not null"), "profile_id")
    loads = loads.select("id", "name", F.lit(None).cast("bigint").alias("batch"), F.col("_posts").alias("rows"), "duration_ms")
    batches = per_step.where(F.col("_n")["lines"].isNotNull())
    batches = batches.select("id", "name", F.col("_n")["batch"].alias("batch"), F.col("_n")["lines"].alias("rows"), "duration_ms")
    every = loads.unionByName(batches)
    return every.withColumn("rate", rate_per_second(F.col("rows"), F.col("duration_ms")))


def matching(df: DataFrame, column: str, value, order: list[Column] | None = None) -> DataFrame:
    """Rows with one value, sorted when an order is given."""
    rows = df.where(F.col(column) == F.lit(value))
    return rows.orderBy(*order) if order else rows


def newest_first(df: DataFrame, moment: str, key: str) -> DataFrame:
    """O2: whole table, newest row first, equal times by key."""
    return df.orderBy(F.desc(moment), key)


class StepTimer:
    """Wall-clock tree of named steps, stored as rows.

    ``step`` nests; ``observe`` counts the rows that flow through a frame while
    it is written, without a job of its own.
    """

    def __init__(self, name: str, user: str | None = None, machine: str | None = None) -> None:
        self.profile_id = str(uuid.uuid4())
        self.started = datetime.now(timezone.utc)
        self.user, self.machine = user, machine
        self._zero = time.perf_counter()
        self._root = {"id": str(uuid.uuid4()), "parent": None, "name": name, "start": 0.0, "depth": 0}
        self._open = [self._root]
        self._done: list[dict] = []
        self._observed: dict[str, Observation] = {}

    def _ms(self) -> float:
        return (time.perf_counter() - self._zero) * 1000

    @contextmanager
    def step(self, name: str):
        """Time a block as a child of the step around it."""
        entry = {
            "id": str(uuid.uuid4()),
            "parent": self._open[-1]["id"],
            "name": name,
            "start": self._ms(),
            "depth": len(self._open),
        }
        self._open.append(entry)
        try:
            yield self
        finally:
            self._open.pop()
            entry["took"] = self._ms() - entry["start"]
            self._done.append(entry)

    def observe(self, df: DataFrame, name: str) -> DataFrame:
        """Count the rows of ``df`` when it runs; see :meth:`observed`."""
        self._observed[name] = Observation(f"{name}-{self.profile_id}")
        return df.observe(self._observed[name], F.count(F.lit(1)).alias("n"))

    def observed(self, name: str) -> int:
        """Rows counted by :meth:`observe`, once the frame has run."""
        return self._observed[name].get["n"]

    def note(self, name: str) -> None:
        """Keep the count of an observed frame that has run with the step that is open."""
        self._open[-1].setdefault("counts", {})[name] = self.observed(name)

    def timings(self, spark: SparkSession) -> DataFrame:
        """One row per step, the root included, in the declared layout; ``custom``
        holds the noted counts as JSON."""

        def ms(value: float) -> Decimal:
            return Decimal(f"{value:.3f}")

        entries = [{**self._root, "took": self._ms()}, *self._done]
        rows = [
            (e["id"], self.profile_id, e["parent"], e["name"], ms(e["took"]), ms(e["start"]), e["depth"] == 0,
             e["depth"], json.dumps(e["counts"], sort_keys=True) if "counts" in e else None)
            for e in entries
        ]
        return spark.createDataFrame(rows, TIMINGS.ddl)

    def profile(self, spark: SparkSession) -> DataFrame:
        """The one row that describes the whole run."""
        row = (self.profile_id, self._root["id"], self.started, Decimal(f"{self._ms():.1f}"), self.user, self.machine)
        return spark.createDataFrame([row], PROFILES.ddl)
