"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Reliable checkpoints are removed once the frame that made them is gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app: str = "postmill",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the fixed settings; ``settings`` adds or overrides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings_during(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of a session for as long as a block runs."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Taken from ``spark.checkpoint.dir``. Only a local master, where driver and
    executors share one disk, may fall back on a temporary folder of its own.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if current is None:
        if named is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            named = tempfile.mkdtemp(prefix="postmill-")
        context.setCheckpointDir(named)
    return (named or context.getCheckpointDir()).rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """New path under the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage through a reliable checkpoint, so a lost executor costs a
    re-read and never a re-run with other partition bounds."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def side_by_side(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """Run independent Spark actions at the same time, so that the last tasks of
    one leave no cores idle. Returns their results in order; the first error is
    raised once all have ended."""
    inheriting = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(inheriting(job)) for job in jobs]
    return [job.result() for job in running]
