"""A queue of files with a ledger of their attempts (S3, T5).

A file is taken whole or not at all: one with a line that is rejected, or that cannot be
read, is left out of its load and goes to the end of the queue; the other files of the
load are not held up. After so many tries it is set aside. Ledger rows are published
in the commit of the load they tell of. A file is known by its place, size and time
of change, so one that has been mended is a new one and is taken again.
"""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from postmill.plans.load import load_staging, merge_staging
from postmill.plans.store import Store
from postmill.schema import LEDGER
from postmill.sources.lines import read_lines

LOADED, FAILED, SET_ASIDE = "loaded", "failed", "set aside"

# Attempts a file has, and files taken at a time, one per worker (fixed value).
TRIES, FILES_PER_LOAD = 3, 7

_VERSION = ["src_file", "modified", "size"]
_JOB_ERRORS = (PySparkException, Py4JJavaError)


def listed_files(spark: SparkSession, folder: str | list[str], pattern: str = "*.json") -> DataFrame:
    """``path, src_file, modified, size`` of the files under a folder, or of the files named;
    none is opened. Files of no bytes hold nothing and are not listed."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    named = F.col("_metadata.file_path").alias("src_file")
    return reader.load(folder).select("path", named, F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def waiting(store: Store, files: DataFrame) -> DataFrame:
    """Files that are neither loaded nor set aside as they are now, with the number of the
    attempt that is next."""
    done = F.max(F.col("outcome").isin(LOADED, SET_ASIDE)).alias("_done")
    known = store.read(LEDGER.name).groupBy(*_VERSION).agg(F.max("attempt").alias("_last"), done)
    left = files.join(known, _VERSION, "left").where(~F.coalesce("_done", F.lit(False)))
    return left.select("path", *_VERSION, (F.coalesce("_last", F.lit(0)) + 1).alias("attempt"))


def _entries(store: Store, taken: list[Row], broken: dict[str, str], tries: int) -> DataFrame:
    """Ledger rows of files; those in ``broken`` have failed for the reason given there."""
    rows = []
    for file in taken:
        reason = broken.get(file["src_file"])
        outcome = LOADED if reason is None else FAILED if file["attempt"] < tries else SET_ASIDE
        rows.append((file["path"], file["src_file"], file["modified"], file["size"], file["attempt"], outcome, reason))
    return store.spark.createDataFrame(rows, LEDGER.ddl)


def _read_error(spark: SparkSession, path: str) -> str | None:
    """Why a file cannot be read to its end, or None."""
    try:
        spark.read.text(path).write.format("noop").mode("overwrite").save()
    except _JOB_ERRORS as error:
        return f"unreadable: {type(error).__name__}"
    return None


def stage_files(store: Store, taken: list[Row], ingest_ts, tries: int = TRIES, pattern: str = "*.json", **options) -> None:
    """One load of the files in ``taken`` (rows of :func:`waiting`), with its ledger rows.

    Where the load itself fails, each file is read by itself; those that cannot be are
    noted as failed, and the rest stays in the queue for the next load. An error
    that is no file's is raised.
    """

    def note(left_out: DataFrame) -> dict[str, int]:
        number = store.marks().get(LEDGER.name, 0) + 1
        broken = {row["src_file"]: row["reason"] for row in left_out.collect()}  # a row per file taken, at most
        store.write(LEDGER.name, _entries(store, taken, broken, tries), number)
        return {LEDGER.name: number}

    lines = read_lines(store.spark, [file["path"] for file in taken], pattern)
    try:
        load_staging(store, lines, ingest_ts, None, "file", left_out=note, **options)
    except _JOB_ERRORS:
        unreadable = {file["src_file"]: _read_error(store.spark, file["path"]) for file in taken}
        broken = [file for file in taken if unreadable[file["src_file"]]]
        if not broken:
            raise
        with store.writing():
            number = store.marks().get(LEDGER.name, 0) + 1
            store.write(LEDGER.name, _entries(store, broken, unreadable, tries), number)
            store.publish({LEDGER.name: number})


def load_files(
    store: Store,
    folder: str | list[str],
    clock: Callable[[int], object],
    pattern: str = "*.json",
    tries: int = TRIES,
    files_per_load: int = FILES_PER_LOAD,
    **options,
) -> int:
    """S3, T4, T5: take all waiting files, a few at a time, those with the fewest attempts
    first; when none is left, merge. ``clock`` gives the time of intake of each load.
    Returns the number of loads; ``options`` go to :func:`load_staging`."""
    turns = 0
    while True:
        queue = waiting(store, listed_files(store.spark, folder, pattern))
        taken = queue.orderBy("attempt", "path").limit(files_per_load).collect()
        if not taken:
            break
        stage_files(store, taken, clock(turns), tries, pattern, **options)
        turns += 1
    merge_staging(store)
    return turns


def note_failed(store: Store, left_out: DataFrame, tries: int = TRIES) -> dict[str, int]:
    """Ledger rows for the first attempt of files a stream's batch has left out, which it
    will not bring again; returns the marks for the batch's commit."""
    reasons = {row["src_file"]: row["reason"] for row in left_out.collect()}  # files of one batch at most
    if not reasons:
        return {}
    hadoop, uri = store.spark.sparkContext._jvm.org.apache.hadoop.fs, store.spark.sparkContext._jvm.java.net.URI
    paths = [hadoop.Path(uri(name)).toString() for name in reasons]
    files = listed_files(store.spark, paths, "*").withColumn("attempt", F.lit(1)).collect()
    number = store.marks().get(LEDGER.name, 0) + 1
    store.write(LEDGER.name, _entries(store, files, reasons, tries), number)
    return {LEDGER.name: number}


def failed_files(store: Store) -> list[str]:
    """The files whose last attempt failed, neither loaded nor set aside since."""
    newest = F.max_by("outcome", F.struct("modified", "attempt")).alias("outcome")
    last = store.read(LEDGER.name).groupBy("path").agg(newest)
    return [row["path"] for row in last.where(F.col("outcome") == FAILED).orderBy("path").collect()]


def retry_files(store: Store, clock: Callable[[int], object], tries: int = TRIES, **options) -> int:
    """T5: take the failed files again until each is loaded or set aside."""
    paths = failed_files(store)
    return load_files(store, paths, clock, "*", tries, **options) if paths else 0
