"""Streams over a landing folder."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postmill.functions.text import is_blank
from postmill.plans.ledger import note_failed, retry_files
from postmill.plans.load import load_staging, merge_staging
from postmill.plans.store import Store
from postmill.sources.lines import with_position
from postmill.streaming.progress import BatchTimes, store_batches

# Fixed value: files taken in at a time, one per worker.
FILES_PER_TRIGGER = 7


def land(lines: DataFrame, path: str, checkpoint: str, wanted: Column | None = None) -> StreamingQuery:
    """K1: append every non-blank line of a stream, once, to a landing folder.

    ``wanted`` is an optional subscription predicate on ``value``.
    """
    kept = lines.where(~is_blank(F.col("value")))
    if wanted is not None:
        kept = kept.where(wanted)
    return (
        kept.select("value")
        .writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drain(lines: DataFrame, path: str, checkpoint: str) -> None:
    """K2: write the whole backlog and stop; a later call writes only what is new."""
    land(lines, path, checkpoint).awaitTermination()


def checkpoint_id(store: Store, checkpoint: str) -> str:
    """The id a stream gave its checkpoint when it first wrote there."""
    return json.loads(store.spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def stage_stream(
    store: Store,
    lines: DataFrame,
    clock: Callable[[int], object],
    checkpoint: str,
    on_error: str = "quarantine",
) -> StreamingQuery:
    """Every micro-batch is one staging load.

    The commit of a load also marks its batch as done, under the identity of the
    checkpoint, since batches are numbered per checkpoint. A batch that failed
    half way overwrites its own partitions when it runs again, and one that is
    already committed is skipped. With a new checkpoint all files come again;
    the merge knows their posts. ``clock`` gives the time of intake of a batch.

    With ``on_error="file"`` a file with a rejected line does not hold up its batch: it is
    left out and noted as failed in the ledger, for ``retry_files``.
    """

    def one_batch(batch: DataFrame, epoch: int) -> None:
        done = f"stream:{checkpoint_id(store, checkpoint)}"
        if epoch < store.committed(done):
            return
        load_staging(
            store, with_position(batch), clock(epoch), None, on_error, also={done: epoch + 1},
            left_out=lambda broken: note_failed(store, broken),
        )

    return (
        lines.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def load_stream(
    store: Store,
    lines: DataFrame,
    clock: Callable[[int], object],
    checkpoint: str,
    on_error: str = "quarantine",
) -> int:
    """Stage the backlog, and when it is empty merge it once. How long each batch
    took, and the lines it read, are stored as steps."""
    with BatchTimes(store.spark) as times:
        query = stage_stream(store, lines, clock, checkpoint, on_error)
        query.awaitTermination()
        batches = times.of(query)
    store_batches(store, batches)
    if on_error == "file":
        retry_files(store, clock)
    return merge_staging(store)
