"""T2 within a stream: each key once, however late it comes again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from postmill.session import settings_during

# The state is on the executors' disks with a log of its changes in the checkpoint, not on
# their heaps, since it holds every key there ever was.
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def write_unique(rows: DataFrame, keys: list[str], path: str, checkpoint: str) -> StreamingQuery:
    """Append the first row of every key of a stream to a Parquet folder.

    There is no watermark, so no row is too late: a key met in any earlier batch, also
    before a restart, is left out, and no new one is dropped. Which of several rows of one
    batch stays is open. The state grows by one key for every row written, is spread by key
    over ``spark.sql.shuffle.partitions`` (fixed by the first start) and needs disk on the
    executors; the merge's anti-join (:func:`postmill.plans.merge.new_posts`) needs none and
    is the way for posts that are stored anyway. A null key is a key like others.
    """
    with settings_during(rows.sparkSession, STATE_ON_DISK):
        return (
            rows.dropDuplicates(keys)
            .writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
