"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key under a total ``order``.

    The planner puts a group limit before the shuffle, so a task sends one row
    per key it holds and a key with a third of all rows costs one row per task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def first_in_file(df: DataFrame, *keys: str) -> DataFrame:
    """A5: the first line of every key within its file. Keys come first, as a sort tells
    them apart sooner than names of files."""
    return first_per_key(df, [*keys, "src_file"], [F.col("pos")])


def one_name_per_user(users: DataFrame) -> DataFrame:
    """The alphabetically first name of every user over all batches."""
    return users.groupBy("user_ext_id").agg(F.min("name").alias("name"))


def latest_copy(posts: DataFrame) -> DataFrame:
    """The copy of every post that was taken in last; ties go to the later
    file name and within a file to the earlier line."""
    order = [F.desc("ingest_ts"), F.desc("src_file"), F.asc("pos")]
    return first_per_key(posts, ["post_ext_id"], order)
