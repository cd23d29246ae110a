"""Mixing sources to target weights (4): subset-sum budget fitting.

Every source gets a share of all words by its weight, at most ``MOST_TIMES`` its
own size; what is over goes to the others by weight until none is above. A source
whose target is k times its size and some more takes all documents k times, and
some once more. Which: documents are counted by exact length; of each length the
same share is taken, rounded down; what the budget then lacks is filled by
bounded knapsack over the counts that are left, exactly where lengths allow.
Documents of a length are chosen by a seeded hash.

Only counts by (source, length) meet: a source's lengths, never its documents,
are together in one task.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postmill.llm.columns import only, stored, with_columns_aside, words
from postmill.operators.joins import fits_broadcast
from postmill.operators.keys import dense_ids

MOST_TIMES = 3
#: Bits of the table of sums: at least so many, and so many times the longest document's words,
#: so that documents of every length take part.
LEAST_ROOM, ROOM_TIMES = 1 << 18, 8


def size_of(text: Column) -> Column:
    """The number of words of a text; 0 for null."""
    return F.size(words(text)).cast("bigint")


def cycled_weights(rank: Column) -> Column:
    """1, 2, 3, 1, 2, 3 ... for ranks from 1 on."""
    return (F.pmod(rank - 1, F.lit(3)) + 1).cast("double")


def targets(sources: DataFrame, weight: Column, most_times: int = MOST_TIMES) -> DataFrame:
    """Add ``target`` to ``sources`` (one row per source with its ``source_size``).

    Rounds of sums: each gives the words nobody holds yet to the sources below
    their limit, by weight; sources that get above it stop there. Words are
    exact, so the order of summing cannot change which sources stop.
    """
    rows = stored(sources.withColumn("_w", weight), "mix-sources")
    limit = F.col("source_size") * most_times
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0  # words per unit of weight
    while True:
        capped = limit <= F.col("_w") * level
        sums = rows.agg(
            F.sum(F.when(capped, limit).otherwise(0)).alias("held"), F.sum(F.when(capped, 0.0).otherwise(F.col("_w"))).alias("w")
        ).first()
        if not sums["w"]:
            break
        higher = (total - sums["held"]) / sums["w"]
        if higher <= level:
            break
        level = higher
    return rows.withColumn("target", F.least(F.col("_w") * level, limit.cast("double"))).drop("_w")


def fill(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int) -> np.ndarray:
    """How many documents of each length to take for as many words as ``budget``, or just
    below it: none of these choices takes more than there are."""
    taken = np.zeros(len(lengths), dtype=np.int64)
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return taken
    if budget >= total:
        return counts.copy()
    taken[:] = [int(count) * budget // total for count in counts.tolist()]
    taken[lengths == 0] = 0
    rest = budget - int((lengths * taken).sum())
    # Far from the budget, whole documents in a seeded order of lengths. What is left
    # over is always several times the longest document, for the table to choose in.
    room = max(LEAST_ROOM, ROOM_TIMES * int(lengths.max()))
    for i in np.random.default_rng(seed).permutation(len(lengths)):
        if rest <= room:
            break
        if lengths[i] > 0:
            more = int(min(counts[i] - taken[i], (rest - room // 2) // lengths[i]))
            if more > 0:
                taken[i] += more
                rest -= more * int(lengths[i])
    return taken + _knapsack(lengths, counts - taken, rest, seed)


def _knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int) -> np.ndarray:
    """Bounded subset sum: the largest sum up to the budget that the lengths allow.

    Bit s of ``reach`` says that s words can be had from the lengths so far; parts of
    1, 2, 4 ... documents stand for any number of them. Lengths come in a seeded
    order, in which few of them reach most sums. ``reach`` is kept at every
    ``stride``-th step only, the square root of their number; on the way back the
    steps between two of those are done once more.
    """
    steps: list[tuple[int, int]] = []  # length, documents
    for i in np.random.default_rng(seed + 1).permutation(len(lengths)):
        length, left = int(lengths[i]), int(counts[i])
        if not 0 < length <= budget:
            continue
        left, part = min(left, budget // length), 1
        while left > 0:
            part = min(part, left)
            steps.append((int(i), part))
            left, part = left - part, part * 2
    mask, stride = (1 << (budget + 1)) - 1, max(isqrt(len(steps)), 1)

    def after(reach: int, step: tuple[int, int]) -> int:
        return reach | (reach << (step[1] * int(lengths[step[0]]))) & mask

    kept, reach = [], 1
    for number, step in enumerate(steps):
        if number % stride == 0:
            kept.append(reach)
        reach = after(reach, step)
        if reach >> budget & 1:
            steps = steps[: number + 1]
            break
    taken = np.zeros(len(lengths), dtype=np.int64)
    at = reach.bit_length() - 1
    while kept:
        before = [kept.pop()]
        block = steps[len(kept) * stride : (len(kept) + 1) * stride]
        for step in block[:-1]:
            before.append(after(before[-1], step))
        for (i, part), earlier in zip(reversed(block), reversed(before), strict=True):
            if not earlier >> at & 1:
                taken[i] += part
                at -= part * int(lengths[i])
    return taken


def plan(histogram: DataFrame, seed: int) -> DataFrame:
    """For each (source, size) of the histogram (``_key``, ``size``, ``n``, ``source_size``,
    ``target``): ``times`` every document is taken, and how many once more, ``extra``."""

    def each(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size")
        whole, target = int(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
        goal = int(target + 1e-6)
        times = goal // whole if whole else 0
        own = seed + int(rows["_key"].iloc[0]) % (1 << 32)
        extra = fill(rows["size"].to_numpy(), rows["n"].to_numpy(), goal - times * whole, own)
        return rows.assign(times=times, extra=extra)[["_key", "size", "n", "times", "extra"]]

    return histogram.groupBy("_key").applyInPandas(each, "_key bigint, size bigint, n bigint, times bigint, extra bigint")


def _chosen(sized: DataFrame, plans: DataFrame, seed: int) -> DataFrame:
    """Add ``times`` (once more for the chosen ones) to the documents.

    Within a (source, size) the first ``extra`` by hash are chosen. A group of n
    is dealt into about sqrt(n) buckets in the order of the hash; buckets before
    the cut are taken whole, and rows are numbered within buckets only.
    """
    spread = F.struct(F.xxhash64("_id", "_hash", F.lit(seed)).alias("h"), "_id", "_hash")
    known = plans.where("n > 0")
    known = F.broadcast(known) if fits_broadcast(known) else known
    joined = sized.join(known, ["_key", "size"]).withColumn("_order", spread)
    width = F.greatest(F.lit(1), F.sqrt(F.col("n")).cast("int"))
    bucket = F.floor((F.col("_order.h") / 2.0**64 + 0.5) * width).cast("int")
    joined = stored(joined.withColumn("_bucket", bucket), "mix-dealt")
    partly = (F.col("extra") > 0) & (F.col("extra") < F.col("n"))
    sums = joined.where(partly).groupBy("_key", "size", "_bucket").agg(F.count(F.lit(1)).alias("_in"))
    running = Window.partitionBy("_key", "size").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_before", F.coalesce(F.sum("_in").over(running), F.lit(0))).drop("_in")
    numbered = (
        joined.where(partly)
        .join(starts, ["_key", "size", "_bucket"])
        .withColumn("_r", F.row_number().over(Window.partitionBy("_key", "size", "_bucket").orderBy("_order")))
    )
    first = numbered.withColumn("_more", (F.col("_before") + F.col("_r") <= F.col("extra")).cast("bigint"))
    all_or_none = joined.where(~partly).withColumn("_more", (F.col("extra") > 0).cast("bigint"))
    columns = ["_id", "_key", "size", "_hash", (F.col("times") + F.col("_more")).alias("times")]
    return first.select(*columns).unionByName(all_or_none.select(*columns))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 4
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``size``, ``source_size``, ``target``, ``times``,
    ``taken`` (times * size).

    Sources are weighed in the order of their names' code points, null last, as one
    source. Null and empty texts have no words: they may be taken or not and
    change nothing. Repeated rows are documents of their own. An empty table
    gives an empty result; further columns are not looked at.
    """
    rows = _mixed_rows(docs, id_col, text_col, source_col, seed)
    taken = (F.col("times") * F.col("size")).alias("taken")
    return rows.select(F.col("_id").alias(id_col), "size", "source_size", "target", "times", taken)


def _mixed_rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    read = only(docs, id_col, text_col, source_col).select(
        F.col(id_col).alias("_id"),
        F.col(source_col).cast("string").alias("_source"),
        size_of(F.col(text_col)).alias("size"),
        F.xxhash64(text_col).alias("_hash"),
    )
    sized = stored(read, "mix-sizes")
    key = F.struct(F.col("_source").isNull().alias("last"), F.coalesce("_source", F.lit("")).alias("name"))
    sources = sized.groupBy(key.alias("_s")).agg(F.sum("size").alias("source_size"))
    ranked = dense_ids(sources, "_s", "_key")
    aimed = stored(targets(ranked, cycled_weights(F.col("_key"))), "mix-targets")
    near = F.broadcast(aimed) if fits_broadcast(aimed) else aimed
    keyed = sized.withColumn("_s", key).join(near.select("_s", "_key"), "_s").drop("_s", "_source")
    histogram = keyed.groupBy("_key", "size").agg(F.count(F.lit(1)).alias("n"))
    facts = histogram.join(near.select("_key", "source_size", "target"), "_key")
    plans = stored(plan(facts, seed), "mix-plan")
    return _chosen(keyed, plans, seed).join(near.select("_key", "source_size", "target"), "_key")


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 4
) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, all columns kept.

    Rows equal in id and text are taken together as often as ``mix`` says, dealt
    evenly among them.
    """
    rows = _mixed_rows(docs, id_col, text_col, source_col, seed)
    keys = ["_k", "_h"]
    per_text = rows.groupBy(F.struct(F.col("_id").alias("k")).alias("_k"), F.col("_hash").alias("_h")).agg(
        F.sum("times").alias("_times"), F.count(F.lit(1)).alias("_rows")
    )
    aside, old, new = with_columns_aside(docs)
    keyed = aside.select("*", F.struct(F.col(new[id_col]).alias("k")).alias("_k"), F.xxhash64(new[text_col]).alias("_h"))
    joined = keyed.join(per_text, keys)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    own = F.floor(F.col("_times") / F.col("_rows")) + (place <= F.col("_times") % F.col("_rows")).cast("bigint")
    repeated = joined.withColumn("_own", own).withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_own").cast("int"))))
    return repeated.select(*aside.columns).toDF(*old)
