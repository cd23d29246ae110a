"""Joins whose plan follows the size of their sides."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postmill.session import durable

# A side is sent to every executor only when it stays below both bounds.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024

# A key with more than this fraction of all facts is split into parts of at most
# that size. At most HOT_PARTS keys can be that frequent, and splitting adds at
# most HOT_PARTS copies of their rows, however many facts there are.
HOT_PARTS = 10_000


def fits_broadcast(side: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Measure a side; every task hands on one row of sums, and no rows."""
    widths = [
        F.coalesce(F.octet_length(f.name), F.lit(0)) + 8 if isinstance(f.dataType, T.StringType) else F.lit(24)
        for f in side.schema.fields
    ]
    row_size = sum(widths, F.lit(0)).cast("bigint")
    seen = side.agg(F.count(F.lit(1)).alias("n"), F.sum(row_size).alias("b")).first()
    return seen["n"] <= rows and (seen["b"] or 0) <= size


def salted_join(
    facts: DataFrame,
    side: DataFrame,
    key: str,
    spread_by: list[str],
    how: str = "inner",
    parts: int = HOT_PARTS,
) -> DataFrame:
    """Shuffle join that splits hot keys; the result is that of the plain join.

    Hot keys are those with more than one of ``parts`` equal shares of the
    facts, found by a pre-aggregated count of the key column alone. Fewer than
    ``parts`` keys can be hot, which is what allows their broadcast. Their facts
    spread over several salts by a hash of ``spread_by``, a unique key of the
    facts, and only their rows of ``side`` are repeated, once per salt.

    Facts are read three times: pass a table, or a frame that is stored.
    """
    share = max(1, facts.count() // parts)
    hot = (
        facts.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where((F.col("_n") > share) & F.col(key).isNotNull())
        .select(key, F.ceil(F.col("_n") / share).cast("int").alias("_salts"))
    )
    place = F.xxhash64(*spread_by)
    salt = (
        F.when(F.col(key).isNull(), F.pmod(place, F.lit(2**20)))  # matches nothing, so it may go anywhere
        .when(F.col("_salts").isNull(), 0)
        .otherwise(F.pmod(place, F.col("_salts")))
    )
    spread = facts.join(F.broadcast(hot), key, "left").withColumn("_salt", salt.cast("int")).drop("_salts")
    last = F.coalesce(F.col("_salts") - 1, F.lit(0))
    copies = (
        side.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
        .drop("_salts")
    )
    return spread.join(copies, [key, "_salt"], how).drop("_salt")


@dataclass(frozen=True)
class Lookup:
    """A keyed side that has been measured, for use in several joins."""

    rows: DataFrame
    small: bool


def measured(side: DataFrame) -> Lookup:
    """Measure a side once."""
    return Lookup(side, fits_broadcast(side))


def lookup_join(
    facts: DataFrame, side: DataFrame | Lookup, key: str, spread_by: list[str], how: str = "inner"
) -> DataFrame:
    """Facts with the columns of a keyed side.

    Broadcast when the side is measured to fit, else a shuffle join that splits
    hot keys.
    """
    side = side if isinstance(side, Lookup) else measured(side)
    if side.small:
        return facts.join(F.broadcast(side.rows), key, how)
    return salted_join(facts, side.rows, key, spread_by, how)


def missing_from(rows: DataFrame, known: DataFrame, *keys: str) -> DataFrame:
    """The rows whose key ``known`` does not hold."""
    return rows.join(known.select(*keys), list(keys), "left_anti")


def within_range(known: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The part of ``known`` that can match ``rows``, by the key range of ``rows``.

    Every stored file is sorted by its key, so the two bounds let the scan skip
    the row groups outside of them.
    """
    low, high = rows.agg(F.min(key), F.max(key)).first()
    if low is None:
        return known.limit(0)
    return known.where(F.col(key).between(low, high))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent; null keys refer to nothing.

    Each key is compared once. The keys without a parent, as a rule few, are
    stored and then go to the child rows, which stay where they are.
    """
    keys = child.select(child_key).where(F.col(child_key).isNotNull()).distinct()
    lost = durable(keys.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti"))
    marked = child.withColumn("_row", F.monotonically_increasing_id())
    return lookup_join(marked, lost, child_key, ["_row"], "left_semi").drop("_row")
