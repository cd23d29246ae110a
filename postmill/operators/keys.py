"""Dense integer keys."""

from __future__ import annotations

from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.operators.joins import Lookup, lookup_join, measured, missing_from
from postmill.session import durable

# monotonically_increasing_id() holds the partition above 33 row bits.
_ROW_BITS = 33


def largest_id(dim: DataFrame, id_col: str) -> int:
    """The largest key of a dimension, 0 when it is empty."""
    return dim.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("m")).first()["m"]


def dense_ids(rows: DataFrame, key: str | list[str], id_col: str, base: int = 0) -> DataFrame:
    """Number rows ``base`` + 1, ``base`` + 2 ... in the order of a unique key.

    The rows are range-partitioned and sorted, then stored, so that both passes
    see the same partitions: one counts rows per partition, the other adds the
    rows of all earlier partitions to the place within its own. No task sees
    more than its range; the driver sees one number per partition.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return numbered(durable(rows.orderBy(*keys)), id_col, base)


def numbered(rows: DataFrame, id_col: str, base: int = 0) -> DataFrame:
    """Number the rows of a checkpoint or another frame whose partitions never change,
    in their order there; nothing is shuffled."""
    placed = rows.withColumn("_place", F.monotonically_increasing_id())
    part = F.shiftrightunsigned("_place", _ROW_BITS)
    row = F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).orderBy("_part").collect()
    if len(sizes) <= 1:
        return placed.select(*rows.columns, (row + base + 1).alias(id_col))
    starts = accumulate((size["_n"] for size in sizes[:-1]), initial=base)
    offsets = pa.table({"_part": [size["_part"] for size in sizes], "_offset": list(starts)})
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(rows.sparkSession.createDataFrame(offsets)), "_part")
        .select(*rows.columns, (F.col("_offset") + row + 1).alias(id_col))
    )


def new_entries(keys: DataFrame, dim: DataFrame, key: str, id_col: str) -> DataFrame:
    """The keys ``dim`` does not know, with the next free numbers."""
    fresh = keys.select(key).where(F.col(key).isNotNull()).distinct()
    return dense_ids(missing_from(fresh, dim, key), key, id_col, largest_id(dim, id_col))


def grown_dictionary(keys: DataFrame, dim: DataFrame, key: str, id_col: str) -> Lookup:
    """The dictionary after all ``keys`` have been looked up."""
    return measured(dim.select(key, id_col).unionByName(new_entries(keys, dim, key, id_col)))


def encode(facts: DataFrame, dictionary: Lookup, key: str, spread_by: list[str]) -> DataFrame:
    """Facts with the number of their key; null where there is none."""
    return lookup_join(facts, dictionary, key, spread_by, how="left")
