"""Stored tables, seed rows and generated users."""

from __future__ import annotations

from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.schema import MAIN, TableSpec

_SEEDS = Path(__file__).with_name("languages.csv")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stored table; select columns on the result and the scan reads no others."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A scan with fewer splits than the session has cores, dealt out to all of
    them; one with enough splits stays as it is and is not shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def declared_empty(spark: SparkSession, columns: dict[str, str]) -> DataFrame:
    """A frame of the given columns without rows, which the optimizer knows to be empty."""
    nulls = [F.lit(None).cast(kind).alias(name) for name, kind in columns.items()]
    return spark.range(1).where(F.lit(False)).select(*nulls)


def empty_table(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """K4: a declared table without rows."""
    return declared_empty(spark, spec.columns)


def _seed_rows() -> list[list[str]]:
    return [line.split(",") for line in _SEEDS.read_text(encoding="utf-8").splitlines()[2:]]


def seed_values() -> str:
    """The same rows for a VALUES clause."""
    quoted = [[key, *("'" + word.replace("'", "''") + "'" for word in words)] for key, *words in _seed_rows()]
    return ", ".join(f"({', '.join(row)})" for row in quoted)


def seed_languages(spark: SparkSession) -> DataFrame:
    """The fixed language dimension, 188 rows."""
    keys, codes, names = zip(*_seed_rows())
    rows = pa.table({"lang_id": [int(key) for key in keys], "short_code": codes, "name": names})
    return spark.createDataFrame(rows, MAIN["languages"].ddl)


def generated_users(ids: DataFrame, id_col: str, prefix: str = "Bob") -> DataFrame:
    """One made-up user per id, for load trials; ``spark.range(n)`` gives ``n`` of them."""
    key = F.col(id_col).cast("bigint")
    return ids.select(F.concat(F.lit(prefix), key.cast("string")).alias("name"), key.alias("user_ext_id"))
