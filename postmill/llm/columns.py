"""Column helpers the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.session import scratch_path

#: Words are runs of anything but these six ASCII signs.
BLANKS = " \t\n\x0b\f\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; select columns on the result and the scan reads no others."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns and no others, found by their exact spelling, so that a
    further column ``Text`` or a second ``text`` beside ``text`` does no harm
    (of columns with one spelling, the first counts)."""
    places: dict[str, int] = {}
    for place, name in enumerate(df.columns):
        places.setdefault(name, place)
    numbered = df.toDF(*(f"_c{place}" for place in range(len(df.columns))))
    return numbered.select(*(F.col(f"_c{places[name]}").alias(name) for name in names))


def with_columns_aside(df: DataFrame) -> tuple[DataFrame, list[str], dict[str, str]]:
    """The frame with columns ``_c0``, ``_c1`` ..., the old names in order, and the
    new name of each old one. Lets an operator add columns of its own without
    meeting one of the caller's; ``toDF(*old)`` on the first columns undoes it."""
    old = list(df.columns)
    new: dict[str, str] = {}
    for place, name in enumerate(old):
        new.setdefault(name, f"_c{place}")
    return df.toDF(*(f"_c{place}" for place in range(len(old)))), old, new


def words(text: Column) -> Column:
    """The words of a text, in order; none for null. Splitting at one plain sign
    needs no pattern matching, so the other blanks become spaces first."""
    spaced = F.coalesce(text, F.lit(""))
    for blank in BLANKS[1:]:
        spaced = F.replace(spaced, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(spaced, " "), "")


def text_hash(text: Column) -> Column:
    """128 bits of a text, as two numbers in one struct; null stands for empty."""
    whole = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(whole).alias("a"), F.xxhash64(whole, F.lit(1)).alias("b"))


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written as a table in the shared folder and read back: lineage ends
    there, so a lost executor costs a read. The table stays until the folder is
    cleared, as later reads of the result need it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
