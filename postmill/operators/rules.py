"""The rules of a table as one verdict per row (K5, Q8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.schema import STAGING, TableSpec

REPORT, QUARANTINE, FAIL = "report", "quarantine", "fail"
CHOICES = (REPORT, QUARANTINE, FAIL)

# Which column of a parsed line feeds a limited column of a staging table.
_LINE_COLUMNS = {
    ("posts_stage", "text"): "text",
    ("posts_stage", "lang"): "lang",
    ("users_stage", "name"): "user_name",
    ("tags_stage", "name"): "tags",
}


def breaks(spec: TableSpec) -> list[tuple[str, str, Column]]:
    """Q7, Q8: every rule of a table as (rule, column, whether a row breaks it)."""
    rules = [("null", name, F.col(name).isNull()) for name in spec.required]
    return rules + [("too long", name, F.length(name) > size) for name, size in spec.max_length.items()]


def first_break(spec: TableSpec) -> Column:
    """The first rule a row breaks as struct (``rule``, ``on``), null for a sound row. One
    projection, evaluated where the row is written."""
    hits = [F.when(hit, F.struct(F.lit(rule).alias("rule"), F.lit(name).alias("on"))) for rule, name, hit in breaks(spec)]
    return F.coalesce(*hits) if hits else F.lit(None).cast("struct<rule: string, on: string>")


def refused(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """K5: the rows, and an error at the first one that breaks a rule."""
    broken = first_break(spec)
    said = F.concat(F.lit(f"{spec.name}: row refused, "), broken["on"], F.lit(" is "), broken["rule"])
    return rows.where(F.when(broken.isNull(), True).otherwise(F.raise_error(said).cast("boolean")))


def too_long(columns: list[str]) -> Column:
    """K5: what of a parsed line passes the width of its staging column, as ``too long text``;
    null if nothing does. One of several tags is enough."""
    found = []
    for (table, column), name in _LINE_COLUMNS.items():
        if name in columns:
            size = STAGING[table].max_length[column]
            over = F.exists(name, lambda tag: F.length(tag) > size) if name == "tags" else F.length(name) > size  # noqa: B023
            found.append(F.when(over, f"too long {name}"))
    return F.coalesce(*found, F.lit(None).cast("string"))
