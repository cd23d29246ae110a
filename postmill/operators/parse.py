"""From text lines to typed posts, notices and rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions.scalar import as_long, evaluated_once, on_its_day, written_moment
from postmill.functions.text import is_blank, normalise_tag
from postmill.operators.rules import too_long
from postmill.schema import INGEST_SCHEMA

POST_COLUMNS = ("post_ext_id", "created_at", "text", "lang", "user_ext_id", "user_name", "tags")

GOOD, BLANK, NOTICE, REJECT = "good", "blank", "notice", "reject"

_JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


def parse_json(value: Column, schema: str = INGEST_SCHEMA) -> Column:
    """One JSON document to a struct; unknown members are ignored and
    a document that does not fit leaves its text in ``_corrupt``."""
    return F.from_json(value, schema, _JSON_OPTIONS)


def parse_lines(lines: DataFrame) -> DataFrame:
    """Add the post columns and a verdict to every line.

    ``status`` is ``good``, ``blank`` (no text), ``notice`` (valid JSON without
    an id) or ``reject``; ``reason`` names the first rule a reject breaks. No
    line is dropped, so the counts add up to the lines read.
    """
    parsed = lines.select("*", evaluated_once(parse_json(F.col("value"))).alias("_doc"))
    doc, user = F.col("_doc"), F.col("_doc")["user"]
    no_tags = F.array().cast("array<string>")
    moment = parsed.withColumn("_moment", written_moment(doc["created_at"]))
    # Typed columns first, verdict on them second. The second generator keeps the optimizer
    # from copying dates and tags into each filter on the verdict.
    raw = moment.select(
        *lines.columns,
        F.struct(
            (doc.isNull() | doc["_corrupt"].isNotNull()).alias("_malformed"),
            doc["id_str"].isNull().alias("_no_id"),
            as_long(F.coalesce(doc["id"], doc["id_str"])).alias("post_ext_id"),
            on_its_day(doc["created_at"], F.col("_moment")).alias("created_at"),
            doc["text"].alias("text"),
            doc["lang"].alias("lang"),
            as_long(user["id"]).alias("user_ext_id"),
            user["name"].alias("user_name"),
            F.transform(F.coalesce(doc["entities"]["hashtags"]["text"], no_tags), normalise_tag).alias("tags"),
        ).alias("_raw"),
    )
    typed = raw.select(*lines.columns, evaluated_once(F.col("_raw")).alias("_typed")).select(*lines.columns, "_typed.*")
    blank = is_blank(F.col("value"))
    reason = (
        F.when(blank, F.lit(None))
        .when(F.col("_malformed"), "malformed")
        .when(F.col("_no_id"), F.lit(None))
        .when(F.col("created_at").isNull(), "bad date")
        .when(F.col("post_ext_id").isNull(), "bad id")
        .when(F.col("user_ext_id").isNull() | F.col("user_name").isNull(), "bad user")
        .when(F.col("text").isNull(), "no text")
        .when(F.col("lang").isNull(), "no language")
        # Tags are in lower case, so none is equal, and the answer is null beside a null tag.
        .when(F.array_contains("tags", "A").isNull(), "bad tag")
    )
    judged = typed.withColumn("reason", reason)
    status = (
        F.when(blank, BLANK)
        .when(F.col("reason").isNotNull(), REJECT)
        .when(F.col("_no_id"), NOTICE)
        .otherwise(GOOD)
    )
    return judged.select(*lines.columns, status.alias("status"), "reason", *POST_COLUMNS)


def limited(parsed: DataFrame) -> DataFrame:
    """K5: parsed lines, of which those too long for a staging table are rejects too."""
    over = F.when(F.col("status") == GOOD, too_long(list(POST_COLUMNS)))
    judged = parsed.withColumn("_over", over)
    status = F.when(F.col("_over").isNotNull(), REJECT).otherwise(F.col("status"))
    return judged.withColumns({"status": status, "reason": F.coalesce("reason", "_over")}).drop("_over")


def broken_files(parsed: DataFrame) -> DataFrame:
    """S3, T5: the files that hold a rejected line, with the first reason in text order."""
    return parsed.where(F.col("status") == REJECT).groupBy("src_file").agg(F.min("reason").alias("reason"))


def good_posts(parsed: DataFrame, on_error: str = "quarantine") -> DataFrame:
    """The posts among parsed lines.

    ``on_error="fail"`` ends the job at the first rejected line instead of
    leaving it to :func:`rejects`.
    """
    wanted = F.col("status") == GOOD
    if on_error == "fail":
        broken = F.raise_error(F.concat(F.lit("line rejected: "), F.col("reason"))).cast("boolean")
        wanted = F.when(F.col("status") == REJECT, broken).otherwise(wanted)
    elif on_error != "quarantine":
        raise ValueError(f"on_error is 'quarantine' or 'fail', not {on_error!r}")
    return parsed.where(wanted).drop("value", "status", "reason")


def rejects(parsed: DataFrame) -> DataFrame:
    """The lines set aside, with the rule they break and their whole text."""
    keep = [name for name in ("src_file", "pos") if name in parsed.columns]
    return parsed.where(F.col("status") == REJECT).select(*keep, "reason", "value")


def status_counts(parsed: DataFrame) -> DataFrame:
    """Lines per verdict and reason."""
    return parsed.groupBy("status", "reason").agg(F.count(F.lit(1)).alias("n"))
