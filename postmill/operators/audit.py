"""Checks of stored posts and tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions.scalar import evaluated_once
from postmill.functions.text import contains_text, extract_tags
from postmill.operators.joins import lookup_join, orphans
from postmill.operators.rules import breaks
from postmill.schema import TableSpec


def linked_tags(pairs: DataFrame, tags: DataFrame, post_key: str = "post_id") -> DataFrame:
    """The distinct tag names of each post, for all posts in one join.

    Pairs are dealt out by post alone, so that what follows by post needs no further shuffle.
    """
    distinct = pairs.select(post_key, "tag_id").repartition(post_key).distinct()
    return lookup_join(distinct, tags.select("tag_id", "name"), "tag_id", [post_key]).select(post_key, "name")


def tags_per_post(linked: DataFrame, post_key: str = "post_id") -> DataFrame:
    """The sorted tag names of each post as one array.

    A list holds each name once, and the names of one post come out of one line,
    so a list is no longer than a line.
    """
    return linked.distinct().groupBy(post_key).agg(F.array_sort(F.collect_list("name")).alias("tags"))


def tags_not_in_text(posts: DataFrame, linked: DataFrame, post_key: str = "post_id", ignore_case: bool = True) -> DataFrame:
    """Q1: linked tags that the text does not contain."""
    both = linked.join(posts.select(post_key, "text"), post_key)
    return both.where(~contains_text(F.col("text"), F.col("name"), ignore_case)).select(post_key, "name")


def text_tags_not_linked(
    posts: DataFrame,
    linked: DataFrame,
    post_key: str = "post_id",
    ignore_case: bool = True,
    keep_empty: bool = False,
) -> DataFrame:
    """Q2: tags written in the text without a link.

    Only the tags leave the scan of the texts, each once, as one array of a post, and meet
    there the array of its links. Posts with a null key have no links.
    """
    found = F.array_distinct(extract_tags(F.col("text"), keep_empty))
    written = posts.select(post_key, evaluated_once(found).alias("_written"))
    names = linked.select(post_key, F.lower("name").alias("name") if ignore_case else F.col("name"))
    names = names.groupBy(post_key).agg(F.collect_set("name").alias("_names"))
    both = written.where(F.size("_written") > 0).join(names, post_key, "left")

    def open_one(tag: Column) -> Column:
        held = F.array_contains("_names", F.lower(tag) if ignore_case else tag)
        return ~F.coalesce(held, F.lit(False))

    return both.select(post_key, F.explode(F.filter("_written", open_one)).alias("tag"))


def differs_from_text(linked_texts: DataFrame, name: str, text: str) -> DataFrame:
    """Rows whose name is not the whole text.

    This is what ``name not in (select outer.text from posts where the key is
    that of the outer row)`` says: the subquery holds the outer text, nothing
    else, and a null on either side drops the row.
    """
    return linked_texts.where(F.col(name) != F.col(text))


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Q5: keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def rule_breaks(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Q7, Q8: for each column, nulls where a value is required and texts that
    are too long; one scan and one row per rule of the table."""
    rules = breaks(spec)
    counts = df.agg(
        *[F.coalesce(F.sum(F.when(hit, 1)), F.lit(0)).alias(f"_{i}") for i, (_, _, hit) in enumerate(rules)]
    )
    rows = F.array(
        *[
            F.struct(F.lit(kind).alias("rule"), F.lit(column).alias("on"), F.col(f"_{i}").alias("n"))
            for i, (kind, column, _) in enumerate(rules)
        ]
    )
    return counts.select(F.lit(spec.name).alias("t"), F.inline(rows))


def table_report(tables: dict[str, DataFrame], specs: dict[str, TableSpec]) -> DataFrame:
    """Q5-Q8 for a set of tables: broken rules as (table, rule, columns, count).

    Rules without a break are not listed, so a sound set gives no rows.
    """
    parts = []
    for name, spec in specs.items():
        parts.append(rule_breaks(tables[name], spec))
        if spec.key:
            extra = repeated_keys(tables[name], *spec.key).agg(F.count(F.lit(1)).alias("n"))
            parts.append(
                extra.select(F.lit(name).alias("t"), F.lit("repeated").alias("rule"), F.lit(",".join(spec.key)).alias("on"), "n")
            )
        for child, (parent, parent_key) in spec.references.items():
            lost = orphans(tables[name], tables[parent], child, parent_key).agg(F.count(F.lit(1)).alias("n"))
            parts.append(lost.select(F.lit(name).alias("t"), F.lit("orphan").alias("rule"), F.lit(child).alias("on"), "n"))
    return reduce(DataFrame.unionByName, parts).where(F.col("n") > 0)
