"""From staging to main tables: what each table gains."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postmill.operators.joins import lookup_join, measured, missing_from
from postmill.operators.keys import dense_ids, largest_id, numbered
from postmill.operators.pick import latest_copy, one_name_per_user
from postmill.schema import MAIN
from postmill.session import durable


def new_languages(lang_stage: DataFrame, languages: DataFrame) -> DataFrame:
    """Languages not stored yet, with an empty name."""
    fresh = missing_from(lang_stage.select("lang_id", "short_code").distinct(), languages, "lang_id")
    return fresh.withColumn("name", F.lit("")).select(*MAIN["languages"].columns)


def new_users(users_stage: DataFrame, users: DataFrame, base: int | None = None) -> DataFrame:
    """Users not stored yet, one name each. ``base`` is the largest number in
    use, if it is known already."""
    fresh = missing_from(one_name_per_user(users_stage), users, "user_ext_id")
    base = largest_id(users, "user_id") if base is None else base
    return dense_ids(fresh, "user_ext_id", "user_id", base).select(*MAIN["users"].columns)


def new_posts(posts_stage: DataFrame, users: DataFrame, posts: DataFrame, base: int | None = None) -> DataFrame:
    """The latest copy of every post not stored yet.

    Winner, user and number are settled on the narrow columns, in one shuffle to ranges of
    posts, in whose order they are numbered. The texts cross
    the network once, in the join that keeps the winning lines. ``posts`` may be
    the part of the table that can match; ``base`` then gives the largest
    number in use.
    """
    narrow = posts_stage.select("post_ext_id", "user_ext_id", "ingest_ts", "src_file", "pos")
    fresh = missing_from(narrow, posts, "post_ext_id")
    owners = measured(users.select("user_ext_id", "user_id"))
    base = largest_id(posts, "post_id") if base is None else base
    columns = ["post_ext_id", "user_id", "src_file", "pos"]
    if owners.small:
        # A post has one staged line per file and load, so none is too frequent for one range.
        winners = latest_copy(fresh.repartitionByRange("post_ext_id"))
        keyed = lookup_join(winners, owners, "user_ext_id", ["post_ext_id"])
        rows = numbered(durable(keyed.select(*columns).sortWithinPartitions("post_ext_id")), "post_id", base)
    else:
        keyed = lookup_join(durable(latest_copy(fresh)), owners, "user_ext_id", ["post_ext_id"])
        rows = dense_ids(keyed.select(*columns), "post_ext_id", "post_id", base)
    lines = posts_stage.select("post_ext_id", "src_file", "pos", "created_at", "text", "lang_id", "ingest_ts")
    kept = lines.join(rows, ["post_ext_id", "src_file", "pos"]).sortWithinPartitions("post_ext_id")
    return kept.select(*MAIN["posts"].columns)


def new_tags(tags_stage: DataFrame, tags: DataFrame) -> DataFrame:
    """J3d, A3: tags not stored yet."""
    return missing_from(tags_stage.select("tag_id", "name").distinct(), tags, "tag_id").select(*MAIN["tags"].columns)


def new_pairs(
    post_tag_stage: DataFrame,
    posts: DataFrame,
    post_tag: DataFrame,
    base: int | None = None,
    keep_duplicates: bool = False,
) -> DataFrame:
    """Post-tag pairs of stored posts.

    One row per pair, and none that is stored already. ``keep_duplicates``
    keeps the staged bag instead, repeated pairs included.

    Pairs and posts go to ranges of posts together, in one shuffle and one sort: there a
    pair follows its post and its own copies, and stands where its number is counted.
    """
    side = posts.select("post_ext_id", "post_id")
    base = largest_id(post_tag, "post_tag_id") if base is None else base
    if keep_duplicates:
        # The copies of a pair are alike; their number only keeps them apart.
        pairs = post_tag_stage.select("post_ext_id", "tag_id", F.monotonically_increasing_id().alias("_copy"))
        linked = lookup_join(pairs, side, "post_ext_id", ["_copy"])
        rows = linked.select("post_ext_id", "post_id", "tag_id", "_copy")
        return dense_ids(rows, ["post_ext_id", "tag_id", "_copy"], "post_tag_id", base).select(*MAIN["post_tag"].columns)
    pairs = missing_from(post_tag_stage.select("post_ext_id", "tag_id"), post_tag, "post_ext_id", "tag_id")
    no_tag, no_post = (F.lit(None).cast("bigint").alias(name) for name in ("tag_id", "post_id"))
    both = side.select("post_ext_id", F.lit(False).alias("_pair"), no_tag, "post_id").unionByName(
        pairs.select("post_ext_id", F.lit(True).alias("_pair"), "tag_id", no_post)
    )
    in_post = Window.partitionBy("post_ext_id").orderBy("_pair", "tag_id")
    so_far = in_post.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = both.repartitionByRange("post_ext_id").select(
        "post_ext_id",
        "_pair",
        "tag_id",
        F.first("post_id").over(so_far).alias("post_id"),
        F.lag(F.struct("_pair", "tag_id")).over(in_post).alias("_before"),
    )
    # The first row of a post that is stored is the post.
    known = F.col("_pair") & F.col("post_id").isNotNull()
    fresh = placed.where(known & ~F.struct("_pair", "tag_id").eqNullSafe(F.col("_before")))
    # In the order of the window, which the rows have already: they are not sorted again.
    linked = fresh.sortWithinPartitions("post_ext_id", "_pair", "tag_id").select("post_ext_id", "post_id", "tag_id")
    return numbered(durable(linked), "post_tag_id", base).select(*MAIN["post_tag"].columns)
