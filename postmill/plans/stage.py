"""Five staging tables out of parsed posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.operators.joins import Lookup, lookup_join
from postmill.operators.keys import encode, grown_dictionary
from postmill.operators.pick import first_in_file
from postmill.schema import STAGING
from postmill.session import durable

# Relative error of the estimate of repeated posts, and from how many of them on it counts.
_ERROR, _MANY = 0.02, 10_000


def used_tags(posts: DataFrame) -> DataFrame:
    """One row per tag of a post line, bag semantics."""
    return posts.select("src_file", F.explode("tags").alias("name"))


def language_dictionary(posts: DataFrame, languages: DataFrame) -> Lookup:
    """Short code to number, new codes included."""
    return grown_dictionary(posts.select(F.col("lang").alias("short_code")), languages, "short_code", "lang_id")


def tag_dictionary(posts: DataFrame, tags: DataFrame) -> Lookup:
    """Stored tag to number, new tags included."""
    return grown_dictionary(used_tags(posts), tags, "name", "tag_id")


def stage_languages(posts: DataFrame, dictionary: Lookup) -> DataFrame:
    """The languages each file uses."""
    pairs = posts.select("src_file", F.col("lang").alias("short_code")).distinct()
    staged = encode(pairs, dictionary, "short_code", ["src_file"])
    return staged.select(*STAGING["lang_stage"].columns)


def stage_users(posts: DataFrame) -> DataFrame:
    """The first name each file gives to a user."""
    users = posts.select("src_file", "pos", "user_ext_id", F.col("user_name").alias("name"))
    return first_in_file(users, "user_ext_id").select(*STAGING["users_stage"].columns)


def often_repeated(lines: DataFrame) -> bool:
    """Whether files repeat so many posts that it costs less to move the lines than to send
    these to them: an estimate, which chooses between two ways to the same rows. One row of
    sums per task."""
    place = F.xxhash64("src_file", "post_ext_id")
    seen = lines.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(place, _ERROR).alias("posts")).first()
    return seen["n"] - seen["posts"] > max(_MANY, 2 * _ERROR * seen["n"])


def _first_in_place(lines: DataFrame) -> DataFrame:
    """The first line of each post and file; a place occurs once in a file."""
    lines = lines.withColumn("_post", F.struct("src_file", "post_ext_id"))
    places = lines.groupBy("_post").agg(F.min("pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    repeated = durable(places.where("_n > 1").drop("_n"))
    marked = lookup_join(lines, repeated, "_post", ["pos"], "left")
    return marked.where(F.col("_first").isNull() | (F.col("pos") == F.col("_first")))


def stage_posts(posts: DataFrame, dictionary: Lookup, often: bool | None = None) -> DataFrame:
    """The first line each file holds of a post, with its language number.

    Posts that a file repeats, as a rule few, are found on the keys and go to the
    lines, whose texts stay where they are. Where they are many, the lines meet by post
    instead; ``often`` says so if it is known already.
    """
    lines = posts.drop("user_name")
    often = often_repeated(lines) if often is None else often
    first = first_in_file(lines, "post_ext_id") if often else _first_in_place(lines)
    coded = encode(first.withColumnRenamed("lang", "short_code"), dictionary, "short_code", ["src_file", "post_ext_id"])
    return coded.withColumnRenamed("short_code", "lang").select(*STAGING["posts_stage"].columns)


def stage_tags(posts: DataFrame, dictionary: Lookup) -> DataFrame:
    """P10, A3, A5: the tags each file uses."""
    pairs = used_tags(posts).distinct()
    return encode(pairs, dictionary, "name", ["src_file", "name"]).select(*STAGING["tags_stage"].columns)


def stage_post_tags(staged_posts: DataFrame, dictionary: Lookup) -> DataFrame:
    """Tags of the staged posts as numbers; a tag written twice is two rows."""
    pairs = staged_posts.select("src_file", "post_ext_id", F.posexplode("tags").alias("_nth", "name"))
    coded = encode(pairs, dictionary, "name", ["src_file", "post_ext_id", "_nth"])
    return coded.select(*STAGING["post_tag_stage"].columns)
