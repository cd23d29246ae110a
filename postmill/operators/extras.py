"""Declared tables beyond the main load: mentions, links, places, profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions.scalar import as_long, epoch_millis_time, evaluated_once, or_false, or_zero, post_time
from postmill.operators.parse import parse_json
from postmill.schema import WIDE_SCHEMA


def wide_posts(lines: DataFrame) -> DataFrame:
    """Whole documents of the lines that are posts, as struct ``doc`` beside their id."""
    parsed = lines.select(evaluated_once(parse_json(F.col("value"), WIDE_SCHEMA)).alias("doc"))
    good = parsed.where(F.col("doc._corrupt").isNull() & F.col("doc.id_str").isNotNull())
    return good.select(as_long(F.coalesce("doc.id", "doc.id_str")).alias("post_ext_id"), "doc")


def mentions(posts: DataFrame) -> DataFrame:
    """One row per mentioned user; the id may be missing."""
    rows = posts.select("post_ext_id", F.explode("doc.entities.user_mentions").alias("m"))
    return rows.select("post_ext_id", F.col("m.screen_name").alias("screen_name"))


def links(posts: DataFrame) -> DataFrame:
    """One row per link."""
    return posts.select("post_ext_id", F.explode("doc.entities.urls").alias("u")).select(
        "post_ext_id", F.col("u.url").alias("url")
    )


def _corner(ring: Column, place: int) -> Column:
    point = F.get(ring, F.lit(place))
    return F.struct(F.get(point, F.lit(1)).alias("lat"), F.get(point, F.lit(0)).alias("lon"))


def places(posts: DataFrame) -> DataFrame:
    """Every place once, with the corners of its box from lower left, as the
    box lists them."""
    place = F.col("doc.place")
    ring = F.get(place["bounding_box"]["coordinates"], F.lit(0))
    return (
        posts.where(place["id"].isNotNull())
        .select(
            place["id"].alias("place_key"),
            place["place_type"].alias("place_type"),
            place["name"].alias("name"),
            place["country_code"].alias("country_code"),
            _corner(ring, 0).alias("box_ll"),
            _corner(ring, 1).alias("box_ul"),
            _corner(ring, 2).alias("box_ur"),
            _corner(ring, 3).alias("box_lr"),
        )
        .distinct()
    )


def post_details(posts: DataFrame) -> DataFrame:
    """Position, place, counters and flags of each post."""
    doc = F.col("doc")
    point = doc["coordinates"]["coordinates"]
    return posts.select(
        "post_ext_id",
        F.when(
            point.isNotNull(), F.struct(F.get(point, F.lit(1)).alias("lat"), F.get(point, F.lit(0)).alias("lon"))
        ).alias("coordinates"),
        doc["place"]["id"].alias("place_key"),
        or_zero(doc["retweet_count"]).alias("retweet_count"),
        or_zero(doc["favorite_count"]).alias("favourite_count"),
        or_false(doc["truncated"]).alias("truncated"),
        or_false(doc["is_quote_status"]).alias("is_quote"),
        or_false(doc["possibly_sensitive"]).alias("possibly_sensitive"),
        epoch_millis_time(doc["timestamp_ms"]).alias("sent_at"),
    )


def profiles(posts: DataFrame) -> DataFrame:
    """E5: the profile columns of each post's user; absent counters are 0."""
    user = F.col("doc.user")
    return posts.select(
        "post_ext_id",
        as_long(user["id"]).alias("user_ext_id"),
        user["name"].alias("name"),
        user["screen_name"].alias("screen_name"),
        user["location"].alias("location"),
        user["url"].alias("url"),
        user["description"].alias("description"),
        or_zero(user["followers_count"]).alias("followers_count"),
        or_zero(user["friends_count"]).alias("friends_count"),
        or_zero(user["favourites_count"]).alias("favourites_count"),
        or_zero(user["statuses_count"]).alias("statuses_count"),
        user["time_zone"].alias("time_zone"),
        post_time(user["created_at"]).alias("created_at"),
        user["lang"].alias("lang"),
    )
