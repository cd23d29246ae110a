"""Mentions, links, places and profiles of posts written from orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.catalogue.entry import Entry
from postmill.functions.scalar import epoch_seconds
from postmill.operators import extras
from postmill.sources.tables import read_table


def _wide_lines(spark: SparkSession, folder: str) -> DataFrame:
    # The nation is the place, its key the lower left corner of a box of side 1.
    nations = read_table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    users = read_table(spark, folder, "customer").join(F.broadcast(nations), "c_nationkey")
    rows = read_table(spark, folder, "orders").join(users.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
    x = F.col("c_nationkey").cast("double")
    ring = F.array(F.array(x, x), F.array(x, x + 1), F.array(x + 1, x + 1), F.array(x + 1, x))
    doc = F.struct(
        F.date_format("o_orderdate", "EEE MMM dd HH:mm:ss '+0000' yyyy").alias("created_at"),
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").cast("string").alias("id_str"),
        F.col("o_orderpriority").alias("text"),
        F.lit("en").alias("lang"),
        F.struct(
            F.col("o_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("_"))).alias("screen_name"),
            F.col("n_name").alias("location"),
            F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("int")).alias("followers_count"),
            F.lit("Mon Jan 01 00:00:00 +0000 2001").alias("created_at"),
        ).alias("user"),
        F.struct(
            F.array(F.struct(F.col("c_name").alias("screen_name"), F.col("o_custkey").alias("id"))).alias("user_mentions"),
            F.when(
                F.col("o_orderstatus") == "O",
                F.array(F.struct(F.concat(F.lit("http://o.example/"), "o_orderkey").alias("url"))),
            ).alias("urls"),
        ).alias("entities"),
        F.struct(
            F.col("c_nationkey").cast("string").alias("id"),
            F.lit("country").alias("place_type"),
            F.col("n_name").alias("name"),
            F.substring("n_name", 1, 2).alias("country_code"),
            F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("bounding_box"),
        ).alias("place"),
        F.when(
            F.col("o_orderstatus") == "F",
            F.struct(F.lit("Point").alias("type"), F.array(x, F.col("c_acctbal")).alias("coordinates")),
        ).alias("coordinates"),
        F.when(F.col("o_orderstatus") == "P", F.length("o_orderpriority")).alias("retweet_count"),
        (F.unix_timestamp("o_orderdate") * 1000).cast("string").alias("timestamp_ms"),
    )
    return rows.select(F.to_json(doc).alias("value"))


def _posts(spark, folder):
    return extras.wide_posts(_wide_lines(spark, folder))


def post_mentions(spark, folder):
    return extras.mentions(_posts(spark, folder))


def post_links(spark, folder):
    return extras.links(_posts(spark, folder))


def post_places(spark, folder):
    corners = ("box_ll", "box_ul", "box_ur", "box_lr")
    return extras.places(_posts(spark, folder)).select(
        "place_key", "place_type", "name", "country_code", *[F.col(c)[k].alias(f"{c}_{k}") for c in corners for k in ("lat", "lon")]
    )


def post_details(spark, folder):
    details = extras.post_details(_posts(spark, folder))
    return details.select(
        "post_ext_id",
        F.col("coordinates.lat").alias("lat"),
        F.col("coordinates.lon").alias("lon"),
        "place_key",
        "retweet_count",
        "favourite_count",
        "is_quote",
        epoch_seconds(F.col("sent_at")).alias("sent_s"),
    )


def user_profiles(spark, folder):
    people = extras.profiles(_posts(spark, folder))
    return people.select(
        "post_ext_id", "user_ext_id", "name", "screen_name", "location", "followers_count", "friends_count",
        epoch_seconds(F.col("created_at")).alias("created_s"),
    )


_JOINED = "orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey"

ENTRIES = {
    "post_mentions": Entry(post_mentions, f"select o_orderkey post_ext_id, c_name screen_name from {_JOINED}"),
    "post_links": Entry(
        post_links,
        "select o_orderkey post_ext_id, concat('http://o.example/', o_orderkey) url"
        f" from {_JOINED} where o_orderstatus = 'O'",
    ),
    "post_places": Entry(
        post_places,
        "select distinct cast(c_nationkey as varchar) place_key, 'country' place_type, n_name as name,"
        " substr(n_name, 1, 2) country_code, c_nationkey::double box_ll_lat, c_nationkey::double box_ll_lon,"
        " c_nationkey + 1.0::double box_ul_lat, c_nationkey::double box_ul_lon, c_nationkey + 1.0::double box_ur_lat,"
        " c_nationkey + 1.0::double box_ur_lon, c_nationkey::double box_lr_lat, c_nationkey + 1.0::double box_lr_lon"
        f" from {_JOINED}",
    ),
    "post_details": Entry(
        post_details,
        "select o_orderkey post_ext_id, case when o_orderstatus = 'F' then c_acctbal end lat,"
        " case when o_orderstatus = 'F' then c_nationkey::double end lon, cast(c_nationkey as varchar) place_key,"
        " case when o_orderstatus = 'P' then length(o_orderpriority)::int else 0 end retweet_count, 0 favourite_count,"
        f" false is_quote, cast(epoch(o_orderdate) as bigint) sent_s from {_JOINED}",
    ),
    "user_profiles": Entry(
        user_profiles,
        "select o_orderkey post_ext_id, o_custkey user_ext_id, c_name as name, lower(replace(c_name, '#', '_')) screen_name,"
        " n_name as location, case when c_acctbal >= 0 then trunc(c_acctbal)::int else 0 end followers_count,"
        f" 0 friends_count, 978307200::bigint created_s from {_JOINED}",
    ),
}
