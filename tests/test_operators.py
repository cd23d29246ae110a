"""Joins, keys, picks, audits, metrics."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from postmill.operators import audit, extras, joins, keys, metrics, pick, subscription
from postmill.operators.subscription import subscribed
from postmill.plans.load import scratch_store
from postmill.schema import MAIN, PROFILES, TIMINGS, TableSpec
from postmill.sources.tables import empty_table, generated_users, seed_languages


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------- seeds


def test_seed_languages(spark):
    seeds = {row.short_code: (row.lang_id, row.name) for row in seed_languages(spark).collect()}
    assert len(seeds) == 188 and sorted(i for i, _ in seeds.values()) == list(range(1, 189))
    assert (seeds["en"][0], seeds["es"][0], seeds["iw"][0]) == (37, 39, 188)


def test_generated_users(spark):
    assert rows(generated_users(spark.range(3), "id")) == [("Bob0", 0), ("Bob1", 1), ("Bob2", 2)]


# -------------------------------------------------------------------- keys


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_dense_ids_follow_the_key_order(spark, partitions):
    names = [f"n{i:04d}" for i in range(500)]
    random.Random(1).shuffle(names)
    df = spark.createDataFrame([(name,) for name in names], "name string").repartition(partitions)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rows(keys.dense_ids(df, "name", "id", 40))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == [(name, 41 + i) for i, name in enumerate(sorted(names))]


def test_dictionary(spark):
    dim = seed_languages(spark)
    used = spark.createDataFrame([("en",), ("xxx",), ("es",), ("en",), ("aaa",), (None,)], "short_code string")
    fresh = keys.new_entries(used, dim, "short_code", "lang_id")
    assert rows(fresh) == [("aaa", 189), ("xxx", 190)]
    coded = keys.encode(used, keys.grown_dictionary(used, dim, "short_code", "lang_id"), "short_code", ["short_code"])
    assert Counter(row.lang_id for row in coded.collect()) == {37: 2, 39: 1, 189: 1, 190: 1, None: 1}


def test_first_number_of_an_empty_dictionary(spark):
    empty = empty_table(spark, MAIN["tags"])
    assert keys.largest_id(empty, "tag_id") == 0
    used = spark.createDataFrame([("xxx",)], "name string")
    assert rows(keys.new_entries(used, empty, "name", "tag_id")) == [("xxx", 1)]
    none = used.where("false")
    assert rows(keys.new_entries(none, empty, "name", "tag_id")) == []


# ------------------------------------------------------------------- joins


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_is_the_plain_join(spark, how):
    rng = random.Random(2)
    facts = [(i, None if i % 10 == 0 else 0 if rng.random() < 0.4 else rng.randint(1, 60)) for i in range(3000)]
    df = spark.createDataFrame(facts, "id int, k int")
    side = spark.createDataFrame([(k, f"v{k}") for k in range(0, 70, 2)], "k int, v string")
    salted = joins.salted_join(df, side, "k", ["id"], how, parts=60)
    assert rows(salted.select("id", "k", "v")) == rows(df.join(side, "k", how).select("id", "k", "v"))


def test_salted_join_splits_the_hot_key(spark):
    facts = spark.range(10_000).select(F.col("id"), F.lit(1).alias("k"))
    side = spark.createDataFrame([(1, "v")], "k int, v string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        joined = joins.salted_join(facts, side, "k", ["id"], parts=100)
        sizes = [row["count"] for row in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    assert len(sizes) > 4 and sum(sizes) == 10_000 and max(sizes) < 4_000


def test_broadcast_only_what_fits(spark):
    side = spark.createDataFrame([(i, "x" * 100) for i in range(50)], "k int, v string")
    assert joins.fits_broadcast(side)
    assert not joins.fits_broadcast(side, rows=49)
    assert not joins.fits_broadcast(side, size=50 * 100)
    assert joins.fits_broadcast(side.where("false"))


def test_within_range(spark):
    known, staged = spark.range(100), spark.range(20, 30)
    assert rows(joins.within_range(known, staged, "id")) == [(i,) for i in range(20, 30)]
    assert rows(joins.within_range(known, staged.where("false"), "id")) == []


def test_orphans(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 10)], "id int, p int")
    parent = spark.createDataFrame([(11,)], "pk int")
    assert rows(joins.orphans(child, parent, "p", "pk").select("id")) == [(1,), (4,)]


# -------------------------------------------------------------------- pick


def test_group_limit_runs_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select((F.col("id") % 3).alias("k"), "id").write.parquet(path)
    plan = plan_of(pick.first_per_key(spark.read.parquet(path), ["k"], [F.col("id")]))
    below = plan.split("Exchange hashpartitioning", 1)[1]
    assert "WindowGroupLimit" in below


def test_latest_copy(spark):
    data = [
        (1, "2017-01-01", "a", 5, "old"),
        (1, "2017-01-02", "a", 9, "new, later line"),
        (1, "2017-01-02", "a", 8, "new, first line"),
        (2, "2017-01-01", "a", 1, "file a"),
        (2, "2017-01-01", "b", 7, "file b"),
    ]
    df = spark.createDataFrame(data, "post_ext_id int, ingest_ts string, src_file string, pos int, text string")
    assert rows(pick.latest_copy(df).select("post_ext_id", "text")) == [(1, "new, first line"), (2, "file b")]


def test_one_name_per_user(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "user_ext_id int, name string")
    assert rows(pick.one_name_per_user(df)) == [(1, "a"), (2, "c")]


# ------------------------------------------------------------------ audits


@pytest.fixture(scope="module")
def linked(spark):
    posts = spark.createDataFrame(
        [(1, "#Spark and #sql!"), (2, "no tags # here"), (3, "#alone #'x"), (4, None)], "post_id int, text string"
    )
    tags = spark.createDataFrame([(1, "spark"), (2, "sql"), (3, "ghost")], "tag_id int, name string")
    pairs = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (1, 3), (2, 3)], "post_id int, tag_id int")
    return posts, audit.linked_tags(pairs, tags)


def test_tag_audits(spark, linked):
    posts, names = linked
    assert rows(audit.tags_not_in_text(posts, names)) == [(1, "ghost"), (2, "ghost")]
    assert rows(audit.tags_not_in_text(posts, names, ignore_case=False)) == [(1, "ghost"), (1, "spark"), (2, "ghost")]
    assert rows(audit.text_tags_not_linked(posts, names)) == [(3, "alone")]
    parity = audit.text_tags_not_linked(posts, names, ignore_case=False, keep_empty=True)
    assert rows(parity) == [(1, "Spark"), (3, ""), (3, "alone")]
    assert rows(audit.tags_per_post(names)) == [(1, ["ghost", "spark", "sql"]), (2, ["ghost"])]


def test_differs_from_text(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), (None, "b"), ("a", None)], "n string, t string")
    assert rows(audit.differs_from_text(df, "n", "t")) == [("a", "b")]
    df.createOrReplaceTempView("t_j5")
    original = "select n, t from t_j5 x where n not in (select x.t from t_j5 y where y.t = x.t)"
    assert ("a", "b") in rows(spark.sql(original))


def test_table_report(spark):
    spec = TableSpec(
        "child", {}, key=("id",), required=("name",), max_length={"name": 3}, references={"p": ("parent", "pk")}
    )
    child = spark.createDataFrame([(1, "ok", 1), (1, None, 2), (2, "long", None)], "id int, name string, p int")
    parent = spark.createDataFrame([(1,)], "pk int")
    report = audit.table_report({"child": child, "parent": parent}, {"child": spec})
    assert rows(report) == [
        ("child", "null", "name", 1),
        ("child", "orphan", "p", 1),
        ("child", "repeated", "id", 1),
        ("child", "too long", "name", 1),
    ]
    assert audit.table_report({"child": parent}, {"child": TableSpec("child", {}, key=("pk",), required=("pk",))}).count() == 0


# ----------------------------------------------------------------- metrics


def test_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert rows(metrics.distinct_compare(df, "k", "v")) == [(3, 2)]
    assert rows(metrics.duplicate_count(df, ["k", "v"])) == [(1,)]
    assert rows(metrics.duplicate_count(df.where("false"), ["k"])) == [(0,)]
    assert rows(metrics.table_counts({"x": df, "y": df.where("false")})) == [("x", 4), ("y", 0)]


def test_step_timer(spark):
    timer = metrics.StepTimer("load", user="ann")
    with timer.step("outer"):
        with timer.step("inner"):
            timer.observe(spark.range(30), "lines").write.format("noop").mode("overwrite").save()
    assert timer.observed("lines") == 30
    steps = {row.name: row for row in timer.timings(spark).collect()}
    assert steps["load"].is_root and steps["load"].depth == 0 and steps["load"].parent_id is None
    assert steps["inner"].parent_id == steps["outer"].id and steps["inner"].depth == 2
    assert steps["load"].duration_ms >= steps["outer"].duration_ms >= steps["inner"].duration_ms

    store = scratch_store(spark, "timings")
    store.write("timings", timer.timings(spark), 1)
    store.write("profiles", timer.profile(spark), 1)
    store.publish({"timings": 1, "profiles": 1})
    stored = store.read("timings")
    assert metrics.matching(stored, "profile_id", timer.profile_id).count() == 3
    children = metrics.matching(stored, "is_root", False, [F.col("duration_ms")])
    assert [row.name for row in children.collect()] == ["inner", "outer"]
    assert metrics.max_by_group(stored, "name", "duration_ms", "max_ms").first().name == "load"
    assert metrics.newest_first(store.read("profiles"), "started", "id").count() == 1
    assert audit.table_report({"timings": stored, "profiles": store.read("profiles")}, {"timings": TIMINGS, "profiles": PROFILES}).count() == 0
    store.reset("timings", "profiles")
    assert store.read("timings").count() == 0


# ------------------------------------------------------------ subscription


def test_subscription(spark):
    data = [
        (1, "Bumble BEE seen", 5, None, None, "en", "low"),
        (2, "bee, no bumbling", 6, 10.0, 50.0, "fr", "low"),
        (3, "nothing", 7, -3.0, 55.0, "en", "low"),
        (4, "nothing", 8, None, None, "en", "none"),
        (5, "the bee did bumble", None, None, None, "en", "none"),
    ]
    df = spark.createDataFrame(data, "id int, text string, user int, lon double, lat double, lang string, level string")
    c = {"text": F.col("text"), "user_id": F.col("user"), "lon": F.col("lon"), "lat": F.col("lat")}
    phrases = {"phrases": ["bumble bee"]}

    def ids(**wanted):
        return [row.id for row in df.where(subscribed(**c, **wanted)).orderBy("id").collect()]

    assert ids(**phrases) == [1, 5]
    assert ids(**phrases, users=[8]) == [1, 4, 5]
    assert ids(**phrases, box=(-7, 50, 3, 60)) == [1, 3, 5]
    assert ids(box=(-180, -90, 180, 90)) == [2, 3]
    assert ids(**phrases, lang=F.col("lang"), only_lang="en", filter_level=F.col("level"), only_level="none") == [5]
    assert ids() == []


# ------------------------------------------------------------------ extras


def test_extras(spark):
    doc = {
        "created_at": "Thu Mar 14 13:26:53 +0000 2019", "id": 5, "id_str": "5", "text": "t", "lang": "en",
        "timestamp_ms": "1552570013000", "favorite_count": 3, "quoted_status": {"id": 1, "text": "q"},
        "user": {"id": 9, "name": "Ann", "screen_name": "ann", "followers_count": 4,
                 "created_at": "Mon Jan 01 00:00:00 +0000 2001"},
        "coordinates": {"type": "Point", "coordinates": [-3.5, 55.0]},
        "place": {"id": "p1", "place_type": "city", "name": "X", "country_code": "GB", "bounding_box": {
            "type": "Polygon", "coordinates": [[[0, 1], [0, 2], [3, 2], [3, 1]]]}},
        "entities": {"user_mentions": [{"screen_name": "bob", "id": None}, {"screen_name": "cy", "id": 3}],
                     "urls": [{"url": "http://u"}]},
    }
    bare = {"id": 6, "id_str": "6", "text": "t", "user": {"id": 9, "name": "Ann"}, "place": None}
    lines = [json.dumps(doc), json.dumps({**doc, "id": 7, "id_str": "7"}), json.dumps(bare), "xxx", "", '{"limit":{}}']
    posts = extras.wide_posts(spark.createDataFrame([(line,) for line in lines], "value string"))
    assert rows(posts.select("post_ext_id")) == [(5,), (6,), (7,)]
    assert rows(extras.mentions(posts)) == [(5, "bob"), (5, "cy"), (7, "bob"), (7, "cy")]
    assert rows(extras.links(posts)) == [(5, "http://u"), (7, "http://u")]
    (place,) = extras.places(posts).collect()
    assert (place.place_key, tuple(place.box_ll), tuple(place.box_ur)) == ("p1", (1.0, 0.0), (2.0, 3.0))
    details = {row.post_ext_id: row for row in extras.post_details(posts).collect()}
    assert tuple(details[5].coordinates) == (55.0, -3.5) and details[5].favourite_count == 3
    assert details[6].coordinates is None and details[6].retweet_count == 0 and details[6].is_quote is False
    assert details[5].sent_at.isoformat() == "2019-03-14T13:26:53"
    people = {row.post_ext_id: row for row in extras.profiles(posts).collect()}
    assert people[5].followers_count == 4 and people[6].followers_count == 0
    assert people[5].created_at.isoformat() == "2001-01-01T00:00:00"


def test_blank_phrases_ask_for_nothing(spark):
    posts = spark.createDataFrame([("a bee",), ("",)], "text string")
    assert posts.where(subscription.tracks(F.col("text"), ["", "  "])).count() == 0
    assert posts.where(subscription.tracks(F.col("text"), [" ", "bee"])).count() == 1
