"""Numbers given in ranges of posts: one shuffle, and the same rows as by plain joins."""

from pyspark.sql import functions as F

from postmill.plans import merge, stage
from postmill.operators.joins import measured
from postmill.schema import MAIN
from postmill.sources.tables import empty_table


def rows(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


def staged(spark, n=3000):
    """Posts of two files, some in both, in no order; three owners."""
    key = F.pmod(F.xxhash64("id"), F.lit(n))
    return spark.range(2 * n).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("src_file"),
        F.format_string("text %d", "id").alias("text"),
        (F.col("id") % 3).alias("user_ext_id"),
        key.alias("post_ext_id"),
        F.lit("en").alias("lang"),
        F.lit(37).cast("bigint").alias("lang_id"),
        F.lit("2024-01-01").cast("timestamp").alias("ingest_ts"),
        F.lit("2024-01-01").cast("timestamp").alias("created_at"),
        F.array(F.lit("x")).alias("tags"),
        F.struct(F.lit(0).cast("bigint").alias("block"), F.col("id").alias("row")).alias("pos"),
    )


def test_posts_are_numbered_in_ranges(spark, monkeypatch):
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        lines = staged(spark).localCheckpoint()
        users = spark.range(2).select(F.col("id").alias("user_ext_id"), (F.col("id") + 1).alias("user_id"))  # user 2 is unknown
        seen = []
        monkeypatch.setattr(merge, "durable", lambda df: seen.append(df) or df.checkpoint())
        got = rows(merge.new_posts(lines, users, empty_table(spark, MAIN["posts"]), 10), "post_ext_id", "post_id", "text", "user_id")
        plan = seen[0]._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    best = {}
    for row in lines.collect():
        best[row.post_ext_id] = max(best.get(row.post_ext_id, ("", 0, "", 0)), (row.src_file, -row.pos.row, row.text, row.user_ext_id))
    kept = [(key, best[key][2], best[key][3] + 1) for key in sorted(best) if best[key][3] < 2]
    assert got == [(key, 11 + i, text, user) for i, (key, text, user) in enumerate(kept)]


def test_pairs_are_numbered_in_ranges(spark, monkeypatch):
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        pairs = [(post, tag) for post in range(500) for tag in (post % 5, 3, post % 5)] * 2 + [(900, 1), (7, None)]
        stage_rows = spark.createDataFrame(pairs, "post_ext_id bigint, tag_id bigint").repartition(5)
        posts = spark.range(0, 600, 2).unionByName(spark.createDataFrame([(7,)], "id bigint"))
        posts = posts.select(F.col("id").alias("post_ext_id"), (F.col("id") + 1000).alias("post_id"))
        stored = spark.createDataFrame([(4, 3), (6, 1)], "post_ext_id bigint, tag_id bigint")
        seen = []
        monkeypatch.setattr(merge, "durable", lambda df: seen.append(df) or df.checkpoint())
        got = [tuple(row) for row in merge.new_pairs(stage_rows, posts, stored, 5).orderBy("post_tag_id").collect()]
        plan = seen[0]._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("Exchange rangepartitioning") == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    known = {*range(0, 600, 2), 7}
    want = sorted({(p, t) for p, t in pairs if p in known} - {(4, 3), (6, 1)}, key=lambda pair: (pair[0], -1 if pair[1] is None else pair[1]))
    assert got == [(6 + i, p, p + 1000, t) for i, (p, t) in enumerate(want)]


def test_many_repeated_posts_meet_once(spark, monkeypatch):
    lines = staged(spark).drop("lang_id").withColumn("user_name", F.lit("U")).localCheckpoint()
    langs = measured(spark.sql("select 'en' short_code, 37L lang_id"))
    assert not stage.often_repeated(lines)
    few = rows(stage.stage_posts(lines, langs), "src_file", "post_ext_id", "text")
    monkeypatch.setattr(stage, "_MANY", 100)
    assert stage.often_repeated(lines)
    many = stage.stage_posts(lines, langs)
    assert rows(many, "src_file", "post_ext_id", "text") == few
    assert many._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_pairs_are_sorted_once(spark, monkeypatch):
    pairs = spark.createDataFrame([(post, tag) for post in range(50) for tag in (3, 1, 3)], "post_ext_id bigint, tag_id bigint")
    posts = spark.range(50).select(F.col("id").alias("post_ext_id"), (F.col("id") + 100).alias("post_id"))
    seen = []
    monkeypatch.setattr(merge, "durable", lambda df: seen.append(df) or df.checkpoint())
    linked = merge.new_pairs(pairs, posts, empty_table(spark, MAIN["post_tag"]), 0)
    assert rows(linked, "post_tag_id", "post_id", "tag_id") == [(2 * n + t // 2 + 1, n + 100, t) for n in range(50) for t in (1, 3)]
    plan = seen[0]._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count(" Sort [") == 1
