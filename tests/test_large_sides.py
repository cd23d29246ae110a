"""The paths taken when a side is too large to send around give the same rows."""

from posts import post
from pyspark.sql import functions as F

from postmill.operators.joins import Lookup
from postmill.operators.parse import good_posts, parse_lines
from postmill.plans import merge, stage
from postmill.schema import MAIN
from postmill.sources.lines import with_position
from postmill.sources.tables import empty_table, seed_languages


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def feed(spark):
    # One user, one tag and one post hold a third of the lines.
    lines = [
        post(1 if i % 3 == 0 else i, f"text {i} #hot", (7, "Hot") if i % 3 == 1 else (i, f"U{i}"), "en", ["hot", f"t{i % 9}"])
        for i in range(120)
    ]
    df = spark.createDataFrame([(f"f{i % 2}", line, i) for i, line in enumerate(lines)], "src_file string, value string, block bigint")
    parsed = parse_lines(with_position(df.coalesce(1)).withColumn("ingest_ts", F.lit("2024-01-01").cast("timestamp")))
    return good_posts(parsed)


def test_large_sides(spark, monkeypatch):
    posts = feed(spark)
    langs = stage.language_dictionary(posts, seed_languages(spark))
    tags = stage.tag_dictionary(posts, empty_table(spark, MAIN["tags"]))
    assert langs.small and tags.small
    large_langs, large_tags = Lookup(langs.rows, False), Lookup(tags.rows, False)
    staged = stage.stage_posts(posts, langs)
    assert rows(stage.stage_posts(posts, large_langs)) == rows(staged)
    pairs = stage.stage_post_tags(staged, tags)
    assert rows(stage.stage_post_tags(staged, large_tags)) == rows(pairs)
    assert rows(stage.stage_tags(posts, large_tags)) == rows(stage.stage_tags(posts, tags))

    users = merge.new_users(stage.stage_users(posts), empty_table(spark, MAIN["users"]))
    none = empty_table(spark, MAIN["posts"])
    small = rows(merge.new_posts(staged, users, none))
    # 80 numbers up to 119 are no multiples of 3, and 1 is one of them.
    assert len(small) == 80
    monkeypatch.setattr(merge, "measured", lambda side: Lookup(side, False))
    assert rows(merge.new_posts(staged, users, none)) == small
