"""Lines to posts: every kind of line the engine has to tell apart."""

import json

import pytest
from pyspark.sql import functions as F

from posts import post, write_files

from postmill.functions.scalar import epoch_millis_time, epoch_seconds, post_time
from postmill.operators.parse import good_posts, parse_lines, rejects, status_counts
from postmill.sources.lines import read_lines, rechunk_lines


def parsed(spark, *lines):
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    return [row.asDict() for row in parse_lines(df).collect()]


def one(spark, line):
    return parsed(spark, line)[0]


def test_good_post(spark):
    row = one(spark, post(12, "whole text, as sent é", (7, "Zoë"), "fr", ["Tag ", " TWO"], unknown={"a": [1]}))
    assert row["status"] == "good" and row["reason"] is None
    assert (row["post_ext_id"], row["user_ext_id"], row["user_name"]) == (12, 7, "Zoë")
    assert (row["text"], row["lang"], row["tags"]) == ("whole text, as sent é", "fr", ["tag", "two"])
    assert row["created_at"].isoformat() == "2019-03-14T13:26:53"


def test_tag_of_entities_counts_not_text(spark):
    assert one(spark, post(text="#Dont do it", tags=["Don"]))["tags"] == ["don"]


def test_quoted_id_is_good(spark):
    assert one(spark, post(id="12"))["post_ext_id"] == 12


def test_absent_members(spark):
    doc = json.loads(post())
    del doc["entities"], doc["id"]
    row = one(spark, json.dumps(doc))
    assert (row["status"], row["post_ext_id"], row["tags"]) == ("good", int(doc["id_str"]), [])
    row = one(spark, json.dumps({**doc, "id_str": "none"}))
    assert (row["status"], row["reason"]) == ("reject", "bad id")
    del doc["user"]["id"]
    row = one(spark, json.dumps(doc))
    assert (row["status"], row["reason"]) == ("reject", "bad user")


@pytest.mark.parametrize("line", ["", '{"limit":{"track":6,"timestamp_ms":"1552570013000"}}', '{"delete":{}}'])
def test_skipped(spark, line):
    assert one(spark, line)["status"] == ("notice" if line else "blank")


@pytest.mark.parametrize(
    "line, reason",
    [
        ("xxx" + post(), "malformed"),
        (post()[:-5], "malformed"),
        ("null", "malformed"),
        ("[1]", "malformed"),
        ("  ", "malformed"),
        (post(created_at="Thu Mar 33 13:26:53 +0000 2019"), "bad date"),
        (post(created_at="Mon Mar 14 13:26:53 +0000 2019"), "bad date"),
        (post(created_at=None), "bad date"),
        (post(id="12x"), "bad id"),
        (json.dumps({**json.loads(post()), "user": None}), "bad user"),
        (post(user=(1, None)), "bad user"),
        (post(text=None), "no text"),
        (post(lang=None), "no language"),
        (post(tags=["a", None]), "bad tag"),
    ],
)
def test_rejected(spark, line, reason):
    row = one(spark, line)
    assert (row["status"], row["reason"]) == ("reject", reason)


def test_reject_keeps_whole_line_and_counts_add_up(spark):
    long_text = "y" * 100_000
    lines = [post(1), "xxx" + long_text, "", post(2)]
    df = parse_lines(spark.createDataFrame([(line,) for line in lines], "value string"))
    assert [row.value for row in rejects(df).collect()] == ["xxx" + long_text]
    assert sum(row.n for row in status_counts(df).collect()) == len(lines)
    assert good_posts(df).count() == 2


def test_fail_mode_ends_the_job(spark):
    df = parse_lines(spark.createDataFrame([(post(1),), ("xxx",)], "value string"))
    with pytest.raises(Exception, match="line rejected: malformed"):
        good_posts(df, "fail").collect()
    fine = parse_lines(spark.createDataFrame([(post(1),), ("",)], "value string"))
    assert good_posts(fine, "fail").count() == 1
    with pytest.raises(ValueError):
        good_posts(df, "ignore")


def test_a_line_is_parsed_once(spark, tmp_path):
    lines = read_lines(spark, write_files(tmp_path / "in", a=[post(1)]))
    plan = good_posts(parse_lines(lines))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_dates_and_tags_are_read_once(spark, tmp_path):
    lines = read_lines(spark, write_files(tmp_path / "in", a=[post(1)]))
    plan = good_posts(parse_lines(lines))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("gettimestamp(") == 1 and plan.count("transform(") == 1


def test_tags_are_trimmed_of_any_white_space(spark):
    tags = ["a", " A", "a\n", "\u00a0a\u2003", "\t", "", "a b ", "\n\na\n\n"]
    assert one(spark, post(1, tags=tags))["tags"] == ["a", "a", "a", "a", "", "", "a b", "a"]


def test_many_posts(spark):
    lines = [post(i, f"text {i}", (i % 7, f"U{i % 7}")) for i in range(1000)]
    assert {row["status"] for row in parsed(spark, *lines)} == {"good"}


def test_offsets_and_weekday_of_the_written_date(spark):
    cases = {
        "Thu Mar 14 13:26:53 +0000 2019": 1552570013,
        "Fri Mar 15 01:26:53 +1200 2019": 1552570013,
        "Wed Mar 13 23:56:53 -1330 2019": 1552570013,
        "Thu Mar 15 01:26:53 +1200 2019": None,
        "Wed Dec 31 23:59:59 +0000 1969": -1,
        "Sat Feb 29 00:00:00 +0000 2020": 1582934400,
        "Sun Feb 29 00:00:00 +0000 2021": None,
        "": None,
        "Thu": None,
    }
    df = spark.createDataFrame([(text,) for text in cases], "t string")
    got = df.select("t", epoch_seconds(post_time(F.col("t"))).alias("s")).collect()
    assert {row.t: row.s for row in got} == cases


def test_epoch_millis(spark):
    df = spark.createDataFrame([("1552570013123",), ("x",), (None,)], "t string")
    got = [row[0] for row in df.select(epoch_millis_time(F.col("t")).cast("string")).collect()]
    assert got == ["2019-03-14 13:26:53.123", None, None]


def test_lines_keep_their_order_over_splits(spark, tmp_path):
    folder = write_files(tmp_path / "in", a=[f"{i:06d}" for i in range(5000)], b=["x", "y"])
    (tmp_path / "in" / "skip.txt").write_text("not read\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = read_lines(spark, folder)
        assert lines.rdd.getNumPartitions() > 3
        rows = lines.where(F.col("src_file").endswith("a.json")).orderBy("pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [row.value for row in rows] == [f"{i:06d}" for i in range(5000)]
    assert len({row.pos.block for row in rows}) > 3
    assert lines.where(F.col("value") == "not read").count() == 0


def test_rechunk(spark, tmp_path):
    folder = write_files(tmp_path / "in", a=[f"line {i} é" for i in range(3000)])
    out = str(tmp_path / "out")
    rechunk_lines(read_lines(spark, folder), out, 700)
    back = read_lines(spark, out, "*.txt")
    sizes = [row["count"] for row in back.groupBy("src_file").count().collect()]
    assert max(sizes) <= 700 and sum(sizes) == 3000
    assert {row.value for row in back.collect()} == {f"line {i} é" for i in range(3000)}
