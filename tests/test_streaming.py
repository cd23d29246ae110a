"""Streams give what the batch gives."""

import pytest

from pyspark.sql import functions as F

from posts import post, write_files

from postmill.operators.parse import good_posts, parse_lines
from postmill.operators.subscription import tracks
from postmill.plans.load import load_lines, scratch_store
from postmill.sources.lines import read_lines, stream_lines
from postmill.streaming import ingest

NOON = "2019-03-14 12:00:00"


def rows(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


FILES = {
    "a": [post(1, "one", (1, "Ann"), "en", ["x"]), "", post(1, "one again", (1, "Ann"), "en", ["x"]), "xxx"],
    "b": [post(2, "two", (2, "Bob"), "qq", ["y", "x"])],
    "c": [post(1, "one", (1, "Ann"), "en", ["x"]), post(3, "three", (2, "Bob"), "en", [])],
}


def clock(epoch):
    return NOON


def test_stream_is_batch_and_a_repeated_batch_is_skipped(spark, tmp_path):
    folder = write_files(tmp_path / "in", **FILES)
    store = scratch_store(spark, "stream")
    log = str(tmp_path / "log")
    ingest.load_stream(store, stream_lines(spark, folder, files_per_trigger=1), clock, log)
    # One load per file.
    assert store.committed("stage") == 3

    batch = scratch_store(spark, "batch")
    load_lines(batch, read_lines(spark, folder), NOON)
    streamed, loaded = store.main(), batch.main()
    for name, columns in {"users": ["user_ext_id", "name", "user_id"], "posts": ["post_id", "post_ext_id", "text"]}.items():
        assert rows(streamed[name], *columns) == rows(loaded[name], *columns)
    assert {n for n, in rows(streamed["tags"], "name")} == {n for n, in rows(loaded["tags"], "name")} == {"x", "y"}
    assert streamed["post_tag"].count() == loaded["post_tag"].count() == 3

    # A late duplicate and a new post arrive; the stream goes on where it stopped.
    write_files(tmp_path / "in", d=[post(2, "late copy", (2, "Bob")), post(9, "new", (3, "Cy"))])
    ingest.load_stream(store, stream_lines(spark, folder, files_per_trigger=1), clock, log)
    assert store.committed("stage") == 4
    assert rows(store.read("posts"), "post_ext_id", "text")[1:] == [(2, "two"), (3, "three"), (9, "new")]

    # The log is lost while a post arrives: all batches come again, the new one with them.
    write_files(tmp_path / "in", e=[post(11, "newer", (3, "Cy"))])
    ingest.load_stream(store, stream_lines(spark, folder, files_per_trigger=1), clock, str(tmp_path / "new-log"))
    assert store.committed("stage") == 9
    assert [n for n, in rows(store.read("posts"), "post_ext_id")] == [1, 2, 3, 9, 11]


def test_two_streams_into_one_store(spark, tmp_path):
    store = scratch_store(spark, "two-streams")
    for name, numbers in {"one": (1, 2), "two": (3, 4)}.items():
        folder = write_files(tmp_path / name, **{f"f{n}": [post(n, f"text {n}", (n, f"U{n}"))] for n in numbers})
        ingest.load_stream(store, stream_lines(spark, folder, files_per_trigger=1), clock, str(tmp_path / f"log-{name}"))
    assert [n for n, in rows(store.read("posts"), "post_ext_id")] == [1, 2, 3, 4]


def test_failed_batch_is_retried(spark, tmp_path, monkeypatch):
    folder = write_files(tmp_path / "in", a=FILES["a"])
    store, log = scratch_store(spark, "retry"), str(tmp_path / "log")
    real, calls = store.publish, []

    def fail_once(marks):
        calls.append(marks)
        if len(calls) == 1:
            raise RuntimeError("lost before the commit")
        real(marks)

    monkeypatch.setattr(store, "publish", fail_once)
    with pytest.raises(Exception, match="lost before the commit"):
        ingest.load_stream(store, stream_lines(spark, folder), clock, log)
    assert store.committed("stage") == 0
    ingest.load_stream(store, stream_lines(spark, folder), clock, log)
    assert store.committed("stage") == 1
    assert rows(store.read("posts"), "post_ext_id", "text") == [(1, "one")]


def test_drain(spark, tmp_path):
    folder = write_files(tmp_path / "in", a=["l1", "", "l2"], b=["l3"])
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    ingest.drain(stream_lines(spark, folder), out, log)
    assert rows(spark.read.text(out), "value") == [("l1",), ("l2",), ("l3",)]
    write_files(tmp_path / "in", c=["l4"])
    ingest.drain(stream_lines(spark, folder), out, log)
    assert rows(spark.read.text(out), "value") == [("l1",), ("l2",), ("l3",), ("l4",)]


def test_land_what_is_wanted(spark, tmp_path):
    folder = write_files(tmp_path / "in", a=["a bee", "", "a wasp", "BEEs too"])
    out = str(tmp_path / "out")
    wanted = tracks(F.col("value"), ["bee"])
    ingest.land(stream_lines(spark, folder), out, str(tmp_path / "log"), wanted).awaitTermination()
    assert rows(spark.read.text(out), "value") == [("BEEs too",), ("a bee",)]


def test_a_key_comes_once_however_late(spark, tmp_path):
    from postmill.streaming.unique import STATE_ON_DISK, write_unique

    before = {name: spark.conf.get(name, None) for name in STATE_ON_DISK}
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    for turn, ids in enumerate([[1, 2, 1], [None, 3], [2, 1, 9, None], [], [3, 4]]):
        folder = write_files(tmp_path / "in", **{f"f{turn}": ["" if i is None else str(i) for i in ids]})
        keys = stream_lines(spark, folder, files_per_trigger=1).select(F.col("value").try_cast("bigint").alias("id"))
        query = write_unique(keys, ["id"], out, log)
        query.awaitTermination()
    found = [row.id for row in spark.read.schema("id bigint").parquet(out).collect()]
    assert sorted(found, key=str) == [1, 2, 3, 4, 9, None]
    assert query.lastProgress is None or query.lastProgress["stateOperators"][0]["numRowsTotal"] == 6
    assert {name: spark.conf.get(name, None) for name in STATE_ON_DISK} == before
