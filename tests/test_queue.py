"""Files as a queue with a ledger, rules at write, the key index, and times of batches."""

import gzip
import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from posts import post, write_files

from postmill.operators import key_index
from postmill.operators.metrics import stored_rates
from postmill.plans import ledger
from postmill.plans.load import load_lines, load_staging, merge_staging, scratch_store, stored_near
from postmill.plans.store import Store
from postmill.session import side_by_side
from postmill.sources.lines import read_lines, stream_lines
from postmill.streaming import ingest
from postmill.streaming.progress import BatchTimes

NOON = "2019-03-14 12:00:00"


def clock(turn):
    return NOON


def rows(df, *columns):
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)


def attempts(store):
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return rows(store.read("ledger"), name, "attempt", "outcome", "reason")


# --------------------------------------------------------------------- ledger


def test_a_broken_file_does_not_hold_up_the_others(spark, tmp_path):
    bad = [post(3, "three"), "xxx"]
    folder = write_files(tmp_path / "in", a=[post(1, "one")], b=bad, c=[post(2, "two"), ""], d=[])  # an empty file holds nothing
    store = scratch_store(spark, "queue")
    assert ledger.load_files(store, folder, clock, tries=2) == 2
    assert rows(store.read("posts"), "post_ext_id") == [(1,), (2,)]
    known = [("a.json", 1, "loaded", None), ("b.json", 1, "failed", "malformed"), ("b.json", 2, "set aside", "malformed"),
             ("c.json", 1, "loaded", None)]
    assert attempts(store) == known
    # Nothing waits, so nothing is done; the lines at fault are kept with each attempt.
    assert ledger.load_files(store, folder, clock, tries=2) == 0
    assert rows(store.read("rejects"), "value") == [("xxx",)] * 2
    # Mended, the file is a new one.
    write_files(tmp_path / "in", b=[post(3, "three"), post(4, "four")])
    assert ledger.load_files(store, folder, clock, tries=2) == 1
    assert rows(store.read("posts"), "post_ext_id") == [(1,), (2,), (3,), (4,)]
    assert attempts(store) == sorted([*known, ("b.json", 1, "loaded", None)], key=repr)


def test_the_queue_goes_on_where_it_was_left(spark, tmp_path, monkeypatch):
    folder = write_files(tmp_path / "in", **{f"f{n}": [post(n, f"text {n}")] for n in range(5)})
    store = scratch_store(spark, "queue")
    real, calls = store.publish, []

    def fail_at_second(marks):
        calls.append(marks)
        if len(calls) == 2:
            raise RuntimeError("lost before the commit")
        real(marks)

    monkeypatch.setattr(store, "publish", fail_at_second)
    with pytest.raises(RuntimeError, match="lost before the commit"):
        ledger.load_files(store, folder, clock, files_per_load=2)
    assert len(attempts(store)) == 2
    assert ledger.load_files(store, folder, clock, files_per_load=2) == 2
    assert rows(store.read("posts"), "post_ext_id") == [(n,) for n in range(5)]
    assert [entry[1:3] for entry in attempts(store)] == [(1, "loaded")] * 5


def test_an_unreadable_file_is_found_among_the_others(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json.gz").write_bytes(gzip.compress((post(1, "one") + "\n").encode()))
    whole = gzip.compress(("\n".join(post(n, os.urandom(200).hex()) for n in range(2, 60))).encode())
    (folder / "b.json.gz").write_bytes(whole[: len(whole) // 2])
    store = scratch_store(spark, "queue")
    ledger.load_files(store, str(folder), clock, "*.gz", tries=2)
    assert rows(store.read("posts"), "post_ext_id") == [(1,)]
    found = attempts(store)
    assert [entry[:3] for entry in found] == [("a.json.gz", 1, "loaded"), ("b.json.gz", 1, "failed"), ("b.json.gz", 2, "set aside")]
    assert found[1][3].startswith("unreadable: ")


def test_an_error_that_is_no_files_is_raised(spark, tmp_path):
    folder = write_files(tmp_path / "in", a=[post(1, "one")])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ledger.load_files(scratch_store(spark, "queue"), folder, lambda turn: "no time")


def test_a_stream_leaves_broken_files_to_the_queue(spark, tmp_path):
    folder = write_files(tmp_path / "in", **{"a": [post(1, "one")], "b and c": [post(3, "three"), "xxx"], "d": [post(2, "two")]})
    store, log = scratch_store(spark, "stream"), str(tmp_path / "log")
    ingest.load_stream(store, stream_lines(spark, folder, files_per_trigger=3), clock, log, "file")
    assert rows(store.read("posts"), "post_ext_id") == [(1,), (2,)]
    assert [entry[:3] for entry in attempts(store)] == [
        ("b and c.json", 1, "failed"), ("b and c.json", 2, "failed"), ("b and c.json", 3, "set aside")
    ]
    assert ledger.retry_files(store, clock) == 0


# ----------------------------------------------------------------- rules at write


def test_what_a_table_does_with_broken_rows(spark):
    store = scratch_store(spark, "rules")
    tags = spark.sql("select * from values (1L, 'ok'), (2L, repeat('x', 256)), (cast(null as bigint), 'none'), (3L, null) t(tag_id, name)")
    with pytest.raises(Exception, match="tags: row refused, .* is "):
        store.write("tags", tags, 2, on_break="fail")
    with pytest.raises(ValueError, match="on_break"):
        store.write("tags", tags, 2, on_break="drop")
    assert store.write("tags", tags, 2).count() == 4
    assert rows(store.write("tags", tags, 2, on_break="quarantine"), "tag_id", "name") == [(1, "ok"), (3, None)]
    assert store.broken("tags").count() == 0  # not before the commit
    store.publish({"main": 2})
    broken = rows(store.broken("tags"), "rule", "on", "row")
    assert [entry[:2] for entry in broken] == [("null", "tag_id"), ("too long", "name")]
    assert json.loads(broken[1][2])["tag_id"] == 2
    # A load that is run again and has none any more leaves none behind.
    assert store.write("tags", tags.where("tag_id = 1"), 2, on_break="quarantine").count() == 1
    assert store.broken("tags").count() == 0


def test_lines_too_long_for_their_table(spark, tmp_path):
    long, wide = "x" * 1025, "y" * 256
    lines = [post(1, "x" * 1024, (1, "y" * 255)), post(2, long), post(3, "t", (2, wide)), post(4, "t", (1, "A"), "z" * 51), post(5, "t", tags=["ok", wide])]
    folder = write_files(tmp_path / "in", a=lines)
    store = scratch_store(spark, "limits")
    load_lines(store, read_lines(spark, folder), NOON, enforce_limits=True)
    assert rows(store.read("posts"), "post_ext_id") == [(1,)]
    assert rows(store.read("rejects"), "reason") == [(f"too long {name}",) for name in ("lang", "tags", "text", "user_name")]
    with pytest.raises(Exception, match="line rejected: too long"):
        load_lines(store, read_lines(spark, folder), NOON, "fail", enforce_limits=True)
    load_lines(store, read_lines(spark, folder), NOON)  # left to the audit
    assert store.read("posts").count() == 5


# -------------------------------------------------------------------- key index


@pytest.mark.parametrize("spread", [1, 1000, 1 << 40])
def test_index_never_misses_a_load(spark, spread):
    rng = random.Random(spread)
    loads = {n: [rng.randrange(-500, 500) * spread + n * 1500 * spread for _ in range(40)] for n in range(1, 5)}
    parts = [
        key_index.index_of(spark.createDataFrame([(k,) for k in [*keys, None]], "k long"), "k", "t").withColumn("load_id", F.lit(n).cast("bigint"))
        for n, keys in loads.items()
    ]
    index = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    asked = [loads[1][0], loads[3][7], loads[3][8], 123 * spread + 7, None]
    keys = spark.createDataFrame([(k,) for k in asked], "k long")
    found = key_index.hits(index, keys, "k")
    holding = {n for n, held in loads.items() if set(held) & set(asked)}
    assert holding <= set(found.loads)
    for n in holding:
        for k in set(loads[n]) & set(asked):
            assert any(low <= k <= high for low, high in found.ranges)
    if spread == 1:  # a bit is a key
        exact = {row["load_id"]: row["n"] for row in key_index.loads_holding(index, keys, "k").groupBy("load_id").agg(F.sum("n").alias("n")).collect()}
        assert exact == {n: len(set(held) & set(asked)) for n, held in loads.items() if set(held) & set(asked)}
    assert key_index.hits(index, keys.limit(0), "k") == ([], [])
    assert key_index.hits(index.limit(0), keys, "k") == ([], [])


def test_index_of_keys_far_apart_stays_small(spark):
    keys = spark.range(3000).select((F.col("id") * (1 << 50) - (1 << 60)).alias("k"))
    assert key_index.index_of(keys, "k", "t").count() <= key_index.BITMAPS
    assert key_index.index_of(keys.limit(0), "k", "t").count() == 0


def test_joined_ranges():
    assert key_index.joined_ranges([(5, 6), (1, 2), (3, 4), (20, 30), (10, 11)], 2) == [(1, 11), (20, 30)]
    assert key_index.joined_ranges([], 3) == []


def test_a_late_duplicate_does_not_read_the_whole_table(spark, tmp_path):
    store, step = scratch_store(spark, "late"), 1 << 22
    for turn in range(3):
        folder = write_files(tmp_path / str(turn), a=[post((turn * 1000 + n) * step, f"t{turn} {n}", tags=["x"]) for n in range(50)])
        load_lines(store, read_lines(spark, folder), NOON)
    again = write_files(tmp_path / "late", a=[post(1003 * step, "late copy", tags=["x", "y"])] + [post((9000 + n) * step, "new") for n in range(20)])
    load_staging(store, read_lines(spark, again), NOON, 4)
    marks = store.marks()
    keys = store.staging(marks, waiting_only=True)["posts_stage"]
    index = store.read_by_load("key_index", marks=marks).where("t = 'posts'")
    assert key_index.hits(index, keys, "post_ext_id").loads == [3]  # the second load of posts
    near = stored_near(store, "posts", keys, marks)
    assert 1 <= near.count() <= 50 and store.read("posts").count() == 150
    files = {row["f"] for row in near.select(F.input_file_name().alias("f")).distinct().collect()}
    assert files and all("/load_id=3/" in name for name in files)
    merge_staging(store)
    assert store.read("posts").count() == 170
    assert rows(store.read("posts").where(F.col("post_ext_id") == 1003 * step), "text") == [("t1 3",)]
    pairs = store.read("post_tag").where(F.col("post_ext_id") == 1003 * step)
    assert pairs.count() == 2 and pairs.select("post_id").distinct().count() == 1
    # A store from before there was an index is read whole.
    store.remove("key_index")
    load_lines(store, read_lines(spark, again), NOON)
    assert store.read("posts").count() == 170


# --------------------------------------------------------------- times of batches


def test_batches_are_stored_as_steps(spark, tmp_path):
    folder = write_files(tmp_path / "in", a=[post(1, "one"), ""], b=[post(2, "two")], c=[post(3, "three")] * 3)
    store, log = scratch_store(spark, "batches"), str(tmp_path / "log")
    ingest.load_stream(store, stream_lines(spark, folder, files_per_trigger=1), clock, log)
    steps = store.read("timings")
    batches = rows(steps.where("name = 'batch'"), "custom", "depth")
    assert sorted(json.loads(custom)["lines"] for custom, _ in batches) == [1, 2, 3]
    assert [json.loads(custom)["batch"] for custom, _ in batches] == [0, 1, 2]
    root = steps.where("name = 'stream'").first()
    assert root["is_root"] and root["duration_ms"] >= steps.where("name = 'batch'").agg(F.max("duration_ms")).first()[0]
    rates = {row["batch"]: row for row in stored_rates(steps).where("batch is not null").collect()}
    for row in rates.values():
        assert row["rate"] == row["rows"] // (max(int(row["duration_ms"]), 1000) // 1000)
    assert stored_rates(steps).where("batch is null").agg(F.sum("rows")).first()[0] == 3
    # A run without new files has no batch and leaves no step.
    ingest.load_stream(store, stream_lines(spark, folder, files_per_trigger=1), clock, log)
    assert store.read("timings").where("name = 'stream'").count() == 1


def test_listener_goes_with_a_failing_stream(spark, tmp_path):
    folder = write_files(tmp_path / "in", a=["xxx"])
    with BatchTimes(spark) as times:
        query = ingest.stage_stream(scratch_store(spark, "fails"), stream_lines(spark, folder), clock, str(tmp_path / "log"), "fail")
        with pytest.raises(Exception, match="line rejected"):
            query.awaitTermination()
        assert times.of(query) == []


# ------------------------------------------------------------------- two writers


def test_two_writers_lose_no_load(spark, tmp_path):
    """Two threads, each with a store object of its own, load into one store at once."""
    root = scratch_store(spark, "shared").root
    folders = [write_files(tmp_path / str(n), a=[post(10 * n + k, f"text {n} {k}", (n, f"U{n}"), f"q{n}", ["both", f"own{n}"]) for k in range(3)]) for n in (1, 2)]
    run = [lambda folder=folder: load_lines(Store(spark, root), read_lines(spark, folder), NOON) for folder in folders]
    side_by_side(spark, *run)
    main = Store(spark, root).main()
    assert rows(main["posts"], "post_ext_id") == [(10 * n + k,) for n in (1, 2) for k in range(3)]
    tags = rows(main["tags"], "tag_id", "name")
    assert [number for number, _ in tags] == [1, 2, 3] and {name for _, name in tags} == {"both", "own1", "own2"}
    assert len({number for number, in rows(main["posts"], "post_id")}) == 6 and main["post_tag"].count() == 12
    assert Store(spark, root)._claims() == []


def test_a_dead_writer_is_overtaken_and_a_slow_one_told(spark):
    store = scratch_store(spark, "claims")
    other = Store(spark, store.root, lease=0.3)
    with pytest.raises(RuntimeError, match="another writer has taken over"), store.writing():
        with pytest.raises(TimeoutError, match="another writer has held"), Store(spark, store.root).writing(patience=0.1):
            pass
        time.sleep(0.5)
        with other.writing():
            other.publish({"main": 7})
        with other.writing(), pytest.raises(RuntimeError, match="taken over"):
            store.publish({"main": 8})
        store.publish({"main": 8})
    assert store.committed("main") == 7
