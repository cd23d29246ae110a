"""Batch load from files to main tables."""

import pytest
from pyspark.sql import functions as F

from posts import post, write_files

from postmill.operators.audit import table_report
from postmill.operators.joins import measured
from postmill.operators.parse import good_posts, parse_lines
from postmill.plans import stage
from postmill.plans.load import load_lines, load_staging, merge_staging, scratch_store
from postmill.schema import MAIN, STAGING
from postmill.sources.lines import read_lines

NOON, LATER = "2019-03-14 12:00:00", "2019-03-15 12:00:00"


def rows(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


def two_files(tmp_path):
    return write_files(
        tmp_path / "in",
        a=[
            post(1, "first", (10, "Zoe"), "en", ["One ", "TWO"]),
            post(1, "again", (10, "Amy"), "xx", ["three"]),
            post(2, "other", (11, "Bob"), "es", []),
            "",
            '{"limit":{"track":6,"timestamp_ms":"1552570013000"}}',
            "xxx{}",
        ],
        b=[post(1, "later copy", (10, "Amy"), "aaa", ["one", "four"]), post(3, "third", (12, "Cy"), "fr", ["two"])],
    )


def check_first_load(store):
    main = store.main()

    languages = dict(rows(main["languages"], "short_code", "lang_id"))
    assert (languages["en"], languages["es"], languages["fr"]) == (37, 39, 47)
    # New codes follow the seeds in the order of their text; duplicates feed them too.
    assert (languages["aaa"], languages["xx"]) == (189, 190)
    assert main["languages"].count() == 190

    # First name within a file, alphabetically first over files.
    assert rows(main["users"], "user_ext_id", "name", "user_id") == [(10, "Amy", 1), (11, "Bob", 2), (12, "Cy", 3)]

    # Same intake time: the copy in the later file stands.
    assert rows(main["posts"], "post_id", "post_ext_id", "text", "user_id", "lang_id") == [
        (1, 1, "later copy", 1, 189),
        (2, 2, "other", 2, 39),
        (3, 3, "third", 3, 47),
    ]
    assert rows(main["tags"], "name", "tag_id") == [("four", 1), ("one", 2), ("three", 3), ("two", 4)]
    assert rows(main["post_tag"], "post_tag_id", "post_ext_id", "post_id", "tag_id") == [
        (1, 1, 1, 1),
        (2, 1, 1, 2),
        (3, 1, 1, 4),
        (4, 3, 3, 4),
    ]
    assert table_report({**main, **store.staging()}, {**MAIN, **STAGING}).count() == 0

def everything(store):
    return {name: rows(df, *df.columns) for name, df in store.main().items()}


def test_life_of_a_store(spark, tmp_path):
    store = scratch_store(spark)
    set_aside = load_lines(store, read_lines(spark, two_files(tmp_path)), NOON)
    assert rows(set_aside, "reason", "value") == [("malformed", "xxx{}")]
    check_first_load(store)
    before = everything(store)

    # Merging twice is merging once, and so is loading the same files again.
    merge_staging(store)
    load_lines(store, read_lines(spark, str(tmp_path / "in")), LATER)
    assert everything(store) == before

    # What a load wrote before it failed is not seen, and the next load overwrites it.
    junk = spark.sql("select 99L tag_id, 'junk' name")
    store.write("tags", junk, store.committed("main") + 1)
    assert everything(store) == before
    more = write_files(tmp_path / "more", c=[post(9, "new", (5, "Eve"), "zzz", ["alpha"]), post(2, "kept?", (11, "Al"))])
    load_lines(store, read_lines(spark, more), LATER)
    main = store.main()
    assert rows(main["posts"], "post_id", "post_ext_id", "text")[1:] == [(2, 2, "other"), (3, 3, "third"), (4, 9, "new")]
    assert rows(main["users"], "user_id", "name") == [(1, "Amy"), (2, "Bob"), (3, "Cy"), (4, "Eve")]
    assert rows(main["tags"], "tag_id", "name")[-1] == (5, "alpha")
    assert rows(main["languages"], "lang_id", "short_code")[-1] == (191, "zzz")

    # After a reset only the seeds are left and numbers start again.
    store.reset_all()
    sizes = {name: df.count() for name, df in store.main().items()}
    assert sizes == {"languages": 188, "users": 0, "posts": 0, "tags": 0, "post_tag": 0}
    assert all(df.count() == 0 for df in store.staging().values())
    load_lines(store, read_lines(spark, str(tmp_path / "in")), NOON)
    assert everything(store) == before


def test_two_waiting_loads_share_numbers(spark, tmp_path):
    store = scratch_store(spark)
    one = write_files(tmp_path / "one", a=[post(1, tags=["x"], lang="qqq")])
    two = write_files(tmp_path / "two", b=[post(2, tags=["x", "w"], lang="qqq")])
    load_staging(store, read_lines(spark, one), NOON, 1)
    load_staging(store, read_lines(spark, two), LATER, 2)
    merge_staging(store)
    main = store.main()
    assert rows(main["tags"], "name", "tag_id") == [("w", 2), ("x", 1)]
    assert rows(main["languages"], "lang_id", "short_code")[-1] == (189, "qqq")
    assert main["languages"].count() == 189


def test_bag_of_pairs_on_request(spark, tmp_path):
    store = scratch_store(spark)
    files = write_files(tmp_path / "in", a=[post(1, tags=["a", "A "])], b=[post(1, tags=["a"])])
    load_staging(store, read_lines(spark, files), NOON, 1)
    merge_staging(store, keep_duplicates=True)
    assert rows(store.main()["post_tag"], "post_tag_id", "tag_id") == [(1, 1), (2, 1), (3, 1)]


def test_file_order_does_not_change_dimensions(spark, tmp_path):
    files = {"a": [post(1, tags=["x"], lang="q1")], "b": [post(2, tags=["y", "x"], lang="q0")]}
    tables = []
    for turn, names in enumerate((("a", "b"), ("b", "a"))):
        folder = write_files(tmp_path / str(turn), **{f"f{i}": files[name] for i, name in enumerate(names)})
        store = scratch_store(spark)
        load_lines(store, read_lines(spark, folder), NOON)
        main = store.main()
        tables.append([rows(main[name], *main[name].columns) for name in ("languages", "users", "tags", "post_tag")])
    assert tables[0] == tables[1]


def test_rejects_steps_and_purge(spark, tmp_path):
    store = scratch_store(spark)
    load_lines(store, read_lines(spark, two_files(tmp_path)), NOON)
    assert rows(store.read("rejects"), "reason", "value") == [("malformed", "xxx{}")]
    assert rows(store.read("timings"), "name") == [("dictionaries",), ("load",), ("merge",), ("merge",), ("parse",), ("staging",)]
    assert store.read("profiles").count() == 2
    # What was parsed is gone after the commit, and a taken number is refused.
    assert store._inside("parsed") == []
    with pytest.raises(RuntimeError, match="stage load 1 is taken"):
        load_staging(store, read_lines(spark, str(tmp_path / "in")), LATER, 1)

    before, marks = everything(store), store.marks()
    store.reset("stage")
    store.purge()
    assert everything(store) == before and store._inside("posts_stage") == store._inside("rejects") == []
    assert store.marks() == {**marks, "stage-reset": 1}
    assert all(df.count() == 0 for df in store.staging().values())


def test_texts_are_staged_in_place(spark, tmp_path):
    lines = read_lines(spark, two_files(tmp_path))
    posts = good_posts(parse_lines(lines.withColumn("ingest_ts", F.lit(NOON).cast("timestamp"))))
    staged = stage.stage_posts(posts, measured(spark.sql("select 'en' short_code, 37L lang_id")))
    assert sorted((row.post_ext_id, row.text) for row in staged.collect()) == [(1, "first"), (1, "later copy"), (2, "other"), (3, "third")]
    assert "Exchange hashpartitioning" not in staged._jdf.queryExecution().executedPlan().toString()
