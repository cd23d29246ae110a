"""Load files into staging and staging into the main tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.operators.joins import lookup_join, missing_from
from postmill.operators.key_index import hits, index_of, narrowed
from postmill.operators.metrics import StepTimer
from postmill.operators.parse import broken_files, good_posts, limited, parse_lines, rejects
from postmill.plans import merge, stage
from postmill.plans.store import SPECS, Store
from postmill.schema import KEY_INDEX, PROFILES, REJECTS, TIMINGS
from postmill.session import durable, scratch_path, settings_during, side_by_side

# The tables whose keys are indexed by load.
INDEXED = {"posts": "post_ext_id", "post_tag": "post_ext_id"}

# Parsing takes long for few bytes. Lines that come from a shuffle come in parts of this size,
# so that the last tasks are short and no core waits for them.
PARSED_AT_ONCE = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m"}


def parsed_once(store: Store, lines: DataFrame, ingest_ts, load_id: int, enforce_limits: bool = False) -> DataFrame:
    """Parse lines and store the result, so that five staging tables and the
    rejects read a few typed columns instead of the JSON text again."""
    moment = F.lit(ingest_ts).cast("timestamp")
    parsed = parse_lines(lines.withColumn("ingest_ts", moment))
    if enforce_limits:
        parsed = limited(parsed)
    kept = F.when(F.col("status") == "reject", F.col("value")).alias("value")
    path = f"{store.root}/parsed/load_id={load_id}"
    columns = [kept if name == "value" else name for name in parsed.columns]
    with settings_during(parsed.sparkSession, PARSED_AT_ONCE):
        parsed.select(*columns).write.mode("overwrite").parquet(path)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parsed.schema.fields)
    return store.spark.read.schema(schema).parquet(path)


def store_steps(store: Store, timer: StepTimer, marks: dict[str, int]) -> dict[str, int]:
    """Write the steps of a load; returns the marks that make them visible,
    for the load's own commit."""
    numbers = {name: marks.get(name, 0) + 1 for name in (TIMINGS.name, PROFILES.name)}
    store.write(TIMINGS.name, timer.timings(store.spark), numbers[TIMINGS.name])
    store.write(PROFILES.name, timer.profile(store.spark), numbers[PROFILES.name])
    return numbers


def load_staging(
    store: Store,
    lines: DataFrame,
    ingest_ts,
    load_id: int | None = None,
    on_error: str = "quarantine",
    timer: StepTimer | None = None,
    also: dict[str, int] | None = None,
    enforce_limits: bool = False,
    left_out: Callable[[DataFrame], dict[str, int]] | None = None,
) -> DataFrame:
    """One load: lines to five staging tables and the rejects, all or nothing (K5, K6, K9).

    ``on_error`` says what a rejected line does: ``quarantine`` sets it aside, ``file`` leaves
    out its whole file, ``fail`` ends the load. With ``enforce_limits`` a line is also
    rejected for a text that is too long for its column; otherwise the audit reports it.
    ``left_out`` is told the files left out, before the commit, and returns marks to
    raise with it.

    ``also`` are marks raised in the same commit. The steps and their row counts
    are stored with the load, unless the caller brings a ``timer`` of its own.

    One writer has the store at a time: others wait until its load is published and
    then go on from there. Without ``load_id`` the load gets the next number.

    Numbers for new languages and tags follow on from the main tables and from
    earlier loads that still wait for a merge. Returns the rejected lines.
    """
    with store.writing():
        return _load_staging(store, lines, ingest_ts, load_id, on_error, timer, also, enforce_limits, left_out)


def _load_staging(store, lines, ingest_ts, load_id, on_error, timer, also, enforce_limits, left_out) -> DataFrame:
    own_timer = timer is None
    timer = timer or StepTimer("load")
    load_id = load_id or store.committed("stage") + 1
    store.require_free("stage", load_id)
    with timer.step("parse"):
        parsed = parsed_once(store, lines, ingest_ts, load_id, enforce_limits)
        posts = good_posts(parsed, "quarantine" if on_error == "file" else on_error)
        if on_error == "file":
            broken = durable(broken_files(parsed))
            posts = lookup_join(posts, broken.select("src_file"), "src_file", ["pos"], "left_anti")
    with timer.step("dictionaries"):
        marks = store.marks()
        languages = _known(store, "languages", "lang_stage", "short_code", "lang_id", marks)
        tags = _known(store, "tags", "tags_stage", "name", "tag_id", marks)
        lang_dict, tag_dict, often = side_by_side(
            store.spark,
            lambda: stage.language_dictionary(posts, languages),
            lambda: stage.tag_dictionary(posts, tags),
            lambda: stage.often_repeated(posts),
        )
    with timer.step("staging"):

        def posts_and_pairs() -> None:
            staged = store.write("posts_stage", stage.stage_posts(posts, lang_dict, often), load_id, timer)
            store.write("post_tag_stage", stage.stage_post_tags(staged, tag_dict), load_id, timer)

        *_, set_aside = side_by_side(
            store.spark,
            posts_and_pairs,
            lambda: store.write("users_stage", stage.stage_users(posts), load_id, timer),
            lambda: store.write("tags_stage", stage.stage_tags(posts, tag_dict), load_id, timer),
            lambda: store.write("lang_stage", stage.stage_languages(posts, lang_dict), load_id, timer),
            lambda: store.write(REJECTS.name, rejects(parsed), load_id, timer),
        )
    steps = store_steps(store, timer, marks) if own_timer else {}
    store.require_free("stage", load_id)
    noted = left_out(broken) if left_out and on_error == "file" else {}
    store.publish({"stage": load_id, **steps, **(also or {}), **noted})
    store.remove(f"parsed/load_id={load_id}")
    return set_aside


def _known(store: Store, main: str, staged: str, key: str, id_col: str, marks: dict[str, int]) -> DataFrame:
    numbered = store.read(main, marks=marks).select(key, id_col)
    waiting = store.read(staged, marks.get("merged", 0), marks).select(key, id_col).distinct()
    return numbered.unionByName(missing_from(waiting, numbered, key))


def stored_near(store: Store, name: str, keys: DataFrame, marks: dict[str, int]) -> DataFrame:
    """The part of an indexed table that can hold the given keys. Loads that
    cannot hold any are not read."""
    key = INDEXED[name]
    index = store.read_by_load(KEY_INDEX.name, marks=marks).where(F.col("t") == name)
    indexed = {row["load_id"] for row in index.select("load_id").distinct().collect()}  # one number per load
    unindexed = [load for load in store.loads_after_reset(name, marks) if load not in indexed]
    found = hits(index, keys, key)
    return narrowed(store.read_by_load(name, marks=marks), found, unindexed, key).drop("load_id")


def merge_staging(store: Store, keep_duplicates: bool = False, timer: StepTimer | None = None) -> int:
    """T4, K7, K9: everything staged since the last merge to the main tables,
    all or nothing.

    A second run finds nothing new. Of several loaders that call this at once, one
    merges what all have staged and the others find nothing left. Returns the number
    of the load.
    """
    with store.writing():
        return _merge_staging(store, keep_duplicates, timer)


def _merge_staging(store: Store, keep_duplicates: bool, timer: StepTimer | None) -> int:
    own_timer = timer is None
    timer = timer or StepTimer("merge")
    marks = store.marks()
    load_id = marks.get("main", 0) + 1
    staged, main = store.staging(marks, waiting_only=True), store.main(marks)

    def base(name: str) -> int:
        return store.totals(name, SPECS[name].key[0], marks)[1]

    def users_posts_and_pairs() -> None:
        fresh_users = merge.new_users(staged["users_stage"], main["users"], base("users"))
        users = store.write("users", fresh_users, load_id, timer)
        stored = stored_near(store, "posts", staged["posts_stage"], marks)
        everyone = main["users"].unionByName(users)
        fresh = merge.new_posts(staged["posts_stage"], everyone, stored, base("posts"))
        posts = store.write("posts", fresh, load_id, timer)
        pairs = stored_near(store, "post_tag", staged["post_tag_stage"], marks)
        linked = merge.new_pairs(
            staged["post_tag_stage"], stored.unionByName(posts), pairs, base("post_tag"), keep_duplicates
        )
        linked = store.write("post_tag", linked, load_id, timer)
        marked = [index_of(rows, INDEXED[name], name) for name, rows in {"posts": posts, "post_tag": linked}.items()]
        store.write(KEY_INDEX.name, marked[0].unionByName(marked[1]), load_id)

    with timer.step("merge"):
        side_by_side(
            store.spark,
            users_posts_and_pairs,
            lambda: store.write("languages", merge.new_languages(staged["lang_stage"], main["languages"]), load_id, timer),
            lambda: store.write("tags", merge.new_tags(staged["tags_stage"], main["tags"]), load_id, timer),
        )
    steps = store_steps(store, timer, marks) if own_timer else {}
    store.require_free("main", load_id)
    store.publish({"main": load_id, "merged": marks.get("stage", 0), **steps})
    return load_id


def load_lines(store: Store, lines: DataFrame, ingest_ts, on_error: str = "quarantine", **options) -> DataFrame:
    """Stage and merge one set of lines; returns the rejected lines."""
    set_aside = load_staging(store, lines, ingest_ts, None, on_error, **options)
    merge_staging(store)
    return set_aside


def scratch_store(spark, label: str = "store") -> Store:
    """An empty store with seeds under the shared folder."""
    store = Store(spark, scratch_path(spark, label))
    store.reset_all()
    return store
