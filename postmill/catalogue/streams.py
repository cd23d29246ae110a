"""Streams over lines written from ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.catalogue.entry import Entry
from postmill.catalogue.feed import INGEST_TS
from postmill.operators.metrics import stored_rates
from postmill.operators.parse import good_posts, parse_lines
from postmill.plans.ledger import load_files
from postmill.plans.load import scratch_store
from postmill.session import scratch_path
from postmill.sources.lines import rechunk_lines, read_lines, stream_lines
from postmill.sources.tables import read_table
from postmill.streaming.ingest import FILES_PER_TRIGGER, drain, load_stream
from postmill.streaming.unique import write_unique


def _event_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One line per event; clicks are sent twice and signups are blank lines."""
    events = read_table(spark, folder, "events")
    doc = F.to_json(
        F.struct(
            F.date_format("ts", "EEE MMM dd HH:mm:ss '+0000' yyyy").alias("created_at"),
            F.col("event_id").alias("id"),
            F.col("event_id").cast("string").alias("id_str"),
            F.concat_ws(" ", F.col("event_type"), F.col("props")).alias("text"),
            F.lit("en").alias("lang"),
            F.struct(F.col("user_id").alias("id"), F.concat(F.lit("User "), "user_id").alias("name")).alias("user"),
            F.struct(F.array(F.struct(F.col("event_type").alias("text"))).alias("hashtags")).alias("entities"),
        )
    )
    copies = F.when(F.col("event_type") == "click", 2).otherwise(1)
    line = F.when(F.col("event_type") == "signup", "").otherwise(doc)
    lines = events.select(line.alias("value"), copies.alias("_copies"))
    return lines.select("value", F.explode(F.sequence(F.lit(1), "_copies"))).select("value")


def _landing(spark: SparkSession, folder: str) -> str:
    path = scratch_path(spark, "landing")
    rechunk_lines(_event_lines(spark, folder), path)
    return path


def stream_landed_lines(spark, folder):
    landed = scratch_path(spark, "landed")
    lines = stream_lines(spark, _landing(spark, folder), "*.txt", FILES_PER_TRIGGER)
    drain(lines, landed, scratch_path(spark, "landed-log"))
    parsed = good_posts(parse_lines(read_lines(spark, landed, "*.txt")))
    return parsed.groupBy("post_ext_id").agg(F.count(F.lit(1)).alias("n"))


def stream_loaded_posts(spark, folder):
    store = scratch_store(spark, "stream")
    lines = stream_lines(spark, _landing(spark, folder), "*.txt", FILES_PER_TRIGGER)
    load_stream(store, lines, lambda epoch: INGEST_TS, scratch_path(spark, "stream-log"))
    main = store.main()
    users = main["users"].select("user_id", F.col("name").alias("user_name"))
    return main["posts"].join(users, "user_id").select("post_id", "post_ext_id", "user_name", "text", "lang_id")


def stream_two_sources(spark, folder):
    """Two landing folders, each with a checkpoint of its own, into one store, in
    several batches; then the second folder once more, its checkpoint lost."""
    store, halves = scratch_store(spark, "two"), []
    for part in (0, 1):
        path = scratch_path(spark, "half")
        lines = _event_lines(spark, folder).where(F.pmod(F.crc32(F.col("value").cast("binary")), F.lit(2)) == part)
        lines.repartition(3).write.text(path)
        halves.append(path)
    for path in (*halves, halves[1]):
        lines = stream_lines(spark, path, "*.txt", 1)
        load_stream(store, lines, lambda epoch: INGEST_TS, scratch_path(spark, "two-log"))
    return store.main()["posts"].groupBy("post_ext_id").agg(F.count(F.lit(1)).alias("n"))


def stream_unique(spark, folder):
    """Many files, posts in no order and some twice, the stream stopped half way; then
    every post once more. Each is written once."""
    path, log, out = (scratch_path(spark, f"unique-{part}") for part in ("files", "log", "out"))
    lines = _event_lines(spark, folder).where("value <> ''")
    half = F.pmod(F.xxhash64("value", F.lit(1)), F.lit(2))
    post = F.get_json_object("value", "$.id").cast("bigint").alias("post_ext_id")
    for some in (lines.where(half == 0), lines):
        some.repartition(8, F.xxhash64("value", F.lit(2))).write.mode("append").text(path)
        posts = stream_lines(spark, path, "*.txt", 3).select(post)
        write_unique(posts, ["post_ext_id"], out, log).awaitTermination()
    return spark.read.schema("post_ext_id bigint").parquet(out).groupBy("post_ext_id").agg(F.count(F.lit(1)).alias("n"))


FILES = 8


def _event_files(spark: SparkSession, folder: str, lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Lines as one file for each value of their column ``file``, in a folder of that name."""
    lines.repartition("file").write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("file").text(path)


def _numbered_event_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Event lines with the number of their file; blank lines all go to the first."""
    event = F.get_json_object("value", "$.id_str").cast("bigint")
    return _event_lines(spark, folder).select("value", F.coalesce(event % FILES, F.lit(0)).cast("int").alias("file"))


def file_retries(spark, folder):
    """S3, T5: eight files, one with a broken line. Seven are loaded, the broken one is tried
    again and set aside; mended, it is taken once more. Ledger and posts of each file."""
    store, path = scratch_store(spark, "queue"), scratch_path(spark, "queue-files")
    lines = _numbered_event_lines(spark, folder)
    broken = spark.range(1).select(F.lit("{not json").alias("value"), F.lit(5).alias("file"))
    _event_files(spark, folder, lines.unionByName(broken), path)
    load_files(store, path, lambda turn: INGEST_TS, "*.txt", tries=2, files_per_load=3)
    _event_files(spark, folder, lines.where("file = 5"), path, "overwrite")
    load_files(store, path, lambda turn: INGEST_TS, "*.txt", tries=2, files_per_load=3)
    number = F.regexp_extract("src_file", r"/file=(\d+)/", 1).cast("int").alias("file")
    ledger = store.read("ledger").select(number, "attempt", "outcome", "reason")
    posts = store.read("posts").groupBy((F.col("post_ext_id") % FILES).cast("int").alias("file")).agg(F.count(F.lit(1)).alias("posts"))
    return ledger.join(posts, "file", "left")


def stream_batches(spark, folder):
    """The lines of each batch of a stream, as its listener stored them, and whether
    the stored rate is theirs over the seconds it took."""
    store, path = scratch_store(spark, "batches"), scratch_path(spark, "batch-files")
    _event_files(spark, folder, _numbered_event_lines(spark, folder), path)
    load_stream(store, stream_lines(spark, f"{path}/*", "*.txt", 1), lambda epoch: INGEST_TS, scratch_path(spark, "batch-log"))
    rates = stored_rates(store.read("timings")).where("batch is not null")
    seconds = F.greatest(F.floor(F.col("duration_ms") / 1000), F.lit(1))
    return rates.select(F.col("rows").alias("lines"), (F.col("rate") == F.floor(F.col("rows") / seconds)).alias("rate_holds"))


ENTRIES = {
    "file_retries": Entry(
        file_retries,
        "with p as (select event_id % 8 as file, count(*) as posts from events where event_type <> 'signup' group by all),"
        " l as (select file::int as file, 1 as attempt, 'loaded' as outcome, null::varchar as reason from range(8) t(file)"
        " where file in (select file from p) or file = 0"
        " union all select 5, 1, 'failed', 'malformed' union all select 5, 2, 'set aside', 'malformed')"
        " select l.*, p.posts from l left join p using (file)",
    ),
    "stream_batches": Entry(
        stream_batches,
        "select sum(case when event_type = 'click' then 2 else 1 end)::bigint as lines, true as rate_holds"
        " from events group by case when event_type = 'signup' then 0 else event_id % 8 end",
    ),
    "stream_landed_lines": Entry(
        stream_landed_lines,
        "select event_id post_ext_id, case when event_type = 'click' then 2::bigint else 1::bigint end n"
        " from events where event_type <> 'signup'",
    ),
    "stream_loaded_posts": Entry(
        stream_loaded_posts,
        "select row_number() over (order by event_id) post_id, event_id post_ext_id, concat('User ', user_id) user_name,"
        " concat(event_type, ' ', props) as text, 37::bigint lang_id from events where event_type <> 'signup'",
    ),
    "stream_unique": Entry(stream_unique, "select event_id post_ext_id, 1::bigint n from events where event_type <> 'signup'"),
    "stream_two_sources": Entry(
        stream_two_sources,
        "select event_id post_ext_id, 1::bigint n from events where event_type <> 'signup'",
    ),
}
