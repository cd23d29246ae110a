"""Time the headline queries and a whole load; prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local cores. Every query
runs once to warm up and once on the clock. The load reads post lines from text
files, which are written before the clock starts, and ends with all five main
tables published; the smallest tables warm it up.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from postmill.catalogue import ENTRIES
from postmill.catalogue.feed import INGEST_TS, feed_lines
from postmill.operators import audit
from postmill.operators.metrics import StepTimer
from postmill.plans.load import load_staging, merge_staging, scratch_store
from postmill.session import build_session, scratch_path
from postmill.sources.lines import read_lines, rechunk_lines

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")

QUERIES = (
    "post_latest",
    "merge_posts",
    "merge_users",
    "resolve_user_key",
    "resolve_user_key_split",
    "correlated_not_in",
    "fk_check",
    "tag_bridge",
    "encode_lang",
    "identity_keys",
    "distinct_compare",
    "dup_count",
    "pk_check",
    "written_tag_counts",
    "subscription_filter",
    "newest_first",
    "post_times",
    "ingest_good_posts",
)


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        {
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="postmill-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in QUERIES:
        run = ENTRIES[name].run
        noop(run(spark, SF_DIR))
        seconds[name] = timed(lambda: noop(run(spark, SF_DIR)))

    small = os.path.join(os.path.dirname(SF_DIR), "sf0.001")
    for folder in (small, SF_DIR):
        if not os.path.isdir(folder):
            continue
        files = scratch_path(spark, "files")
        rechunk_lines(feed_lines(spark, folder), files)
        lines = read_lines(spark, files, "*.txt")
        n_lines = lines.count()
        store, timer = scratch_store(spark), StepTimer("load")
        staging = timed(lambda: load_staging(store, lines, INGEST_TS, 1, timer=timer))
        merging = timed(lambda: merge_staging(store, timer=timer))
    seconds["load_staging"], seconds["load_merge"] = staging, merging
    table = store.main()

    def audits() -> None:
        linked = audit.linked_tags(table["post_tag"], table["tags"])
        noop(audit.tags_not_in_text(table["posts"], linked))
        noop(audit.text_tags_not_linked(table["posts"], linked))

    audits()
    seconds["load_audits"] = timed(audits)
    posts = table["posts"].count()
    took = staging + merging
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries and one load",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR).removeprefix("sf"),
                "cpus": int(CPUS),
                "load": {
                    "lines": n_lines,
                    "posts": posts,
                    "seconds": round(took, 3),
                    "lines_per_sec": round(n_lines / took),
                    "steps_ms": {row["name"]: float(row["duration_ms"]) for row in timer.timings(spark).collect()},
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
