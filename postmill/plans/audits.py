"""Audits load by load (Q1-Q4): what a load changes in the audits of the whole store.

An audit of all stored posts reads all of them each time. Here each load is audited once,
over its own rows and the older posts its pairs belong to, and the findings are stored as
signed numbers. Their sums are the audits of the whole, as of the last load audited.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postmill.functions.text import extract_tags
from postmill.operators import audit
from postmill.operators.joins import missing_from
from postmill.plans.load import stored_near
from postmill.plans.store import Store
from postmill.schema import AUDITS, MAIN
from postmill.session import durable, settings_during, side_by_side

#: Audit -> what its number counts; ``rows in <table>`` come beside them.
NAMES = {
    "Q1": "linked tags not in the text",
    "Q2": "tags in the text not linked",
    "Q3": "linked tags that are not the text",
    "Q4": "posts beyond the first of their key",
}


# With a plan that stays as it is, a checkpoint keeps how its rows are dealt out and sorted.
_FIXED = {"spark.sql.adaptive.enabled": "false"}


def _by_post(linked: DataFrame) -> DataFrame:
    """Linked tags, stored once by post: joins by post neither shuffle nor sort them again."""
    with settings_during(linked.sparkSession, _FIXED):
        return durable(linked.sortWithinPartitions("post_id"))


def audits_of(store: Store, load_id: int, marks: dict[str, int] | None = None) -> dict[str, int]:
    """By how much a load raises each audit of the store.

    Q1 and Q3 count pairs, and every pair is of one load. Q2 counts tags of the load's own
    posts that no pair of this load links, less those of older posts that a pair of this
    load is the first to link. Q4 counts the load's posts whose key the load or an earlier
    one has already. Tags are compared regardless of case.
    """
    marks = store.marks() if marks is None else marks
    as_of = {**marks, "main": load_id}
    earlier = {**marks, "main": load_id - 1}

    def own(name: str) -> DataFrame:
        return store.read(name, load_id - 1, as_of)

    posts, pairs = own("posts"), own("post_tag")
    first = posts.agg(F.min("post_id")).first()[0]
    is_own = F.lit(False) if first is None else F.col("post_id") >= first
    old_pairs = durable(pairs.where(~is_own))
    near = stored_near(store, "posts", old_pairs, earlier).select("post_id", "text")
    old_posts = durable(near.join(old_pairs.select("post_id").distinct(), "post_id", "left_semi"))
    tags = store.read("tags", marks=as_of)
    linked = _by_post(audit.linked_tags(pairs, tags))
    texts = posts.select("post_id", "text").unionByName(old_posts)

    def q1_and_q3() -> list[int]:
        # One action, in which texts are shuffled once.
        rows = audit.tags_not_in_text(texts, linked), audit.differs_from_text(linked.join(texts, "post_id"), "name", "text")
        counts = [found.agg(F.count(F.lit(1)).alias("n")).select(F.lit(at).alias("at"), "n") for at, found in enumerate(rows)]
        return [row["n"] for row in sorted(counts[0].unionByName(counts[1]).collect())]

    def q2() -> int:
        missing = audit.text_tags_not_linked(posts, linked.where(is_own)).count()
        known = stored_near(store, "post_tag", old_pairs, earlier)
        fresh = audit.linked_tags(missing_from(old_pairs.select("post_id", "tag_id").distinct(), known, "post_id", "tag_id"), tags)
        written = old_posts.select("post_id", F.explode(F.array_distinct(extract_tags(F.col("text"), False))).alias("tag"))
        names = fresh.select("post_id", F.lower("name").alias("name"))
        found = written.withColumn("name", F.lower("tag")).join(names, ["post_id", "name"], "left_semi")
        return missing - found.count()

    def q4() -> int:
        known = stored_near(store, "posts", posts, earlier)
        return rows["posts"] - missing_from(posts.select("post_ext_id").distinct(), known, "post_ext_id").count()

    rows = {}
    for name, spec in MAIN.items():
        now, before = (store.totals(name, spec.key[0], at)[0] for at in (as_of, earlier))
        rows[name] = now - before
    (n1, n3), n2, n4 = side_by_side(store.spark, q1_and_q3, q2, q4)
    found = dict(zip(NAMES.values(), (n1, n2, n3, n4)))
    return {**found, **{f"rows in {name}": n for name, n in rows.items()}}


def audit_loads(store: Store, loads: Iterable[int] | None = None) -> list[int]:
    """Audit the loads that have not been audited yet, each with a commit of its own, so that
    a stop half way costs one load. Returns their numbers."""
    done = []
    with store.writing():
        marks = store.marks()
        waiting = store.loads_after_reset("posts", marks)
        audited = max(marks.get(AUDITS.name, 0), waiting.start - 1)
        for load_id in (load for load in (waiting if loads is None else loads) if load > audited):
            if load_id != audited + 1:
                raise ValueError(f"load {audited + 1} comes before {load_id}")
            found = audits_of(store, load_id, marks)
            rows = F.array(*(F.struct(F.lit(name).alias("audit"), F.lit(n).cast("bigint").alias("n")) for name, n in found.items()))
            store.write(AUDITS.name, store.spark.range(1, numPartitions=1).select(F.inline(rows)), load_id)
            store.publish({AUDITS.name: load_id})
            audited = load_id
            done.append(load_id)
    return done


def running_totals(store: Store) -> DataFrame:
    """``load_id, audit, n, total``: what each load added, and the audit of the whole as of it.
    A few rows per load; posts are not read."""
    so_far = Window.partitionBy("audit").orderBy("load_id")
    return store.read_by_load(AUDITS.name).select("load_id", "audit", "n", F.sum("n").over(so_far).alias("total"))
