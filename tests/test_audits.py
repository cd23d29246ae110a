"""Audits load by load add up to the audits of the whole; totals come from footers."""

from posts import post
from pyspark.sql import functions as F

from postmill.operators import audit, metrics
from postmill.plans import audits
from postmill.plans.load import load_lines, scratch_store
from postmill.schema import MAIN
from postmill.sources.lines import with_position

LOADS = [
    [post(1, "all #Ants and #BEES", tags=["ants"]), post(2, "no tag here", tags=["wasp"]), post(5, "fly", tags=["fly"])],
    # Late copies bring tags of stored posts: one that its text has, one that it has not, one known.
    [post(1, "late copy", tags=["bees", "moth", "ants"]), post(3, "new #gnat #Gnat", tags=[])],
    [post(1, "again", tags=["bees"])],  # nothing new at all
    [post(7, "#one #two", tags=["one", "Two"]), post(2, "x", tags=["no"]), post(7, "#three", tags=["three"])],
]


def whole(store):
    main = store.main()
    linked = audit.linked_tags(main["post_tag"], main["tags"])
    texts = linked.join(main["posts"].select("post_id", "text"), "post_id")
    found = {
        "Q1": audit.tags_not_in_text(main["posts"], linked).count(),
        "Q2": audit.text_tags_not_linked(main["posts"], linked).count(),
        "Q3": audit.differs_from_text(texts, "name", "text").count(),
        "Q4": metrics.duplicate_count(main["posts"], ["post_ext_id"]).first()[0],
    }
    rows = {f"rows in {name}": table.count() for name, table in main.items()}
    return {**{audits.NAMES[name]: n for name, n in found.items()}, **rows}


def lines(spark, load):
    rows = [("f", line, i) for i, line in enumerate(load)]
    df = spark.createDataFrame(rows, "src_file string, value string, block bigint")
    return with_position(df.coalesce(1))


def test_audits_by_load(spark):
    store = scratch_store(spark, "audited")
    expected = {}
    for load in LOADS:
        load_lines(store, lines(spark, load), "2024-01-01 00:00:00")
        expected[store.committed("main")] = whole(store)
    # Audited late, all loads at once: each is seen as of itself.
    assert audits.audit_loads(store) == [1, 2, 3, 4, 5] and audits.audit_loads(store) == []
    got = {}
    for row in audits.running_totals(store).collect():
        got.setdefault(row.load_id, {})[row.audit] = row.total
    seeds = got.pop(1)
    assert seeds.pop("rows in languages") == 188 and set(seeds.values()) == {0}
    assert got == expected
    # The third late copy links what the first left open, so the number falls.
    q2 = [found[audits.NAMES["Q2"]] for _, found in sorted(got.items())]
    assert q2[1] == q2[0] + 1 and q2[2] == q2[1]

    store.reset_all()
    assert audits.running_totals(store).count() == 0
    load_lines(store, lines(spark, LOADS[0]), "2024-01-01 00:00:00")
    assert len(audits.audit_loads(store)) == 2
    assert {row.audit: row.total for row in audits.running_totals(store).where("load_id = 7").collect()} == whole(store)


def test_audits_share_their_shuffles(spark):
    store = scratch_store(spark, "shared")
    load_lines(store, lines(spark, LOADS[0] + LOADS[3]), "2024-01-01 00:00:00")
    main = store.main()
    linked = audits._by_post(audit.linked_tags(main["post_tag"], main["tags"]))
    texts = main["posts"].select("post_id", "text")
    rows = [
        audit.tags_not_in_text(texts, linked.hint("merge")),
        audit.differs_from_text(linked.hint("merge").join(texts, "post_id"), "name", "text"),
        audit.text_tags_not_linked(texts, linked).hint("merge"),
    ]
    # Linked tags stay where they are; only the side of the texts is shuffled.
    for found in rows:
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= 1, plan


def test_open_tags_of_odd_posts(spark):
    texts = [(1, "#a #A #b #b"), (1, "#c"), (2, None), (3, "none"), (None, "#x"), (4, "#Q")]
    posts = spark.createDataFrame(texts, "post_id int, text string")
    linked = spark.createDataFrame([(1, "B"), (1, None), (None, "x"), (3, "y"), (4, "q")], "post_id int, name string")

    def found(**options):
        return sorted((tuple(row) for row in audit.text_tags_not_linked(posts, linked, **options).collect()), key=repr)

    assert found() == [(1, "A"), (1, "a"), (1, "c"), (None, "x")]
    assert found(ignore_case=False) == [(1, "A"), (1, "a"), (1, "b"), (1, "c"), (4, "Q"), (None, "x")]


def test_totals_come_from_footers(spark):
    store = scratch_store(spark, "footers")
    assert store.totals("posts", "post_id") == (0, 0)
    load_lines(store, lines(spark, LOADS[0]), "2024-01-01 00:00:00")
    load_lines(store, lines(spark, LOADS[1]), "2024-01-01 00:00:00")
    marks = store.marks()
    for name, spec in MAIN.items():
        key = spec.key[0]
        row = store.read(name).agg(F.count(F.lit(1)), F.max(key)).first()
        assert store.totals(name, key) == tuple(row)
        plan = store.footer_totals(name, key)._jdf.queryExecution().executedPlan().toString()
        assert f"PushedAggregation: [COUNT(*), MAX({key})]" in plan
    # As of an earlier commit, and with the caller's own settings untouched.
    assert store.totals("posts", "post_id", {**marks, "main": 2}) == (3, 3)
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
