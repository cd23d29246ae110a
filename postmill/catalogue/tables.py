"""Each relational operator on the given tables.

The tables stand in for stored posts: ``events`` and ``lineitem`` are staged
rows (``lineitem`` repeats its keys), ``customer`` and ``orders`` are main
tables, the two words of ``part.p_name`` are tags, ``documents`` holds texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.catalogue.entry import Entry
from postmill.functions import scalar, text
from postmill.operators import audit, joins, keys, metrics, pick
from postmill.operators.parse import parse_json
from postmill.operators.subscription import subscribed
from postmill.operators.subscription_index import matching_subscriptions
from postmill.schema import TableSpec
from postmill.sources.tables import generated_users, read_table, spread


def _table(name: str, *columns: str):
    def read(spark: SparkSession, folder: str) -> DataFrame:
        df = read_table(spark, folder, name)
        return df.select(*columns) if columns else df

    return read


def _part_tags(spark: SparkSession, folder: str) -> DataFrame:
    parts = read_table(spark, folder, "part")
    words = F.transform(F.split("p_name", " "), text.normalise_tag)
    return parts.select("p_partkey", F.explode(words).alias("tag")).distinct()


_PART_TAGS = (
    "(select distinct p_partkey, lower(w) as tag from"
    " (select p_partkey, unnest(string_split(p_name, ' ')) w from part))"
)

# ------------------------------------------------- projections and filters


def parse_json_field(spark, folder):
    parsed = parse_json(F.col("props"), "k int, _corrupt string")
    return read_table(spark, folder, "events").select("event_id", parsed["k"].alias("k"))


def project_filter_posts(spark, folder):
    events = read_table(spark, folder, "events").where(~text.is_blank(F.col("props")))
    return events.select("event_id", "user_id", "event_type", "ts")


def subscription_filter(spark, folder):
    docs = spread(read_table(spark, folder, "documents"))
    wanted = subscribed(
        text=F.col("text"),
        user_id=F.col("source"),
        phrases=["quality", "tion des"],
        users=["src0", "src3"],
    )
    return docs.where(wanted).select("doc_id")


def subscription_narrowed(spark, folder):
    docs = read_table(spark, folder, "documents")
    wanted = subscribed(
        text=F.col("text"), lang=F.col("lang"), phrases=["the", "la"], only_lang="en"
    )
    return docs.where(wanted).select("doc_id", "lang")


def subscription_box(spark, folder):
    # Price and balance stand in for longitude and latitude.
    orders = read_table(spark, folder, "orders").join(
        read_table(spark, folder, "customer").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey"
    )
    wanted = subscribed(
        text=F.col("o_orderpriority"),
        lon=F.col("o_totalprice"),
        lat=F.col("c_acctbal"),
        box=(100000.0, 0.0, 200000.0, 5000.0),
        phrases=["urgent"],
    )
    return orders.where(wanted).select("o_orderkey")


def subscriptions_matched(spark, folder):
    """One subscription per part (words, a followed user, a box, a level), the events as posts."""
    events = spread(read_table(spark, folder, "events"))
    posts = events.select(
        F.col("event_id").alias("post_id"),
        F.concat_ws(" ", "event_type", "props").alias("text"),
        "user_id",
        F.col("value").alias("lon"),
        F.col("user_id").cast("double").alias("lat"),
        F.col("event_type").alias("filter_level"),
    )
    part, size = F.col("p_partkey"), F.col("p_size")
    boxed = part % 7 == 0
    subscriptions = read_table(spark, folder, "part").select(
        part.alias("subscription_id"),
        F.array(
            F.when(part % 10 == 0, F.concat(F.lit("VIEW "), size)),
            F.when(part % 10 == 1, F.concat_ws(" ", size + 40, F.lit("click"), F.lit('"k"'))),
            F.lit(" "),
        ).alias("phrases"),
        F.when(part % 5 == 0, F.array(part, part + 1)).alias("users"),
        F.when(boxed, size).alias("west"),
        F.when(boxed, size + 0.5).alias("east"),
        F.when(boxed, 0).alias("south"),
        F.when(boxed, 20).alias("north"),
        F.when(part % 4 == 1, "click").alias("filter_level"),
    )
    return matching_subscriptions(posts, subscriptions)


_SUBSCRIBED = (
    "with e as (select *, lower(concat_ws(' ', event_type, props)) as t from events)"
    " select p_partkey as subscription_id, event_id as post_id from part, e where ("
    " (p_partkey % 10 = 0 and contains(t, 'view') and contains(t, p_size::varchar))"
    " or (p_partkey % 10 = 1 and contains(t, 'click') and contains(t, '\"k\"') and contains(t, (p_size + 40)::varchar))"
    " or (p_partkey % 5 = 0 and user_id in (p_partkey, p_partkey + 1))"
    " or (p_partkey % 7 = 0 and value between p_size and p_size + 0.5 and user_id between 0 and 20))"
    " and (p_partkey % 4 <> 1 or event_type = 'click')"
)


def row_preview(spark, folder):
    return read_table(spark, folder, "documents").select("doc_id", text.preview(F.col("text")).alias("preview"))


def filter_equal_sorted(spark, folder):
    events = _table("events", "event_id", "event_type", "value")(spark, folder)
    return metrics.matching(events, "event_type", "error", [F.col("value"), F.col("event_id")]).select("event_id", "value")


# ---------------------------------------------------------- one row per key


def first_wins_user(spark, folder):
    events = _table("events", "user_id", "event_id", "event_type")(spark, folder)
    return pick.first_per_key(events, ["user_id"], [F.col("event_id")])


def user_rank_one(spark, folder):
    names = _table("customer", "c_nationkey", "c_name")(spark, folder).toDF("user_ext_id", "name")
    return pick.one_name_per_user(names).toDF("c_nationkey", "c_name")


def _latest_lines(spark, folder):
    lines = spread(read_table(spark, folder, "lineitem"))
    order = [F.desc("l_shipdate"), "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    return pick.first_per_key(lines, ["l_orderkey", "l_linenumber"], order)


_LATEST_LINES = (
    "(select * from (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc,"
    " l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax) rn from lineitem) where rn = 1)"
)


def post_latest(spark, folder):
    return _latest_lines(spark, folder).select("l_orderkey", "l_linenumber", "l_shipdate")


# -------------------------------------------------------------------- keys


def lang_dictionary(spark, folder):
    seeds = spark.sql("select inline(array(struct('en' as code, 1L as id), struct('fr' as code, 2L as id)))")
    codes = _table("documents", "lang")(spark, folder).toDF("code")
    return keys.grown_dictionary(codes, seeds, "code", "id").rows


def encode_lang(spark, folder):
    docs = _table("documents", "doc_id", "lang")(spark, folder)
    codes = keys.measured(keys.dense_ids(docs.select("lang").distinct(), "lang", "lang_id"))
    return keys.encode(docs, codes, "lang", ["doc_id"]).select("doc_id", "lang_id")


def _tag_dictionary(spark, folder):
    tags = _part_tags(spark, folder).select("tag").distinct()
    return keys.measured(keys.dense_ids(tags, "tag", "tag_id"))


def tag_dictionary(spark, folder):
    return _tag_dictionary(spark, folder).rows


def tag_bridge(spark, folder):
    pairs = _part_tags(spark, folder)
    return keys.encode(pairs, _tag_dictionary(spark, folder), "tag", ["p_partkey", "tag"]).select("p_partkey", "tag_id")


_TAG_IDS = f"(select tag, row_number() over (order by tag) tag_id from (select distinct tag from {_PART_TAGS}))"


def identity_keys(spark, folder):
    return keys.dense_ids(_table("customer", "c_custkey")(spark, folder), "c_custkey", "user_id")


def max_key(spark, folder):
    events = _table("events", "event_id")(spark, folder)
    return events.agg(scalar.or_zero(F.max("event_id")).alias("max_id"))


# ------------------------------------------------------------------- joins


def resolve_user_key(spark, folder):
    events = _table("events", "event_id", "user_id")(spark, folder)
    users = _table("customer", "c_custkey", "c_name")(spark, folder).withColumnRenamed("c_custkey", "user_id")
    return joins.lookup_join(events, users, "user_id", ["event_id"]).select("event_id", "c_name")


def resolve_user_key_split(spark, folder):
    # The same join along the path taken when the users are too many to send around.
    events = _table("events", "event_id", "user_id")(spark, folder)
    users = _table("customer", "c_custkey", "c_name")(spark, folder).withColumnRenamed("c_custkey", "user_id")
    return joins.salted_join(events, users, "user_id", ["event_id"]).select("event_id", "c_name")


def anti_new_lang(spark, folder):
    known = spark.sql("select inline(array(struct('en' as lang), struct('fr' as lang)))")
    langs = _table("documents", "lang")(spark, folder).distinct()
    return joins.missing_from(langs, known, "lang").select("lang", F.lit("").alias("name"))


def anti_new_users(spark, folder):
    urgent = read_table(spark, folder, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    users = _table("customer", "c_custkey")(spark, folder)
    return joins.missing_from(users, urgent.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


def merge_users(spark, folder):
    staged = _table("events", "user_id", "event_type")(spark, folder).toDF("user_ext_id", "name")
    stored = read_table(spark, folder, "customer").where(F.col("c_mktsegment") == "BUILDING")
    stored = stored.select(F.col("c_custkey").alias("user_ext_id"))
    fresh = joins.missing_from(pick.one_name_per_user(staged), stored, "user_ext_id")
    return fresh.toDF("user_id", "event_type")


def merge_posts(spark, folder):
    orders = read_table(spark, folder, "orders")
    stored = orders.where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("l_orderkey"))
    fresh = joins.missing_from(_latest_lines(spark, folder), stored, "l_orderkey")
    owners = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    # The anti-join leaves its rows partitioned by order, which this join uses again.
    linked = fresh.join(owners, "l_orderkey")
    return linked.select("l_orderkey", "l_linenumber", "l_shipdate", "o_custkey")


def anti_new_tags(spark, folder):
    known = spark.sql("select inline(array(struct('red' as tag), struct('blue' as tag)))")
    return joins.missing_from(_part_tags(spark, folder).select("tag").distinct(), known, "tag")


def merge_bridge(spark, folder):
    stored = read_table(spark, folder, "part").where(F.col("p_size") > 25).select("p_partkey")
    return _part_tags(spark, folder).join(stored, "p_partkey").select("p_partkey", "tag").distinct()


def correlated_not_in(spark, folder):
    users = _table("customer", "c_custkey")(spark, folder)
    orders = _table("orders", "o_orderkey", "o_custkey", "o_orderstatus")(spark, folder)
    lines = _table("lineitem", "l_orderkey", "l_linenumber", "l_linestatus")(spark, folder)
    joined = orders.join(users, F.col("o_custkey") == F.col("c_custkey")).join(
        lines, F.col("l_orderkey") == F.col("o_orderkey")
    )
    return audit.differs_from_text(joined, "l_linestatus", "o_orderstatus").select("c_custkey", "o_orderkey", "l_linenumber")


def fk_check(spark, folder):
    solvent = read_table(spark, folder, "customer").where(F.col("c_acctbal") >= 0)
    events = _table("events", "event_id", "user_id")(spark, folder)
    return audit.orphans(events, solvent, "user_id", "c_custkey").select("event_id")


# ------------------------------------------------ sets, counts and sorting


def union_batches(spark, folder):
    events = _table("events", "event_id", "user_id", "event_type")(spark, folder)
    one = events.where(F.col("event_type").isin("click", "view"))
    two = events.where(F.col("event_type").isin("view", "signup"))
    return one.unionByName(two).select("event_id", "user_id")


def table_counts(spark, folder):
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")
    return metrics.table_counts({name: read_table(spark, folder, name) for name in names})


_TABLE_COUNTS = " union all ".join(
    f"select '{name}' as t, count(*) as n from {name}"
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")
)


def max_by_group(spark, folder):
    return metrics.max_by_group(_table("events", "event_type", "value")(spark, folder), "event_type", "value", "max_value")


def newest_first(spark, folder):
    return metrics.newest_first(_table("events", "event_id", "ts")(spark, folder), "ts", "event_id")


def distinct_rows(spark, folder):
    return _table("events", "user_id", "event_type")(spark, folder).distinct()


def distinct_compare(spark, folder):
    events = _table("events", "user_id", "event_type")(spark, folder)
    return metrics.distinct_compare(events, "user_id", "event_type")


def dup_count(spark, folder):
    return metrics.duplicate_count(_table("lineitem", "l_orderkey", "l_linenumber")(spark, folder), ["l_orderkey", "l_linenumber"])


def throughput(spark, folder):
    events = _table("events", "event_type", "value")(spark, folder)
    return metrics.throughput(events, "event_type", (F.col("value") * 100).cast("decimal(20,0)").cast("bigint"))


def tags_per_post(spark, folder):
    linked = _part_tags(spark, folder).withColumnRenamed("tag", "name")
    return audit.tags_per_post(linked, "p_partkey").select("p_partkey", text.joined(F.col("tags")).alias("tags"))


# ------------------------------------------------------------------ audits


def _shifted_links(spark, folder):
    # Tags of each part, linked to the part after it.
    return _part_tags(spark, folder).select((F.col("p_partkey") + 1).alias("p_partkey"), F.col("tag").alias("name"))


def tag_not_in_text(spark, folder):
    posts = _table("part", "p_partkey", F.col("p_name").alias("text"))(spark, folder)
    return audit.tags_not_in_text(posts, _shifted_links(spark, folder), "p_partkey")


def text_tag_not_linked(spark, folder):
    marked = F.concat(F.lit("#"), F.replace(F.col("p_name"), F.lit(" "), F.lit("! #")), F.lit(" # #'x"))
    posts = _table("part", "p_partkey", marked.alias("text"))(spark, folder)
    return audit.text_tags_not_linked(posts, _shifted_links(spark, folder), "p_partkey")


def written_tag_counts(spark, folder):
    # Every word after a blank becomes a tag of its document.
    docs = spread(_table("documents", "text")(spark, folder))
    tags = text.extract_tags(F.replace(F.col("text"), F.lit(" "), F.lit(" #")))
    return docs.select(F.explode(tags).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


def pk_check(spark, folder):
    lines = _table("lineitem", "l_orderkey", "l_linenumber")(spark, folder)
    return audit.repeated_keys(lines, "l_orderkey", "l_linenumber")


_DOCUMENTS = TableSpec(
    "documents",
    {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"},
    key=("doc_id",),
    required=("doc_id", "text"),
    max_length={"text": 1024, "lang": 50},
)


def null_and_length_check(spark, folder):
    return audit.rule_breaks(read_table(spark, folder, "documents"), _DOCUMENTS)


_RULES = (
    "select 'documents' t, 'null' rule, 'doc_id' as \"on\", count(*) filter (where doc_id is null) n from documents"
    " union all select 'documents', 'null', 'text', count(*) filter (where text is null) from documents"
    " union all select 'documents', 'too long', 'text', count(*) filter (where length(text) > 1024) from documents"
    " union all select 'documents', 'too long', 'lang', count(*) filter (where length(lang) > 50) from documents"
)


def constraint_report(spark, folder):
    specs = {
        "documents": _DOCUMENTS,
        "lineitem": TableSpec("lineitem", {}, key=("l_orderkey", "l_linenumber"), required=("l_orderkey",)),
        "labels": TableSpec("labels", {}, references={"doc_id": ("documents", "doc_id")}, required=("quality",)),
    }
    return audit.table_report({name: read_table(spark, folder, name) for name in specs}, specs)


_REPORT = (
    "select * from (select 'documents' t, 'too long' rule, 'text' as \"on\","
    " count(*) filter (where length(text) > 1024) n from documents"
    " union all select 'lineitem', 'repeated', 'l_orderkey,l_linenumber', count(*) from"
    " (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)"
    " union all select 'labels', 'orphan', 'doc_id', count(*) from labels l"
    " where not exists (select 1 from documents d where d.doc_id = l.doc_id)) where n > 0"
)

# --------------------------------------------------------------- functions


def time_functions(spark, folder):
    events = read_table(spark, folder, "events")
    return events.select(
        "event_id",
        scalar.clock_text(F.col("ts")).alias("clock"),
        scalar.epoch_seconds(F.col("ts")).alias("epoch_s"),
        scalar.epoch_seconds(scalar.epoch_millis_time((scalar.epoch_seconds(F.col("ts")) * 1000).cast("string"))).alias(
            "millis_s"
        ),
    )


def post_times(spark, folder):
    lines = spread(read_table(spark, folder, "lineitem"))
    right = F.date_format("l_shipdate", "EEE MMM dd HH:mm:ss")
    day = F.when(F.col("l_linestatus") == "F", right).otherwise(F.concat(F.lit("Xxx"), F.substring(right, 4, 99)))
    zone = F.when(F.col("l_returnflag") == "R", " +0130 ").otherwise(" +0000 ")
    written = F.concat(day, zone, F.date_format("l_shipdate", "yyyy"))
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", scalar.epoch_seconds(scalar.post_time(written)).alias("epoch_s")
    )


def text_functions(spark, folder):
    users = read_table(spark, folder, "customer")
    name = F.col("c_name")
    return users.select(
        "c_custkey",
        text.dictionary_key("User", F.lower(name)).alias("k"),
        text.form_text(F.concat(F.lit("&track="), name)).alias("form"),
        text.percent_encode(F.concat_ws(" ", name, "c_mktsegment")).alias("encoded"),
        text.joined([name, F.col("c_mktsegment")]).alias("listed"),
        text.utf8_text(text.utf8_bytes(name)).alias("same"),
        text.normalise_tag(F.concat(F.lit("  "), name, F.lit("\t"))).alias("tag"),
        scalar.as_long(F.element_at(F.split(name, "#"), -1)).alias("n"),
    )


def generated_users_(spark, folder):
    return generated_users(_table("customer", "c_custkey")(spark, folder), "c_custkey")


def bulk_load_users(spark, folder):
    # Generated users, staged as a bag twice, against the users stored already.
    batch = generated_users(_table("customer", "c_custkey")(spark, folder), "c_custkey")
    stored = read_table(spark, folder, "customer").where(F.col("c_mktsegment") == "BUILDING")
    fresh = joins.missing_from(
        pick.one_name_per_user(batch.unionAll(batch)), stored.select(F.col("c_custkey").alias("user_ext_id")), "user_ext_id"
    )
    return keys.dense_ids(fresh, "user_ext_id", "user_id")


ENTRIES = {
    "parse_json_field": Entry(
        parse_json_field, "select event_id, cast(json_extract_string(props, '$.k') as int) k from events"
    ),
    "project_filter_posts": Entry(
        project_filter_posts, "select event_id, user_id, event_type, ts from events where props is not null and props <> ''"
    ),
    "subscription_filter": Entry(
        subscription_filter,
        "select doc_id from documents where contains(lower(text), 'quality')"
        " or (contains(lower(text), 'tion') and contains(lower(text), 'des')) or source in ('src0', 'src3')",
    ),
    "subscription_narrowed": Entry(
        subscription_narrowed,
        "select doc_id, lang from documents where (contains(lower(text), 'the') or contains(lower(text), 'la'))"
        " and lang = 'en'",
    ),
    "subscription_box": Entry(
        subscription_box,
        "select o_orderkey from orders join customer on c_custkey = o_custkey"
        " where contains(lower(o_orderpriority), 'urgent')"
        " or (o_totalprice between 100000 and 200000 and c_acctbal between 0 and 5000)",
    ),
    "subscriptions_matched": Entry(subscriptions_matched, _SUBSCRIBED),
    "row_preview": Entry(row_preview, "select doc_id, substr(text, 1, 250) preview from documents"),
    "filter_equal_sorted": Entry(
        filter_equal_sorted, "select event_id, value from events where event_type = 'error' order by value, event_id"
    ),
    "first_wins_user": Entry(
        first_wins_user,
        "select user_id, event_id, event_type from"
        " (select *, row_number() over (partition by user_id order by event_id) rn from events) where rn = 1",
    ),
    "user_rank_one": Entry(
        user_rank_one,
        "select c_nationkey, c_name from"
        " (select *, row_number() over (partition by c_nationkey order by c_name) rn from customer) where rn = 1",
    ),
    "post_latest": Entry(post_latest, f"select l_orderkey, l_linenumber, l_shipdate from {_LATEST_LINES}"),
    "lang_dictionary": Entry(
        lang_dictionary,
        "with s(code, id) as (values ('en', 1), ('fr', 2)),"
        " n as (select distinct lang code from documents where lang not in (select code from s))"
        " select code, cast(id as bigint) id from s"
        " union all select code, cast(2 + row_number() over (order by code) as bigint) id from n",
    ),
    "encode_lang": Entry(
        encode_lang,
        "with d as (select lang, row_number() over (order by lang) id from (select distinct lang from documents))"
        " select doc_id, id lang_id from documents join d using (lang)",
    ),
    "tag_dictionary": Entry(tag_dictionary, f"select tag, tag_id from {_TAG_IDS}"),
    "tag_bridge": Entry(tag_bridge, f"select p_partkey, tag_id from {_PART_TAGS} join {_TAG_IDS} using (tag)"),
    "identity_keys": Entry(
        identity_keys, "select c_custkey, row_number() over (order by c_custkey) user_id from customer"
    ),
    "max_key": Entry(max_key, "select coalesce(max(event_id), 0) max_id from events"),
    "resolve_user_key": Entry(
        resolve_user_key, "select event_id, c_name from events join customer on user_id = c_custkey"
    ),
    "resolve_user_key_split": Entry(
        resolve_user_key_split, "select event_id, c_name from events join customer on user_id = c_custkey"
    ),
    "anti_new_lang": Entry(
        anti_new_lang, "select distinct lang, '' as name from documents where lang not in ('en', 'fr')"
    ),
    "anti_new_users": Entry(
        anti_new_users,
        "select c_custkey from customer c where not exists"
        " (select 1 from orders o where o.o_custkey = c.c_custkey and o.o_orderpriority = '1-URGENT')",
    ),
    "merge_users": Entry(
        merge_users,
        "select user_id, event_type from"
        " (select *, row_number() over (partition by user_id order by event_type, event_id) rn from events) e"
        " where rn = 1 and not exists (select 1 from customer c"
        " where c.c_custkey = e.user_id and c.c_mktsegment = 'BUILDING')",
    ),
    "merge_posts": Entry(
        merge_posts,
        f"select l.l_orderkey, l.l_linenumber, l.l_shipdate, o.o_custkey from {_LATEST_LINES} l"
        " join orders o on o.o_orderkey = l.l_orderkey where not exists"
        " (select 1 from orders x where x.o_orderkey = l.l_orderkey and x.o_orderstatus = 'F')",
    ),
    "anti_new_tags": Entry(
        anti_new_tags, f"select distinct tag from {_PART_TAGS} where tag not in ('red', 'blue')"
    ),
    "merge_bridge": Entry(
        merge_bridge,
        f"select distinct t.p_partkey, t.tag from {_PART_TAGS} t join part p on p.p_partkey = t.p_partkey"
        " where p.p_size > 25",
    ),
    "correlated_not_in": Entry(
        correlated_not_in,
        "select c.c_custkey, o.o_orderkey, l.l_linenumber from customer c join orders o on o.o_custkey = c.c_custkey"
        " join lineitem l on l.l_orderkey = o.o_orderkey where l.l_linestatus not in"
        " (select o.o_orderstatus from orders o2 where o2.o_orderkey = o.o_orderkey)",
    ),
    "fk_check": Entry(
        fk_check,
        "select event_id from events e where not exists"
        " (select 1 from customer c where c.c_custkey = e.user_id and c.c_acctbal >= 0)",
    ),
    "union_batches": Entry(
        union_batches,
        "select event_id, user_id from events where event_type in ('click', 'view')"
        " union all select event_id, user_id from events where event_type in ('view', 'signup')",
    ),
    "table_counts": Entry(table_counts, _TABLE_COUNTS),
    "max_by_group": Entry(
        max_by_group,
        "select event_type, max(value) max_value from events group by event_type order by max_value desc",
    ),
    "newest_first": Entry(newest_first, "select event_id, ts from events order by ts desc"),
    "distinct_rows": Entry(distinct_rows, "select distinct user_id, event_type from events"),
    "distinct_compare": Entry(
        distinct_compare,
        "select (select count(*) from (select distinct user_id, event_type from events)) pairs,"
        " (select count(distinct user_id) from events) users",
    ),
    "dup_count": Entry(
        dup_count,
        "select count(*) - (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem)) dups"
        " from lineitem",
    ),
    "throughput": Entry(
        throughput,
        "select event_type, count(*) // (greatest(max(cast(value * 100 as bigint)), 1000) // 1000) rate"
        " from events group by event_type",
    ),
    "tags_per_post": Entry(
        tags_per_post, f"select p_partkey, string_agg(tag, ',' order by tag) tags from {_PART_TAGS} group by p_partkey"
    ),
    "tag_not_in_text": Entry(
        tag_not_in_text,
        f"select p.p_partkey, t.tag as name from {_PART_TAGS} t join part p on p.p_partkey = t.p_partkey + 1"
        " where not contains(lower(p.p_name), t.tag)",
    ),
    "text_tag_not_linked": Entry(
        text_tag_not_linked,
        f"select t.p_partkey, t.tag from {_PART_TAGS} t where not exists (select 1 from {_PART_TAGS} b"
        " where b.p_partkey + 1 = t.p_partkey and b.tag = t.tag)",
    ),
    "written_tag_counts": Entry(
        written_tag_counts,
        "with x as (select unnest(string_split_regex(replace(text, ' ', ' #'), '\\s+')) tok from documents),"
        " y as (select regexp_extract(tok, '^#([^''.?,:!…💕]*)', 1) tag from x where starts_with(tok, '#'))"
        " select tag, count(*) n from y where tag <> '' group by tag",
    ),
    "pk_check": Entry(
        pk_check,
        "select l_orderkey, l_linenumber, count(*) n from lineitem group by l_orderkey, l_linenumber having count(*) > 1",
    ),
    "null_and_length_check": Entry(null_and_length_check, _RULES),
    "constraint_report": Entry(constraint_report, _REPORT),
    "time_functions": Entry(
        time_functions,
        "select event_id, strftime(date_trunc('millisecond', ts), '%H:%M:%S.%g') clock,"
        " cast(floor(epoch(ts)) as bigint) epoch_s, cast(floor(epoch(ts)) as bigint) millis_s from events",
    ),
    "post_times": Entry(
        post_times,
        "select l_orderkey, l_linenumber, l_partkey, case when l_linestatus = 'F' then cast(epoch(l_shipdate) as bigint)"
        " - case when l_returnflag = 'R' then 5400 else 0 end end epoch_s from lineitem",
    ),
    "text_functions": Entry(
        text_functions,
        "select c_custkey, concat('User:', lower(c_name)) k, concat('track=', replace(c_name, '#', '%23')) form,"
        " url_encode(concat(c_name, ' ', c_mktsegment)) encoded, concat(c_name, ',', c_mktsegment) listed,"
        " c_name as same, lower(c_name) tag, cast(split_part(c_name, '#', 2) as bigint) n from customer",
    ),
    "generated_users": Entry(
        generated_users_, "select concat('Bob', c_custkey) name, c_custkey user_ext_id from customer"
    ),
    "bulk_load_users": Entry(
        bulk_load_users,
        "select c_custkey user_ext_id, concat('Bob', c_custkey) name, row_number() over (order by c_custkey) user_id"
        " from customer where c_mktsegment <> 'BUILDING'",
    ),
}
