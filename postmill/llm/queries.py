"""One query per operator, over its whole table, and the SQL of those that SQL can say."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm import (
    bpe,
    collocations,
    line_dedup,
    mixing,
    preferences,
    quality_classifier,
    quality_rules,
    token_counts,
    toxicity,
    url_filters,
    weighted_minhash,
    whitening,
    winnowing,
)
from postmill.llm.columns import only, stored, table
from postmill.llm.metrics import STOP_WORDS
from postmill.session import scratch_path

#: The vocabulary file the encoding query reads.
VOCABULARY = "byte_bpe_50k.json"


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Score of every document, with its toxic spans."""
    return toxicity.tag(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text, and what they decode to, as digests."""
    definition = bpe.read_definition(public_tokenizers.path(VOCABULARY))
    return bpe.encode(table(spark, folder, "documents"), definition, with_ids=False)


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Totals after three batches: all documents come, toxic ones go, bad ones are
    counted anew without their symbols. The first batch comes twice. Of several
    labels of a document the worst counts."""
    docs = only(table(spark, folder, "documents"), "doc_id", "text", "source", "lang")
    labels = token_counts.worst_labels(table(spark, folder, "labels"))
    bare = F.translate("text", "#*$%&|", "")
    counted = stored(token_counts.counted(docs, revised=bare), "token-counted")
    labelled = counted.join(labels, "doc_id")
    rollup = token_counts.Rollup(spark, scratch_path(spark, "token-counts"))
    rollup.commit("arrival", token_counts.inserts(counted))
    rollup.commit("toxic", token_counts.deletes(labelled.where("toxic = 1")))
    rollup.commit("cleaned", token_counts.revisions(labelled.where("quality = 0 and coalesce(toxic, 0) <> 1")))
    rollup.commit("arrival", token_counts.inserts(counted))
    return rollup.totals()


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How often each document is taken, and its source's target."""
    return mixing.mix(table(spark, folder, "documents"))


def op5_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and its edited copy, and how alike they are."""
    return winnowing.edited_fingerprints(table(spark, folder, "documents"))


def op6_preferences(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation against itself with its partner's ending."""
    turns = only(table(spark, folder, "conversations"), "conv_id", "turn", "role", "text").withColumnRenamed("conv_id", "pair")
    pairs = preferences.format_pairs(turns, preferences.with_swapped_ending(turns))

    def spans(name: str):
        parts = F.transform(name, lambda s: F.concat_ws("-", s["begin"].cast("string"), s["end"].cast("string")))
        return F.array_join(parts, ",").alias(name)

    texts = ["prompt", "chosen", "rejected"]
    return pairs.select(F.col("pair").alias("conv_id"), "block", "n_common", *texts, spans("chosen_mask"), spans("rejected_mask"))


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: lines, repeated lines, and the digest of what is left."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    left = line_dedup.dedup_lines(docs)
    return left.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every document."""
    judged = quality_rules.judge(table(spark, folder, "documents"))
    return judged.withColumn("failed", F.array_join("failed", ","))


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Posterior quality of every document."""
    found = quality_classifier.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))
    numbers = [F.round(name, 9).alias(name) for name in ("evidence", "site_quality", "score")]
    return found.select("doc_id", "host", "path", *numbers, "kept")


def op10_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return weighted_minhash.near_duplicate_classes(table(spark, folder, "documents"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Whitened components of every vector."""
    return whitening.whiten(table(spark, folder, "embeddings"))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """Each language's best phrases."""
    return collocations.collocations(table(spark, folder, "documents"))


def op13_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page's URL, and the rule or glob it comes from."""
    return url_filters.judge(table(spark, folder, "pages"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_bpe": op2_bpe,
    "op3_token_counts": op3_token_counts,
    "op4_mixing": op4_mixing,
    "op5_winnowing": op5_winnowing,
    "op6_preferences": op6_preferences,
    "op7_line_dedup": op7_line_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_minhash": op10_minhash,
    "op11_whitening": op11_whitening,
    "op12_collocations": op12_collocations,
    "op13_url_filters": op13_url_filters,
}

_STOPS = "[" + ", ".join(f"'{word}'" for word in STOP_WORDS) + "]"

_PIECES = "[A-Za-z]+|[0-9]+|[^A-Za-z0-9\\x09-\\x0D ]"
_WORDS = "[^\\x20\\x09-\\x0D]+"

ORACLES = {
    "op3_token_counts": f"""
        with d as (
            select d.source, d.lang, case when l.quality = 0 then regexp_replace(d.text, '[#*$%&|]', '', 'g') else d.text end as t
            from documents d left join (
                select doc_id, min(quality) as quality, max(toxic) as toxic from labels group by doc_id
            ) l using (doc_id) where coalesce(l.toxic, 0) <> 1
        ),
        c as (
            select source, lang, 'words/1' as tokenizer, len(regexp_extract_all(coalesce(t, ''), '{_WORDS}')) as n from d
            union all
            select source, lang, 'pieces/1', len(regexp_extract_all(coalesce(t, ''), '{_PIECES}')) from d
        )
        select source, lang, tokenizer, count(*) as docs, cast(sum(n) as bigint) as tokens from c group by all""",
    "op6_preferences": """
        with t as (
            select conv_id, turn, min({'role': role, 'text': text}) as said
            from conversations where conv_id is not null and turn is not null group by all
        ),
        e as (select conv_id, max(turn) as last, arg_max(said.text, turn) as ending from t group by conv_id),
        r as (
            select t.conv_id, t.turn, t.said.role as role,
                case when t.turn = e.last then p.ending else t.said.text end as text
            from t join e using (conv_id) join e p on p.conv_id = xor(e.conv_id, 1)
        ),
        b as (
            select t.conv_id, t.turn, t.said.role as role, t.said.text as c, r.text as r, r.conv_id is not null as paired
            from t left join r on r.conv_id = t.conv_id and r.turn = t.turn
        ),
        o as (
            select *, coalesce(turn < min(case when not paired or c is distinct from r then turn end)
                over (partition by conv_id), true) as common from b
        ),
        s as (
            select *, '<|' || coalesce(role, '') || '|>' || chr(10) as head,
                '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(c, '') || chr(10) as cs,
                case when paired then '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(r, '') || chr(10) end as rs
            from o
        ),
        m as (
            select *, sum(case when common then 0 else len(cs) end) over w as c_end,
                sum(case when common then 0 else coalesce(len(rs), 0) end) over w as r_end
            from s window w as (partition by conv_id order by turn)
        )
        select conv_id, cast(0 as bigint) as block, count(*) filter (common) as n_common,
            coalesce(string_agg(cs, '' order by turn) filter (common), '') as prompt,
            coalesce(string_agg(cs, '' order by turn) filter (not common), '') as chosen,
            coalesce(string_agg(rs, '' order by turn) filter (not common), '') as rejected,
            coalesce(string_agg((c_end - len(cs) + len(head))::bigint || '-' || (c_end - 1)::bigint, ',' order by turn)
                filter (not common and role = 'assistant'), '') as chosen_mask,
            coalesce(string_agg((r_end - len(rs) + len(head))::bigint || '-' || (r_end - 1)::bigint, ',' order by turn)
                filter (not common and paired and role = 'assistant'), '') as rejected_mask
        from m group by conv_id""",
    "op8_quality_rules": f"""
        with t as (select doc_id, coalesce(text, '') as t from documents),
        w as (
            select doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') as w,
                list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) as lines
            from t
        ),
        g as (
            select doc_id, t, w, lines,
                list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) as grams
            from w
        ),
        once as (
            select rowid as r, gram, count(*) as n
            from (select row_number() over () as rowid, grams from g), unnest(grams) as u(gram)
            group by all having n > 1
        ),
        numbered as (select row_number() over () as r, * from g),
        places as (
            select n.r, i, unnest(range(i, i + 5)) as place
            from (select r, grams, unnest(range(1, len(grams) + 1)) as i from numbered) n
            join once on once.r = n.r and once.gram = n.grams[n.i]
        ),
        repeated as (select r, count(distinct place) as n from places group by r),
        c as (
            select doc_id, len(w) as n_words, len(array_to_string(w, '')) as word_chars,
                len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
                len(lines) - len(list_distinct(lines)) as n_dup_lines,
                coalesce(repeated.n, 0) as n_repeat_words,
                len(t) as n_chars, len(lines) as n_lines,
                len(list_intersect(list_distinct(w), {_STOPS})) as n_stop_words,
                len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) as n_same_neighbours,
                len(t) - len(regexp_replace(t, '\\p{{Lu}}', '', 'g')) as n_capitals,
                len(t) - len(replace(t, '!', '')) as n_exclamations,
                len(list_filter(lines, lambda l: regexp_matches(trim(l), '^[|*•-]|\\|$'))) as n_bar_lines
            from numbered left join repeated using (r)
        ),
        v as (
            select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
                array_to_string(list_filter([
                    case when n_words < 10 or n_words > 1000000 then 'word_count' end,
                    case when n_words = 0 or word_chars / n_words < 2 or word_chars / n_words > 20 then 'mean_word_length' end,
                    case when n_words > 0 and n_symbols / n_words > 0.1 then 'symbol_ratio' end,
                    case when n_words > 0 and n_exclamations / n_words > 0.3 then 'exclamation_ratio' end,
                    case when word_chars > 0 and n_capitals / word_chars > 0.4 then 'capital_ratio' end,
                    case when n_words >= 50 and n_stop_words < 1 then 'stop_words' end,
                    case when n_words >= 50 and n_lines > 0 and n_bar_lines / n_lines > 0.9 then 'bar_lines' end,
                    case when n_lines > 0 and n_dup_lines / n_lines > 0.5 then 'duplicate_lines' end,
                    case when n_words > 0 and n_same_neighbours / n_words > 0.3 then 'same_neighbours' end
                ], lambda x: x is not null), ',') as failed
            from c
        )
        select *, not base_failed and failed = '' as kept from v""",
    "op7_line_dedup": """
        with l as (
            select doc_id, pos - 1 as pos, parts[pos] as line,
                regexp_extract_all(parts[pos], '[^\\x20\\x09-\\x0D]+') as w
            from (
                select doc_id, string_split(coalesce(text, ''), chr(10)) as parts,
                    unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) as pos
                from documents
            )
        ),
        d as (
            select row_number() over (order by min((doc_id, pos))) as k, line, any_value(w) as w, min((doc_id, pos)) as first
            from l where len(w) > 0 group by line
        ),
        v as (
            select k, len(w) as n, unnest(range(1, len(w) + 1)) as i, w from d where len(w) >= 8
        ),
        e as (
            select k, n, i, md5(array_to_string(list_concat(w[1:i - 1], w[i + 1:]), ' ')) as cut from v
        ),
        near as (
            select b.k from e a join e b on a.n = b.n and a.i = b.i and a.cut = b.cut and a.k < b.k
            union
            select greatest(e.k, d.k) from e join d on len(d.w) = e.n - 1 and len(d.w) >= 8
                and md5(array_to_string(d.w, ' ')) = e.cut
        ),
        judged as (
            select l.*, len(l.w) > 0 and (d.k in (select k from near) or (l.doc_id, l.pos) <> d.first) as gone
            from l left join d on l.line = d.line
        )
        select doc_id, count(*) filter (len(w) > 0) as n_lines, count(*) filter (gone) as n_removed,
            sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as text_sha256
        from judged group by doc_id""",
    "op12_collocations": """
        with pieces as (
            select coalesce(lang, 'und') as lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\\x0A-\\x0D]')) as piece
            from documents
        ),
        w as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces),
        totals as (select lang, cast(sum(len(w)) as bigint) as n from w group by lang),
        sizes as (select lang, w, unnest([1, 2, 3, 4]) as size from w),
        runs as (select lang, size, w, unnest(range(1, len(w) - size + 2)) as i from sizes),
        f as (
            select lang, size, w[i:i + size - 1] as p, count(*) as a from runs group by all having a >= 30
        ),
        cuts as (
            select lang, p, size, a, unnest(range(1, size)) as k from f where size > 1
        ),
        scored as (
            select c.lang, c.p, c.a, min((cast(cast(2000000 as hugeint) * c.a // (l.a + r.a) as bigint), c.k, l.a, r.a)) as best
            from cuts c
            join f l on l.lang = c.lang and l.p = c.p[1:c.k]
            join f r on r.lang = c.lang and r.p = c.p[c.k + 1:c.size]
            group by c.lang, c.p, c.a
        ),
        spans as (select lang, p, size, a, unnest([2, 3]) as part from f where size > 2),
        inner_runs as (select lang, p, a, part, unnest(range(1, size - part + 2)) as i from spans where part < size),
        inside as (select lang, p[i:i + part - 1] as p, max(a) as longer from inner_runs group by all),
        kept as (
            select s.lang, array_to_string(s.p, ' ') as phrase, s.a, s.best
            from scored s left join inside i on i.lang = s.lang and i.p = s.p
            where i.longer is null or 100 * i.longer < 80 * s.a
        ),
        ranked as (
            select *, row_number() over (partition by lang order by best[1] desc, a desc, encode(phrase)) as rank from kept
        )
        select r.lang, r.rank, r.phrase, r.a, r.best[3] as l, r.best[4] as r, t.n, r.best[1] as score
        from ranked r join totals t using (lang) where r.rank <= 2000""",
    "op13_url_filters": """
        with parts as (
            select page_id,
                translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
            from pages
        ),
        ruled as (
            select *, case
                when ends_with('.' || host, '.www.example.com') and starts_with(path, '/en/') then 'www.example.com/en/'
                when ends_with('.' || host, '.example.com') and starts_with(path, '/en/') then 'example.com/en/'
                when ends_with('.' || host, '.net') and starts_with(path, '/es/') then 'net/es/'
                when ends_with('.' || host, '.net') and starts_with(path, '/fr/') then 'net/fr/'
                when ends_with('.' || host, '.com') and starts_with(path, '/') then 'com/'
            end as fit,
            list_filter([
                case when regexp_matches(host, '^casino-') then 'casino-**' end,
                case when regexp_matches(host, '\\.casino-') then '*.casino-**' end,
                case when regexp_matches(host, '^adult-') then 'adult-**' end,
                case when regexp_matches(host, '\\.adult-') then '*.adult-**' end,
                case when regexp_matches(host, '^spam-') then 'spam-**' end,
                case when regexp_matches(host, '\\.spam-') then '*.spam-**' end,
                case when regexp_matches(host, '^ads-') then 'ads-**' end,
                case when regexp_matches(host, '\\.ads-') then '*.ads-**' end,
                case when contains(host, '-bets.') then '*-bets.**' end,
                case when contains(host, '-pills.') then '*-pills.**' end,
                case when starts_with(path, '/') and ends_with(path, '.exe') then '*/**.exe' end
            ], lambda g: g is not null) as globs
            from parts
        ),
        named as (select *, list_sort(list_transform(globs, lambda g: (-len(g), g)))[1] as best from ruled)
        select page_id, host, path, fit as rule,
            case when fit in ('com/', 'www.example.com/en/') or (fit is null and best is null) then 'allow' else 'block' end as verdict,
            case when fit is null then best[2] end as wildcard
        from named""",
}
