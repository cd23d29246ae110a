"""The ten operators on small tables: brute force, round trips and odd input."""

import collections
import hashlib
import math
import re
from itertools import product
from pathlib import Path

import duckdb
import numpy as np
import pytest
import regex

from postmill.llm import (
    bpe,
    line_dedup,
    mixing,
    preferences,
    quality_classifier,
    quality_rules,
    token_counts,
    toxicity,
    weighted_minhash,
    winnowing,
)
from postmill.llm.columns import table, text_hash
from postmill.llm.components import components
from postmill.llm.queries import ORACLES, QUERIES

FOLDER = Path("/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, Text string, score int, size string"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
NEAR = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen " * 3

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, "a b c d e f g h i\nsecond line", "en", "x", 9, "q", 1, "s"),
        (1, "a b c d e f g h i\nsecond line", "en", "x", 9, None, 1, "s"),
        (2, None, None, None, None, None, None, None),
        (3, "", "en", "y", 0, "z", 2, "t"),
        (None, "no id\n\n  \nhere", "de", "x", 3, "z", 2, "t"),
        (4, LONG, "fr", "y", len(LONG), "z", 2, "t"),
        (5, LONG, "fr", "x", len(LONG), "z", 2, "t"),
        (6, NEAR, "fr", "x", 1, "z", 2, "t"),
        (7, NEAR + "more", "fr", "x", 1, "z", 2, "t"),
        (None, None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, str(FOLDER), "documents")


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, str(FOLDER), "labels")


def plain(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in row) for row in rows), key=repr)


@pytest.mark.parametrize("name", ORACLES)
def test_sql(spark, name):
    con = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        files = f"{path}/*.parquet" if path.is_dir() else str(path)
        con.execute(f"create view {path.stem} as select * from '{files}'")
    got = QUERIES[name](spark, str(FOLDER))
    cursor = con.execute(ORACLES[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(columns) == sorted(got.columns)
    assert plain(got.select(*columns).collect()) == plain(cursor.fetchall())


def test_odd_rows_and_empty_tables(spark, odd, labels):
    for rows, n in ((odd, 10), (odd.limit(0), 0)):
        assert quality_rules.judge(rows).count() == n
        assert quality_classifier.classify(rows, labels).count() == n
        assert toxicity.tag(rows, labels).count() == n
        assert mixing.mix(rows).count() == n
        assert winnowing.edited_fingerprints(rows).count() == n
        assert winnowing.fingerprints(rows).count() == n
        assert weighted_minhash.near_duplicate_classes(rows).count() == n
        deduped = line_dedup.dedup_lines(rows)
        assert deduped.columns == [*rows.columns, "n_lines", "n_removed"] and deduped.count() == n
        assert quality_classifier.keep_good(rows, labels.limit(0)).count() == n
        assert mixing.mixed(rows).columns == rows.columns


def test_quality_base_counts(docs):
    judged = {row["doc_id"]: row for row in quality_rules.judge(docs).collect()}
    for doc_id, text in docs.select("doc_id", "text").collect():
        words = WORD.findall(text or "")
        seen = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        covered = {j for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
        row = judged[doc_id]
        assert (row["n_words"], row["n_repeat_words"]) == (len(words), len(covered))


def test_same_neighbours_of_every_text(spark, docs):
    doubled = " ".join(f"word{i} word{i}" for i in range(10))
    extra = spark.createDataFrame([(-1, doubled), (-2, "a a"), (-3, "a"), (-4, None)], "doc_id long, text string")
    rows = docs.select("doc_id", "text").unionByName(extra)
    judged = {row["doc_id"]: row for row in quality_rules.judge(rows).collect()}
    for doc_id, text in rows.collect():
        words = WORD.findall(text or "")
        same = sum(a == b for a, b in zip(words, words[1:], strict=False))
        row = judged[doc_id]
        assert row["n_same_neighbours"] == same
        assert ("same_neighbours" in row["failed"]) == (len(words) > 0 and same / len(words) > 0.3)
    assert judged[-1]["failed"] == ["same_neighbours"] and not judged[-1]["base_failed"]


def test_classifier_held_out(spark, docs, labels):
    learn, rest = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    found = quality_classifier.classify(docs, learn).join(rest, "doc_id").select("kept", "quality").collect()
    assert sum(row["kept"] == bool(row["quality"]) for row in found) >= 0.95 * len(found)


def test_sparse_sites_shrink(spark):
    rows = [("big", "a", 0.9)] * 400 + [("big", "b", 0.2)] * 400 + [("tiny", "c", 0.01)]
    scored = spark.createDataFrame(rows, "host string, path string, _p double")
    sites, priors = quality_classifier.site_posteriors(scored, "host", "path", "_p")
    assert sites.count() == 3 and 1 <= priors["path_weight"] < 100


def test_toxicity_learns_words_not_ids():
    rng = np.random.default_rng(3)
    vocabulary = [f"word{i}" for i in range(300)]
    texts, labels = [], []
    for i in range(400):
        words = list(rng.choice(vocabulary, 30))
        toxic = i % 5 == 0
        if toxic:
            words[7] = words[19] = "vilething" + str(i % 3)
        texts.append(" ".join(words[:15]) + "\n" + " ".join(words[15:]))
        labels.append(int(toxic))
    field = toxicity.train(*toxicity.label_words(texts, np.array(labels)))
    scores, spans = toxicity._scored(field, ["word1 word2 vilething9 word3", "word4 word5\nword6", ""])
    assert scores[0] > 0.7 > scores[1] >= scores[2] == 0.0
    assert [(s["begin"], s["end"]) for s in spans[0]] == [(12, 22)] and spans[1:] == [[], []]


def test_forward_backward_is_exact():
    rng = np.random.default_rng(0)
    factors, moves = rng.uniform(0.1, 3, 5), rng.uniform(0.2, 2, (2, 2))
    ahead, back = toxicity.Chains(np.array([2, 3])).odds(factors, moves)
    p = ahead * back / (1 + ahead * back)
    weights = {}
    for path in np.ndindex(2, 2, 2):
        value, before = 1.0, 0
        for place, label in enumerate(path):
            value *= moves[before, label] * (factors[2 + place] if label else 1)
            before = label
        weights[path] = value
    for place in range(3):
        assert p[2 + place] == pytest.approx(sum(w for path, w in weights.items() if path[place]) / sum(weights.values()))


def test_bpe_equals_the_library(spark, docs):
    tokenizers, public = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    theirs, definition = tokenizers.Tokenizer.from_file(path), bpe.read_definition(path)
    got = bpe.encode(docs, definition).collect()
    texts = dict(docs.select("doc_id", "text").collect())
    for row in got:
        ids = theirs.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["ids"] == ids and row["n_tokens"] == len(ids)
        assert row["decoded_sha256"] == hashlib.sha256(theirs.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    own = bpe.Tokenizer(definition, bpe.character_classes())
    for text in ("", "it's  we'll\n\n x", "<|endoftext|> a<|endoftext|>", "é中😀 　", "x" * 20_000, " " * 500 + "'s"):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids
        assert own.decode(own.encode(text)).decode() == text
    odd = spark.createDataFrame([(1, None), (2, "a b")], "doc_id int, text string")
    assert {r["doc_id"]: r["text"] for r in bpe.decode(bpe.encode(odd, definition), definition).collect()} == {1: "", 2: "a b"}


def test_pieces_equal_the_pattern():
    pattern, classes = regex.compile(bpe.PIECES), np.frombuffer(bpe.character_classes(), np.uint8)
    rng = np.random.default_rng(5)
    signs = ["a", "'s", "'", "'re", "'l", " ", "\n", "1", "!", "é", "t", "ll"]
    for _ in range(3000):
        text = "".join(rng.choice(signs, rng.integers(0, 12)))
        assert bpe.cut(text, classes) == pattern.findall(text)


def test_rollup_is_idempotent(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x", "en", "v", 5), (2, None, "en", "v", 7)], "doc_id int, source string, lang string, tokenizer string, tokens long")
    rollup = token_counts.Rollup(spark, str(tmp_path))
    assert rollup.totals().count() == 0
    assert rollup.commit("a", token_counts.inserts(rows)) and not rollup.commit("a", token_counts.inserts(rows))
    changed = rows.where("doc_id = 1").selectExpr("*", "3L as new_tokens")
    assert rollup.commit("b", token_counts.revisions(changed)) and rollup.commit("c", token_counts.deletes(rows.where("doc_id = 2")))
    assert [tuple(row) for row in rollup.totals().collect()] == [("x", "en", "v", 1, 3)]


def test_mixing_meets_targets(spark, docs):
    rows = mixing.mix(docs).collect()
    by_source = collections.defaultdict(lambda: [0, 0])
    for row in rows:
        assert row["taken"] <= 3 * row["size"]
        by_source[(row["source_size"], row["target"])][0] += row["taken"]
    assert sum(target for _, target in by_source) == pytest.approx(sum(row["size"] for row in rows))
    for (_, target), (taken, _) in by_source.items():
        assert target - 50 <= taken <= target + 1e-6
    assert plain(rows) == plain(mixing.mix(docs).collect())
    assert mixing.mixed(docs).count() == sum(row["times"] for row in rows)


def test_knapsack_is_exact_where_it_can_be():
    taken = mixing.fill(np.array([0, 3, 5, 7]), np.array([4, 10, 10, 10]), 101, 1)
    assert (taken * [0, 3, 5, 7]).sum() == 101 and (taken <= [4, 10, 10, 10]).all()
    assert (mixing.fill(np.array([4]), np.array([3]), 7, 1) == [1]).all()


def test_winnowing(docs):
    def brute(text, gram=winnowing.GRAM, window=winnowing.WINDOW):
        gram = min(gram, len(text))
        hashes = [int(winnowing.fingerprint(text[i : i + gram]).hashes[0]) for i in range(len(text) - gram + 1)]
        places = []
        for i in range(len(hashes) - min(window, len(hashes)) + 1):
            part = hashes[i : i + window]
            place = max(j for j, value in enumerate(part) if value == min(part)) + i
            places += [place] if place not in places[-1:] else []
        return [(hashes[j], j) for j in places]

    for text in ("abc" * 60, "a" * 100, "x", docs.orderBy("doc_id").first()["text"][:1500]):
        mark = winnowing.fingerprint(text)
        assert list(zip(mark.hashes.tolist(), mark.positions.tolist(), strict=True)) == brute(text)
    texts = [text for _, text in sorted(docs.select("doc_id", "text").collect())]
    got = [row for row in sorted(winnowing.edited_fingerprints(docs).collect())]
    for i, row in enumerate(got):
        half = len(texts[i]) // 2
        edited = texts[i][: len(texts[i]) - half] + texts[(i + 1) % len(texts)][:half]
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()


def test_mixing_reaches_sums_of_long_documents(spark):
    lengths = np.array([40_000, 50_000, 60_000])
    for seed in range(6):
        assert mixing.fill(lengths, np.array([1, 1, 1]), 100_000, seed).tolist() == [1, 0, 1]
    # Two sources of the same weights as sizes: 1/3 and 2/3 of 210,000 words, of which "a" has 150,000.
    sizes = [("a", 40_000), ("a", 50_000), ("a", 60_000), ("b", 30_000), ("b", 30_000)]
    rows = [(i, "w " * n, source) for i, (source, n) in enumerate(sizes)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken, target = collections.Counter(), {}
    for row in mixed:
        taken[sizes[row["doc_id"]][0]] += row["taken"]
        target[sizes[row["doc_id"]][0]] = row["target"]
    assert target == {"a": 70_000, "b": 140_000}
    assert taken == {"a": 60_000, "b": 120_000}  # the most that whole documents allow


@pytest.mark.parametrize("seed", range(40))
def test_knapsack_reaches_the_largest_sum(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.choice(60_000, int(rng.integers(1, 6)), replace=False))
    counts = rng.integers(1, 4, len(lengths))
    budget = int(rng.integers(0, int((lengths * counts).sum()) + 2))
    taken = mixing._knapsack(lengths, counts, budget, seed)
    sums = [sum(n * int(length) for n, length in zip(some, lengths, strict=True)) for some in product(*(range(c + 1) for c in counts))]
    assert ((taken >= 0) & (taken <= counts)).all()
    assert int((taken * lengths).sum()) == max(one for one in sums if one <= budget)


def test_preferences_rows_of_long_conversations_are_parts_of_the_whole(spark):
    common = [(1, t, "user" if t % 2 else "assistant", f"t{t}") for t in range(1100)]
    chosen = spark.createDataFrame([*common, *((1, t, "assistant", "yes" * (t % 5)) for t in range(1100, 2300))], "pair long, turn long, role string, text string")
    rejected = spark.createDataFrame([*common, *((1, t, "assistant", "no" * (t % 7)) for t in range(1100, 1900))], "pair long, turn long, role string, text string")

    def whole(turns_per_row: int) -> tuple:
        rows = sorted(preferences.format_pairs(chosen, rejected, turns_per_row).collect(), key=lambda r: r["block"])
        texts = tuple("".join(r[name] for r in rows) for name in ("prompt", "chosen", "rejected"))
        masks = tuple([tuple(span) for r in rows for span in r[name]] for name in ("chosen_mask", "rejected_mask"))
        assert {r["n_common"] for r in rows} == {1100}
        return len(rows), texts, masks

    one, many = whole(5000), whole(512)
    assert one[0] == 1 and many[0] == 5 and one[1:] == many[1:]
    (_, good, bad), (good_mask, bad_mask) = one[1:]
    assert [good[b:e] for b, e in good_mask] == ["yes" * (t % 5) for t in range(1100, 2300)]
    assert [bad[b:e] for b, e in bad_mask] == ["no" * (t % 7) for t in range(1100, 1900)]


def test_preferences_edges(spark):
    schema = "pair long, turn long, role string, text string, block int"
    chosen = [(1, 0, "user", "hi", 0), (1, 1, "assistant", "a", 0), (1, 1, "assistant", "a", 0), (2, 0, None, None, 0), (None, 0, "user", "x", 0)]
    rejected = [(1, 0, "user", "hi", 0), (1, 1, "assistant", "b", 0), (2, 0, None, None, 0)]
    got = {r["pair"]: r for r in preferences.format_pairs(spark.createDataFrame(chosen, schema), spark.createDataFrame(rejected, schema)).collect()}
    assert got[1]["prompt"] == "<|user|>\nhi\n" and got[1]["rejected"] == "<|assistant|>\nb\n"
    begin, end = got[1]["chosen_mask"][0]
    assert got[1]["chosen"][begin:end] == "a"
    assert got[2]["n_common"] == 1 and got[2]["chosen"] == "" and set(got) == {1, 2}


def test_line_dedup_edges(spark):
    line = "one two three four five six seven eight nine"
    rows = [(1, line), (2, line.replace("five", "5")), (3, line + " ten\nunique"), (4, "other\n" + line), (5, "short a"), (6, "short b")]
    got = dict(line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "text").collect())
    assert got == {1: line, 2: "", 3: "unique", 4: "other", 5: "short a", 6: "short b"}


def _deduped(rows):
    """Brute force over distinct (id, text) in the order of their documents: by row, the
    text left, the lines with a word, the lines removed."""

    def near(a, b):
        if a == b:
            return True
        a, b = sorted((WORD.findall(a), WORD.findall(b)), key=len)
        if len(a) < 8 or len(b) - len(a) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    seen, result = [], {}
    for row in rows:
        lines, gone = (row[1] or "").split("\n"), set()
        for place, line in enumerate(lines):
            if WORD.search(line):
                if any(near(line, other) for other in seen):
                    gone.add(place)
                seen.append(line)
        left = "\n".join(line for place, line in enumerate(lines) if place not in gone) if gone else row[1]
        result[row] = (left, sum(bool(WORD.search(line)) for line in lines), len(gone))
    return result


def test_line_dedup_null_and_repeated_ids(spark):
    rng = np.random.default_rng(11)
    base = [[f"w{i}x{j}" for j in range(10)] for i in range(12)]
    rows = []
    for n in range(60):
        lines = []
        for place in range(5):
            words = list(base[rng.integers(12)]) if rng.random() < 0.5 else [f"own{n}x{place}x{j}" for j in range(9)]
            if rng.random() < 0.4:
                words[rng.integers(len(words))] = f"edit{n}x{place}"
            lines.append(" ".join(words))
        rows.append((None if n % 3 == 0 else int(n % 7), "\n".join(lines)))
    rows += [rows[0], rows[1], (None, None), (3, ""), (3, None)]
    frame = spark.createDataFrame(rows, "id long, t string")
    hashed = frame.select("id", "t", text_hash(frame["t"]).alias("h")).distinct().collect()
    order = sorted(hashed, key=lambda r: (r["id"] is not None, r["id"] or 0, tuple(r["h"])))
    expected = _deduped([(r["id"], r["t"]) for r in order])
    got = line_dedup.dedup_lines(frame.selectExpr("*", "t as was"), "id", "t").collect()
    assert len(got) == len(rows)
    for row in got:
        assert (row["t"], row["n_lines"], row["n_removed"]) == expected[row["id"], row["was"]]


def test_line_dedup_edits_of_all_lengths(spark):
    """Each edit at the ends, beside the halves and beside the parts, for lengths around every step."""
    rng = np.random.default_rng(12)
    rows = []
    for n in (7, 8, 9, 10, 15, 16, 17, 31, 32, 33, 34, 63, 64, 65, 129):
        base = [f"n{n}x{j}" for j in range(n)]
        for turn, place in enumerate(sorted({0, 1, n // 8, n // 2 - 1, n // 2, n // 2 + 1, 7 * n // 8, n - 2, n - 1})):
            edited = [base[:place] + ["new"] + base[place + 1 :], base[:place] + ["put"] + base[place:], base[:place] + base[place + 1 :]][(turn + n) % 3]
            twice = list(base)
            twice[place], twice[(place + n // 3 + 1) % n] = f"a{place}", f"b{place}"
            rows += [(len(rows), " ".join(edited)), (len(rows) + 1, "  ".join(twice))]
            if turn % 2:
                rows.append((len(rows), f"{' '.join(base)}\nown {n} {place}"))
    order = [(place, rows[at][1]) for place, at in enumerate(rng.permutation(len(rows)))]
    expected = _deduped(order)
    got = line_dedup.dedup_lines(spark.createDataFrame(order, "doc_id long, text string")).collect()
    assert len(got) == len(order)
    assert 0 < sum(row["n_removed"] for row in got) < sum(row["n_lines"] for row in got)
    for row in got:
        removed = expected[order[row["doc_id"]]]
        assert (row["text"], row["n_lines"], row["n_removed"]) == removed


def test_line_dedup_shuffles_little(spark, docs):
    """Equal lines meet without a sort, and what was shuffled for a table is not kept on disk."""
    lines = line_dedup.lines_of(docs, "doc_id", "text")
    plan = line_dedup.distinct_lines(lines)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def shuffled():
        return {path for folder in folders for path in Path(folder).rglob("shuffle_*.data")}

    before = shuffled()
    line_dedup.repeated_lines(docs)
    assert not shuffled() - before


def _similar(docs):
    bags = {}
    for doc_id, text in docs:
        words = WORD.findall(text or "")
        bags[doc_id] = collections.Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else collections.Counter()
    frequency, n = collections.Counter(s for bag in bags.values() for s in bag), len(bags)

    def idf(shingle):
        if frequency[shingle] <= max(n / weighted_minhash.RARE, 1):
            return 1 + weighted_minhash.IDF_STRENGTH
        return 1 + weighted_minhash.IDF_STRENGTH * min(math.log(n / frequency[shingle]) / math.log(weighted_minhash.RARE), 1)

    weights = {i: {s: count * idf(s) for s, count in bag.items()} for i, bag in bags.items()}
    for i, a in weights.items():
        for j, b in weights.items():
            if i < j and (shared := sum(min(a[s], b[s]) for s in a.keys() & b.keys())):
                if shared >= weighted_minhash.THRESHOLD * (sum(a.values()) + sum(b.values()) - shared):
                    yield i, j


def test_minhash_equals_brute_force(docs):
    rows = docs.select("doc_id", "text").collect()
    parent = {doc_id: doc_id for doc_id, _ in rows}

    def root(i):
        return i if parent[i] == i else root(parent[i])

    first = {}
    links = [(first.setdefault(text, doc_id), doc_id) for doc_id, text in sorted(rows)] + list(_similar(rows))
    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    got = dict(weighted_minhash.near_duplicate_classes(docs).collect())
    assert got == {doc_id: root(doc_id) for doc_id in parent}


def test_minhash_large_group(spark):
    base = [f"t{i}" for i in range(120)]
    rows = [(i, " ".join([*base[: i % 100], f"edit{i}", *base[i % 100 :]])) for i in range(90)]
    rows += [(1000 + i, " ".join(f"z{i}x{j}" for j in range(60))) for i in range(5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = dict(weighted_minhash.near_duplicate_classes(frame).collect())
    assert {got[i] for i in range(90)} == {0} and all(got[1000 + i] == 1000 + i for i in range(5))
    assert weighted_minhash.drop_near_duplicates(frame).count() == 6


def test_drop_near_duplicates_null_and_repeated_ids(spark):
    def text(name, edit=None):
        words = [f"{name}{j}" for j in range(120)]
        return " ".join(words if edit is None else [*words[:60], edit, *words[61:]])

    rows = [(1, text("a"), "x"), (2, text("a", "edit"), "x"), (2, text("b"), "x"), (2, text("c"), "x"), (3, text("c"), "x")]
    rows += [(None, text("a"), "x")] * 3 + [(None, text("d"), "x")] * 40 + [(None, text("d", "edit"), "x")]
    rows += [(7, text("e"), "x"), (7, text("e"), "y"), (7, text("e"), "x"), (8, text("e", "edit"), "x")]
    rows += [(9, text("f"), "x"), (9, text("f", "edit"), "x"), (None, None, "x"), (None, "", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    left = weighted_minhash.drop_near_duplicates(frame).collect()
    stems = collections.Counter((row["doc_id"], (row["text"] or "")[:1]) for row in left)
    assert stems == {(1, "a"): 1, (2, "b"): 1, (2, "c"): 1, (None, "d"): 1, (7, "e"): 1, (9, "f"): 1, (None, ""): 1}
    assert set(map(tuple, left)) <= set(rows)
    got = collections.Counter((row["doc_id"], row["class_id"]) for row in weighted_minhash.near_duplicate_classes(frame).collect())
    assert got == {(1, 1): 1, (2, 1): 1, (2, 2): 2, (3, 2): 1, (None, 1): 3, (None, None): 43, (7, 7): 3, (8, 7): 1, (9, 9): 2}


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)], "a long, b long")
    got = dict(components(links).collect())
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in (90, 95, 100)} == {90}


def test_repeated_labels_change_a_document_once(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b", "en", "s", "T"), (2, "c d e", "en", "s", "T")], "doc_id long, text string, lang string, source string, Text string")
    labels = spark.createDataFrame([(1, 1, 1), (1, 0, 1), (None, 0, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    worst = token_counts.worst_labels(labels)
    assert plain(worst.collect()) == plain([(1, 0, 1), (2, None, None)])
    counted = token_counts.counted(docs)
    rollup = token_counts.Rollup(spark, str(tmp_path / "rollup"))
    rollup.commit("arrival", token_counts.inserts(counted))
    rollup.commit("toxic", token_counts.deletes(counted.join(worst, "doc_id").where("toxic = 1")))
    totals = {row["tokenizer"]: (row["docs"], row["tokens"]) for row in rollup.totals().collect()}
    assert totals == {"words/1": (1, 3), "pieces/1": (1, 3)}


@pytest.mark.parametrize("rare, chunk", [(20, 2), (7, 1), (1000, 20)])
def test_frequent_shingles_are_exact(spark, docs, monkeypatch, rare, chunk):
    """Whatever the chunks and rounds, the shingles in over n / RARE texts and their counts."""
    for name, value in {"RARE": rare, "CHUNK": chunk, "_SHINGLES_AT_ONCE": 500}.items():
        monkeypatch.setattr(weighted_minhash, name, value)
    texts = docs.select("text").unionByName(docs.select("text").limit(30)).repartition(8)
    n = texts.count()
    hashes, counts = weighted_minhash.frequent_shingles(texts, n)
    want = collections.Counter()
    for row in texts.collect():
        words = WORD.findall(row["text"] or "")
        windows = {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()
        want.update(windows)
    frequent = sorted(count for count in want.values() if count > max(n / rare, 1))
    assert sorted(counts.tolist()) == frequent and len(set(hashes.tolist())) == len(frequent)
