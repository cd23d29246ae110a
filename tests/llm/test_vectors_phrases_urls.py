"""Whitening, collocations and URL filters on small tables, against brute force."""

import collections
import math
import random
import re
from pathlib import Path

import numpy as np
import pytest

from postmill.llm import collocations, url_filters, whitening
from postmill.llm.columns import table

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")

# ------------------------------------------------------------------ whitening


def check_whitening(rows, got, components=8):
    """``rows``: (id, vector) in any order; ids unique."""
    grid = {i: [math.floor(1024 * float(c)) + 100_000 for c in v] for i, v in rows}
    x = np.array(list(grid.values()), dtype=np.float64)
    n, sums = len(x), [sum(column) for column in zip(*grid.values(), strict=True)]
    centred = x - np.array(sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    taken = [k for k in range(min(components, len(sums))) if values[k] > 1e-11 * values[0]]
    assert len(got) == n * len(taken)
    found = {(row["vec_id"], row["component"]): row for row in got}
    for k in taken:
        want = centred @ vectors[:, k] / math.sqrt(values[k])
        have = np.array([found[i, k + 1]["whitened"] for i in grid])
        sign = np.sign(want @ have)
        assert np.allclose(have * sign, want, atol=1e-6)
    for (i, k), row in found.items():
        assert row["n"] == n and row["identity_error"] < 1e-4
        assert row["deviation"] == sum((n * c - s) ** 2 for c, s in zip(grid[i], sums, strict=True))
        assert math.isclose(row["explained"], values[k - 1] / values.sum(), rel_tol=1e-4)


def test_whitening_of_the_table(spark):
    vectors = table(spark, FOLDER, "embeddings")
    rows = [(row["vec_id"], row["embedding"]) for row in vectors.collect()]
    check_whitening(rows, whitening.whiten(vectors).collect())


def test_whitening_in_many_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 8 * 64 * 7)
    monkeypatch.setattr(whitening, "BLOCKS_PER_TASK", 2)
    vectors = table(spark, FOLDER, "embeddings").repartition(3)
    rows = [(row["vec_id"], row["embedding"]) for row in vectors.collect()]
    check_whitening(rows, whitening.whiten(vectors).collect())


VECTORS = "vec_id long, embedding array<float>, Embedding string, component int"


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(5)
    good = [(i, [float(c) for c in rng.normal(size=5).astype(np.float32)]) for i in range(40)]
    good += [(100 + i, good[0][1]) for i in range(20)]  # repeated vectors weigh as often as they come
    odd = [(-1, None), (-2, [1.0, None, 0.0, 0.0, 0.0]), (-3, [math.nan] * 5), (-4, [math.inf, 0.0, 0.0, 0.0, 0.0])]
    odd += [(-5, []), (-6, [1.0, 2.0]), (-7, [1.0, 2.0])]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in [*good, *odd]], VECTORS)
    got = whitening.whiten(frame)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitening(good, got.collect())
    # Null and repeated ids are rows of their own.
    nameless = spark.createDataFrame([(None if i < 30 else 7, v, "x", 1) for i, v in good], VECTORS)
    assert collections.Counter(row["vec_id"] for row in whitening.whiten(nameless, components=2).collect()) == {None: 60, 7: 60}
    for few in ([], good[:1], [good[0]] * 3, odd[:4], [(1, []), (2, [])]):
        assert whitening.whiten(spark.createDataFrame([(i, v, "x", 1) for i, v in few], VECTORS)).count() == 0
    # Fewer directions than dimensions: only those with variance.
    assert whitening.whiten(spark.createDataFrame([(i, v, "x", 1) for i, v in good[:3]], VECTORS)).count() == 6


def test_deviation_beyond_64_bits(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.5, 0.25])]
    got = whitening.whiten(spark.createDataFrame([(i, v, "x", 1) for i, v in rows], VECTORS)).collect()
    x = {i: [max(-(2**40), min(2**40, math.floor(1024 * c))) + 100_000 for c in v] for i, v in rows}
    sums = [sum(column) for column in zip(*x.values(), strict=True)]
    for row in got:
        exact = sum((3 * c - s) ** 2 for c, s in zip(x[row["vec_id"]], sums, strict=True))
        assert row["deviation"] == (exact if exact < 2**63 else None)


# --------------------------------------------------------------- collocations

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def brute_collocations(rows, least, top=2000):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for i in range(len(words)):
                for size in range(1, min(4, len(words) - i) + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    listed = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {p[i:j] for p, a in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                  if j - i < len(p) and 100 * a >= 80 * f[p[i:j]]}
        rows = []
        for p, a in candidates.items():
            if p not in inside:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            listed.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(listed)


def found_collocations(frame, least, **more):
    return sorted(tuple(row) for row in collocations.collocations(frame, least=least, **more).collect())


def test_collocations_of_the_table(spark):
    docs = table(spark, FOLDER, "documents")
    assert found_collocations(docs, 4) == brute_collocations(docs.select("text", "lang").collect(), 4)


def _hot_texts():
    rng = random.Random(2)
    words = ["of", "the", "new", "York", "city", "été", "x1", "a", "b", "c", "d"]
    rows = [(" ".join(rng.choices(words, weights=[9, 9, 5, 5, 3, 1, 1, 1, 1, 1, 1], k=60)) + rng.choice(".,;:!?\n\x0b\r") * 2, "en") for _ in range(150)]
    rows += [("OF THE of the\tof the  new york", None), ("a b, c d. a b", ""), (None, "en"), ("", "de"), ("one", "de")]
    rows += [("of the " * 4000, "de"), ("very long " * 3000 + "." + "z" * 5000, "fr")] + [("the same text, the same text", "fr")] * 60
    return rows


@pytest.mark.parametrize("switches", [{}, {"SHARES": 40, "_STRIDE": 1}, {"_BYTES_AT_ONCE": 700, "_SUFFIXES_AT_ONCE": 900, "SUFFIXES_PER_GROUP": 50}])
@pytest.mark.parametrize("fits", [True, False])
def test_collocations_with_heavy_prefixes(spark, monkeypatch, switches, fits):
    """All plans give one result: spread prefixes, small parts, words that are not broadcast."""
    for name, value in switches.items():
        monkeypatch.setattr(collocations, name, value)
    if not fits:
        monkeypatch.setattr(collocations, "fits_broadcast", lambda *a, **b: False)
    rows = _hot_texts()
    frame = spark.createDataFrame([(i, t, lang, "q") for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string, Text string")
    assert found_collocations(frame.repartition(3), 7) == brute_collocations(rows, 7)


def test_collocations_top_and_empty(spark):
    rows = _hot_texts()
    frame = spark.createDataFrame(rows, "text string, lang string")
    assert found_collocations(frame, 7, top=5) == brute_collocations(rows, 7, 5)
    assert found_collocations(frame.limit(0), 1) == []
    assert found_collocations(spark.createDataFrame([(None, None), ("", "x"), (" ., ", "x")], "text string, lang string"), 1) == []


def test_another_seed_where_two_words_share_a_number(spark, monkeypatch):
    right = collocations._word_numbers

    def clash(data, begins, ends, lang, seed):
        numbers = right(data, begins, ends, lang, seed)
        return np.where(ends - begins == 2, np.uint64(7), numbers) if seed == 0 else numbers

    monkeypatch.setattr(collocations, "_word_numbers", clash)
    rows = [("aa bb cc aa bb", "en")] * 4
    assert found_collocations(spark.createDataFrame(rows, "text string, lang string"), 2) == brute_collocations(rows, 2)


def test_quicksort_counts_equal_prefixes():
    rng = np.random.default_rng(1)
    for width, values, n, least in ((4, 3, 500, 5), (4, 40, 2000, 3), (2, 1, 50, 1), (3, 5, 1, 1)):
        words = rng.integers(1, values + 1, (n, width)).astype(np.uint32)
        ends = rng.integers(1, width + 1, n)
        words[np.arange(width) >= ends[:, None]] = 0
        times = rng.integers(1, 4, n).astype(np.int64)
        want = collections.Counter()
        for row, count in zip(words.tolist(), times.tolist(), strict=True):
            for size in range(1, width + 1):
                if row[size - 1]:
                    want[tuple(row[:size])] += count
        got = {}
        for at, size, counts in collocations.quicksorted(collocations.Suffixes(words, times), least):
            for i, count in zip(at, counts, strict=True):
                assert tuple(words[i][:size].tolist()) not in got
                got[tuple(words[i][:size].tolist())] = count
        assert got == {phrase: count for phrase, count in want.items() if count >= least}


# ---------------------------------------------------------------- URL filters


def brute_url(url, rules, globs):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate(LOWER)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host) or not r.host) and path.startswith(r.path)]
    if fits:
        best = min(fits, key=lambda r: (-len(r.name), r.verdict != "block", r.name))
        return host, path, best.name, best.verdict, None
    fits = [g for g in globs if re.fullmatch(as_regex(g.pattern), host + path, re.DOTALL)]
    if fits:
        best = min(fits, key=lambda g: (-len(g.pattern), g.verdict != "block", g.pattern))
        return host, path, None, best.verdict, best.pattern
    return host, path, None, "allow", None


def as_regex(pattern):
    parts = re.findall(r"\\.|\*\*|.", pattern, re.DOTALL)
    names = {"**": ".*", "*": "[^/]*", "?": "[^/]"}
    return "".join(names.get(part) or re.escape(part[-1]) for part in parts)


URLS = [
    None, "", "no scheme", "http://", "http:///only/path", "HTTP://WWW.Example.COM/en/1", "http://a.www.example.com/en/x?y=/en/",
    "http://example.com/en/1", "http://com/", "http://com", "http://.com/x", "http://xcom/", "http://x.net/es/1#a", "http://x.net/fr/",
    "http://x.net/es", "http://x.org/net/es/1", "http://x.net?/es/", "http://a://b.net/fr/x", "http://casino-x.org", "http://m.casino-x.org/1",
    "http://x.org/.casino-x", "http://my-bets.org/en/1", "http://x.org/a-bets.b", "http://x.org/setup.exe", "http://x.org/setup.exe?q",
    "http://é.org/ü", "http://x.org/\n.exe", "http://x.org/" + "a/" * 3000 + "b.exe", "http://ADS-x.net/en/",
]


def judged(spark, urls, **rules):
    rows = [(i if i % 5 else None, url, "U", i) for i, url in enumerate(urls)]
    frame = spark.createDataFrame(rows, "page_id long, url string, URL string, host int")
    got = url_filters.judge(frame, **rules)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "wildcard"]
    return sorted((tuple(row) for row in got.collect()), key=repr)


def test_urls_against_brute_force(spark):
    want = [(i if i % 5 else None, *brute_url(url, url_filters.HOST_RULES, url_filters.GLOBS)) for i, url in enumerate(URLS)]
    assert judged(spark, URLS) == sorted(want, key=repr)
    assert judged(spark, []) == []


def test_random_globs_over_many_words(spark):
    """Several hundred rules, whose states fill many words, over random short texts."""
    rng = random.Random(4)
    signs = ["a", "b", "/", ".", "*", "**", "?", "é", "\\*"]
    globs = tuple(url_filters.Glob("".join(rng.choices(signs, k=rng.randint(0, 9))), rng.choice(["allow", "block"])) for _ in range(300))
    rules = tuple(url_filters.HostRule("".join(rng.choices("ab.", k=rng.randint(0, 3))), "/" + "".join(rng.choices("ab/", k=rng.randint(0, 2))),
                                       rng.choice(["allow", "block"])) for _ in range(3))
    urls = ["x://" + "".join(rng.choices("ab./é*", k=rng.randint(0, 12))) for _ in range(400)]
    want = [(i if i % 5 else None, *brute_url(url, rules, globs)) for i, url in enumerate(urls)]
    assert judged(spark, urls, hosts=rules, globs=globs) == sorted(want, key=repr)


def test_no_rules_allow_all(spark):
    assert {row[4] for row in judged(spark, URLS, hosts=(), globs=())} == {"allow"}
