"""Phrase collocation mining (12): multikey three-way quicksort of suffix pointers.

Texts, A-Z in lower case, are cut into pieces and those into words. Every word begins
a suffix, its piece's next words up to a maximum depth. Suffixes are routed by their
two leading words, so that all suffixes a phrase begins meet in one group; there a
three-way quicksort, one word deeper at a time, parts the pointers to them. The size
of an equal partition is the count of the phrase its suffixes share; a partition too
small for the least count is abandoned, whichever side of a pivot it is on.

Two passes over the texts. The first counts words, which also settles that no two words
share the 64-bit number that stands for them (with another seed otherwise). In the
second a suffix ends before a word that is too rare for any phrase, if the frequent
words are measured to fit a broadcast; without it, results are the same.

Skew. Each task sends a suffix it has met many times once, with a count. Leading pairs
with a large share of all suffixes are routed by three words, such triples by four;
their own counts are then sums of parts. Which prefixes are spread so is settled
between the passes and decides where work is done, never what comes out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postmill.llm.columns import only, stored
from postmill.llm.wordhash import mix
from postmill.operators.joins import fits_broadcast, lookup_join

DEPTH = 4
LEAST = 30
CONTAINED = 80
TOP = 2000
NO_LANG = "und"

#: Signs that end a piece, and blanks between words.
BREAKS, BLANKS = ".,;:!?\n\x0b\x0c\r", " \t"

#: Bytes of text, suffixes collected before a task sends them, and suffixes to a group.
_BYTES_AT_ONCE, _SUFFIXES_AT_ONCE, SUFFIXES_PER_GROUP = 1_000_000, 250_000, 250_000
#: Every so manieth suffix tells which prefixes are heavy: those with more than one of SHARES equal shares.
_STRIDE, SHARES = 16, 2_000

_WORD, _BLANK, _BREAK = 0, 1, 2
_KIND = np.full(256, _WORD, np.uint8)
_KIND[[ord(sign) for sign in BLANKS]] = _BLANK
_KIND[[ord(sign) for sign in BREAKS]] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_KEYS = [f"k{depth}" for depth in range(1, DEPTH + 1)]


class Slice(NamedTuple):
    """Words of some text of one language: their numbers, how many words of the piece
    begin there (``DEPTH`` at most), and where they stand in the bytes."""

    lang: str
    keys: np.ndarray
    left: np.ndarray
    data: np.ndarray
    begins: np.ndarray
    ends: np.ndarray


def _word_numbers(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, lang: str, seed: int) -> np.ndarray:
    """64 bits of each word with its language; never 0."""
    sizes = ends - begins
    total = int(sizes.sum())
    first = np.cumsum(sizes) - sizes
    inside = np.arange(total) - np.repeat(first, sizes)
    base = np.uint64((0x9E3779B97F4A7C15 + 2 * (seed + 1) * 0x1000193) | 1)
    powers = np.full(int(sizes.max()), base, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    terms = (data[np.repeat(begins, sizes) + inside].astype(np.uint64) + np.uint64(1)) * powers[inside]
    of_lang = np.frombuffer(lang.encode() or b"\0", np.uint8).astype(np.uint64) + np.uint64(1)
    place = np.zeros(1, np.uint64)
    for byte in of_lang:
        place = mix(place * base + byte)
    return np.maximum(mix(mix(np.add.reduceat(terms, first)) ^ place), np.uint64(1))


def _streams(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
    """The bytes of a batch's texts by language, in lower case, pieces of at most so many
    bytes that end where a piece of text does (a piece longer than that stays whole)."""
    langs = np.array([NO_LANG if lang is None else lang for lang in batch.column("lang").to_pylist()], dtype=object)
    texts = batch.column("text").cast(pa.large_binary())
    for lang in sorted(set(langs)):
        rows = texts.take(pa.array(np.flatnonzero(langs == lang)))
        held, size = [], 0
        for text in rows:
            if not text.is_valid:
                continue
            data = text.as_py()
            if held and size + len(data) > _BYTES_AT_ONCE:
                yield lang, np.frombuffer(b"\n".join(held), np.uint8)
                held, size = [], 0
            if len(data) <= _BYTES_AT_ONCE:
                held.append(data)
                size += len(data)
                continue
            whole = np.frombuffer(data, np.uint8)
            breaks = np.flatnonzero(_KIND[whole] == _BREAK)
            begin = 0
            while begin < len(whole):
                last = np.searchsorted(breaks, begin + _BYTES_AT_ONCE, side="right") - 1
                if last < 0 or breaks[last] < begin:  # no break for so long: go on to the next one
                    last += 1
                end = int(breaks[last]) + 1 if last < len(breaks) and begin + _BYTES_AT_ONCE < len(whole) else len(whole)
                yield lang, whole[begin:end]
                begin = end
        if held:
            yield lang, np.frombuffer(b"\n".join(held), np.uint8)


def _slices(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[Slice]:
    for batch in batches:
        for lang, data in _streams(batch):
            kind = _KIND[data]
            word = np.concatenate([[False], kind == _WORD, [False]])
            begins, ends = np.flatnonzero(word[1:] & ~word[:-1]), np.flatnonzero(word[:-1] & ~word[1:])
            if not len(begins):
                continue
            data = _LOWER[data]
            pieces = np.cumsum(kind == _BREAK, dtype=np.int64)[begins]
            left = np.ones(len(begins), np.int8)
            for depth in range(1, DEPTH):
                left[:-depth] += pieces[depth:] == pieces[:-depth]
            yield Slice(lang, _word_numbers(data, begins, ends, lang, seed), left, data, begins, ends)


def _signed(numbers: np.ndarray) -> pa.Array:
    return pa.array(numbers.astype(np.uint64, copy=False).view(np.int64))


def _prefixes(keys: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Numbers of the first 1, 2 ... ``DEPTH`` words of every suffix, a row per length; a
    suffix that ends keeps the number it has."""
    rows = np.empty((DEPTH, len(keys)), np.uint64)
    rows[0] = keys
    for depth in range(1, DEPTH):
        following = np.zeros_like(keys)
        following[:-depth] = keys[depth:]
        rows[depth] = np.where(left > depth, mix(rows[depth - 1] * np.uint64(0x9E3779B97F4A7C15) + following), rows[depth - 1])
    return rows


def _unequal(part: Slice, other: np.ndarray) -> np.ndarray:
    """For each word of a slice, whether it differs from the word at the place ``other`` names."""
    sizes = part.ends - part.begins
    differ = sizes != sizes[other]
    held = np.where(differ, 0, sizes)
    inside = np.arange(int(held.sum())) - np.repeat(np.cumsum(held) - held, held)
    bytes_differ = part.data[np.repeat(part.begins, held) + inside] != part.data[np.repeat(part.begins[other], held) + inside]
    wrong = np.repeat(np.arange(len(sizes)), held)[bytes_differ]
    differ[wrong] = True
    return differ


_COUNTED = "lang string, word string, key bigint, n bigint, depth int"


def _count_words(seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Words of a task with their counts (``depth`` 1), and the prefixes of two and three
    words that stand out among every ``_STRIDE``-th suffix."""

    def words_of(part: Slice) -> pa.RecordBatch:
        keys, first, place, counts = np.unique(part.keys, return_index=True, return_inverse=True, return_counts=True)
        # Words that share a number with another one in the slice, whose counts then come apart.
        strange = np.flatnonzero(_unequal(part, first[place]))
        np.subtract.at(counts, place[strange], 1)
        keys, counts = np.append(keys, part.keys[strange]), np.append(counts, np.ones(len(strange), np.int64))
        at = np.append(first, strange)
        whole = part.data.tobytes()
        spelt = [whole[i:j] for i, j in zip(part.begins[at].tolist(), part.ends[at].tolist(), strict=True)]
        return rows(part.lang, pa.array(spelt, pa.binary()).cast(pa.string()), keys, counts, 1)

    def rows(lang: str, spelt: pa.Array, keys: np.ndarray, counts: np.ndarray, depth: int) -> pa.RecordBatch:
        n = len(keys)
        columns = [pa.repeat(pa.scalar(lang), n), spelt, _signed(keys), pa.array(counts.astype(np.int64))]
        return pa.record_batch([*columns, pa.repeat(pa.scalar(depth, pa.int32()), n)], names=["lang", "word", "key", "n", "depth"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, seed):
            yield words_of(part)
            seen = _prefixes(part.keys, part.left)[:, ::_STRIDE]
            for depth in (2, 3):
                keys, counts = np.unique(seen[depth - 1][part.left[::_STRIDE] >= depth], return_counts=True)
                heavy = counts > max(1, seen.shape[1] // (2 * SHARES))
                yield rows(part.lang, pa.nulls(int(heavy.sum()), pa.string()), keys[heavy], counts[heavy], depth)

    return run


class Suffixes(NamedTuple):
    """Suffixes of equal words are one row: the words' numbers, 0 after the last, and how often."""

    words: np.ndarray
    times: np.ndarray


def _collapsed(words: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers of the distinct suffixes, their counts and the order's number of each.
    ``whole`` is a number of the whole suffix; rows that share it and differ stay apart."""
    numbers, first, place, counts = np.unique(whole, return_index=True, return_inverse=True, return_counts=True)
    strange = np.flatnonzero((words != words[first[place]]).any(axis=1))
    np.subtract.at(counts, place[strange], 1)
    return np.concatenate([first, strange]), np.concatenate([counts, np.ones(len(strange), np.int64)]), numbers


def _send_suffixes(
    seed: int, groups: int, frequent: np.ndarray | None, pairs: np.ndarray, triples: np.ndarray
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Suffixes of two words or more, packed: one row per group they go to and level, 0 for
    those routed by two words, 1 by three, 2 by four."""

    def among(numbers: np.ndarray, known: np.ndarray) -> np.ndarray:
        if not len(known):
            return np.zeros(len(numbers), bool)
        return known[np.minimum(np.searchsorted(known, numbers), len(known) - 1)] == numbers

    def suffixes(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        names, left = part.keys, part.left
        if frequent is not None:
            at = np.minimum(np.searchsorted(frequent, part.keys), max(len(frequent) - 1, 0))
            names = np.where(frequent[at] == part.keys, at + 1, 0).astype(np.uint32) if len(frequent) else np.zeros(len(at), np.uint32)
            held = np.zeros(len(left), np.int8)
            for depth in reversed(range(DEPTH)):  # words up to the first rare one
                known = np.zeros(len(names), bool)
                known[: len(names) - depth] = names[depth:] > 0
                held = np.where((left > depth) & known, held + 1, 0)
            left = held
        seen = _prefixes(part.keys, left)
        rows = np.flatnonzero(left > 1)
        words = np.zeros((len(rows), DEPTH), names.dtype)
        for depth in range(DEPTH):
            goes_on = left[rows] > depth
            words[goes_on, depth] = names[rows[goes_on] + depth]
        return words, *seen[1:, rows]

    def packed(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        words, two, three, four = (np.concatenate(column) for column in zip(*parts, strict=True))
        rows, times, _ = _collapsed(words, four)
        words, two, three, four = words[rows], two[rows], three[rows], four[rows]
        level = among(two, pairs).astype(np.int8)
        level += (level > 0) & among(three, triples)
        group = (np.choose(level, [two, three, four]) % np.uint64(groups)).astype(np.int64)
        place = group * 3 + level
        order = np.argsort(place, kind="stable")
        bounds = np.flatnonzero(np.diff(place[order], prepend=-1, append=-1))
        packs = [(order[i:j], place[order[i]]) for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
        yield pa.record_batch(
            [
                pa.array([int(at) // 3 for _, at in packs], pa.int64()),
                pa.array([int(at) % 3 for _, at in packs], pa.int32()),
                pa.array([words[chosen].tobytes() for chosen, _ in packs], pa.binary()),
                pa.array([times[chosen].tobytes() for chosen, _ in packs], pa.binary()),
            ],
            names=["grp", "level", "words", "times"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for part in _slices(batches, seed):
            parts.append(suffixes(part))
            held += len(parts[-1][0])
            if held >= _SUFFIXES_AT_ONCE:
                yield from packed(parts)
                parts, held = [], 0
        if held:
            yield from packed(parts)

    return run


def quicksorted(rows: Suffixes, least: int, depth: int = 0) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """Phrases in at least ``least`` suffixes, as ``(a row of each, words, counts)``.

    Multikey quicksort: a partition of pointers agrees in its first ``depth`` words. A
    pivot word parts it into those whose next word is less, equal or greater; equal ones
    go one word deeper. All partitions are split at once, round by round. Pointers move
    by running counts, so a round is linear. ``depth`` above 0: rows come sorted by
    their first ``depth`` words, and those make the first partitions.
    """
    words, times = rows
    flat, width = words.reshape(-1), words.shape[1]
    pointers = np.arange(len(words))
    fresh = np.zeros(len(words), bool)
    fresh[:1] = True
    if depth and len(words):
        fresh[1:] = (words[1:, :depth] != words[:-1, :depth]).any(axis=1)
    starts = np.flatnonzero(fresh)
    depths = np.full(len(starts), depth)
    while len(starts):
        sizes = np.diff(np.append(starts, len(pointers)))
        part = np.repeat(np.arange(len(starts)), sizes)
        keys = flat[pointers * width + np.repeat(depths, sizes)]
        low, middle, high = keys[starts], keys[starts + sizes // 2], keys[starts + sizes - 1]
        pivots = np.maximum(np.minimum(low, middle), np.minimum(np.maximum(low, middle), high))[part]
        side = (keys >= pivots).astype(np.int8) + (keys > pivots)
        weight = np.bincount(part * 3 + side, weights=times[pointers], minlength=3 * len(starts)).astype(np.int64)
        count = np.bincount(part * 3 + side, minlength=3 * len(starts))
        child_depth = np.repeat(depths, 3)
        equal = np.arange(3 * len(starts)) % 3 == 1
        child_depth[equal] += 1
        # An equal partition after the last word (0) is no phrase, nor one that cannot go deeper.
        ended = np.zeros(3 * len(starts), bool)
        ended[1::3] = pivots[starts] == 0
        stay = (weight >= least) & ~ended
        # Room for each partition that stays, in order; a pointer's place is its rank there.
        begin = np.cumsum(np.where(stay, count, 0)) - np.where(stay, count, 0)
        place = part * 3 + side
        kept = stay[place]
        moved = np.empty(int(np.where(stay, count, 0).sum()), np.int64)
        for which in range(3):
            mine = (side == which) & kept
            rank = np.cumsum(mine) - mine
            rank -= rank[starts][part]
            moved[(begin[place] + rank)[mine]] = pointers[mine]
        pointers, starts, depths = moved, begin[stay], child_depth[stay]
        found = equal[stay]
        for size in range(1, width + 1):
            mine = found & (depths == size)
            if mine.any():
                yield pointers[starts[mine]], size, weight[stay][mine]
        deep = depths < width
        if not deep.all():
            sizes = np.diff(np.append(starts, len(pointers)))
            pointers = pointers[np.repeat(deep, sizes)]
            sizes, depths = sizes[deep], depths[deep]
            starts = np.cumsum(sizes) - sizes


def _parts_of_heavy(rows: Suffixes, depth: int) -> tuple[Suffixes, Iterator[tuple[np.ndarray, int, np.ndarray]]]:
    """Rows sorted by their first ``depth`` words, and the counts, of whatever size, of
    their prefixes of 2 to ``depth`` words in this group."""
    order = np.lexsort([rows.words[:, at] for at in reversed(range(depth))])
    rows = Suffixes(rows.words[order], rows.times[order])

    def sums() -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        for size in range(2, depth + 1):
            new = np.ones(len(order), bool)
            new[1:] = (rows.words[1:, :size] != rows.words[:-1, :size]).any(axis=1)
            begins = np.flatnonzero(new & (rows.words[:, size - 1] > 0))
            if len(begins):
                yield begins, size, np.add.reduceat(rows.times, np.flatnonzero(new))[(np.cumsum(new) - 1)[begins]]

    return rows, sums()


def _count_phrases(least: int, frequent: np.ndarray | None) -> Callable[[pa.Table], pa.Table]:
    kind = np.dtype("<u8" if frequent is None else "<u4")

    def of_level(table: pa.Table, level: int) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
        chosen = [at for at, found in enumerate(table.column("level").to_pylist()) if found == level]
        if not chosen:
            return
        words = b"".join(table.column("words")[at].as_py() for at in chosen)
        times = b"".join(table.column("times")[at].as_py() for at in chosen)
        rows = Suffixes(np.frombuffer(words, kind).reshape(-1, DEPTH), np.frombuffer(times, np.int64))
        if level:
            rows, sums = _parts_of_heavy(rows, level + 1)
            for at, size, counts in sums:
                yield rows.words[at], size, counts
        for at, size, counts in quicksorted(rows, least, level + 1 if level else 0):
            if size > 1:
                yield rows.words[at], size, counts

    def run(table: pa.Table) -> pa.Table:
        found, totals = [np.zeros((0, DEPTH), np.uint64)], [np.zeros(0, np.int64)]
        for level in range(3):
            for words, size, counts in of_level(table, level):
                keys = words.astype(np.uint64)
                keys[:, size:] = 0
                found.append(keys if frequent is None else np.where(keys > 0, frequent[np.maximum(keys, 1) - 1], 0).astype(np.uint64))
                totals.append(counts.astype(np.int64))
        keys = np.concatenate(found)
        return pa.table([*(_signed(np.ascontiguousarray(keys[:, at])) for at in range(DEPTH)), pa.array(np.concatenate(totals))], names=[*_KEYS, "a"])

    return run


def _distinct_words(texts: DataFrame) -> tuple[DataFrame, int]:
    """Stored counts of words and of heavy prefixes, and the seed with which no two words
    of a language have one number."""
    seed = 0
    while True:
        counted = texts.mapInArrow(_count_words(seed), _COUNTED)
        counted = counted.groupBy("depth", "key", "lang", "word").agg(F.sum("n").alias("n"))
        counted = stored(counted, "collocation-words")
        if counted.where("depth = 1").groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").isEmpty():
            return counted, seed
        seed += 1


def _numbers(rows: DataFrame) -> np.ndarray:
    return np.sort(rows.select("key").toPandas()["key"].to_numpy(dtype=np.int64).view(np.uint64))


def phrase_counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Stored words (``lang, word, key, n``), and stored phrases of 2 to ``DEPTH`` words in
    at least ``least`` places: keys of their words (0 after the last) and count ``a``."""
    spark = docs.sparkSession
    read = only(docs, "text", "lang")
    texts = read.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"))
    counted, seed = _distinct_words(texts)
    words = counted.where("depth = 1").select("lang", "word", "key", "n")
    total = words.agg(F.sum("n")).first()[0] or 0
    known = words.where(F.col("n") >= least).select("key")
    frequent = _numbers(known) if fits_broadcast(known, rows=2_000_000) else None
    share = max(total // (_STRIDE * SHARES), 2)  # at most 2 * SHARES prefixes of a length have more than that
    heavy = counted.where(F.col("depth") > 1).groupBy("depth", "key").agg(F.sum("n").alias("n")).where(F.col("n") > share)
    pairs, triples = (_numbers(heavy.where(F.col("depth") == depth)) for depth in (2, 3))
    groups = max(total // SUFFIXES_PER_GROUP + 1, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    sent = spark.sparkContext.broadcast((frequent, pairs, triples))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _send_suffixes(seed, groups, *sent.value)(batches)

    def count(table: pa.Table) -> pa.Table:
        return _count_phrases(least, sent.value[0])(table)

    routed = texts.mapInArrow(send, "grp bigint, level int, words binary, times binary")
    found = routed.groupBy("grp").applyInArrow(count, ", ".join(f"{key} bigint" for key in _KEYS) + ", a bigint")
    whole = found.groupBy(*_KEYS).agg(F.sum("a").alias("a")).where(F.col("a") >= least)  # heavy ones come in parts
    return words, stored(whole, "collocation-phrases")


def _part(keys: Column, first: int | Column, size: int | Column) -> Column:
    """Some of a phrase's words, as its key."""
    return F.slice(keys, first, size)


def collocations(docs: DataFrame, least: int = LEAST, contained: int = CONTAINED, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase of 2 to 4 words in ``least`` places or more scores the least of
    ``floor(2000000 * a / (l + r))`` over its cuts into a first part with ``l`` and a rest
    with ``r`` places, the first such cut on ties. Phrases inside a longer one that has
    ``contained`` percent of their places go. A null language is ``und``; null or empty
    texts have no words; repeated rows count as often as they come; a text of any length
    counts whole. An empty table gives an empty result; columns other than ``text`` and
    ``lang`` are not looked at.
    """
    words, phrases = phrase_counts(docs, least)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    named = F.filter(F.array(*_KEYS), lambda key: key != 0)
    phrases = phrases.select(named.alias("keys"), "a")
    counts = stored(phrases.unionByName(words.where(F.col("n") >= least).select(F.array("key").alias("keys"), F.col("n").alias("a"))), "collocation-counts")
    rest = counts.select(F.col("keys").alias("part"), F.col("a").alias("of_part"))
    candidates = counts.where(F.size("keys") > 1)
    # Each cut asks for two counts; parts such as a frequent last word are asked for often.
    cuts = candidates.select("keys", "a", F.explode(F.sequence(F.lit(1), F.size("keys") - 1)).alias("k"))
    asked = cuts.select(
        "keys",
        "a",
        "k",
        F.explode(
            F.array(
                F.struct(F.lit(True).alias("first"), _part(F.col("keys"), 1, F.col("k")).alias("part")),
                F.struct(F.lit(False).alias("first"), _part(F.col("keys"), F.col("k") + 1, F.lit(DEPTH)).alias("part")),
            )
        ).alias("ask"),
    ).select("keys", "a", "k", "ask.first", "ask.part")
    answered = lookup_join(asked, rest, "part", ["keys", "k", "first"])
    sides = answered.groupBy("keys", "a", "k").agg(
        F.max(F.when(F.col("first"), F.col("of_part"))).alias("l"), F.max(F.when(~F.col("first"), F.col("of_part"))).alias("r")
    )
    score = F.expr("cast(cast(a as decimal(20,0)) * 2000000 as decimal(38,0)) div (cast(l as decimal(38,0)) + r)")
    least_cut = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = sides.groupBy("keys", "a").agg(least_cut).select("keys", "a", "cut.score", "cut.l", "cut.r")
    # Phrases inside longer ones: all their shorter runs of words, with the longer one's count.
    spans = [(first, size) for size in range(2, DEPTH) for first in range(1, DEPTH - size + 2)]
    runs = F.filter(
        F.array(*(F.when(F.size("keys") >= first + size - 1, F.slice("keys", first, size)) for first, size in spans)),
        lambda run: run.isNotNull() & (F.size(run) < F.size("keys")),
    )
    inside = candidates.where(F.size("keys") > 2).select(F.explode(runs).alias("keys"), F.col("a").alias("longer"))
    inside = inside.groupBy("keys").agg(F.max("longer").alias("longer"))
    covered = F.col("longer").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * contained
    alone = scored.join(inside, "keys", "left").where(~F.coalesce(covered, F.lit(False))).drop("longer")
    spelt = words.where(F.col("n") >= least).select("key", "word", "lang")
    headed = alone.withColumn("key", F.col("keys")[0])
    headed = lookup_join(stored(headed, "collocation-scored"), spelt.select("key", "lang"), "key", ["keys"])
    by_count = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = headed.withColumn("_r", F.rank().over(by_count)).where(F.col("_r") <= top).select("lang", "keys", "a", "l", "r", "score")
    best = stored(best, "collocation-best")
    each = best.select("lang", "keys", F.posexplode("keys").alias("place", "key"))
    texts = lookup_join(each, spelt.select("key", "word"), "key", ["keys", "place"]).groupBy("lang", "keys")
    ordered = F.array_sort(F.collect_list(F.struct("place", "word")))
    phrase = texts.agg(F.array_join(F.transform(ordered, lambda entry: entry["word"]), " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.join(phrase, ["lang", "keys"]).withColumn("rank", F.row_number().over(order).cast("bigint"))
    listed = ranked.where(F.col("rank") <= top).join(totals, "lang")
    return listed.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
