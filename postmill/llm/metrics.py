"""Counts of a text's words, lines, symbols and repetitions, as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm.columns import BLANKS, words

#: The symbols that count as such, and common words of four languages.
SYMBOLS = "#*$%&|<>"
STOP_WORDS = (
    "the of and to a in is that it for was on with as be by this are at from "
    "der die und den von zu das mit sich für auf des ist im dem nicht ein eine als "
    "de la le et les en un du une que est pour qui dans au par sur pas avec "
    "el y los se del las por con una no para su es al lo"
).split()

WINDOW = 5

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_chars", "n_lines", "n_stop_words", "n_same_neighbours", "n_capitals", "n_exclamations", "n_bar_lines")


def _signs(text: Column, signs: str) -> Column:
    """How many of the text's characters are among ``signs``."""
    rest = text
    for sign in signs:
        rest = F.replace(rest, F.lit(sign), F.lit(""))
    return (F.length(text) - F.length(rest)).cast("bigint")


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda total, number: total + number)


def measured_texts(df: DataFrame, text: str, keep: list[str], more: bool = True) -> DataFrame:
    """``keep`` and the counts of ``BASE`` (and ``MORE``) for each row's whole text.

    Built-in functions only. Arrays that several counts share are columns of
    inner projections, which the optimizer leaves alone because they are used
    more than once. Repeated windows are found through 64-bit hashes; only texts
    in which one repeats have theirs sorted, so a text costs n log n at most.
    ``n_same_neighbours`` counts words equal to the one before. A null text counts
    as empty, its counts are 0.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    split = df.select(
        *keep,
        whole.alias("_t"),
        words(F.col(text)).alias("_w"),
        F.filter(F.split(whole, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "").alias("_lines"),
    )
    starts = F.slice(F.col("_w"), F.lit(1), F.greatest(F.size("_w") - (WINDOW - 1), F.lit(0)))

    def window_hash(word: Column, place: Column) -> Column:
        return F.xxhash64(word, *(F.get(F.col("_w"), place + i) for i in range(1, WINDOW)))

    hashed = split.select("*", F.transform(starts, window_hash).alias("_h"))
    # A window is told by 64 bits of it; equal ones stand next to each other once sorted.
    numbered = F.transform("_h", lambda window, place: F.struct(window.alias("g"), place.alias("p")))
    sorted_windows = hashed.select(
        "*", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.sort_array(numbered)).alias("_s")
    )
    neighbours = F.arrays_zip(F.col("_s").alias("a"), F.slice(F.col("_s"), F.lit(2), F.size("_s")).alias("b"))
    equal = sorted_windows.select(
        *(name for name in sorted_windows.columns if name not in ("_h", "_s")),
        F.when(
            F.col("_s").isNotNull(),
            F.filter(neighbours, lambda pair: F.coalesce(pair["a"]["g"] == pair["b"]["g"], F.lit(False))),
        ).alias("_e"),
    )
    ends = F.concat(F.transform("_e", lambda pair: pair["a"]["p"]), F.transform("_e", lambda pair: pair["b"]["p"]))
    places = equal.select(
        *(name for name in equal.columns if name != "_e"), F.sort_array(F.array_distinct(ends)).alias("_p")
    )
    all_but_last = F.slice(F.col("_p"), F.lit(1), F.greatest(F.size("_p") - 1, F.lit(0)))
    covered = _total(
        F.transform(
            all_but_last, lambda at, i: F.least(F.lit(WINDOW), F.get(F.col("_p"), i + 1) - at).cast("bigint")
        )
    )
    counts = [
        F.size("_w").cast("bigint").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("bigint").alias("word_chars"),
        _signs(F.col("_t"), SYMBOLS).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.coalesce(F.size("_p"), F.lit(0)) > 0, covered + WINDOW)
        .otherwise(F.lit(0).cast("bigint"))
        .alias("n_repeat_words"),
    ]
    if more:
        same = F.filter(F.col("_w"), lambda word, i: (i > 0) & (word == F.get(F.col("_w"), i - 1)))
        counts += [
            F.length("_t").cast("bigint").alias("n_chars"),
            F.size("_lines").cast("bigint").alias("n_lines"),
            F.size(F.array_intersect(F.col("_w"), F.array(*(F.lit(word) for word in STOP_WORDS))))
            .cast("bigint")
            .alias("n_stop_words"),
            F.size(same).cast("bigint").alias("n_same_neighbours"),
            F.regexp_count("_t", F.lit(r"\p{Lu}")).cast("bigint").alias("n_capitals"),
            _signs(F.col("_t"), "!").alias("n_exclamations"),
            F.size(F.filter("_lines", lambda line: F.btrim(line).rlike(r"^[|*•-]|\|$"))).cast("bigint").alias("n_bar_lines"),
        ]
    return once(places.select(*keep, *counts), keep)


def once(df: DataFrame, keep: list[str]) -> DataFrame:
    """The same rows, their columns beside ``keep`` behind a generator of one element.
    Without it a later filter on a count would be pushed below the projections
    and, its names replaced by what they stand for, compute arrays anew inside
    lambdas."""
    rest = [name for name in df.columns if name not in keep]
    held = df.select(*keep, F.explode(F.array(F.struct(*rest))).alias("_held"))
    return held.select(*keep, "_held.*")
