"""Quality rules (8): a table of thresholds that becomes one projection."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm.columns import only
from postmill.llm.metrics import measured_texts


class Rule(NamedTuple):
    """``count`` per ``unit`` (per text when None) must lie within the bounds. With
    ``at_least``, the rule is silent for texts of fewer words than that."""

    name: str
    count: str
    unit: str | None = None
    low: float | None = None
    high: float | None = None
    at_least: int = 0


RULES = (
    Rule("word_count", "n_words", low=10, high=1_000_000),
    Rule("mean_word_length", "word_chars", "n_words", low=2, high=20),
    Rule("symbol_ratio", "n_symbols", "n_words", high=0.1),
    Rule("exclamation_ratio", "n_exclamations", "n_words", high=0.3),
    Rule("capital_ratio", "n_capitals", "word_chars", high=0.4),
    Rule("stop_words", "n_stop_words", low=1, at_least=50),
    Rule("bar_lines", "n_bar_lines", "n_lines", high=0.9, at_least=50),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=0.5),
    Rule("same_neighbours", "n_same_neighbours", "n_words", high=0.3),
)


def passes(rule: Rule) -> Column:
    """One rule as a column, never null: a ratio to nothing counts as 0."""
    value = F.col(rule.count).cast("double")
    if rule.unit is not None:
        value = F.when(F.col(rule.unit) > 0, value / F.col(rule.unit)).otherwise(0.0)
    tests = []
    if rule.low is not None:
        tests.append(value >= rule.low)
    if rule.high is not None:
        tests.append(value <= rule.high)
    verdict = reduce(and_, tests, F.lit(True))
    return or_(F.col("n_words") < rule.at_least, verdict) if rule.at_least else verdict


def base_failed() -> Column:
    """Too short, or over a fifth of the words in repeated five-word windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, all counts, ``base_failed``, ``failed``
    (the names of the rules it breaks, in table order) and ``kept``.

    One narrow projection without user functions: no shuffle, no state. A null
    or empty text has no words and fails; repeated rows are judged each on their
    own; an empty table gives an empty result; other columns are not looked at.
    """
    counted = measured_texts(only(docs, id_col, text_col), text_col, [id_col])
    broken = [F.when(~passes(rule), F.lit(rule.name)) for rule in rules]
    judged = counted.select("*", base_failed().alias("base_failed"), F.array_compact(F.array(*broken)).alias("failed"))
    return judged.select("*", (~F.col("base_failed") & (F.size("failed") == 0)).alias("kept"))
