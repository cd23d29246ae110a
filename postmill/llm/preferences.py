"""Chat formatting (6): preference pairs with one prompt and masked completions.

Two conversations, chosen and rejected, share their first turns. The longest common
prefix of turns is rendered once, as the prompt; what follows in either is its
completion, with the places of what the assistant says as the loss mask.

Turns meet turns by (pair, turn number), so no conversation is in one place before it
is written; a rendered row holds at most ``turns_per_row`` turns of each part, and
longer conversations go on in further rows (``block``). Rows of a pair, put together in
the order of their blocks, are the whole: texts go on where the row before ends,
and places and counts are those of the whole conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: How a turn is written.
OPEN, MIDDLE, CLOSE = "<|", "|>\n", "\n"
SPOKEN = "assistant"
TURNS_PER_ROW = 512


def rendered(role: Column, text: Column) -> Column:
    """One turn as text; null role or text count as empty."""
    none = F.lit("")
    return F.concat(F.lit(OPEN), F.coalesce(role, none), F.lit(MIDDLE), F.coalesce(text, none), F.lit(CLOSE))


def one_per_turn(turns: DataFrame, *keys: str) -> DataFrame:
    """Turns that repeat a number of a conversation give way to the smallest (role, text)."""
    said = F.struct(F.col("role").alias("role"), F.col("text").alias("text"))
    return turns.groupBy(*keys).agg(F.min(said).alias("said"))


def format_pairs(chosen: DataFrame, rejected: DataFrame, turns_per_row: int = TURNS_PER_ROW) -> DataFrame:
    """``pair``, ``block``, ``n_common``, ``prompt``, ``chosen``, ``rejected``, ``chosen_mask``, ``rejected_mask``.

    Both frames have ``pair, turn, role, text``. Masks are arrays of (begin, end), in
    characters of the whole completion, of the assistant's words; ``n_common`` counts the
    turns of the whole prompt. How many rows a pair has, by ``turns_per_row``, changes
    none of them: rows of a pair with their texts and masks joined by ``block`` are
    the same for every value. A turn
    is common if all up to it are equal on both sides, nulls included. A pair
    with one side only has no common turn and an empty other side; equal sides
    have empty completions. Rows without a pair or turn number are left out; an
    empty table gives an empty result. Further columns are not looked at.
    """
    sides = [
        one_per_turn(side.select("pair", "turn", "role", "text").where("pair is not null and turn is not null"), "pair", "turn")
        for side in (chosen, rejected)
    ]
    both = sides[0].withColumnRenamed("said", "c").join(sides[1].withColumnRenamed("said", "r"), ["pair", "turn"], "full")
    first_other = both.groupBy("pair").agg(
        F.min(F.when(~F.col("c").eqNullSafe(F.col("r")), F.col("turn"))).alias("other")
    )
    split = both.join(first_other, "pair").withColumn(
        "common", F.coalesce(F.col("turn") < F.col("other"), F.lit(True))
    )
    # Where each turn goes: the prompt once, or the completion of its side.
    parts = F.when(F.col("common"), F.array(F.struct(F.lit(0).alias("part"), F.col("c").alias("said")))).otherwise(
        F.array(F.struct(F.lit(1).alias("part"), F.col("c").alias("said")), F.struct(F.lit(2).alias("part"), F.col("r").alias("said")))
    )
    placed = split.select("pair", "turn", F.explode(parts).alias("p")).where("p.said is not null")
    # A turn's number says its block; numbers from -1 or 1 on are as good as from 0.
    segment = F.struct(
        F.col("turn"),
        rendered(F.col("p.said.role"), F.col("p.said.text")).alias("shown"),
        F.length(F.concat(F.lit(OPEN), F.coalesce("p.said.role", F.lit("")), F.lit(MIDDLE))).alias("head"),
        F.coalesce(F.col("p.said.role") == SPOKEN, F.lit(False)).alias("spoken"),
    )
    block = F.floor(F.col("turn") / turns_per_row).alias("block")
    keyed = placed.select("pair", block, "p.part", segment.alias("s"))
    gathered = keyed.groupBy("pair", "block").agg(
        *(F.sort_array(F.collect_list(F.when(F.col("part") == part, F.col("s")))).alias(name) for part, name in enumerate("pcr")),
    )

    # Where each row's parts begin in the whole: sums of lengths, a few numbers a row.
    def amount(part: int, what: Column) -> Column:
        return F.sum(F.when(F.col("part") == part, what).otherwise(0)).cast("bigint")

    sums = keyed.groupBy("pair", "block").agg(
        amount(0, F.lit(1)).alias("common"), amount(1, F.length("s.shown")).alias("c_more"), amount(2, F.length("s.shown")).alias("r_more")
    )
    rows_before = Window.partitionBy("pair").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "pair",
        "block",
        F.sum("common").over(Window.partitionBy("pair")).alias("n_common"),
        *(F.coalesce(F.sum(f"{name}_more").over(rows_before), F.lit(0)).alias(f"{name}_start") for name in "cr"),
    )
    gathered = gathered.join(starts, ["pair", "block"])

    def shown(name: str) -> Column:
        return F.array_join(F.transform(name, lambda s: s["shown"]), "")

    def mask(name: str) -> Column:
        nothing = F.array().cast("array<struct<begin:bigint,end:bigint>>")
        start = F.struct(F.col(f"{name}_start").alias("at"), nothing.alias("spans"))

        def step(state: Column, s: Column) -> Column:
            end = state["at"] + F.length(s["shown"])
            span = F.struct((state["at"] + s["head"]).alias("begin"), (end - len(CLOSE)).alias("end"))
            spans = F.when(s["spoken"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
            return F.struct(end.alias("at"), spans.alias("spans"))

        return F.aggregate(name, start, step, lambda state: state["spans"])

    return gathered.select(
        "pair",
        "block",
        "n_common",
        shown("p").alias("prompt"),
        shown("c").alias("chosen"),
        shown("r").alias("rejected"),
        mask("c").alias("chosen_mask"),
        mask("r").alias("rejected_mask"),
    )


def with_swapped_ending(turns: DataFrame) -> DataFrame:
    """A rejected side for each conversation: its own turns, the last one's text replaced
    by the last text of its partner (numbers 2k and 2k + 1 are partners).

    Takes and gives ``pair, turn, role, text``. A conversation without a partner has no
    rejected side.
    """
    own = one_per_turn(turns.select("pair", "turn", "role", "text").where("pair is not null and turn is not null"), "pair", "turn")
    last = own.groupBy("pair").agg(F.max(F.struct("turn", "said")).alias("l"))
    partner = last.select(F.col("pair").bitwiseXOR(F.lit(1)).alias("pair"), F.col("l.said.text").alias("other"))
    ending = last.join(partner, "pair").select("pair", F.col("l.turn").alias("last"), "other")
    return own.join(ending, "pair").select(
        "pair", "turn", F.col("said.role").alias("role"), F.when(F.col("turn") == F.col("last"), F.col("other")).otherwise(F.col("said.text")).alias("text")
    )
