"""Line dedup (7): a deletion-neighbourhood join over word edits.

A line repeats an earlier one if it equals it or is one word edit away (a word
put in, left out or changed) while both have ``NEAR_WORDS`` words or more. Lines
come in the order of (document id, hash of its text, place in the document). A
line goes as soon as any earlier line, kept or not, is that near; the earliest stays.

Two lines are one edit apart exactly if leaving a word out of one gives the
other, or leaving the word at one place out of both gives the same. So each line
emits the keys of its variants and equal keys meet. Keys are sums of word hashes:
with the word's place in it when both lines lose a word, so that a group of
equal keys holds one-word changes only and its earliest line decides for all;
without places when only one does, and there the pairs, few, are verified.
Four steps keep the join small without losing a pair: equal lines are one
line; a line whose halves no other line shares has no neighbour; of those left,
a word goes only from a part (of ``PARTS``) beside which another line is equal;
texts stay where they are, hashes travel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm.columns import BLANKS, only, stored, text_hash, with_columns_aside, words
from postmill.operators.joins import fits_broadcast
from postmill.session import settings_during

#: Lines of fewer words repeat another only if they are equal.
NEAR_WORDS = 8

#: Parts of a line in which an edit is looked for before words are left out one by one.
PARTS = 8

#: Shuffle files go once the table is written, not when the driver happens to collect garbage.
_CLEANED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

_HALVES = [f"_half{number}" for number in range(4)]

_MASK = (1 << 60) - 1


def _line_key(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("_a"), F.xxhash64(line, F.lit(7)).alias("_b")]


def _document(row_id: Column, text: Column) -> Column:
    """What tells documents apart; a null id equals a null id here."""
    return F.struct(row_id.alias("k"), text_hash(text).alias("h"))


def _masked(value: Column) -> Column:
    return value.bitwiseAND(F.lit(_MASK))


def _sum(hashes: Column) -> Column:
    """Sum modulo 2^60; no step can overflow."""
    return F.aggregate(hashes, F.lit(0).cast("bigint"), lambda total, one: _masked(total + one))


def _written(df: DataFrame, label: str) -> DataFrame:
    """``stored``, without what was shuffled for it."""
    with settings_during(df.sparkSession, _CLEANED):
        return stored(df, label)


def _half(length: Column) -> Column:
    """At most half the words; longer lines in steps, so that lines with one word more
    or less mostly have the same half."""
    half = F.floor(length / 2).cast("int")
    steps = F.when(half < 16, 1).when(half < 32, 2).when(half < 64, 4).when(half < 128, 8).otherwise(16)
    return half - half % steps


def _half_keys(words_col: Column) -> list[Column]:
    """Hashes of as many first and last words as ``_half`` of the line's own length says,
    and of one word less where that differs (else null): of two lines one edit apart,
    the shorter or equal one of n words shares its first or last ``_half(n)`` with the other."""
    n = F.size(words_col)

    def keys(half: Column) -> list[Column]:
        first, last = F.slice(words_col, F.lit(1), half), F.slice(words_col, n - half + 1, half)
        return [F.xxhash64(F.lit(0), half, first), F.xxhash64(F.lit(1), half, last)]

    whole, less = _half(n), _half(n - 1)
    shorter = (n > NEAR_WORDS) & (less != whole)
    return [*(F.when(n >= NEAR_WORDS, key) for key in keys(whole)), *(F.when(shorter, key) for key in keys(less))]


def _bound(length: Column, part: Column) -> Column:
    """Place of the first word of a part."""
    return F.floor(length * part / PARTS).cast("int")


def _rest_key(words_col: Column, less: Column, part: Column) -> Column:
    """Hash of the words before and behind a part of a line of ``less`` words fewer (null
    for less than ``NEAR_WORDS``). Two lines one edit apart have an equal one: that of
    the part with the edit, for the length of the shorter or equal line."""
    n = F.size(words_col)
    length = n - less
    behind = length - _bound(length, part + 1)
    before, after = F.slice(words_col, F.lit(1), _bound(length, part)), F.slice(words_col, n - behind + 1, behind)
    return F.when(length >= NEAR_WORDS, F.xxhash64(length, part, before, after))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each document (id and hash of the text, as an id may be null or stand for several
    texts) and its text."""
    whole = F.coalesce(F.col(text_col), F.lit("")).alias("_text")
    read = only(docs, id_col, text_col).select(F.col(id_col).alias("_id"), whole)
    return read.select(_document(F.col("_id"), F.col("_text")).alias("_doc"), "_text")


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line that has a word: its document, place from 0, the line and its key."""
    hashed = _texts(docs, id_col, text_col)
    lines = hashed.select("_doc", F.posexplode(F.split("_text", "\n")).alias("_pos", "_line"))
    has_word = F.btrim(F.col("_line"), F.lit(BLANKS)) != ""
    return lines.where(has_word).select("_doc", "_pos", "_line", *_line_key(F.col("_line")))


def distinct_lines(lines: DataFrame) -> DataFrame:
    """One row per distinct line that is there several times or long enough to have
    neighbours: key, number of places, and the half keys of the long ones (else null)."""
    with_words = lines.select("_a", "_b", words(F.col("_line")).alias("_w"))
    halves = [key.alias(name) for name, key in zip(_HALVES, _half_keys(F.col("_w")), strict=True)]
    # Numbers only: what a hash aggregate can hold without sorting.
    counted = with_words.select("_a", "_b", *halves).groupBy("_a", "_b").agg(
        F.count(F.lit(1)).alias("_times"), *(F.min(name).alias(name) for name in _HALVES)
    )
    return counted.where((F.col("_times") > 1) | F.col(_HALVES[0]).isNotNull())


def _shared_halves(distinct: DataFrame) -> DataFrame:
    """First halves of the keys (``_a``) of the lines that share a half with another line;
    lines that have only ``_a`` in common with one come along and do no harm."""
    halves = distinct.select("_a", F.explode(F.array(*_HALVES)).alias("_half")).where(F.col("_half").isNotNull())
    shared = halves.groupBy("_half").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_half")
    return halves.join(shared, "_half", "left_semi").select("_a").distinct()


def _with_parts(live: DataFrame) -> DataFrame:
    """The lines that are equal to another one beside a part, with the numbers of such parts:
    ``_own`` for lines as long as this or longer, ``_shorter`` for lines with a word less."""
    # A row per part: as one array of all keys the code gets too long to be compiled.
    numbered = live.select("_key", "_w", F.explode(F.sequence(F.lit(0), F.lit(2 * PARTS - 1))).alias("_number"))
    less, part = F.floor(F.col("_number") / PARTS).cast("int"), F.col("_number") % PARTS
    each = numbered.select("_key", "_w", less.alias("_less"), part.alias("_part"))
    keyed = each.select("_key", "_less", "_part", _rest_key(F.col("_w"), F.col("_less"), F.col("_part")).alias("_rest"))
    rests = keyed.where(F.col("_rest").isNotNull())
    shared = rests.groupBy("_rest").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_rest")
    parts = rests.join(shared, "_rest", "left_semi").groupBy("_key").agg(
        F.collect_set(F.when(F.col("_less") == 0, F.col("_part"))).alias("_own"),
        F.collect_set(F.when(F.col("_less") == 1, F.col("_part"))).alias("_shorter"),
    )
    return live.join(parts, "_key")


def _in_parts(place: Column, length: Column, parts: Column, behind: int) -> Column:
    """Whether a place is in one of the parts, or at most ``behind`` words behind it."""
    return F.exists(
        parts, lambda part: (place >= _bound(length, part)) & (place < _bound(length, part + 1) + behind)
    )


def _variants(live: DataFrame) -> DataFrame:
    """One row per (line, word left out): the key with places, the key without; null
    where no other line is equal beside the part the word is in."""
    hashed = live.select(
        "_key",
        "_first",
        "_own",
        "_shorter",
        F.transform("_w", lambda word, place: _masked(F.xxhash64(word, place))).alias("_placed"),
        F.transform("_w", lambda word: _masked(F.xxhash64(word))).alias("_plain"),
    )
    summed = hashed.select(
        "_key",
        "_first",
        "_own",
        "_shorter",
        F.size("_placed").alias("_n"),
        F.arrays_zip("_placed", "_plain").alias("_each"),
        _sum(F.col("_placed")).alias("_sum_placed"),
        _sum(F.col("_plain")).alias("_sum_plain"),
    )
    one = summed.select("*", F.posexplode("_each").alias("_place", "_word")).drop("_each")
    n, place = F.col("_n"), F.col("_place")
    changed = F.xxhash64("_n", "_place", _masked(F.col("_sum_placed") - F.col("_word._placed") + F.lit(_MASK + 1)))
    left = F.xxhash64(n - 1, _masked(F.col("_sum_plain") - F.col("_word._plain") + F.lit(_MASK + 1)))
    keyed = one.select(
        "_key",
        "_first",
        F.when(_in_parts(place, n, F.col("_own"), 0), changed).alias("_changed"),
        F.when(_in_parts(place, n - 1, F.col("_shorter"), 1), left).alias("_left"),
    )
    return keyed.where(F.col("_changed").isNotNull() | F.col("_left").isNotNull())


def _common(a: Column, b: Column) -> Column:
    """How many leading words two lists share."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    shorter = F.least(F.size(a), F.size(b))
    first_other = F.array_position(same, False)
    return F.when(first_other == 0, shorter).otherwise(F.least(first_other - 1, shorter))


def one_edit_apart(a: Column, b: Column) -> Column:
    """Whether two lists of words are at most one edit apart: the words they share
    from the front and from the back cover all but one of the longer list."""
    close = F.abs(F.size(a) - F.size(b)) <= 1
    covered = _common(a, b) + _common(F.reverse(a), F.reverse(b))
    return close & (covered >= F.greatest(F.size(a), F.size(b)) - 1)


def _words_of(texts: DataFrame, firsts: DataFrame) -> DataFrame:
    """Key, first place and words of the distinct lines ``firsts``. Documents meet the
    places asked for in them, and only those lines are taken out."""
    at = F.struct(F.col("_first._pos").alias("_pos"), "_a", "_b")
    wanted = firsts.groupBy(F.col("_first._doc").alias("_doc")).agg(F.collect_list(at).alias("_wanted"))
    met = texts.join(F.broadcast(wanted) if fits_broadcast(firsts) else wanted, "_doc")
    # The generator of one element keeps the split from being done again for every line.
    split = met.select("_doc", "_wanted", F.explode(F.array(F.split("_text", "\n"))).alias("_lines"))
    each = F.transform(
        "_wanted",
        lambda one: F.struct(one["_a"].alias("_a"), one["_b"].alias("_b"), one["_pos"].alias("_pos"), F.get(F.col("_lines"), one["_pos"]).alias("_line")),
    )
    found = split.select("_doc", F.inline(each))
    return found.dropDuplicates(["_a", "_b"]).select(
        F.struct("_a", "_b").alias("_key"), F.struct("_doc", "_pos").alias("_first"), words(F.col("_line")).alias("_w")
    )


def _near_repeats(texts: DataFrame, firsts: DataFrame) -> DataFrame:
    """Keys of those of the distinct lines ``firsts`` that have an earlier one among
    them one edit away."""
    live = _written(_words_of(texts, firsts), "line-live")
    live = _written(_with_parts(live), "line-parts")
    variants = _written(_variants(live), "line-variants")

    # A word changed: all lines of a group are one edit from its earliest.
    one_changed = variants.where(F.col("_changed").isNotNull()).select("_key", "_first", "_changed")
    earliest = one_changed.groupBy("_changed").agg(F.min("_first").alias("_earliest"), F.count(F.lit(1)).alias("_n"))
    groups = earliest.where("_n > 1").select("_changed", "_earliest")
    changed = one_changed.join(groups, "_changed").where(F.col("_earliest") < F.col("_first")).select("_key")

    # A word put in or left out: the whole line meets the longer line's variants.
    whole = live.where(F.size("_own") > 0).select(
        F.col("_key").alias("_short"),
        F.xxhash64(F.size("_w"), _sum(F.transform("_w", lambda word: _masked(F.xxhash64(word))))).alias("_left"),
    )
    one_left = variants.where(F.col("_left").isNotNull()).select("_left", F.col("_key").alias("_long"))
    pairs = one_left.distinct().join(whole, "_left").select("_short", "_long")
    shorts = live.select(F.col("_key").alias("_short"), F.col("_first").alias("_first_s"), F.col("_w").alias("_w_s"))
    longs = live.select(F.col("_key").alias("_long"), F.col("_first").alias("_first_l"), F.col("_w").alias("_w_l"))
    checked = (
        pairs.join(shorts, "_short").join(longs, "_long").where(one_edit_apart(F.col("_w_s"), F.col("_w_l")))
    )
    later = F.when(F.col("_first_l") > F.col("_first_s"), F.col("_long")).otherwise(F.col("_short"))
    return changed.unionByName(checked.select(later.alias("_key"))).distinct().select("_key._a", "_key._b")


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Places of the lines that repeat an earlier one: ``id_col``, ``text_hash`` (struct),
    ``places`` (array).

    Lines without a word are never repeats. Rows with the same id and the same text
    are one document, so what stands at the same place in two of them is no repeat
    of itself; different texts under one id, or without id, are documents of their
    own. A null id sorts first.
    """
    lines = lines_of(docs, id_col, text_col)
    distinct = _written(distinct_lines(lines), "lines")
    sharing = _written(_shared_halves(distinct), "line-halves")
    many = distinct.where("_times > 1").select("_a")
    # Only places of lines that may go, or keep others from staying, are looked at further.
    wanted = many.unionByName(sharing).distinct()
    places = _written(lines.select("_a", "_b", "_doc", "_pos").join(wanted, "_a", "left_semi"), "line-places")
    firsts = _written(places.groupBy("_a", "_b").agg(F.min(F.struct("_doc", "_pos")).alias("_first")), "line-firsts")
    near_some = firsts.join(sharing, "_a", "left_semi")
    near = _written(_near_repeats(_texts(docs, id_col, text_col), near_some), "lines-near")
    marked = firsts.join(near.withColumn("_near", F.lit(True)), ["_a", "_b"], "left")
    gone = places.join(marked, ["_a", "_b"]).where(
        F.col("_near").isNotNull() | ~F.struct("_doc", "_pos").eqNullSafe(F.col("_first"))
    )
    found = gone.groupBy("_doc").agg(F.sort_array(F.collect_set("_pos")).alias("places"))
    return found.select(F.col("_doc.k").alias(id_col), F.col("_doc.h").alias("text_hash"), "places")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, the text without its repeated lines, and
    ``n_lines``, ``n_removed`` beside them (after the columns of ``docs``).

    Repeated rows stay repeated; a null text stays null and has no lines; a
    document may lose all its lines and then has the empty text. Columns of the
    caller may have any name. An empty table gives an empty result.
    """
    aside, old, new = with_columns_aside(docs)
    key, text = new[id_col], new[text_col]
    places = repeated_lines(docs, id_col, text_col).toDF("k", "h", "_places").select(F.struct("k", "h").alias("_doc"), "_places")
    both = aside.withColumn("_doc", _document(F.col(key), F.col(text))).join(places, "_doc", "left")
    split = both.select(
        *aside.columns,
        F.coalesce("_places", F.array().cast("array<int>")).alias("_gone"),
        F.split(F.coalesce(F.col(text), F.lit("")), "\n").alias("_lines"),
    )
    rest = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    kept = F.array_join(F.transform(rest, lambda place: F.get(F.col("_lines"), place)), "\n")
    cleaned = F.when(F.size("_gone") == 0, F.col(text)).otherwise(kept)
    n_lines = F.size(F.filter("_lines", lambda line: F.btrim(line, F.lit(BLANKS)) != ""))
    result = split.select(
        *(cleaned.alias(text) if name == text else F.col(name) for name in aside.columns),
        n_lines.cast("bigint").alias("n_lines"),
        F.size("_gone").cast("bigint").alias("n_removed"),
    )
    return result.toDF(*old, "n_lines", "n_removed")
