"""MinHash near-dedup (10): consistent weighted sampling over TF-IDF shingles.

A document is a bag of five-word shingles, each weighing its count times its
inverse document frequency. Improved consistent weighted sampling draws, per
sample, one (shingle, level) pair such that two documents draw the same with
the probability of their weighted Jaccard similarity. Three samples make a
band, documents with an equal band meet, pairs that meet are verified by their
exact weighted Jaccard similarity, and verified links join into classes.

Document frequencies. Frequencies count for shingles in more than 1 of
``RARE`` documents; rarer ones all have the top weight, so there are at most
``RARE`` times the mean number of shingles of those. They are counted exactly in two
passes: a shingle that is that frequent overall is in more than an equal share of so many
texts in one chunk at least, so chunks name candidates, which then are counted over all.
The weight falls from ``1 + IDF_STRENGTH`` to 1 only, so that copies
in a group of thousands, whose shingles are frequent for that very reason,
stay about as similar as they are by shingles alone.

Large groups. Equal texts are one text. In a band's group of at most
``SMALL_GROUP`` texts all meet. Texts of larger groups are banded anew, with more
samples to a band and more bands, which parts those that share one passage.
If such a group is still large, all its texts meet its first ``LEADERS`` texts, in
the order of a hash; those that do not come out in the class of most then meet
all the others. Nobody else in it can add a link between classes.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postmill.llm.columns import only, stored, text_hash, with_columns_aside
from postmill.llm.components import components
from postmill.llm.wordhash import TEXTS_AT_ONCE, distinct_per_text, hash_words, mix, windows
from postmill.operators.joins import fits_broadcast

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 8, 3
#: Texts in a group of over SMALL_GROUP are banded anew, more sharply, as what they share may be one passage.
SHARP_BANDS, SHARP_ROWS = 16, 6
RARE = 1000
#: Chunks hold so many times RARE texts on average.
CHUNK = 20
IDF_STRENGTH = 0.25
SMALL_GROUP = 24
LEADERS = 2
BLOCK = 200

#: Few texts are hashed at a time, whatever the size of a batch, unless one is larger.
_BYTES_AT_ONCE = 4_000_000
#: A round of counting in a chunk takes at least so many shingles, and ``RARE`` texts.
_SHINGLES_AT_ONCE = 1_000_000


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """65,536 evenly spaced quantiles of the Gamma(2, 1) distribution, by bisection,
    and their logarithms."""
    u = (np.arange(65536) + 0.5) / 65536
    low, high = np.zeros_like(u), np.full_like(u, 40.0)
    for _ in range(60):
        mid = (low + high) / 2
        below = 1 - (1 + mid) * np.exp(-mid) < u
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    return low.astype(np.float32), np.log(low).astype(np.float32)


_GAMMA, _LOG_GAMMA = _tables()


class Weights:
    """Shingle weights: document frequencies of the frequent ones and the number of documents."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, n_docs: int) -> None:
        order = np.argsort(hashes)
        self.hashes, self.n_docs = hashes[order], max(n_docs, 1)
        self.idf = self._idf(counts[order].astype(np.float64))

    def _idf(self, counts: np.ndarray) -> np.ndarray:
        rarity = np.log(np.maximum(self.n_docs / np.maximum(counts, 1), 1)) / math.log(RARE)
        return 1 + IDF_STRENGTH * np.minimum(rarity, 1)

    def sent(self, spark: SparkSession) -> Broadcast:
        """Plain arrays, for every executor."""
        return spark.sparkContext.broadcast((self.hashes, self.idf))

    @staticmethod
    def given(arrays: tuple[np.ndarray, np.ndarray]) -> Weights:
        weights = Weights.__new__(Weights)
        weights.hashes, weights.idf = arrays
        return weights

    def of(self, hashes: np.ndarray, times: np.ndarray) -> np.ndarray:
        idf = np.full(len(hashes), 1 + IDF_STRENGTH)
        if len(self.hashes) and len(hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            idf = np.where(self.hashes[at] == hashes, self.idf[at], idf)
        return idf * times


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut batches so that few texts, or few bytes, are in work at a time."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
        begin, held = 0, 0
        for i, size in enumerate(sizes):
            if i > begin and (held + size > _BYTES_AT_ONCE or i - begin >= TEXTS_AT_ONCE):
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += size
        if batch.num_rows > begin:
            yield batch.slice(begin)


def _shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return distinct_per_text(*windows(hash_words(texts), SHINGLE))


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


class _Survivors:
    """Shingles that may be in more than ``most`` of a chunk's texts, with upper bounds.

    After each round of texts those go that can have been in no more texts than
    there were rounds, which lifts the bound of any that come back by so many.
    Rounds that drop end at ``most``, so none in more texts is ever lost.
    """

    def __init__(self, most: int) -> None:
        self.most, self.rounds = most, 0
        self.hashes, self.upper = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, parts: list[np.ndarray]) -> None:
        """One round: the distinct shingles of each of some texts."""
        new, counts = np.unique(np.concatenate(parts), return_counts=True)
        at = np.searchsorted(self.hashes, new)
        if len(self.hashes):
            known = self.hashes[np.minimum(at, len(self.hashes) - 1)] == new
            self.upper[at[known]] += counts[known]
            new, counts, at = new[~known], counts[~known], at[~known]
        self.hashes, self.upper = np.insert(self.hashes, at, new), np.insert(self.upper, at, counts + self.rounds)
        if self.rounds < self.most:
            self.rounds += 1
            self._keep(self.rounds)

    def _keep(self, above: int) -> None:
        stay = self.upper > above
        self.hashes, self.upper = self.hashes[stay], self.upper[stay]

    def found(self) -> np.ndarray:
        self._keep(self.most)
        return self.hashes


def frequent_shingles(texts: DataFrame, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document frequency of the shingles in over ``n_docs / RARE`` texts, exact.

    Two scans. A task is one chunk; chunks are joined, without a shuffle, until they
    hold ``CHUNK * RARE`` texts on average. A shingle in more than ``n_docs / RARE`` texts
    is in more than an equal share of that, ``CHUNK`` at least, in some chunk.
    """
    chunks = max(1, min(texts.rdd.getNumPartitions(), n_docs // (CHUNK * RARE)))
    least = max(n_docs / RARE, 1)
    most = max(1, int(n_docs / RARE / chunks))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        survivors, parts, held, n = _Survivors(most), [], 0, 0
        for piece in _pieces(batches):
            parts.append(_shingles(piece.column("text"))[0])
            held, n = held + len(parts[-1]), n + piece.num_rows
            if held >= _SHINGLES_AT_ONCE and n >= RARE:
                survivors.add(parts)
                parts, held, n = [], 0, 0
        if parts:
            survivors.add(parts)
        yield pa.record_batch([_signed(survivors.found())], names=["s"])

    named = stored(texts.coalesce(chunks).mapInArrow(candidates, "s bigint").distinct(), "shingle-candidates")
    if fits_broadcast(named, rows=2_000_000):
        sent = texts.sparkSession.sparkContext.broadcast(
            np.sort(named.toPandas()["s"].to_numpy(dtype=np.int64).view(np.uint64))
        )

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = sent.value
            totals = np.zeros(len(known), dtype=np.int64)
            for piece in _pieces(batches):
                hashes = _shingles(piece.column("text"))[0]
                if len(known) and len(hashes):
                    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                    totals += np.bincount(at[known[at] == hashes], minlength=len(known))
            seen = np.flatnonzero(totals)
            yield pa.record_batch([_signed(known[seen]), pa.array(totals[seen])], names=["s", "n"])

        parts = texts.mapInArrow(counted, "s bigint, n bigint")
    else:  # so varied a corpus that chunks do not narrow it down: count them all

        def all_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for piece in _pieces(batches):
                hashes, counts = np.unique(_shingles(piece.column("text"))[0], return_counts=True)
                yield pa.record_batch([_signed(hashes), pa.array(counts.astype(np.int64))], names=["s", "n"])

        parts = texts.mapInArrow(all_shingles, "s bigint, n bigint")
    rows = parts.groupBy("s").agg(F.sum("n").alias("n")).where(F.col("n") > least).toPandas()
    return rows["s"].to_numpy(dtype=np.int64).view(np.uint64), rows["n"].to_numpy(dtype=np.int64)


def weigh(texts: DataFrame) -> Weights:
    """Document frequencies of distinct texts with a word in them."""
    n_docs = texts.count()
    return Weights(*frequent_shingles(texts, n_docs), n_docs)


def _samples(hashes: np.ndarray, weights: np.ndarray, begins: np.ndarray, k: int) -> np.ndarray:
    """Sample ``k`` of every text: 32 bits of the (shingle, level) drawn.

    A shingle's variates come from bits of one hash of it, so they are the same
    in every text. The smallest value wins, found together with what is drawn by
    putting both in one number: a positive float orders like its bits.
    """
    bits = mix(hashes * np.uint64(2 * k + 1) + np.uint64(0x9E3779B97F4A7C15 * (k + 1) & (2**64 - 1)))
    r = _GAMMA[(bits & np.uint64(0xFFFF)).astype(np.int64)]
    log_c = _LOG_GAMMA[((bits >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.int64)]
    beta = ((bits >> np.uint64(32)) & np.uint64(0xFFFFFF)).astype(np.float32) / np.float32(2**24)
    level = np.floor(weights / r + beta)
    value = log_c - r * (level - beta + 1) + np.float32(64)
    drawn = (hashes ^ (level.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) & np.uint64(0xFFFFFFFF)
    both = (np.maximum(value, np.float32(0)).view(np.uint32).astype(np.uint64) << np.uint64(32)) | drawn
    return np.minimum.reduceat(both, begins) & np.uint64(0xFFFFFFFF)


def _blocks(begins: np.ndarray, n: int, size: int = 1 << 15) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about ``size`` shingles, which stay in the cache."""
    i = 0
    while i < len(begins):
        j = max(i + 1, int(np.searchsorted(begins, begins[i] + size, side="right")) - 1)
        yield i, j
        i = j


def band_keys(
    texts: DataFrame, weights: Weights, bands: int = BANDS, rows: int = ROWS, first_sample: int = 0
) -> DataFrame:
    """``id``, ``band``: the keys of every text's bands; none for a text without words."""
    given = weights.sent(texts.sparkSession)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh_all = Weights.given(given.value)
        for piece in _pieces(batches):
            hashes, owner, times = _shingles(piece.column("text"))
            if not len(hashes):
                continue
            logs = np.log(weigh_all.of(hashes, times)).astype(np.float32)
            at = np.flatnonzero(np.diff(owner, prepend=-1))
            texts_at = owner[at]
            keys = np.zeros((len(at), bands), dtype=np.uint64)
            for i, j in _blocks(at, len(hashes)):
                low, high = at[i], at[j] if j < len(at) else len(hashes)
                for k in range(bands * rows):
                    drawn = _samples(hashes[low:high], logs[low:high], at[i:j] - low, first_sample + k)
                    keys[i:j, k // rows] = mix(keys[i:j, k // rows] * np.uint64(31) + drawn + np.uint64(k + 1))
            ids = piece.column("id").take(pa.array(np.repeat(texts_at, bands)))
            yield pa.record_batch([ids, _signed(keys.reshape(-1))], names=["id", "band"])

    return texts.select("id", "text").mapInArrow(draw, "id bigint, band bigint")


def _sized(bands: DataFrame) -> DataFrame:
    return bands.groupBy("band").agg(F.count(F.lit(1)).alias("n"))


def pairs_of_small_groups(bands: DataFrame) -> DataFrame:
    """``a``, ``b``: all pairs within groups of at most ``SMALL_GROUP`` texts."""
    small = _sized(bands).where((F.col("n") > 1) & (F.col("n") <= SMALL_GROUP)).select("band")
    grouped = bands.join(small, "band").groupBy("band").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    held = grouped.select(F.posexplode("ids").alias("i", "a"), "ids")
    return held.select("a", F.explode(F.slice("ids", F.col("i") + 2, F.lit(SMALL_GROUP))).alias("b"))


def in_large_groups(bands: DataFrame) -> DataFrame:
    """``band``, ``id`` of the groups of more than ``SMALL_GROUP`` texts."""
    return bands.join(_sized(bands).where(F.col("n") > SMALL_GROUP).select("band"), "band")


def pairs_with_leaders(bands: DataFrame) -> DataFrame:
    """``a``, ``b``: the leaders of each large group with all texts of it.

    A group's leaders are its first texts by hash; the hash does not depend on
    the group, so that groups of the same texts have the same leaders.
    """
    large = in_large_groups(bands)
    first = _leaders(large).withColumnRenamed("id", "a")
    led = large.withColumnRenamed("id", "b").join(first, "band").where("a <> b")
    return led.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _leaders(large: DataFrame) -> DataFrame:
    """The first texts of each group; the window's limit also holds before the shuffle."""
    order = Window.partitionBy("band").orderBy(F.xxhash64("id"), "id")
    return large.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= LEADERS).drop("_r")


def links_of_rest(
    bands: DataFrame, classes: DataFrame, texts: DataFrame, weights: Weights, threshold: float = THRESHOLD
) -> DataFrame:
    """``a``, ``b``: verified links between classes in large groups that hold several.

    The texts outside a group's main class meet all texts of the group, both sides
    dealt into blocks of about ``BLOCK``; a task compares one block with one
    other and returns, per text, one link to each class it finds near. No pair
    becomes a row. Where each group is one class there is nothing to do.
    """
    large = in_large_groups(bands).join(classes.select(F.col("node").alias("id"), "root"), "id", "left")
    large = stored(large.select("band", "id", F.coalesce("root", "id").alias("root")), "dup-groups")
    per_class = large.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"))
    main = per_class.groupBy("band").agg(
        F.max(F.struct("n", "root")).alias("m"), F.count(F.lit(1)).alias("classes"), F.sum("n").alias("all")
    )
    blocks = main.where("classes > 1").select(
        "band",
        F.col("m.root").alias("main"),
        F.ceil((F.col("all") - F.col("m.n")) / BLOCK).cast("int").alias("n_outside"),
        F.ceil(F.col("all") / BLOCK).cast("int").alias("n_all"),
    )
    split = large.join(blocks, "band")
    place = F.xxhash64("id")

    def dealt(rows: DataFrame, own: str, other: str, outside: bool) -> DataFrame:
        mine = F.pmod(place, F.col(own)).cast("int")
        theirs = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        left, right = ("_l", "_r") if outside else ("_r", "_l")
        return rows.select("band", "id", "root", mine.alias(left), theirs.alias(right)).select(
            "band", "_l", "_r", "id", "root", F.lit(outside).alias("outside")
        )

    both = dealt(split.where("root <> main"), "n_outside", "n_all", True).unionByName(
        dealt(split, "n_all", "n_outside", False)
    )
    ids = stored(split.select("id").distinct(), "dup-split")
    needed = texts.join(F.broadcast(ids) if fits_broadcast(ids) else ids, "id", "left_semi").dropDuplicates(["id"])
    given = weights.sent(texts.sparkSession)

    def compare(block: pa.Table) -> pa.Table:
        outside = block.column("outside").to_numpy().astype(bool)
        left, right = block.filter(pa.array(outside)), block.filter(pa.array(~outside))
        return _links_between(left, right, Weights.given(given.value), threshold)

    filled = both.join(needed.select("id", "text"), "id")
    return filled.groupBy("band", "_l", "_r").applyInArrow(compare, "a bigint, b bigint").distinct()


def _links_between(left: pa.Table, right: pa.Table, weights: Weights, threshold: float) -> pa.Table:
    """For each text of ``left``, one text of each other class in ``right`` that is near."""
    sides = []
    for side in (left, right):
        parts = []
        for begin in range(0, side.num_rows, TEXTS_AT_ONCE):
            hashes, owner, times = _shingles(side.column("text").slice(begin, TEXTS_AT_ONCE).combine_chunks())
            parts.append((hashes, owner + begin, times))
        hashes, owner, times = (np.concatenate(part) for part in zip(*parts, strict=True)) if parts else _shingles(pa.array([], pa.string()))
        weight = weights.of(hashes, times)
        total = np.bincount(owner, weights=weight, minlength=side.num_rows)
        ids, roots = side.column("id").to_numpy(), side.column("root").to_numpy()
        sides.append((hashes, owner, weight, total, ids, roots))
    (h, o, w, total_l, ids_l, roots_l), (hr, o_r, wr, total_r, ids_r, roots_r) = sides
    order = np.argsort(hr, kind="stable")
    hr, o_r, wr = hr[order], o_r[order], wr[order]
    found: list[tuple[int, int]] = []
    bounds = np.searchsorted(o, np.arange(left.num_rows + 1))
    for i in range(left.num_rows):
        own = slice(bounds[i], bounds[i + 1])
        low, high = np.searchsorted(hr, h[own], "left"), np.searchsorted(hr, h[own], "right")
        n = high - low
        at = np.arange(n.sum()) + np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) if len(n) else np.zeros(0, int)
        shared = np.bincount(o_r[at], weights=np.minimum(np.repeat(w[own], n), wr[at]), minlength=right.num_rows)
        similar = shared / np.maximum(total_l[i] + total_r - shared, 1e-12)
        near = np.flatnonzero((similar >= threshold - 1e-9) & (roots_r != roots_l[i]))
        if len(near):
            _, first = np.unique(roots_r[near], return_index=True)
            found += [(int(ids_l[i]), int(ids_r[k])) for k in near[first]]
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def verified(pairs: DataFrame, texts: DataFrame, weights: Weights, threshold: float = THRESHOLD) -> DataFrame:
    """``a``, ``b``, ``similarity`` of the pairs whose weighted Jaccard similarity reaches
    the threshold. Only texts that are in a pair are shuffled."""
    pairs = stored(pairs, "dup-pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    found = texts.join(F.broadcast(ids) if fits_broadcast(ids) else ids, "id", "left_semi")
    needed = stored(found.dropDuplicates(["id"]), "dup-texts")
    given = weights.sent(texts.sparkSession)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh_all = Weights.given(given.value)
        for whole in batches:
            for begin in range(0, whole.num_rows, 128):
                batch = whole.slice(begin, 128)
                scores = _similarities(batch.column("text_a"), batch.column("text_b"), weigh_all)
                near = np.flatnonzero(scores >= threshold - 1e-9)
                at = pa.array(near)
                yield pa.record_batch(
                    [batch.column("a").take(at), batch.column("b").take(at), pa.array(scores[near])],
                    names=["a", "b", "similarity"],
                )

    with_a = pairs.join(needed.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    both = with_a.join(needed.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(compare, "a bigint, b bigint, similarity double")


def _similarities(a: pa.Array, b: pa.Array, weights: Weights) -> np.ndarray:
    """Weighted Jaccard similarity of each pair: both sides' shingles in one sorted list,
    where the ones they share stand next to each other."""
    n = len(a)
    left, right = _shingles(a), _shingles(b)
    hashes, owner = np.concatenate([left[0], right[0]]), np.concatenate([left[1], right[1]])
    weight = weights.of(hashes, np.concatenate([left[2], right[2]]))
    order = np.lexsort((hashes, owner))
    hashes, owner, weight = hashes[order], owner[order], weight[order]
    total = np.bincount(owner, weights=weight, minlength=n)
    same = np.flatnonzero((hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])) if len(hashes) else []
    shared = np.bincount(owner[same], weights=np.minimum(weight[same], weight[np.asarray(same) + 1]), minlength=n) if len(same) else np.zeros(n)
    return shared / np.maximum(total - shared, 1e-12)


#: Ids from here on stand for null ids and ids of several texts, one per text.
_NAMELESS = 1 << 62


def near_duplicate_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``class_id`` (the smallest id of the class).

    Equal texts are always one class. A null text counts as empty; texts without
    words are near only to equal ones. A row without id has the class of its
    text, null if nobody in it has an id. Repeated rows each get their class;
    different texts under one id are documents of their own, so that id may be
    the smallest of several classes. An empty table gives an empty result;
    further columns are not looked at.
    """
    rows, several = _rooted(docs, id_col, text_col, threshold)
    if not several:
        return rows.select(F.col("doc").alias(id_col), F.when(F.col("root") < _NAMELESS, F.col("root")).alias("class_id"))
    rows = stored(rows, "dup-rooted")
    least = rows.groupBy("root").agg(F.min(F.col("doc").cast("bigint")).alias("class_id"))
    return rows.join(least, "root").select(F.col("doc").alias(id_col), "class_id")


def _numbered(rows: DataFrame, shared: DataFrame | None, hash_col: Column) -> DataFrame:
    """Add ``id``, a number of the row's text: its ``doc``, unless that is null or stands
    for several texts; then one made from the text."""
    own = F.col("doc").cast("bigint")
    stand_in = F.lit(_NAMELESS) + hash_col.bitwiseAND(F.lit(_NAMELESS - 1))
    if shared is None:
        return rows.withColumn("id", F.coalesce(own, stand_in))
    joined = rows.join(shared, own == F.col("_shared"), "left")
    return joined.withColumn("id", F.coalesce(F.when(F.col("_shared").isNull(), own), stand_in)).drop("_shared")


def _rooted(docs: DataFrame, id_col: str, text_col: str, threshold: float) -> tuple[DataFrame, bool]:
    """One row per row of ``docs``: its id ``doc``, the hash ``key`` of its text and the
    ``root`` of its class, a number no other class has; and whether some id stands
    for several texts. If none does, a root is the smallest id of its class."""
    whole = F.coalesce(F.col(text_col), F.lit(""))
    read = only(docs, id_col, text_col).select(F.col(id_col).alias("doc"), whole.alias("text"))
    keyed = stored(read.select("doc", text_hash(F.col("text")).alias("key")), "dup-keys")
    ranges = keyed.groupBy(F.col("doc").cast("bigint").alias("_shared")).agg(
        *(how(f"key.{half}").alias(f"{name}_{half}") for half in "ab" for name, how in (("low", F.min), ("high", F.max)))
    )
    differ = F.col("_shared").isNotNull() & ((F.col("low_a") < F.col("high_a")) | (F.col("low_b") < F.col("high_b")))
    shared = stored(ranges.where(differ).select("_shared"), "dup-shared-ids")
    several = not shared.isEmpty()
    side = (F.broadcast(shared) if fits_broadcast(shared) else shared) if several else None
    texts = _numbered(read, side, F.xxhash64("text"))
    # Equal texts are one text, named by the smallest id among them.
    keyed = _numbered(keyed, side, F.col("key.a"))
    same = keyed.groupBy("key").agg(F.min("id").alias("rep"))
    members = stored(keyed.join(same, "key").select("doc", "key", "id", "rep"), "dup-members")
    firsts = members.where("id = rep").select("id").distinct()

    weights = weigh(texts)
    bands = band_keys(texts, weights).distinct().join(firsts, "id", "left_semi")
    bands = stored(bands, "dup-bands")
    crowded = stored(in_large_groups(bands).select("id").distinct(), "dup-crowded")
    crowded_texts = texts.join(F.broadcast(crowded) if fits_broadcast(crowded) else crowded, "id", "left_semi")
    sharp = band_keys(crowded_texts, weights, SHARP_BANDS, SHARP_ROWS, BANDS * ROWS).distinct()
    sharp = stored(sharp, "dup-bands-sharp")
    pairs = pairs_of_small_groups(bands).unionByName(pairs_of_small_groups(sharp)).unionByName(pairs_with_leaders(sharp))
    links = stored(verified(pairs.distinct(), texts, weights, threshold), "dup-links")
    classes = components(links)
    more = stored(links_of_rest(sharp, classes, texts, weights, threshold), "dup-links-rest")
    if not more.isEmpty():
        classes = components(links.select("a", "b").unionByName(more))
    found = members.join(classes.withColumnRenamed("node", "rep"), "rep", "left")
    return found.select("doc", "key", F.coalesce("root", "rep").alias("root")), several


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """One row of ``docs`` per class, all columns kept: that with the smallest id.

    Rows without id come after all others. Of several texts of a class under one
    id, the first by hash stays; of rows equal in id and text, the first by a hash
    of all columns.
    """
    rows, _ = _rooted(docs, id_col, text_col, threshold)
    order = F.struct(F.col("doc").isNull().alias("last"), F.col("doc").alias("k"), F.col("key").alias("h"))
    held = stored(rows.groupBy("root", order.alias("_at")).agg(F.count(F.lit(1)).alias("_n")), "dup-held")
    best = held.groupBy("root").agg(F.min("_at").alias("_best"), F.count(F.lit(1)).alias("_members"))
    others = held.join(best.where("_members > 1"), "root").where("_at <> _best")
    doc = F.struct("_at.k", "_at.h").alias("_doc")
    gone, often = stored(others.select(doc), "dup-gone"), stored(held.where("_n > 1").select(doc), "dup-often")

    def near(side: DataFrame) -> DataFrame:
        return F.broadcast(side) if fits_broadcast(side) else side

    aside, old, new = with_columns_aside(docs)
    key = F.struct(F.col(new[id_col]).alias("k"), text_hash(F.col(new[text_col])).alias("h"))
    kept = aside.withColumn("_doc", key).join(near(gone), "_doc", "left_anti")
    if not often.isEmpty():
        side = near(often)
        hashed = [f.name for f in aside.schema.fields if not {"map", "variant"} & set(re.findall(r"\w+", f.dataType.simpleString()))]
        first = Window.partitionBy("_doc").orderBy(F.xxhash64(*hashed))
        one = kept.join(side, "_doc", "left_semi").withColumn("_r", F.row_number().over(first)).where("_r = 1").drop("_r")
        kept = kept.join(side, "_doc", "left_anti").unionByName(one)
    return kept.select(*aside.columns).toDF(*old)
