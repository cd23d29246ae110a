"""Document fingerprints (5): winnowing over characters.

Every run of ``GRAM`` characters has a rolling hash. Of each ``WINDOW`` runs in a row
the smallest hash is chosen, the rightmost of equal ones, and kept with its
position. Two texts that share ``GRAM + WINDOW - 1`` characters in a row therefore
share a chosen hash. A text shorter than a run is one run; an empty one has an
empty fingerprint.

To put a text's end in place of the one before it, documents are dealt by ranges of
their ids and sorted, so that a document's successor is the next row; only the
first document of each range is needed twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.columns import only
from postmill.llm.wordhash import _POWERS, mix

GRAM, WINDOW = 24, 40


class Fingerprint(NamedTuple):
    """Chosen hashes, 32 bits each, and where their runs begin."""

    hashes: np.ndarray
    positions: np.ndarray

    def text(self) -> str:
        """The hashes in order, eight hexadecimal digits each."""
        return self.hashes.astype(">u4").tobytes().hex()


def fingerprint(text: str, gram: int = GRAM, window: int = WINDOW) -> Fingerprint:
    """Winnow one text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    n = len(points)
    if not n:
        return Fingerprint(np.zeros(0, np.uint32), np.zeros(0, np.int64))
    gram = min(gram, n)
    up, down = _POWERS.upto(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((points + np.uint64(1)) * up[:n], out=sums[1:])
    hashes = mix((sums[gram:] - sums[: n - gram + 1]) * down[: n - gram + 1]) >> np.uint64(32)
    # Smaller hash first, then the larger place: the place counts down below the hash.
    keys = (hashes << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - np.arange(len(hashes), dtype=np.uint64))
    width, least = 1, keys
    while width < min(window, len(keys)):  # least of windows of 1, 2, 4 ... and at last of all
        step = min(width, min(window, len(keys)) - width)
        least = np.minimum(least[: len(least) - step], least[step:])
        width += step
    chosen = least[np.flatnonzero(np.diff(least, prepend=~least[:1]))]
    return Fingerprint((chosen >> np.uint64(32)).astype(np.uint32), (np.uint64(0xFFFFFFFF) - (chosen & np.uint64(0xFFFFFFFF))).astype(np.int64))


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """Shared hashes among all distinct ones of both; two empty fingerprints are alike."""
    left, right = np.unique(a.hashes), np.unique(b.hashes)
    if not len(left) and not len(right):
        return 1.0
    shared = len(np.intersect1d(left, right, assume_unique=True))
    return shared / (len(left) + len(right) - shared)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``hashes`` and ``positions`` of every row's whole text, where it stands.

    A null text counts as empty; repeated rows each get theirs; an empty table gives
    an empty result; further columns are not looked at.
    """
    read = only(docs, id_col, text_col)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 256):
                batch = whole.slice(begin, 256)
                marks = [fingerprint(text or "") for text in batch.column(1).to_pylist()]
                hashes = pa.array([mark.hashes.astype(np.int64) for mark in marks], pa.list_(pa.int64()))
                places = pa.array([mark.positions for mark in marks], pa.list_(pa.int64()))
                yield pa.record_batch([batch.column(0), hashes, places], names=[id_col, "hashes", "positions"])

    kind = read.schema[id_col].dataType.simpleString()
    return read.mapInArrow(each, f"`{id_col}` {kind}, hashes array<bigint>, positions array<bigint>")


def successors(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows dealt by ranges of ids: ``_range``, ``_id``, ``_text``, ``_own``. Each range is sorted and
    ends with the first row of the next one (``_own`` false); the last, with that of the first.

    Rows are in the order of (id, text), null ids last. Bounds come from approximate
    quantiles of the ids, so ranges are about equal whatever the ids are; rows
    with one id are in one range.
    """
    spark = docs.sparkSession
    rows = only(docs, id_col, text_col).select(
        F.col(id_col).cast("bigint").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")
    )
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    steps = [i / parts for i in range(1, parts)] or [0.5]
    bounds = rows.agg(F.percentile_approx("_id", steps, 10 * parts)).first()[0] or []
    bounds = sorted(set(bounds))
    at = F.size(F.filter(F.array(*(F.lit(b) for b in bounds)).cast("array<bigint>"), lambda b: b < F.col("_id")))
    placed = rows.select(F.when(F.col("_id").isNull(), len(bounds) + 1).otherwise(at).alias("_range"), "_id", "_text")
    firsts = placed.groupBy("_range").agg(F.min("_id").alias("_id")).collect()  # one id a range
    order = sorted(row["_range"] for row in firsts)
    before = {part: order[i - 1] for i, part in enumerate(order)}  # the first one's goes to the last
    if not order:
        return placed.withColumn("_own", F.lit(True))
    moves = F.create_map(*(F.lit(x) for pair in before.items() for x in pair))
    first_ids = [row["_id"] for row in firsts if row["_id"] is not None]
    wanted = F.col("_id").isin(first_ids) if first_ids else F.lit(False)
    if any(row["_id"] is None for row in firsts):
        wanted = wanted | F.col("_id").isNull()
    heads = placed.where(wanted).groupBy("_range", "_id").agg(F.min("_text").alias("_text"))
    heads = heads.select(moves[F.col("_range")].alias("_range"), "_id", "_text", F.lit(False).alias("_own"))
    both = placed.withColumn("_own", F.lit(True)).unionByName(heads)
    return both.repartition(parts, "_range").sortWithinPartitions("_range", F.desc("_own"), F.col("_id").asc_nulls_last(), "_text")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document against an edited copy: the last half of its characters gives way to
    as many first ones of the next document, by ascending id (after the last: the first).

    One row per row: id, ``n_chars``, ``edited_sha256``, both fingerprints as text, ``n_marks``,
    and the likeness to the edited copy (``near_edited``) and to the next document
    (``near_next``). A null text counts as empty; rows with one id are in the order
    of their texts; null ids come last; a lone row is its own successor; an empty
    table gives an empty result.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that still waits for its successor: range, id, text, fingerprint
        out: list[tuple] = []
        for batch in batches:
            for part, number, text, own in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                mark = fingerprint(text)
                if held is not None and held[0] == part:
                    out.append(_compared(held, text, mark))
                held = (part, number, text, mark) if own else None
                if len(out) >= 256:
                    yield _batch(out)
                    out = []
        if out:
            yield _batch(out)

    def _compared(held: tuple, next_text: str, next_mark: Fingerprint) -> tuple:
        _, number, text, mark = held
        half = len(text) // 2
        edited = text[: len(text) - half] + next_text[:half]
        other = fingerprint(edited)
        digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        return (
            number, len(text), digest, mark.text(), other.text(), len(mark.hashes), likeness(mark, other), likeness(mark, next_mark)
        )

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.float64(), pa.float64()]
        columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.record_batch(columns, names=names)

    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "n_marks", "near_edited", "near_next"]
    schema = (
        f"`{id_col}` bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "n_marks bigint, near_edited double, near_next double"
    )
    return successors(docs, id_col, text_col).mapInArrow(each, schema)
