"""A training corpus from raw documents: five stages, each one operator of ``postmill.llm``.

Each stage reads what the one before has written. ``ORACLE_SQL`` is None: the fitted
classifier and the sampled signatures have no SQL, tests hold the stages against
brute force instead.
"""

from __future__ import annotations

import sys
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from postmill.llm import bpe, line_dedup, mixing, quality_classifier, weighted_minhash  # noqa: E402
from postmill.llm.columns import only, stored, table, with_columns_aside  # noqa: E402
from postmill.llm.queries import VOCABULARY  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier rejects go."""
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go, and documents with them that lose all their
    lines; ``n_chars`` is that of the text that is left."""
    left = line_dedup.dedup_lines(docs)
    aside, old, new = with_columns_aside(left)
    removed, held = F.col(new["n_removed"]), F.col(new["n_lines"])
    kept = aside.where((removed == 0) | (removed < held))
    length = F.when(removed > 0, F.length(new["text"]).cast("bigint")).otherwise(F.col(new["n_chars"]).cast("bigint"))
    columns = [length.alias(name) if name == new["n_chars"] else F.col(name) for name in aside.columns[:-2]]
    return kept.select(*columns).toDF(*old[:-2])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, that with the smallest id."""
    return weighted_minhash.drop_near_duplicates(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their sources' targets take them."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, with the digest of what they decode to."""
    definition = bpe.read_definition(public_tokenizers.path(VOCABULARY))
    return bpe.encode(only(docs, "doc_id", "text"), definition)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near duplicates", near_duplicates),
    ("mixing", mixture),
    ("bpe", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is stored before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
