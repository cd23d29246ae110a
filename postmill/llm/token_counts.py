"""Token counts (3): rollups kept up by signed changes, in idempotent batches.

Totals by (source, language, tokenizer version) are additive, so a change needs no
look at what is stored: an insert adds a document and its tokens, a delete takes
them away, a revised count adds the difference. A batch is pre-aggregated to one
row per group, written to a folder of its own and made visible by renaming that
folder to the batch's name, which can happen once: a batch that comes again,
after a lost answer or from a second writer, changes nothing.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm.columns import only, words

GROUP = ("source", "lang", "tokenizer")
_SCHEMA = "source string, lang string, tokenizer string, docs bigint, tokens bigint"

#: Tokenizer versions that are plain column expressions.
TOKENIZERS = {
    "words/1": lambda text: F.size(words(text)).cast("bigint"),
    "pieces/1": lambda text: F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[A-Za-z]+|[0-9]+|[^A-Za-z0-9\\x09-\\x0D ]")).cast("bigint"),
}


def counted(docs: DataFrame, versions: dict | None = None, revised: Column | None = None) -> DataFrame:
    """``doc_id, source, lang, tokenizer, tokens`` of every document, for each version.
    A null text has no tokens, a text of any length is counted whole; null source or
    language are groups of their own; repeated rows count as often as they come; an
    empty table gives an empty result; further columns are not looked at.

    ``revised``: what a revision would make of the text; its count is ``new_tokens``.
    Counts are narrow, so which documents change is best joined to them, not to texts."""

    def entry(name: str, count) -> Column:
        fields = [F.lit(name).alias("tokenizer"), count(F.col("text")).alias("tokens")]
        if revised is not None:
            fields.append(count(revised).alias("new_tokens"))
        return F.struct(*fields)

    each = [entry(name, count) for name, count in (versions or TOKENIZERS).items()]
    return only(docs, "doc_id", "source", "lang", "text").select("doc_id", "source", "lang", F.inline(F.array(*each)))


def worst_labels(labels: DataFrame) -> DataFrame:
    """One row per labelled document: ``quality`` is the lowest it was given, ``toxic``
    the highest. A row twice in a batch of changes would count twice, so repeated
    labels must not repeat documents."""
    given = only(labels, "doc_id", "quality", "toxic").where(F.col("doc_id").isNotNull())
    return given.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))


def _signed(rows: DataFrame, docs: int, tokens: Column) -> DataFrame:
    return rows.select(*GROUP, F.lit(docs).cast("bigint").alias("docs"), F.coalesce(tokens, F.lit(0)).cast("bigint").alias("tokens"))


def inserts(rows: DataFrame) -> DataFrame:
    """Counted documents that are new."""
    return _signed(rows, 1, F.col("tokens"))


def deletes(rows: DataFrame) -> DataFrame:
    """Counted documents that go, as they were counted when they came."""
    return _signed(rows, -1, -F.col("tokens"))


def revisions(rows: DataFrame) -> DataFrame:
    """Documents that stay, with ``tokens`` as it was and ``new_tokens``."""
    return _signed(rows, 0, F.col("new_tokens") - F.coalesce(F.col("tokens"), F.lit(0)))


class Rollup:
    """Totals in a shared folder; one subfolder for each batch."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        self._fs = hadoop.Path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _folder(self, batch: str) -> str:
        return f"{self.root}/batches/{hashlib.sha256(batch.encode()).hexdigest()[:32]}"

    def committed(self, batch: str) -> bool:
        return self._fs.exists(self._path(self._folder(batch)))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch of signed changes; False if one of that name is there already."""
        if self.committed(batch):
            return False
        delta = changes.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        attempt = f"{self.root}/attempts/{uuid.uuid4().hex}"
        delta.where("docs <> 0 or tokens <> 0").write.parquet(attempt)
        final = self._path(self._folder(batch))
        self._fs.mkdirs(final.getParent())
        if self._fs.exists(final) or not self._fs.rename(self._path(attempt), final):
            self._fs.delete(self._path(attempt), True)
            return False
        # Where a rename may move a folder into another that appeared meanwhile, undo that.
        inside = self._path(f"{self._folder(batch)}/{attempt.rsplit('/', 1)[1]}")
        if self._fs.exists(inside):
            self._fs.delete(inside, True)
            return False
        return True

    def totals(self) -> DataFrame:
        """One row per group: documents and tokens over all batches. Groups whose
        changes have cancelled out are left out."""
        batches = self._path(f"{self.root}/batches")
        if not self._fs.exists(batches) or not self._fs.listStatus(batches):
            return self.spark.createDataFrame([], _SCHEMA)
        stored = self.spark.read.schema(_SCHEMA).parquet(f"{self.root}/batches/*")
        sums = stored.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where("docs <> 0 or tokens <> 0")
