"""The pipeline's stages on a small table."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from postmill.llm.columns import table  # noqa: E402

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def test_stages(spark, tmp_path):
    docs = table(spark, FOLDER, "documents")
    columns, n = docs.columns, docs.count()
    labels = {row["doc_id"]: row["quality"] for row in table(spark, FOLDER, "labels").collect()}
    for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / str(place)))
        docs = spark.read.parquet(str(tmp_path / str(place)))
        if place == 0:
            kept = {row["doc_id"] for row in docs.collect()}
            good = [i for i, quality in labels.items() if quality == 1]
            assert len(kept & set(good)) >= 0.97 * len(good) and docs.count() < n
        if place < 4:
            assert docs.columns == columns
        if place == 1:
            lines = [line for row in docs.collect() for line in row["text"].split("\n") if line.split()]
            assert len(lines) == len(set(lines))
        if place == 2:
            assert docs.join(before, "doc_id", "left_anti").count() == 0 and docs.count() <= before.count()
    assert {"doc_id", "ids", "n_tokens"} <= set(docs.columns) and docs.count() == before.count()
