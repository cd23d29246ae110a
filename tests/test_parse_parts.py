"""Lines that come from a shuffle are parsed in small parts, and the session's settings stay."""

from posts import post
from pyspark.sql import functions as F

from postmill.plans import load
from postmill.plans.load import parsed_once, scratch_store


def test_shuffled_lines_are_parsed_in_small_parts(spark, monkeypatch):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    small = {name: "1k" for name in load.PARSED_AT_ONCE} | {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    monkeypatch.setattr(load, "PARSED_AT_ONCE", small)
    lines = [(post(id=n), "a", (0, n)) for n in range(1, 401)]
    frame = spark.createDataFrame(lines, "value string, src_file string, pos struct<block:bigint,row:bigint>")
    before = spark.conf.get(size)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        parsed = parsed_once(scratch_store(spark), frame.repartition(F.xxhash64("value")), "2024-01-01 00:00:00", 1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert len(parsed.inputFiles()) > 4
    assert sorted(row[0] for row in parsed.select("post_ext_id").collect()) == list(range(1, 401))
    assert spark.conf.get(size) == before
