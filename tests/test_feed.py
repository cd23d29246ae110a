"""Lines of a part of the feed are those that their text would choose."""

import datetime

import pytest
from pyspark.sql import functions as F

from postmill.catalogue import loads
from postmill.catalogue.feed import feed_lines, largest_order, line_order

LINES = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,"
    " l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
)

def made(spark, folder, lost_part):
    """Every kind of line over the orders, some without a key, and the largest order with a part or without."""
    day = datetime.datetime(2020, 1, 2)
    rows = [
        (None if i == 7 else i * 3, i % 5, i % 4, None if i == 8 else 1 + i % 9, None if i == 9 else float(i % 51), 1.5 * i, 0.03, "A", "FO"[i % 2], day)
        for i in range(160)
    ]
    rows.append((700, 99 if lost_part else 1, 1, 1, 1.0, 5.0, 0.0, "N", "O", day))
    rows.append((3000, 1, 1, 1, 48.0, 5.0, 0.0, "N", "O", day))  # no post
    spark.createDataFrame(rows, LINES).write.parquet(f"{folder}/lineitem.parquet")
    parts = [(i, f'wo"rd{i} p{i}', f"Brand#{i}") for i in range(5)]
    spark.createDataFrame(parts, "p_partkey bigint, p_name string, p_brand string").write.parquet(f"{folder}/part.parquet")
    return str(folder)


@pytest.mark.parametrize("lost_part", [False, True])
def test_chosen_lines(spark, tmp_path, lost_part):
    folder = made(spark, tmp_path, lost_part)
    lines = feed_lines(spark, folder).withColumn("_order", F.shiftright(F.get_json_object("value", "$.id_str").cast("bigint"), 3))
    largest = lines.agg(F.max("_order")).first()[0]
    assert largest_order(spark, folder) == largest and (largest == 700) != lost_part
    third = largest // 3 + 1

    def ranges(order):
        return [F.floor(order / third) == 0, F.floor(order / third) == 1, (order >= 2 * third) | (order < 64)]

    for by_text, chosen in zip(ranges(F.col("_order")), ranges(line_order())):
        expected, got = lines.where(by_text).drop("_order"), feed_lines(spark, folder, chosen)
        assert got.count() > 0 and sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_lines_of_other_loads_are_not_made(spark, tmp_path, monkeypatch):
    """A load gets its lines from a scan that leaves out the rows of other loads."""
    folder, plans = made(spark, tmp_path, False), []
    monkeypatch.setattr(loads, "load_lines", lambda store, lines, *_: plans.append(lines))
    monkeypatch.setattr(loads, "load_staging", lambda store, lines, *_: plans.append(lines))
    monkeypatch.setattr(loads, "merge_staging", lambda store: None)
    loads.loads_with_late_posts(spark, folder)
    assert len(plans) == 3
    for lines in plans:
        plan = lines._jdf.queryExecution().optimizedPlan().toString()
        filters = [line for line in plan.splitlines() if "Filter" in line]
        assert "get_json_object" not in plan and any("shiftright" in line for line in filters)
