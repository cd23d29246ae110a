"""Every query against the SQL of its result, on the small tables."""

import datetime
import decimal
import importlib.util
from pathlib import Path

import duckdb
import pytest

from postmill.catalogue import ENTRIES

FOLDER = Path("/root/testdata/sf0.001")
TABLES = [path.stem for path in FOLDER.glob("*.parquet")]

pytestmark = pytest.mark.skipif(not TABLES, reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    yield con
    con.close()


def plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, (decimal.Decimal, datetime.datetime)):
        return str(value)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", ENTRIES)
def test_query(spark, duck, name):
    query = ENTRIES[name]
    df = query.run(spark, str(FOLDER))
    got = table(df.columns, [tuple(row) for row in df.collect()])
    cursor = duck.execute(query.sql)
    assert got == table([column[0] for column in cursor.description], cursor.fetchall())


def test_driver_contract(spark):
    path = Path(__file__).resolve().parents[1] / "__spark_entry__.py"
    spec = importlib.util.spec_from_file_location("driver_entry", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert set(module.oracle_sql()) <= set(module.queries()) >= set(ENTRIES)
    assert module.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["stage_posts", "stage_post_tags", "stage_tags", "stage_languages"])
def test_staging_reads_stored_posts(spark, name):
    plan = ENTRIES[name].run(spark, str(FOLDER))._jdf.queryExecution().executedPlan().toString()
    assert "from_json(" not in plan and "lineitem" not in plan
