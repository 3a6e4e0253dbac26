"""Every registered query with SQL against DuckDB, on the smallest tables."""

import importlib.util
import os

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry

_spec = importlib.util.spec_from_file_location(
    "check_oracle", os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools", "check_oracle.py"))
check = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in check.TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_sql(spark, duck, name):
    got = check.strip_zone(entry.queries()[name](spark, SF).toArrow())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got.num_columns
        return
    want = check.strip_zone(duck.sql(sql).to_arrow_table())
    assert check.kinds(got) == check.kinds(want)
    assert check.canonical(got) == check.canonical(want)


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["year", "month", "shipping_country", "category", "total_orders", "unique_customers", "total_items_sold", "total_revenue_usd"]
    assert result.count() > 0


def test_every_query_has_sql():
    assert set(entry.registry.oracle_sql()) == set(entry.registry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_csv_verdicts_over_many_files_of_bounded_size(spark, monkeypatch):
    sizes = []
    inspect = entry.stored.files.inspect_files

    def counted(*args):
        found = inspect(*args)
        sizes.append(found.count())
        return found

    monkeypatch.setattr(entry.stored, "CSV_ROWS", 60, raising=False)
    monkeypatch.setattr(entry.stored.files, "inspect_files", counted)
    n = spark.read.parquet(f"{SF}/part.parquet").count()
    got = {r.kind: (r.record_count, r.reason) for r in entry.queries()["csv_verdicts"](spark, SF).collect()}
    assert min(sizes) >= n // 60 > 1
    assert got["good"] == got["broken header"] == (n, None)
    assert got["short row"] == (None, "1 row(s) with a field count other than 2")
    assert got["no column"] == (None, "missing required columns: ['label']") and got["empty"] == (None, "file is empty or has no header")
