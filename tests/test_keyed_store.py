"""Keyed writes on touched partitions against the same writes on whole tables."""

import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.sources import keyed, keyed_store
from tidemark.sources.keyed_store import KeyedStore

ROWS = "ticker string, ds date, close double"
KEYS = ["ticker", "ds"]
D = lambda m, d: datetime.date(2024, m, d)


def old(spark):
    rows = [(t, D(m, d), float(m * d)) for t in ("A", "B") for m in (1, 2, 3) for d in (1, 2)]
    return spark.createDataFrame([*rows, ("A", None, 9.0), (None, D(2, 1), 8.0)], ROWS)


def batch(spark):
    return spark.createDataFrame([("A", D(2, 1), 70.0), ("A", D(2, 1), 71.0), ("C", D(2, 9), 72.0), (None, D(2, 1), 73.0)], ROWS)


def store(spark, path):
    return KeyedStore(spark, str(path / "t"), ROWS, tuple(KEYS), {"month": "month(ds)"}).create(old(spark))


def rows(df):
    return sorted((tuple(r) for r in df.select("ticker", "ds", "close").collect()), key=repr)


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


@pytest.mark.parametrize("named", [2000, 0])
@pytest.mark.parametrize("write", ["insert_first", "upsert_last", "replace_keys", "delete_keys"])
def test_equal_to_whole_tables(spark, tmp_path, monkeypatch, write, named):
    monkeypatch.setattr(keyed_store, "NAMED", named)
    order = [[F.col("close").desc()]] if write in ("insert_first", "upsert_last") else []
    s = store(spark, tmp_path)
    before = files(s.path)
    want = rows(getattr(keyed, write)(old(spark), batch(spark), KEYS, *order) if order else getattr(keyed, write)(old(spark), batch(spark), KEYS))
    for _ in range(1 if write == "replace_keys" else 2):  # idempotent
        getattr(s, write)(batch(spark), *order)
        assert rows(s.table()) == want
    after = files(s.path)
    assert all(after.get(f) == t for f, t in before.items() if "month=2" not in f) and {f for f in before if "month=2" in f} - set(after)


def test_replace_is_idempotent(spark, tmp_path):
    s = store(spark, tmp_path)
    s.replace_keys(batch(spark))
    once = rows(s.table())
    s.replace_keys(batch(spark))
    assert rows(s.table()) == once


def test_partition_that_empties(spark, tmp_path):
    s = store(spark, tmp_path)
    gone = old(spark).where("month(ds) = 3 or ds is null")
    s.delete_keys(gone.select(*KEYS))
    assert rows(s.table()) == rows(keyed.delete_keys(old(spark), gone, KEYS))
    assert not any("month=3" in f or "HIVE_DEFAULT" in f for f in files(s.path))


def test_odd_batches(spark, tmp_path):
    """No rows; a null partition; extra columns, also one with the name of a partition column; a partition that is new."""
    s = store(spark, tmp_path)
    before = files(s.path)
    s.upsert_last(batch(spark).where("false"), ["close"])
    assert files(s.path) == before
    odd = spark.createDataFrame([("A", None, 5.0, "x", 1), ("Z", D(7, 1), 6.0, "y", 2)], ROWS + ", month string, folder int")
    s.upsert_last(odd, ["close"])
    assert rows(s.table()) == rows(keyed.upsert_last(old(spark), odd.select("ticker", "ds", "close"), KEYS, ["close"]))


def test_scan_is_pruned(spark, tmp_path):
    s = store(spark, tmp_path)
    plan = s.touched(batch(spark).withColumn("month", F.month("ds")))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(month" in plan and "(month#" in plan.split("PartitionFilters:")[1][:60]
