"""Keyed writes as table-to-table functions, and their application to stored Parquet tables.

Each function gives the table after the write.  All are idempotent: the same
batch written twice changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _one(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(window)).where("_n = 1").drop("_n")


def _anti(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    right = right.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = [left[k].eqNullSafe(right[f"_{k}"]) for k in keys]
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    return left.join(right, condition, "left_anti")


def new_rows(table: DataFrame, batch: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The rows of a batch whose key the table lacks; the first of each key by ``order``.  Their count is what was inserted."""
    return _anti(_one(batch, keys, order), table, keys)


def insert_first(table: DataFrame, batch: DataFrame, keys: list[str], order: list) -> DataFrame:
    """First write wins."""
    return table.unionByName(new_rows(table, batch, keys, order))


def upsert_last(table: DataFrame, batch: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Last write wins; within the batch the last by ``order`` (given descending)."""
    return _anti(table, batch.select(*keys).distinct(), keys).unionByName(_one(batch, keys, order))


def delete_keys(table: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return _anti(table, gone.select(*keys).distinct(), keys)


def replace_keys(table: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of the batch's keys give way to the batch's rows."""
    return delete_keys(table, batch, keys).unionByName(batch)


def append_run(table: DataFrame, batch: DataFrame, run_at) -> DataFrame:
    """Append with a run stamp; a run that is already there is replaced."""
    stamped = batch.withColumn("run_at", F.lit(run_at).cast("timestamp"))
    return table.where(F.col("run_at") != F.lit(run_at).cast("timestamp")).unionByName(stamped)


def save(df: DataFrame, path: str, partition: list[str], sort: list[str] | None = None) -> None:
    """Overwrite the touched partitions of a stored table; rows are sorted inside files so that statistics prune."""
    df = df.repartition(*partition)
    df = df.sortWithinPartitions(*partition, *(sort or []))
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)


def save_csv(df: DataFrame, path: str, partition: list[str]) -> None:
    """CSV artifacts, one folder per partition value."""
    df.write.mode("overwrite").option("header", True).partitionBy(*partition).csv(path)


def metric_rows(results: DataFrame, ids: list[str], values: list[str]) -> DataFrame:
    """Long rows ``ids…, name, value`` of metric columns."""
    wide = results.select(*ids, *[F.col(v).cast("double").alias(v) for v in values])
    return wide.unpivot(ids, values, "name", "value")
