"""Keyed writes to a stored table that read and write the touched partitions alone.

The partition of a row follows from its key, so a batch can only meet rows in the partitions of its own keys.
What a write gives is that of the function of the same name in ``keyed``.  A write that is repeated changes nothing.
A write is not atomic over partitions: one that was lost half way is run again.  A null partition value is a
partition like any other; a batch without rows touches nothing; columns of the batch that the table lacks are dropped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lineage import stored
from . import keyed

#: So many touched partitions are told to the scan one by one; more are met by a semi-join, with the same result.
NAMED = 2000


@dataclass(frozen=True)
class KeyedStore:
    """A Parquet table at ``path`` with rows ``schema``, its ``keys``, and SQL over the keys for each partition column."""

    spark: SparkSession
    path: str
    schema: str
    keys: tuple[str, ...]
    parts: dict[str, str]

    def create(self, table: DataFrame) -> KeyedStore:
        keyed.save(self._placed(table), self.path, list(self.parts), list(self.keys))
        return self

    def table(self) -> DataFrame:
        return self._files().drop(*self.parts)

    def insert_first(self, batch: DataFrame, order: list) -> None:
        self._write(batch, lambda old, new: keyed.insert_first(old, new, list(self.keys), order))

    def upsert_last(self, batch: DataFrame, order: list) -> None:
        self._write(batch, lambda old, new: keyed.upsert_last(old, new, list(self.keys), order))

    def replace_keys(self, batch: DataFrame) -> None:
        self._write(batch, lambda old, new: keyed.replace_keys(old, new, list(self.keys)))

    def delete_keys(self, gone: DataFrame) -> None:
        """``gone`` needs the key columns only."""
        self._write(gone.select(*self.keys), lambda old, new: keyed.delete_keys(old, new, list(self.keys)))

    def touched(self, batch: DataFrame) -> DataFrame:
        """The stored rows of the partitions that a batch (with partition columns) may change."""
        wanted = batch.select(*self.parts).distinct()
        rows, files = wanted.limit(NAMED + 1).collect(), self._files()
        if len(rows) <= NAMED:
            any_of = [reduce(Column.__and__, [F.col(p).eqNullSafe(F.lit(r[p])) for p in self.parts]) for r in rows]
            return files.where(reduce(Column.__or__, any_of, F.lit(False)))
        renamed = wanted.select(*[F.col(p).alias(f"_{p}") for p in self.parts])
        return files.join(renamed, reduce(Column.__and__, [F.col(p).eqNullSafe(F.col(f"_{p}")) for p in self.parts]), "left_semi")

    def _placed(self, rows: DataFrame) -> DataFrame:
        names = [f.name for f in self.spark.createDataFrame([], self.schema).schema if f.name in rows.columns]
        return rows.select(*names).withColumns({p: F.expr(e) for p, e in self.parts.items()})

    def _files(self) -> DataFrame:
        kinds = self.spark.createDataFrame([], self.schema).selectExpr(*[f"{e} as {p}" for p, e in self.parts.items()]).schema
        return self.spark.read.schema(f"{self.schema}, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kinds)).parquet(self.path)

    def _write(self, batch: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        batch = stored(self._placed(batch), "batch")
        old = self.touched(batch)
        folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("folder")
        before = {tuple(r[: len(self.parts)]): r["folder"] for r in old.select(*self.parts, folder).distinct().collect()}
        after = stored(change(old, batch), "changed-partitions")
        keyed.save(after, self.path, list(self.parts), list(self.keys))
        left = {tuple(r) for r in after.select(*self.parts).distinct().collect()}
        self._drop([f for part, f in before.items() if part not in left])

    def _drop(self, folders: list[str]) -> None:
        """A partition without rows is not overwritten by what has none for it."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for folder in folders:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(conf).delete(path, True)
