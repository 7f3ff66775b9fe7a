"""Counts of a run, taken from the plan that runs anyway: observed metrics of a batch, and of every batch of a stream."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "run string, batch long, name string, value double"


class Counted:
    """A DataFrame that counts as it is written: ``frame`` in place of the given one; ``rows`` after the action."""

    def __init__(self, df: DataFrame, run: str, **counts: Column):
        self.run, self.spark = run, df.sparkSession
        self.observation = Observation(run)
        self.frame = df.observe(self.observation, *[v.alias(c) for c, v in counts.items()])

    def rows(self) -> DataFrame:
        """``run, batch, name, value``; waits for the first action on ``frame``."""
        found = self.observation.get
        return self.spark.createDataFrame([(self.run, 0, c, None if v is None else float(v)) for c, v in found.items()], SCHEMA)


class RunLog(StreamingQueryListener):
    """Run rows of streams: input rows and observed metrics of every batch, one small row each, kept until :meth:`write`.

    Metrics are those of ``observe(run, ...)`` on the stream.
    """

    def __init__(self) -> None:
        self.lock, self.held = threading.Lock(), {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        found = {"input": float(p.numInputRows)}
        for metrics in p.observedMetrics.values():
            found |= {c: None if v is None else float(v) for c, v in metrics.asDict().items()}
        with self.lock:
            # a batch that is reported again replaces its row
            self.held[str(p.id), p.batchId] = found

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def rows(self, spark: SparkSession) -> DataFrame:
        with self.lock:
            return spark.createDataFrame([(run, batch, c, v) for (run, batch), found in self.held.items() for c, v in found.items()], SCHEMA)

    def write(self, spark: SparkSession, path: str) -> None:
        """Append what has been held to a table and let go of it."""
        rows = self.rows(spark)
        with self.lock:
            self.held.clear()
        rows.write.mode("append").parquet(path)
