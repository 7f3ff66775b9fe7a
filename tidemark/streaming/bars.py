"""Streams of bars, ticks and headlines.

Production: ``update`` mode into the keyed sink, which keeps the last version of a
key, with the watermark bounding the state.  Ordered row windows are not allowed
on streams, so indicators keep their recurrences as state per ticker.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..sources import keyed
from ..sources.tables import bars_from_ticks

#: Rows later than this are left to the batch backfill.
LATENESS = "5 days"


def read(spark: SparkSession, path: str, schema, files: int = 1) -> DataFrame:
    """A stream of Parquet files; times without zone become UTC timestamps."""
    from ..sources.schemas import utc

    return utc(spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path))


def dedupe(bars: DataFrame, keys: list[str], time: str = "ts", late: str = LATENESS) -> DataFrame:
    """The first row of each key; overlapping fetches give nothing new."""
    return bars.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def batch_bars(ticks: DataFrame, width: str = "15 minutes") -> DataFrame:
    """Ticks (``ticker, ts, price, seq``) to bars of a width."""
    bars = bars_from_ticks(ticks, ["ticker", F.window("ts", width).alias("w")])
    return bars.select("ticker", F.col("w.start").alias("ts"), "open", "high", "low", "close", "volume")


def tumbling(ticks: DataFrame, width: str = "15 minutes", late: str = LATENESS) -> DataFrame:
    """The same over a stream; ticks later than ``late`` are left to :func:`backfill`."""
    return batch_bars(ticks.withWatermark("ts", late), width)


def daily_sentiment(scored: DataFrame, late: str = "7 days") -> DataFrame:
    """Sentiment per ticker and day; a day is a window so that its state can be dropped."""
    rows = scored.withWatermark("published_at", late)
    out = rows.groupBy("ticker", F.window("published_at", "1 day").alias("w")).agg(
        F.avg("compound").alias("sentiment_compound"),
        F.count_if(F.col("sentiment") == "positive").alias("pos_count"),
        F.count_if(F.col("sentiment") == "negative").alias("neg_count"),
        F.count("*").alias("article_count"),
    )
    return out.select("ticker", F.to_date("w.start").alias("ds"), "sentiment_compound", "pos_count", "neg_count", "article_count")


def keyed_sink(path: str, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink: each batch is stored under its id, so a batch that is run again replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.dropDuplicates(keys).withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def last_versions(spark: SparkSession, path: str, keys: list[str], keep_batch: bool = False) -> DataFrame:
    """What the keyed sink holds: the last version of each key."""
    from pyspark.sql import Window

    rows = spark.read.parquet(path).drop("batch")
    newest = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("_batch").desc()))
    return rows.withColumn("_n", newest).where("_n = 1").drop("_n", *([] if keep_batch else ["_batch"]))


def compact(spark: SparkSession, path: str, keys: list[str]) -> None:
    """Replace all stored batches by the last versions of their keys, under the newest batch's id.

    The new files are written before the old ones go; until then a reader finds a version twice
    and takes one.  No stream may be writing meanwhile.
    """
    import uuid

    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = [s.getPath() for s in system.listStatus(files)]
    rows = last_versions(spark, path, keys, keep_batch=True)
    rows.write.parquet(f"{path}/batch=c{uuid.uuid4().hex}")
    for folder in old:
        system.delete(folder, True)


def backfill(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The stream's table with the rows of a batch over what landed late: they come in, or replace what the stream saw in part."""
    return keyed.upsert_last(table, rows, keys, [F.lit(1)])


def closing(bars: DataFrame, after: str = "1 day") -> DataFrame:
    """One row of a ticker of its own, later than all bars: it takes the watermark past them and never comes out itself."""
    at = bars.agg(F.max("ts").alias("ts")).where("ts is not null")
    return at.select(F.lit("closing").alias("ticker"), (F.col("ts") + F.expr(f"interval {after}")).alias("ts"), F.lit(0.0).alias("close"))


def run_available(stream: DataFrame, path: str, keys: list[str], mode: str = "update") -> DataFrame:
    """Run a stream over all that is there into the keyed sink under ``path`` and give the table."""
    query = stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", f"{path}/progress").foreachBatch(keyed_sink(f"{path}/table", keys)).start()
    query.awaitTermination()
    return last_versions(stream.sparkSession, f"{path}/table", keys)


class Indicators(StatefulProcessor):
    """EMA 12/26, signal, Wilder means and the last 30 closes of a ticker.

    Bars wait in buckets of ``width`` of time, a map entry each, until the watermark passes the bucket's end; then they enter in
    time order, so late bars within the watermark give the batch result.  One timer a bucket; a call
    holds one bucket of one ticker, whatever the stream keeps waiting.
    """

    FIELDS = "n long, fast double, slow double, signal double, gain double, loss double, last double, closes array<double>"
    OUT = "ticker string, ts timestamp, close double, rsi_14 double, macd double, macd_signal double, macd_hist double, bb_middle double, bb_upper double, bb_lower double, zscore double, flag string"

    def __init__(self, width: datetime.timedelta = datetime.timedelta(days=1)):
        self.width = width // datetime.timedelta(microseconds=1)

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("recurrences", self.FIELDS)
        self.waiting = handle.getMapState("waiting", "bucket long", "at array<long>, close array<double>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            at = micros(frame["ts"])
            for bucket, part in pd.DataFrame({"at": at, "close": frame["close"].astype(float)}).groupby(at // self.width):
                bucket = int(bucket)
                held = self.waiting.getValue((bucket,)) if self.waiting.containsKey((bucket,)) else None
                if held is None:
                    self.handle.registerTimer((bucket + 1) * self.width // 1000)
                before = ([], []) if held is None else held
                self.waiting.updateValue((bucket,), ([*before[0], *part["at"].tolist()], [*before[1], *part["close"].tolist()]))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # as many calls as buckets are due; the oldest goes first, in whatever order the timers come
        bucket = min((k[0] for k in self.waiting.keys()), default=None)
        if bucket is None:
            return iter([])
        at, closes = self.waiting.getValue((bucket,))
        self.waiting.removeKey((bucket,))
        state = self.state.get() if self.state.exists() else None
        out = []
        for t, close in sorted(zip(at, closes)):
            state, row = step(state, close)
            out.append((key[0], t, close, *row))
        self.state.update(state)
        frame = pd.DataFrame(out, columns=[c.split()[0] for c in self.OUT.split(", ")])
        return iter([frame.assign(ts=pd.to_datetime(frame["ts"], unit="us"))])

    def close(self) -> None:
        pass


def micros(times: pd.Series) -> pd.Series:
    """Microseconds since 1970 of UTC times, with or without a zone."""
    if times.dt.tz is not None:
        times = times.dt.tz_convert("UTC").dt.tz_localize(None)
    return times.astype("datetime64[us]").astype("int64")


def step(state: tuple | None, close: float):
    """One bar through all recurrences: the new state and the indicator values, null while warming up."""
    mean = lambda before, value, alpha: value if before is None else alpha * value + (1 - alpha) * before
    n, fast, slow, signal, gain, loss, last, closes = state or (0, None, None, None, None, None, None, [])
    n, move = n + 1, 0.0 if last is None else close - last
    fast, slow = mean(fast, close, 2 / 13), mean(slow, close, 2 / 27)
    gain, loss = mean(gain, max(move, 0.0), 1 / 14), mean(loss, max(-move, 0.0), 1 / 14)
    macd = fast - slow if n >= 26 else None
    signal = None if macd is None else mean(signal if n > 26 else None, macd, 2 / 10)
    shown = signal if n >= 34 else None
    closes = [*closes, close][-30:]
    rsi = None if n < 14 else 100.0 if loss == 0 else 100 - 100 / (1 + gain / loss)
    band = closes[-20:]
    mid = sum(band) / 20 if n >= 20 else None
    sd = (sum((c - mid) ** 2 for c in band) / 20) ** 0.5 if n >= 20 else None
    z = None
    if n >= 30:
        m = sum(closes) / 30
        s = (sum((c - m) ** 2 for c in closes) / 29) ** 0.5
        z = (close - m) / s if s else None
    values = (rsi, macd, shown, None if shown is None else macd - shown, mid, None if sd is None else mid + 2 * sd, None if sd is None else mid - 2 * sd, z, None if z is None or abs(z) < 2.0 else "HIGH" if z > 0 else "LOW")
    # stored state has no nulls: before the first MACD the signal is not read
    return (n, fast, slow, signal or 0.0, gain, loss, close, closes), values


def indicators(bars: DataFrame, late: str = LATENESS, width: datetime.timedelta = datetime.timedelta(days=1)) -> DataFrame:
    """Indicators, z-scores and their flags of a stream of bars, in append mode; bars without a time or close are left out.

    A bar comes out when the watermark has passed the end of its bucket of ``width``.
    """
    rows = bars.where("ts is not null and close is not null").withWatermark("ts", late)
    return rows.groupBy("ticker").transformWithStateInPandas(Indicators(width), Indicators.OUT, "append", "EventTime")
