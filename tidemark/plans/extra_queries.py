"""Queries over artifacts, counts and variants of the operators."""

from __future__ import annotations

import re
import time

from pyspark.sql import functions as F

from ..functions import runs
from ..functions.lineage import scratch
from ..functions.long_series import numbered, rolling_blocks
from ..functions.recurrence import ewm
from ..functions.series import KEY
from ..operators import anomalies, forecasts, headline_model, sentiment, serving
from ..sources import keyed, tables
from ..streaming import bars as streams
from .registry import BARS, FLAGS, FORECASTS, SCORED, ZFLAGS, query, rounded


@query(f"""WITH {FORECASTS} SELECT ticker, model, forecast_date, round(predicted_close, 7) AS predicted_close, round(lower_bound, 7) AS lower_bound, round(upper_bound, 7) AS upper_bound
FROM forecasts WHERE run_at = TIMESTAMP '2024-01-02' AND model IN ('m1', 'm3')""")
def forecast_csv_artifacts(spark, sf_dir):
    """Forecasts of two models as CSV, a folder per model and ticker, read back."""
    path = scratch(spark, "artifacts")
    rows = tables.stand_in_forecasts(tables.daily_bars(spark, sf_dir))
    rows = forecasts.latest_run(rows.where(F.col("model").isin("m1", "m3"))).drop("run_at")
    keyed.save_csv(rows, path, ["model", KEY])
    kind = "forecast_date date, predicted_close double, lower_bound double, upper_bound double, model string, ticker string"
    back = spark.read.option("header", True).schema(kind).csv(path)
    return rounded(back.select(KEY, "model", "forecast_date", "predicted_close", "lower_bound", "upper_bound"), predicted_close=7, lower_bound=7, upper_bound=7)


@query(f"""WITH {SCORED}, k AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY published_at DESC, headline, source) AS back FROM scored)
SELECT ticker, count(*) FILTER (sentiment = 'positive') AS positive, count(*) FILTER (sentiment = 'negative') AS negative, count(*) FILTER (sentiment = 'neutral') AS neutral,
round(avg(compound), 8) AS avg_compound FROM k WHERE back <= 20 GROUP BY 1""")
def sentiment_shown_counts(spark, sf_dir):
    shown = serving.latest(sentiment.by_lexicon(tables.headlines(spark, sf_dir)), 20, "published_at", ["headline", "source"])
    count = lambda name: F.count_if(F.col("sentiment") == name).alias(name)
    return rounded(shown.groupBy(KEY).agg(count("positive"), count("negative"), count("neutral"), F.avg("compound").alias("avg_compound")), avg_compound=8)


def lexicon_batch(texts: list[str]) -> list[tuple[float, float, float] | None]:
    """The lexicon as a batch scorer in Python, standing in for a model that is loaded once per worker."""
    out = []
    for text in texts:
        words = [w for w in re.split("[^a-z]+", text.lower()) if w]
        pos, neg = (sum(w in names for w in words) for names in (sentiment.POSITIVE, sentiment.NEGATIVE))
        out.append((pos / len(words), neg / len(words), (len(words) - pos - neg) / len(words)) if words else None)
    return out


@query(f"WITH {SCORED} SELECT * FROM scored")
def headline_scores_batch(spark, sf_dir):
    """Each distinct headline goes through the batch scorer once."""
    return sentiment.score(tables.headlines(spark, sf_dir), lexicon_batch)


@query(f"""WITH {BARS}, {FLAGS} SELECT 'bars' AS stage, count(*) AS n_rows FROM bars UNION ALL SELECT 'zscore', count(*) FROM zflags UNION ALL SELECT 'iqr', count(*) FROM qflags
UNION ALL SELECT 'merged', count(*) FROM flags""")
def stage_counts(spark, sf_dir):
    """Rows of each stage of the anomaly run, observed while its flags are written; nothing is read again to count."""
    rows = anomalies.all_flags(tables.daily_bars(spark, sf_dir), time="ds")
    counted = runs.Counted(rows, "anomalies", bars=F.count(F.lit(1)), zscore=F.count_if("by_z"), iqr=F.count_if("by_fence"), merged=F.count("flag"))
    counted.frame.where("flag is not null").write.parquet(scratch(spark, "flags"))
    return counted.rows().select(F.col("name").alias("stage"), F.col("value").cast("long").alias("n_rows"))


@query("SELECT 'bars' AS name, count(*)::double AS value FROM events UNION ALL SELECT 'volume', sum(event_id % 100) FROM events UNION ALL SELECT 'input', count(*) FROM events")
def stream_run_counts(spark, sf_dir):
    """What the batches of a stream report of themselves, summed over the run."""
    events = tables.table(spark, sf_dir, "events")
    path, target = scratch(spark, "events"), scratch(spark, "counted")
    events.repartition(6).write.parquet(path)
    log = runs.RunLog()
    spark.streams.addListener(log)
    try:
        stream = streams.read(spark, path, events.schema, files=2)
        stream = stream.observe("ingest", F.count(F.lit(1)).alias("bars"), F.sum(F.col("event_id") % 100).alias("volume"))
        query_ = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{target}/progress").format("parquet").start(f"{target}/table")
        query_.awaitTermination()
        # the listener hears of the last batch a moment later
        deadline = time.time() + 30
        while time.time() < deadline and len(log.held) < query_.lastProgress.batchId + 1:
            time.sleep(0.05)
    finally:
        spark.streams.removeListener(log)
    log.write(spark, f"{target}/runs")
    return spark.read.parquet(f"{target}/runs").groupBy("name").agg(F.sum("value").alias("value"))


def _classes(spark, sf_dir):
    """Documents as headlines with a class of their labels: toxic ones negative, good ones positive, the rest neutral; and whether a row is left out of learning."""
    labels = tables.table(spark, sf_dir, "labels").where("doc_id is not null")
    labels = labels.groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    kind = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral")
    rows = tables.texts(spark, sf_dir).select("doc_id", F.col("text").alias("headline")).join(labels, "doc_id")
    return rows.select("headline", kind.alias("class"), (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("left_out"))


@query()
def headline_scores_trained(spark, sf_dir):
    """Scores of all headlines by a model learned from the labels, without those left out."""
    model = headline_model.learn(_classes(spark, sf_dir).where("not left_out"))
    return headline_model.score(model, tables.headlines(spark, sf_dir))


@query()
def headline_model_left_out(spark, sf_dir):
    """The model on the labelled rows it has not seen: rows by class and by the class of the largest share, with the mean of that share."""
    rows = _classes(spark, sf_dir)
    found = headline_model.score(headline_model.learn(rows.where("not left_out")), rows.where("left_out"))
    return found.groupBy("class", "sentiment").agg(F.count("*").alias("n_rows"), F.avg(F.greatest(*sentiment.SCORES)).alias("mean_share"))


CUT = "1996-06-30"


@query(f"""WITH {BARS}, rets AS (SELECT ticker, ds, close, 100 * (close / nullif(lag(close) OVER (PARTITION BY ticker ORDER BY ds), 0) - 1) AS r FROM bars),
fences AS (SELECT ticker, quantile_cont(r, 0.25) AS q1, quantile_cont(r, 0.75) AS q3, avg(r) AS mean, stddev_samp(r) AS sd FROM rets WHERE r IS NOT NULL AND ds <= DATE '{CUT}' GROUP BY 1)
SELECT ticker, ds, close, round((r - mean) / nullif(sd, 0), 6) AS zscore, CASE WHEN r > 0 THEN 'HIGH' ELSE 'LOW' END AS flag
FROM rets JOIN fences USING (ticker) WHERE r < q1 - 1.5 * (q3 - q1) OR r > q3 + 1.5 * (q3 - q1)""")
def iqr_frozen_fences(spark, sf_dir):
    """Fences fitted on the rows up to a day, so that later rows do not shape them."""
    return rounded(anomalies.iqr_flags(tables.daily_bars(spark, sf_dir), time="ds", fit_until=F.lit(CUT).cast("date")), zscore=6)


@query(f"""WITH {BARS}, {ZFLAGS}, k AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY ds DESC) AS back FROM zflags)
SELECT ticker, ds, close, round(zscore, 6) AS zscore, flag FROM k WHERE back <= 15""")
def anomaly_tail(spark, sf_dir):
    flags = anomalies.zscore_flags(tables.daily_bars(spark, sf_dir), time="ds")
    return rounded(serving.latest(flags, 15, "ds"), zscore=6)


def _numbered_ticks(spark, sf_dir):
    ticks = tables.ticks(tables.table(spark, sf_dir, "events"))
    return numbered(ticks, F.to_date("ts"), "n", ties=("seq",))


@query("""SELECT event_type AS ticker, event_id AS seq, n, CASE WHEN n >= 19 THEN round(avg(value) OVER w, 8) END AS mean_20, CASE WHEN n >= 19 THEN max(value) OVER w END AS max_20
FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS n FROM events) WINDOW w AS (PARTITION BY event_type ORDER BY n ROWS 19 PRECEDING)""")
def rolling_ticks(spark, sf_dir):
    """Rolling statistics over ticks by blocks of numbers: a long series is many tasks."""
    rows = rolling_blocks(_numbered_ticks(spark, sf_dir), {"mean_20": (F.avg, "price"), "max_20": (F.max, "price")}, 20, "n", block=500)
    return rounded(rows.select(KEY, "seq", "n", "mean_20", "max_20"), mean_20=8)


@query("""WITH RECURSIVE t AS (SELECT event_type AS ticker, event_id AS seq, value AS price, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS n FROM events),
e AS (SELECT ticker, seq, n, price AS m FROM t WHERE n = 0 UNION ALL SELECT t.ticker, t.seq, t.n, t.price * (2 / 13.0::double) + e.m * (11 / 13.0::double) FROM e JOIN t ON t.ticker = e.ticker AND t.n = e.n + 1)
SELECT ticker, seq, n, round(m, 8) AS ema_12 FROM e""")
def ema_ticks(spark, sf_dir):
    """An exponential mean over ticks with numbers from counts per day."""
    rows = ewm(_numbered_ticks(spark, sf_dir), {"ema_12": ("price", 2 / 13)}, index="n")
    return rounded(rows.select(KEY, "seq", "n", "ema_12"), ema_12=8)
