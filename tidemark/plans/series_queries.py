"""Queries over bars: windows, indicators, anomalies, features, strategy and serving."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.series import KEY, business_days, change, lag, position, rolling, skipped
from ..functions.recurrence import ewm
from ..operators import anomalies, features, forecasts, indicators, sentiment, serving, strategy
from ..sources import tables
from .registry import BARS, CURVE, DAILY_SENTIMENT, FLAGS, FORECASTS, HEADLINES, INDICATORS, INTRADAY, PREDICTIONS, QFLAGS, SCORED, ZFLAGS, query, rounded

IND_DIGITS = {"rsi_14": 4, "macd": 2, "macd_signal": 2, "macd_hist": 2, "bb_upper": 2, "bb_middle": 4, "bb_lower": 2}


def _bars(spark, sf_dir):
    return tables.daily_bars(spark, sf_dir)


def _slog(c):
    """A value of any size as signed logarithm: compounding gives sizes that only compare relatively."""
    return F.round(F.signum(c) * F.log10(1 + F.abs(F.col(c))), 6).alias(c)


def _slog_sql(c):
    return f"round(sign({c}) * log10(1 + abs({c})), 6) AS {c}"


@query(f"WITH {BARS} SELECT * FROM bars")
def daily_bars(spark, sf_dir):
    return _bars(spark, sf_dir)


@query(f"WITH {INTRADAY} SELECT * FROM intraday")
def intraday_bars_15m(spark, sf_dir):
    return tables.intraday_bars(spark, sf_dir)


@query("""WITH t AS (SELECT event_type AS ticker, CAST(ts AS DATE) AS ds, value, event_id FROM events)
SELECT ticker, ds, arg_min(value, event_id) AS y, min(event_id) AS first_event FROM t GROUP BY 1, 2""")
def daily_first_row(spark, sf_dir):
    ticks = tables.ticks(tables.table(spark, sf_dir, "events")).withColumn("ds", F.to_date("ts"))
    return ticks.groupBy(KEY, "ds").agg(F.min_by("price", "seq").alias("y"), F.min("seq").alias("first_event"))


@query(f"""WITH {BARS} SELECT ticker, ds, lag(close, 1) OVER w AS close_lag_1, lag(close, 2) OVER w AS close_lag_2, lag(close, 3) OVER w AS close_lag_3,
lag(close, 5) OVER w AS close_lag_5, lag(close, 10) OVER w AS close_lag_10, round(close / nullif(lag(close, 1) OVER w, 0) - 1, 8) AS return_1d,
round(close / nullif(lag(close, 5) OVER w, 0) - 1, 8) AS return_5d, round(volume / nullif(lag(volume) OVER w, 0) - 1, 8) AS volume_change
FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY ds)""")
def lag_returns(spark, sf_dir):
    at = {"time": "ds"}
    return _bars(spark, sf_dir).select(
        KEY, "ds", *[lag("close", k, **at).alias(f"close_lag_{k}") for k in features.LAGS], *[F.round(change("close", k, **at), 8).alias(f"return_{k}d") for k in (1, 5)], F.round(change("volume", 1, **at), 8).alias("volume_change")
    )


@query(f"""WITH {BARS} SELECT ticker, ds, {', '.join(f"CASE WHEN count(*) OVER w{n} = {n} THEN round(avg(close) OVER w{n}, 4) END AS rolling_mean_{n}, CASE WHEN count(*) OVER w{n} = {n} THEN round(stddev_samp(close) OVER w{n}, 2) END AS rolling_std_{n}" for n in (5, 10, 20))}
FROM bars WINDOW {', '.join(f"w{n} AS (PARTITION BY ticker ORDER BY ds ROWS {n - 1} PRECEDING)" for n in (5, 10, 20))}""")
def rolling_stats(spark, sf_dir):
    columns = [F.round(rolling(f, "close", n, time="ds"), d).alias(f"rolling_{k}_{n}") for n in features.WINDOWS for k, f, d in (("mean", F.avg, 4), ("std", F.stddev_samp, 2))]
    return _bars(spark, sf_dir).select(KEY, "ds", *columns)


@query(INDICATORS + " SELECT ticker, ds, round(bb_middle, 4) AS bb_middle, round(bb_upper, 2) AS bb_upper, round(bb_lower, 2) AS bb_lower FROM ind")
def bollinger_20(spark, sf_dir):
    rows = indicators.bollinger(_bars(spark, sf_dir), time="ds").select(KEY, "ds", "bb_middle", "bb_upper", "bb_lower")
    return rounded(rows, bb_middle=4, bb_upper=2, bb_lower=2)


@query(INDICATORS + " SELECT ticker, ds, round(fast, 3) AS ema_12, round(slow, 3) AS ema_26 FROM ind")
def ema_12_26(spark, sf_dir):
    rows = ewm(_bars(spark, sf_dir), {"ema_12": ("close", 2 / 13), "ema_26": ("close", 2 / 27)}, time="ds")
    return rounded(rows.select(KEY, "ds", "ema_12", "ema_26"), ema_12=3, ema_26=3)


@query(INDICATORS + " SELECT ticker, ds, round(macd, 2) AS macd, round(macd_signal, 2) AS macd_signal, round(macd_hist, 2) AS macd_hist FROM ind")
def macd(spark, sf_dir):
    return rounded(indicators.macd(_bars(spark, sf_dir), time="ds").select(KEY, "ds", "macd", "macd_signal", "macd_hist"), macd=2, macd_signal=2, macd_hist=2)


@query(INDICATORS + " SELECT ticker, ds, round(rsi_14, 4) AS rsi_14 FROM ind")
def rsi_14(spark, sf_dir):
    return rounded(indicators.rsi(_bars(spark, sf_dir), time="ds").select(KEY, "ds", "rsi_14"), rsi_14=4)


IND_SQL = ", ".join(f"round({c}, {d}) AS {c}" for c, d in IND_DIGITS.items())


@query(INDICATORS + f" SELECT ticker, ds, {IND_SQL} FROM ind WHERE rn >= 26")
def indicators_full(spark, sf_dir):
    return rounded(indicators.indicators(_bars(spark, sf_dir), time="ds").select(KEY, "ds", *IND_DIGITS), **IND_DIGITS)


@query(INDICATORS + """, k AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY ds DESC) AS back FROM ind WHERE rn >= 26)
SELECT ticker, ds, round(rsi_14, 4) AS rsi_14, CASE WHEN rsi_14 > 70 THEN 'OVERBOUGHT' WHEN rsi_14 < 30 THEN 'OVERSOLD' ELSE 'NEUTRAL' END AS rsi_zone,
CASE WHEN macd > macd_signal THEN 'BULLISH' ELSE 'BEARISH' END AS macd_side FROM k WHERE back <= 10""")
def indicator_readings(spark, sf_dir):
    rows = serving.latest(indicators.indicators(_bars(spark, sf_dir), time="ds"), 10, "ds")
    return rounded(indicators.readings(rows).select(KEY, "ds", "rsi_14", "rsi_zone", "macd_side"), rsi_14=4)


@query(f"WITH {BARS}, {ZFLAGS} SELECT ticker, ds, close, round(zscore, 6) AS zscore, flag FROM zflags")
def zscore_anomalies(spark, sf_dir):
    return rounded(anomalies.zscore_flags(_bars(spark, sf_dir), time="ds"), zscore=6)


@query(f"WITH {BARS}, {QFLAGS} SELECT ticker, ds, close, round(zscore, 6) AS zscore, flag FROM qflags")
def iqr_anomalies(spark, sf_dir):
    return rounded(anomalies.iqr_flags(_bars(spark, sf_dir), time="ds"), zscore=6)


@query(f"WITH {BARS}, {FLAGS} SELECT ticker, ds, close, round(zscore, 6) AS zscore, flag FROM flags")
def anomalies_merged(spark, sf_dir):
    return rounded(anomalies.merged_flags(_bars(spark, sf_dir), time="ds"), zscore=6)


@query(f"""WITH {BARS}, {FLAGS} SELECT ticker, count(*) FILTER (flag = 'HIGH') AS spikes, count(*) FILTER (flag = 'LOW') AS crashes, count(*) AS total,
round(max(abs(zscore)), 6) AS max_zscore, max(ds) AS last_seen FROM flags GROUP BY 1""")
def anomaly_summary(spark, sf_dir):
    return rounded(anomalies.summary(anomalies.merged_flags(_bars(spark, sf_dir), time="ds"), time="ds"), max_zscore=6)


@query(f"WITH {BARS} SELECT ticker, ds, close, row_number() OVER (PARTITION BY ticker ORDER BY ds DESC) <= 30 AS is_holdout FROM bars")
def holdout_split(spark, sf_dir):
    return features.holdout(_bars(spark, sf_dir).select(KEY, "ds", "close"))


@query(f"""WITH {BARS}, l AS (SELECT ticker, max(ds) AS last FROM bars GROUP BY 1),
d AS (SELECT ticker, last + CAST(i AS INT) AS ds FROM l, range(1, 15) t(i)),
k AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY ds) AS step FROM d WHERE isodow(ds) <= 5) SELECT ticker, ds, step FROM k WHERE step <= 7""")
def next_business_days(spark, sf_dir):
    last = _bars(spark, sf_dir).groupBy(KEY).agg(F.max("ds").alias("last"))
    days = last.select(KEY, F.posexplode(business_days("last", 7)).alias("at", "ds"))
    return days.select(KEY, "ds", (F.col("at") + 1).cast("long").alias("step"))


@query(f"""WITH {BARS} SELECT ticker, ds, lead(ds) OVER w AS target_day, lead(close) OVER w AS target_next_close, coalesce(CAST(lead(close) OVER w > close AS INT), 0) AS target_direction
FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY ds)""")
def next_close_target(spark, sf_dir):
    return features.targets(_bars(spark, sf_dir)).select(KEY, "ds", "target_day", "target_next_close", "target_direction")


@query("""WITH t AS (SELECT event_type AS ticker, CAST(ts AS DATE) AS ds, count(DISTINCT time_bucket(INTERVAL '15 minutes', ts)) AS n_rows FROM events GROUP BY 1, 2)
SELECT ticker, ds, stage, n_rows, needed FROM t, (VALUES ('indicators', 26::bigint), ('zscore', 30), ('forecast', 60), ('trees', 60), ('stack', 90)) g(stage, needed) WHERE n_rows < needed""")
def history_gate(spark, sf_dir):
    """The bars of each ticker and day as a series of their own: the stages that its length rules out."""
    return skipped(tables.intraday_bars(spark, sf_dir).withColumn("ds", F.to_date("ts")), [KEY, "ds"])


@query(f"WITH {BARS} SELECT ticker, max(ds) AS ds, arg_max(close, ds) AS close FROM bars GROUP BY 1")
def latest_price(spark, sf_dir):
    return serving.latest_price(_bars(spark, sf_dir))


CHANGE = """chg AS (SELECT ticker, ds, close, high, low, lag(close) OVER w AS previous, close - lag(close) OVER w AS change,
    100 * (close - lag(close) OVER w) / nullif(lag(close) OVER w, 0) AS change_pct, row_number() OVER (PARTITION BY ticker ORDER BY ds DESC) AS back
    FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY ds)),
moved AS (SELECT ticker, ds, close, high, low, previous, round(change, 4) AS change, round(change_pct, 6) AS change_pct FROM chg WHERE back = 1)"""


@query(f"WITH {BARS}, {CHANGE} SELECT *, printf('%+.2f%%', change_pct) AS shown FROM moved")
def price_change(spark, sf_dir):
    rows = rounded(serving.price_change(_bars(spark, sf_dir)), change=4, change_pct=6)
    return rows.withColumn("shown", forecasts.percent(F.col("change_pct")))


@query(f"WITH {BARS}, k AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY ds DESC) AS back FROM bars) SELECT * EXCLUDE (back) FROM k WHERE back <= 60")
def latest_n(spark, sf_dir):
    return serving.latest(_bars(spark, sf_dir), 60, "ds")


@query(f"WITH {HEADLINES} SELECT ticker, source, count(*) AS n_rows FROM headlines GROUP BY 1, 2")
def rows_per_source(spark, sf_dir):
    return serving.rows_per_source(tables.headlines(spark, sf_dir))


AS_OF = "1995-07-15"
MOOD = f"""recent AS (SELECT ticker, avg(compound) AS avg_compound, count(*) FILTER (sentiment = 'positive') AS positive, count(*) FILTER (sentiment = 'negative') AS negative,
    count(*) FILTER (sentiment = 'neutral') AS neutral, count(*) AS total, max(published_at) AS latest
    FROM scored WHERE published_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY AND published_at <= TIMESTAMP '{AS_OF}' GROUP BY 1)"""


@query(f"""{INDICATORS}, {FLAGS}, {SCORED}, {MOOD}, {CHANGE},
li AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY ds DESC) AS back FROM ind WHERE rn >= 26),
cf AS (SELECT ticker, count(*) AS n_anomalies FROM flags GROUP BY 1)
SELECT m.*, round(rsi_14, 4) AS rsi_14, CASE WHEN rsi_14 > 70 THEN 'OVERBOUGHT' WHEN rsi_14 < 30 THEN 'OVERSOLD' WHEN rsi_14 IS NOT NULL THEN 'NEUTRAL' END AS rsi_zone,
CASE WHEN macd > macd_signal THEN 'BULLISH' WHEN macd IS NOT NULL THEN 'BEARISH' END AS macd_side, coalesce(n_anomalies, 0) AS n_anomalies, round(avg_compound, 8) AS avg_compound,
CASE WHEN avg_compound > 0.1 THEN 'POSITIVE' WHEN avg_compound < -0.1 THEN 'NEGATIVE' WHEN avg_compound IS NOT NULL THEN 'NEUTRAL' END AS sentiment_zone
FROM moved m LEFT JOIN (SELECT * FROM li WHERE back = 1) l USING (ticker) LEFT JOIN cf USING (ticker) LEFT JOIN recent USING (ticker)""".replace(
    "SELECT m.*, round(rsi_14", "SELECT m.ticker, m.ds, m.close, m.high, m.low, m.previous, m.change, m.change_pct, round(rsi_14"))
def header_metrics(spark, sf_dir):
    mood = sentiment.summary(sentiment.by_lexicon(tables.headlines(spark, sf_dir)), F.lit(AS_OF).cast("timestamp"))
    rows = serving.header(features.flagged_frame(_bars(spark, sf_dir)), mood)
    return rounded(rows, change=4, change_pct=6, rsi_14=4, avg_compound=8)


@query(f"WITH {SCORED} SELECT * FROM scored")
def headline_scores_lexicon(spark, sf_dir):
    return sentiment.by_lexicon(tables.headlines(spark, sf_dir))


@query("SELECT doc_id, CASE WHEN quality = 1 THEN 0.7 ELSE 0.1 END AS score_pos, CASE WHEN toxic = 1 THEN 0.8 ELSE 0.2 END AS score_neg, 0.1::double AS score_neu, "
       "round(CASE WHEN quality = 1 THEN 0.7 ELSE 0.1 END - CASE WHEN toxic = 1 THEN 0.8 ELSE 0.2 END, 4) AS compound, "
       "CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'negative' END AS sentiment FROM labels".replace("0.7 ", "0.7::double ").replace("0.8 ", "0.8::double ").replace("0.1 ", "0.1::double ").replace("0.2 ", "0.2::double "))
def class_score_labels(spark, sf_dir):
    rows = tables.table(spark, sf_dir, "labels")
    pos, neg = F.when(F.col("quality") == 1, 0.7).otherwise(0.1), F.when(F.col("toxic") == 1, 0.8).otherwise(0.2)
    return sentiment.labelled(rows.select("doc_id", pos.alias("score_pos"), neg.alias("score_neg"), F.lit(0.1).alias("score_neu")))


@query(f"WITH {DAILY_SENTIMENT} SELECT ticker, ds, round(sentiment_compound, 8) AS sentiment_compound, pos_count, neg_count, article_count FROM mood")
def sentiment_daily(spark, sf_dir):
    return rounded(sentiment.daily(sentiment.by_lexicon(tables.headlines(spark, sf_dir))), sentiment_compound=8)


@query(f"WITH {SCORED}, {MOOD} SELECT ticker, round(avg_compound, 8) AS avg_compound, positive, negative, neutral, total, latest FROM recent")
def sentiment_summary(spark, sf_dir):
    rows = sentiment.summary(sentiment.by_lexicon(tables.headlines(spark, sf_dir)), F.lit(AS_OF).cast("timestamp"))
    return serving.ranked(rounded(rows, avg_compound=8), "avg_compound")


@query(f"""WITH {SCORED}, k AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY published_at DESC, headline, source) AS back FROM scored)
SELECT ticker, source, published_at, headline, compound, sentiment FROM k WHERE back <= 15""")
def sentiment_tail(spark, sf_dir):
    rows = serving.latest(sentiment.by_lexicon(tables.headlines(spark, sf_dir)), 15, "published_at", ["headline", "source"])
    return rows.select(KEY, "source", "published_at", "headline", "compound", "sentiment")


@query(f"""WITH {SCORED}, new AS (SELECT * FROM scored s WHERE published_at >= TIMESTAMP '1995-03-01' OR ticker IN (SELECT NULL)),
old AS (SELECT DISTINCT ticker, headline, published_at FROM scored WHERE published_at < TIMESTAMP '1995-03-01'),
k AS (SELECT *, row_number() OVER (PARTITION BY ticker, headline, published_at ORDER BY source) AS n FROM scored s
  WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.ticker IS NOT DISTINCT FROM s.ticker AND o.headline IS NOT DISTINCT FROM s.headline AND o.published_at = s.published_at))
SELECT * EXCLUDE (n) FROM k WHERE n = 1""")
def score_only_new(spark, sf_dir):
    rows = tables.headlines(spark, sf_dir)
    return sentiment.score_new(rows.where("published_at < timestamp '1995-03-01'"), rows, sentiment.by_lexicon)


@query(f"""{INDICATORS}, {FLAGS} SELECT b.ticker, b.ds, b.open, b.high, b.low, b.close, b.volume, round(rsi_14, 4) AS rsi_14, round(macd, 2) AS macd, round(macd_signal, 2) AS macd_signal,
round(bb_upper, 2) AS bb_upper, round(bb_middle, 4) AS bb_middle, round(bb_lower, 2) AS bb_lower, round(zscore, 6) AS zscore, flag
FROM bars b LEFT JOIN (SELECT * FROM ind WHERE rn >= 26) i USING (ticker, ds) LEFT JOIN flags f USING (ticker, ds)
WHERE b.ds >= TIMESTAMP '{AS_OF}' - INTERVAL 90 DAY AND b.ds <= TIMESTAMP '{AS_OF}'""")
def price_panel(spark, sf_dir):
    rows = serving.price_panel(features.flagged_frame(_bars(spark, sf_dir)), F.lit(AS_OF).cast("timestamp"), 90)
    return rounded(rows, rsi_14=4, macd=2, macd_signal=2, bb_upper=2, bb_middle=4, bb_lower=2, zscore=6)


FEATURE_DIGITS = {
    **{f"rolling_mean_{n}": 4 for n in (5, 10, 20)}, **{f"rolling_std_{n}": 2 for n in (5, 10, 20)}, "return_1d": 8, "return_5d": 8, "hl_range": 4, "volume_change": 8,
    "rsi_14": 4, "macd": 2, "macd_signal": 2, "macd_hist": 2, "bb_position": 6, "bb_width": 6, "zscore": 6, "sentiment_compound": 8, "sentiment_3d": 8, "sentiment_change": 8,
}


def matrix(spark, sf_dir, labelled=True):
    mood = sentiment.daily(sentiment.by_lexicon(tables.headlines(spark, sf_dir)))
    return features.feature_matrix(features.flagged_frame(_bars(spark, sf_dir), mood), labelled=labelled)


@query(f"""{INDICATORS}, {FLAGS}, {DAILY_SENTIMENT},
j AS (SELECT b.*, i.rsi_14, i.macd, i.macd_signal, i.macd_hist, i.bb_upper, i.bb_middle, i.bb_lower, coalesce(zscore, 0) AS zscore,
  CAST(abs(coalesce(zscore, 0)) >= 2.0 AS INT) AS is_anomaly, coalesce(sentiment_compound, 0) AS sentiment_compound, coalesce(pos_count, 0) AS pos_count,
  coalesce(neg_count, 0) AS neg_count, coalesce(article_count, 0) AS article_count
  FROM bars b LEFT JOIN (SELECT * FROM ind WHERE rn >= 26) i USING (ticker, ds) LEFT JOIN flags f USING (ticker, ds) LEFT JOIN mood m USING (ticker, ds)),
x AS (SELECT *, lag(close, 1) OVER w AS close_lag_1, lag(close, 2) OVER w AS close_lag_2, lag(close, 3) OVER w AS close_lag_3, lag(close, 5) OVER w AS close_lag_5,
  lag(close, 10) OVER w AS close_lag_10, close / nullif(lag(close, 1) OVER w, 0) - 1 AS return_1d, close / nullif(lag(close, 5) OVER w, 0) - 1 AS return_5d,
  {', '.join(f"CASE WHEN count(*) OVER w{n} = {n} THEN avg(close) OVER w{n} END AS rolling_mean_{n}, CASE WHEN count(*) OVER w{n} = {n} THEN stddev_samp(close) OVER w{n} END AS rolling_std_{n}" for n in (5, 10, 20))},
  high - low AS hl_range, volume / nullif(lag(volume) OVER w, 0) - 1 AS volume_change, (close - bb_lower) / nullif(bb_upper - bb_lower, 0) AS bb_position,
  (bb_upper - bb_lower) / nullif(bb_middle, 0) AS bb_width, CASE WHEN count(*) OVER w3 = 3 THEN avg(sentiment_compound) OVER w3 ELSE 0 END AS sentiment_3d,
  coalesce(sentiment_compound - lag(sentiment_compound) OVER w, 0) AS sentiment_change, lead(close) OVER w AS target_next_close, lead(ds) OVER w AS target_day,
  coalesce(CAST(lead(close) OVER w > close AS INT), 0) AS target_direction
  FROM j WINDOW w AS (PARTITION BY ticker ORDER BY ds), {', '.join(f"w{n} AS (PARTITION BY ticker ORDER BY ds ROWS {n - 1} PRECEDING)" for n in (3, 5, 10, 20))})
SELECT ticker, ds, close, {', '.join(f"round(coalesce({f}, 0), {FEATURE_DIGITS[f]}) AS {f}" if f in FEATURE_DIGITS else f"coalesce({f}, 0) AS {f}" for f in features.FEATURES)}, target_day, target_next_close, target_direction
FROM x WHERE close_lag_10 IS NOT NULL AND rolling_mean_20 IS NOT NULL AND target_next_close IS NOT NULL""")
def feature_matrix_33(spark, sf_dir):
    return rounded(matrix(spark, sf_dir), **FEATURE_DIGITS)


def predictions(spark, sf_dir):
    """The last 30 bars of each ticker with the stand-in models' predictions."""
    at = {"time": "ds"}
    wide = _bars(spark, sf_dir).select(KEY, "ds", F.col("close").alias("actual"), lag("close", 1, **at).alias("previous"), *[lag("close", k, **at).alias(f"m{k}") for k in range(1, 5)], position(time="ds", last=True).alias("back"))
    return wide.where("back <= 30").drop("back").unpivot([KEY, "ds", "actual", "previous"], [f"m{k}" for k in range(1, 5)], "model", "predicted")


@query(f"""WITH {PREDICTIONS} SELECT ticker, model, count(*) AS n, round(sqrt(avg((actual - predicted) ** 2)), 2) AS rmse, round(avg(abs(actual - predicted)), 3) AS mae,
round(100 * avg(abs((actual - predicted) / nullif(actual, 0))), 4) AS mape FROM held GROUP BY 1, 2""")
def naive_forecast_metrics(spark, sf_dir):
    return rounded(forecasts.errors(predictions(spark, sf_dir), [KEY, "model"]), rmse=2, mae=3, mape=4)


@query(f"""WITH {PREDICTIONS}, g AS (SELECT ticker, model, 100 * avg(abs((actual - predicted) / nullif(actual, 0))) AS mape FROM held GROUP BY 1, 2),
o AS (SELECT ticker, min(mape) AS best_base FROM g WHERE model <> 'm4' GROUP BY 1)
SELECT ticker, model, round(mape, 4) AS mape, rank() OVER (PARTITION BY ticker ORDER BY mape) AS rank, round(best_base, 4) AS best_base,
round(CASE WHEN model = 'm4' THEN 100 * (best_base - mape) / nullif(best_base, 0) END, 4) AS improvement_pct FROM g LEFT JOIN o USING (ticker)""")
def error_ranking(spark, sf_dir):
    scores = forecasts.errors(predictions(spark, sf_dir), [KEY, "model"]).select(KEY, "model", "mape")
    return rounded(forecasts.comparison(scores, "m4"), mape=4, best_base=4, improvement_pct=4)


@query(f"WITH {PREDICTIONS} SELECT ticker, model, ds, signal, entry, round(day_return, 8) AS day_return, round(strategy_return, 8) AS strategy_return FROM strat")
def strategy_signals(spark, sf_dir):
    rows = strategy.signals(predictions(spark, sf_dir))
    return rounded(rows.select(KEY, "model", "ds", "signal", "entry", "day_return", "strategy_return"), day_return=8, strategy_return=8)


def _curve(spark, sf_dir):
    return strategy.equity(strategy.signals(predictions(spark, sf_dir)))


@query(f"WITH {CURVE} SELECT ticker, model, day, ds, {_slog_sql('value')}, {_slog_sql('benchmark')} FROM curve")
def equity_curve(spark, sf_dir):
    return _curve(spark, sf_dir).select(KEY, "model", F.col("day").cast("long").alias("day"), "ds", _slog("value"), _slog("benchmark"))


DRAWDOWN = "dd AS (SELECT ticker, model, min(d) AS max_drawdown FROM (SELECT ticker, model, (value - max(value) OVER w) / nullif(max(value) OVER w, 0) AS d FROM curve WINDOW w AS (PARTITION BY ticker, model ORDER BY day ROWS UNBOUNDED PRECEDING)) GROUP BY 1, 2)"


@query(f"WITH {CURVE}, {DRAWDOWN} SELECT ticker, model, round(max_drawdown, 8) AS max_drawdown FROM dd")
def max_drawdown(spark, sf_dir):
    return rounded(strategy.drawdowns(_curve(spark, sf_dir)), max_drawdown=8)


SIZED = ["total_return", "benchmark_return", "annualized_return", "benchmark_annualized", "alpha", "final_value"]


@query(f"""WITH {CURVE}, {DRAWDOWN}, m AS (SELECT ticker, model, count(*) AS holdout_days, product(1 + strategy_return) - 1 AS total_return, product(1 + day_return) - 1 AS benchmark_return,
  CASE WHEN stddev_pop(strategy_return) = 0 THEN 0 ELSE coalesce(avg(strategy_return - 0.045 / 252) / nullif(stddev_pop(strategy_return - 0.045 / 252), 0) * sqrt(252), 0) END AS sharpe_ratio,
  coalesce(count(*) FILTER (signal = 1 AND day_return > 0) / nullif(count(*) FILTER (signal = 1), 0)::double, 0) AS win_rate, sum(entry)::bigint AS num_trades FROM strat GROUP BY 1, 2),
a AS (SELECT *, (1 + total_return) ** (252.0 / holdout_days) - 1 AS annualized_return, (1 + benchmark_return) ** (252.0 / holdout_days) - 1 AS benchmark_annualized, 10000 * (1 + total_return) AS final_value FROM m),
z AS (SELECT *, annualized_return - benchmark_annualized AS alpha FROM a)
SELECT ticker, model, holdout_days, round(sharpe_ratio, 6) AS sharpe_ratio, round(win_rate, 8) AS win_rate, num_trades, round(max_drawdown, 8) AS max_drawdown, {', '.join(map(_slog_sql, SIZED))} FROM z JOIN dd USING (ticker, model)""")
def strategy_metrics(spark, sf_dir):
    rows = strategy.metrics(predictions(spark, sf_dir))
    return rounded(rows, sharpe_ratio=6, win_rate=8, max_drawdown=8).select(KEY, "model", "holdout_days", "sharpe_ratio", "win_rate", "num_trades", "max_drawdown", *map(_slog, SIZED))


@query(f"WITH {CURVE} SELECT ticker, model, day, {_slog_sql('value')}, {_slog_sql('benchmark')} FROM curve")
def equity_series_json(spark, sf_dir):
    rows = strategy.series_rows(strategy.series_json(_curve(spark, sf_dir)))
    return rows.select(KEY, "model", F.col("day").cast("long").alias("day"), _slog("value"), _slog("benchmark"))


@query(f"""WITH {PREDICTIONS}, g AS (SELECT ticker, model, sqrt(avg((actual - predicted) ** 2)) AS rmse, avg(abs(actual - predicted)) AS mae FROM held GROUP BY 1, 2)
SELECT ticker, model, 'rmse' AS name, round(rmse, 2) AS value FROM g UNION ALL SELECT ticker, model, 'mae', round(mae, 2) FROM g""")
def run_metrics_long(spark, sf_dir):
    from ..sources.keyed import metric_rows

    return rounded(metric_rows(forecasts.errors(predictions(spark, sf_dir), [KEY, "model"]), [KEY, "model"], ["rmse", "mae"]), value=2)


def _forecasts(spark, sf_dir):
    return tables.stand_in_forecasts(_bars(spark, sf_dir))


@query(f"""WITH {FORECASTS} SELECT ticker, model, forecast_date, round(avg(predicted_close), 7) AS predicted_close, round(avg(lower_bound), 7) AS lower_bound,
round(avg(upper_bound), 7) AS upper_bound FROM forecasts GROUP BY 1, 2, 3""")
def forecast_avg_runs(spark, sf_dir):
    return rounded(forecasts.averaged(_forecasts(spark, sf_dir)), predicted_close=7, lower_bound=7, upper_bound=7)


LAST_RUN = "lr AS (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY ticker, model, forecast_date ORDER BY run_at DESC) AS k FROM forecasts) WHERE k = 1)"


@query(f"WITH {FORECASTS}, {LAST_RUN} SELECT ticker, model, forecast_date, round(predicted_close, 7) AS predicted_close, run_at FROM lr")
def latest_run(spark, sf_dir):
    return rounded(forecasts.latest_run(_forecasts(spark, sf_dir)).select(KEY, "model", "forecast_date", "predicted_close", "run_at"), predicted_close=7)


@query(f"""WITH {FORECASTS}, {LAST_RUN} SELECT ticker, forecast_date, round(max(predicted_close) FILTER (model = 'm1'), 7) AS m1, round(max(predicted_close) FILTER (model = 'm2'), 7) AS m2,
round(max(predicted_close) FILTER (model = 'm3'), 7) AS m3, round(max(predicted_close) FILTER (model = 'm4'), 7) AS m4 FROM lr GROUP BY 1, 2 HAVING count(*) = 4""")
def forecast_pivot(spark, sf_dir):
    return rounded(forecasts.pivoted(_forecasts(spark, sf_dir), ["m1", "m2", "m3", "m4"], complete=True), m1=7, m2=7, m3=7, m4=7)
