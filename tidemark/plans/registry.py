"""Registration of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its name, and its SQL if there is one."""

    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def r(column: str | Column, digits: int = 4) -> Column:
    """Rounded under its own name: results are compared after rounding, operators do not round."""
    name = column if isinstance(column, str) else None
    out = F.round(column, digits)
    return out.alias(name) if name else out


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


#: Parts of the SQL: the bars, intraday bars, headlines and stand-in forecasts that `sources.tables` derives.
BARS = """bars AS (
  SELECT o_orderpriority AS ticker, CAST(o_orderdate AS DATE) AS ds, arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
         min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close, count(*) AS volume FROM orders GROUP BY 1, 2)"""
INTRADAY = """intraday AS (
  SELECT event_type AS ticker, time_bucket(INTERVAL '15 minutes', ts) AS ts, arg_min(value, event_id) AS open, max(value) AS high,
         min(value) AS low, arg_max(value, event_id) AS close, count(*) AS volume FROM events GROUP BY 1, 2)"""
HEADLINES = """headlines AS (
  SELECT ['1-URGENT','2-HIGH','3-MEDIUM','4-NOT SPECIFIED','5-LOW'][CAST(doc_id % 5 AS INT) + 1] AS ticker, source,
         TIMESTAMP '1995-01-01' + to_days(CAST(doc_id % 200 AS INT)) + to_seconds(CAST(doc_id % 86400 AS INT)) AS published_at,
         text AS headline FROM documents)"""
SCORED = HEADLINES + """,
words AS (SELECT *, list_filter(regexp_split_to_array(lower(headline), '[^a-z]+'), lambda w: w <> '') AS w FROM headlines),
shares AS (SELECT ticker, source, published_at, headline,
    CASE WHEN len(w) > 0 THEN len(list_filter(w, lambda x: x IN ('the','for','was','sur','des','und','los'))) / len(w)::double ELSE 0.33 END AS p,
    CASE WHEN len(w) > 0 THEN len(list_filter(w, lambda x: x IN ('that','with','from','les','par','von','del'))) / len(w)::double ELSE 0.33 END AS g,
    len(w) AS k, w FROM words),
full_shares AS (SELECT *, CASE WHEN k > 0 THEN (k - len(list_filter(w, lambda x: x IN ('the','for','was','sur','des','und','los','that','with','from','les','par','von','del')))) / k::double ELSE 0.34 END AS u FROM shares),
scored AS (SELECT ticker, source, published_at, headline, round(p, 4) AS score_pos, round(g, 4) AS score_neg, round(u, 4) AS score_neu,
    round(p - g, 4) AS compound,
    CASE WHEN p = greatest(p, g, u) THEN 'positive' WHEN g = greatest(p, g, u) THEN 'negative' ELSE 'neutral' END AS sentiment FROM full_shares)"""
DAILY_SENTIMENT = SCORED + """,
mood AS (SELECT ticker, CAST(published_at AS DATE) AS ds, avg(compound) AS sentiment_compound,
    count(*) FILTER (sentiment = 'positive') AS pos_count, count(*) FILTER (sentiment = 'negative') AS neg_count, count(*) AS article_count
    FROM scored GROUP BY 1, 2)"""
FORECASTS = BARS + """,
lags AS (SELECT ticker, ds, unnest(['m1','m2','m3','m4']) AS model,
    unnest([lag(close, 1) OVER w, lag(close, 2) OVER w, lag(close, 3) OVER w, lag(close, 4) OVER w]) AS p
    FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY ds)),
forecasts AS (SELECT ticker, model, ds AS forecast_date, p * f AS predicted_close, p * f * 0.98 AS lower_bound, p * f * 1.02 AS upper_bound, run_at
    FROM lags, (VALUES (TIMESTAMP '2024-01-01', 1.0), (TIMESTAMP '2024-01-02', 1.01)) r(run_at, f) WHERE p IS NOT NULL)"""
PREDICTIONS = BARS + """,
pred AS (SELECT ticker, ds, close AS actual, lag(close) OVER w AS previous, unnest(['m1','m2','m3','m4']) AS model,
    unnest([lag(close, 1) OVER w, lag(close, 2) OVER w, lag(close, 3) OVER w, lag(close, 4) OVER w]) AS predicted,
    row_number() OVER (PARTITION BY ticker ORDER BY ds DESC) AS back FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY ds)),
held AS (SELECT * FROM pred WHERE back <= 30),
sig AS (SELECT *, CAST(predicted > previous AS INT) AS signal, (actual - previous) / previous AS day_return FROM held),
ent AS (SELECT *, CAST(signal = 1 AND coalesce(lag(signal) OVER (PARTITION BY ticker, model ORDER BY ds), 0) = 0 AS INT) AS entry FROM sig),
strat AS (SELECT *, signal * day_return - entry * 0.001 AS strategy_return FROM ent)"""
CURVE = PREDICTIONS + """,
curve AS (
  SELECT ticker, model, row_number() OVER w AS day, ds, 10000.0 * product(1 + strategy_return) OVER w AS value, 10000.0 * product(1 + day_return) OVER w AS benchmark
  FROM strat WINDOW w AS (PARTITION BY ticker, model ORDER BY ds ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT DISTINCT ticker, model, 0, CAST(NULL AS DATE), 10000.0, 10000.0 FROM strat)"""


def recurrences(source: str, time: str) -> str:
    """SQL of all indicators of a table ``source`` by plain recursion, as ``ind`` (all rows, null while warming up)."""
    return f"""
n AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY {time}) AS rn,
        coalesce(close - lag(close) OVER (PARTITION BY ticker ORDER BY {time}), 0) AS mv FROM {source}),
e AS (SELECT ticker, rn, close AS fast, close AS slow, greatest(mv, 0.0)::double AS gain, greatest(-mv, 0.0)::double AS loss, CAST(NULL AS DOUBLE) AS signal FROM n WHERE rn = 1
  UNION ALL SELECT n.ticker, n.rn, n.close * (2 / 13.0::double) + e.fast * (11 / 13.0::double), n.close * (2 / 27.0::double) + e.slow * (25 / 27.0::double),
    greatest(n.mv, 0.0) / 14 + e.gain * (13 / 14.0::double), greatest(-n.mv, 0.0) / 14 + e.loss * (13 / 14.0::double),
    CASE WHEN n.rn < 26 THEN NULL WHEN n.rn = 26 THEN (n.close * (2 / 13.0::double) + e.fast * (11 / 13.0::double)) - (n.close * (2 / 27.0::double) + e.slow * (25 / 27.0::double))
      ELSE 0.2::double * ((n.close * (2 / 13.0::double) + e.fast * (11 / 13.0::double)) - (n.close * (2 / 27.0::double) + e.slow * (25 / 27.0::double))) + 0.8::double * e.signal END
  FROM e JOIN n ON n.ticker = e.ticker AND n.rn = e.rn + 1),
ind AS (SELECT n.*, e.fast, e.slow, CASE WHEN n.rn >= 14 THEN CASE WHEN e.loss = 0 THEN 100 ELSE 100 - 100 / (1 + e.gain / e.loss) END END AS rsi_14,
    CASE WHEN n.rn >= 26 THEN e.fast - e.slow END AS macd, CASE WHEN n.rn >= 34 THEN e.signal END AS macd_signal,
    CASE WHEN n.rn >= 34 THEN e.fast - e.slow - e.signal END AS macd_hist,
    CASE WHEN n.rn >= 20 THEN avg(close) OVER w END AS bb_middle,
    CASE WHEN n.rn >= 20 THEN avg(close) OVER w + 2 * stddev_pop(close) OVER w END AS bb_upper,
    CASE WHEN n.rn >= 20 THEN avg(close) OVER w - 2 * stddev_pop(close) OVER w END AS bb_lower
  FROM n JOIN e USING (ticker, rn) WINDOW w AS (PARTITION BY ticker ORDER BY n.{time} ROWS 19 PRECEDING))"""


INDICATORS = "WITH RECURSIVE " + BARS + "," + recurrences("bars", "ds")
ZFLAGS = """
zs AS (SELECT ticker, ds, close, CASE WHEN count(*) OVER w = 30 THEN (close - avg(close) OVER w) / nullif(stddev_samp(close) OVER w, 0) END AS zscore
    FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY ds ROWS 29 PRECEDING)),
zflags AS (SELECT ticker, ds, close, zscore, CASE WHEN zscore > 0 THEN 'HIGH' ELSE 'LOW' END AS flag FROM zs WHERE abs(zscore) >= 2.0)"""
QFLAGS = """
rets AS (SELECT ticker, ds, close, 100 * (close / nullif(lag(close) OVER (PARTITION BY ticker ORDER BY ds), 0) - 1) AS r FROM bars),
fences AS (SELECT ticker, quantile_cont(r, 0.25) AS q1, quantile_cont(r, 0.75) AS q3, avg(r) AS mean, stddev_samp(r) AS sd FROM rets WHERE r IS NOT NULL GROUP BY 1),
qflags AS (SELECT ticker, ds, close, (r - mean) / nullif(sd, 0) AS zscore, CASE WHEN r > 0 THEN 'HIGH' ELSE 'LOW' END AS flag
    FROM rets JOIN fences USING (ticker) WHERE r < q1 - 1.5 * (q3 - q1) OR r > q3 + 1.5 * (q3 - q1))"""
FLAGS = ZFLAGS + "," + QFLAGS + """,
flags AS (SELECT * EXCLUDE (p, k) FROM (SELECT *, row_number() OVER (PARTITION BY ticker, ds ORDER BY p) AS k
    FROM (SELECT *, 0 AS p FROM zflags UNION ALL SELECT *, 1 AS p FROM qflags)) WHERE k = 1)"""
