"""The stack and the ensemble over stand-in models, whose results SQL can compute from the bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.series import KEY, lag, position
from ..operators import ensemble, features, forecasts
from ..sources import landed, tables
from .registry import BARS, SQL, query, rounded
from .series_queries import matrix

#: Closes are scaled so that the penalties of the grid matter.
SCALE = 1e5
PAIR = ["m1", "m2"]


def _parts(spark, sf_dir):
    """One table per stand-in model over the last 30 bars: the closes one and two bars before, the second without bars that closed below their opening."""
    wide = tables.daily_bars(spark, sf_dir).select(
        KEY, "ds", (F.col("close") / SCALE).alias("actual"), *[(lag("close", k, time="ds") / SCALE).alias(f"m{k}") for k in (1, 2)],
        (F.col("close") >= F.col("open")).alias("up"), position(time="ds", last=True).alias("back"),
    ).where("back <= 30")
    return [wide.select(KEY, "ds", "actual", "m1"), wide.select(KEY, "ds", "actual", "m2"), wide.where("up").select(KEY, "ds", "actual", F.col("m2").alias("m3"))]


HELD = BARS + f""",
lagged AS (SELECT ticker, ds, close / {SCALE} AS actual, lag(close) OVER w / {SCALE} AS m1, lag(close, 2) OVER w / {SCALE} AS m2, close >= open AS up,
  row_number() OVER (PARTITION BY ticker ORDER BY ds DESC) AS back FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY ds)),
held AS (SELECT *, 31 - back AS i FROM lagged WHERE back <= 30)"""


@query(f"WITH {HELD} SELECT ticker, ds, round(actual, 9) AS actual, round(m1, 9) AS m1, round(m2, 9) AS m2, round(m2, 9) AS m3 FROM held WHERE up")
def stack_stand_ins(spark, sf_dir):
    """Models joined on ticker and date; a date that one of them lacks is left out."""
    return rounded(ensemble.stack(_parts(spark, sf_dir)), actual=9, m1=9, m2=9, m3=9)


# Cross products of every prefix of the held rows, so that one table serves folds, prefixes and the whole.
RIDGE = HELD + f""",
sums AS (SELECT ticker, i AS t, count(*) OVER w AS n, sum(m1) OVER w AS s1, sum(m2) OVER w AS s2, sum(actual) OVER w AS sy, sum(m1 * m1) OVER w AS s11, sum(m1 * m2) OVER w AS s12,
  sum(m2 * m2) OVER w AS s22, sum(m1 * actual) OVER w AS s1y, sum(m2 * actual) OVER w AS s2y FROM held WINDOW w AS (PARTITION BY ticker ORDER BY i ROWS UNBOUNDED PRECEDING)),
cross_products AS (SELECT ticker, t, n, s1, s2, sy, alpha, s11 - s1 * s1 / n + alpha AS a11, s12 - s1 * s2 / n AS a12, s22 - s2 * s2 / n + alpha AS a22, s1y - s1 * sy / n AS b1, s2y - s2 * sy / n AS b2
  FROM sums, (SELECT unnest([{', '.join(f'{a}::double' for a in ensemble.ALPHAS)}]) AS alpha)),
solved AS (SELECT *, (b1 * a22 - b2 * a12) / (a11 * a22 - a12 * a12) AS w1, (b2 * a11 - b1 * a12) / (a11 * a22 - a12 * a12) AS w2 FROM cross_products),
fits AS (SELECT ticker, t, alpha, w1, w2, (sy - w1 * s1 - w2 * s2) / n AS c FROM solved),
folds AS (SELECT f.ticker, alpha, a, avg(abs((actual - (w1 * m1 + w2 * m2 + c)) / actual)) AS e
  FROM fits f JOIN (VALUES (9, 16), (16, 23), (23, 30)) k(a, b) ON f.t = a JOIN held h ON h.ticker = f.ticker AND h.i > a AND h.i <= b GROUP BY 1, 2, 3),
ranked AS (SELECT ticker, alpha, row_number() OVER (PARTITION BY ticker ORDER BY avg(e), alpha) AS k FROM folds GROUP BY ticker, alpha),
best AS (SELECT f.* FROM fits f JOIN ranked r ON r.ticker = f.ticker AND r.alpha = f.alpha AND r.k = 1),
weights AS (SELECT ticker, alpha, w1, w2, c FROM best WHERE t = 30),
inside AS (SELECT ticker, 100 * avg(abs((actual - (w1 * m1 + w2 * m2 + c)) / actual)) AS in_sample FROM weights JOIN held USING (ticker) GROUP BY 1),
ahead AS (SELECT b.ticker, 100 * avg(abs((actual - (w1 * m1 + w2 * m2 + c)) / actual)) AS prequential FROM best b JOIN held h ON h.ticker = b.ticker AND h.i = b.t + 1 WHERE b.t >= 9 GROUP BY 1)"""


def _weights(spark, sf_dir):
    stacked = ensemble.stack(_parts(spark, sf_dir)[:2])
    return stacked, ensemble.meta_weights(stacked, PAIR)


@query(f"""WITH {RIDGE} SELECT ticker, 30::bigint AS n, alpha, round(w1, 7) AS w1, round(w2, 7) AS w2, round(c, 7) AS intercept, round(in_sample, 5) AS in_sample_mape, round(prequential, 5) AS prequential_mape
FROM weights JOIN inside USING (ticker) JOIN ahead USING (ticker)""")
def ridge_stand_ins(spark, sf_dir):
    """Penalty by time folds, weights, and both errors of the stack of two stand-in models."""
    rows = _weights(spark, sf_dir)[1]
    flat = rows.select(KEY, "n", "alpha", F.col("weights")[0].alias("w1"), F.col("weights")[1].alias("w2"), "intercept", "in_sample_mape", "prequential_mape")
    return rounded(flat, w1=7, w2=7, intercept=7, in_sample_mape=5, prequential_mape=5)


@query(f"""WITH {RIDGE}, long AS (SELECT ticker, actual, unnest(['m1', 'm2', 'ensemble']) AS model, unnest([m1, m2, w1 * m1 + w2 * m2 + c]) AS p FROM held JOIN weights USING (ticker)),
g AS (SELECT ticker, model, count(*) AS n, sqrt(avg((actual - p) ** 2)) AS rmse, avg(abs(actual - p)) AS mae, 100 * avg(abs((actual - p) / actual)) AS mape FROM long GROUP BY 1, 2),
o AS (SELECT ticker, min(mape) AS best_base FROM g WHERE model <> 'ensemble' GROUP BY 1)
SELECT ticker, model, n, round(rmse, 7) AS rmse, round(mae, 7) AS mae, round(mape, 5) AS mape, rank() OVER (PARTITION BY ticker ORDER BY mape) AS rank, round(best_base, 5) AS best_base,
round(CASE WHEN model = 'ensemble' THEN 100 * (best_base - mape) / best_base END, 4) AS improvement_pct FROM g JOIN o USING (ticker)""")
def comparison_stand_ins(spark, sf_dir):
    """Errors of both stand-in models and of their ensemble, ranked, with what the ensemble gains."""
    stacked, weights = _weights(spark, sf_dir)
    long = ensemble.combine(stacked, weights, PAIR).unpivot([KEY, "ds", "actual"], [*PAIR, "ensemble"], "model", "predicted")
    scores = forecasts.comparison(forecasts.errors(long, [KEY, "model"]))
    return rounded(scores, rmse=7, mae=7, mape=5, best_base=5, improvement_pct=4)


@query(f"""WITH {RIDGE}, f AS (SELECT ticker, ds, m1 * 1.01 AS p1, CASE WHEN up THEN m2 * 0.99 END AS p2 FROM held)
SELECT ticker, 'ensemble' AS model, ds AS forecast_date, round(c + w1 * p1 + w2 * p2, 7) AS predicted_close,
round((abs(w1) * p1 * 0.98 + abs(w2) * p2 * 0.98) / (abs(w1) + abs(w2)), 7) AS lower_bound, round((abs(w1) * p1 * 1.02 + abs(w2) * p2 * 1.02) / (abs(w1) + abs(w2)), 7) AS upper_bound
FROM f JOIN weights USING (ticker) WHERE p2 IS NOT NULL""")
def ensemble_stand_ins(spark, sf_dir):
    """Ensemble forecasts on the dates that both stand-in models have, with bounds weighted by the absolute weights."""
    parts = zip(_parts(spark, sf_dir)[::2], ("m1", "m3"), PAIR, (1.01, 0.99))
    base = [part.select(KEY, F.lit(name).alias("model"), F.col("ds").alias("forecast_date"), (F.col(c) * f).alias("predicted_close"), (F.col(c) * f * 0.98).alias("lower_bound"), (F.col(c) * f * 1.02).alias("upper_bound")) for part, c, name, f in parts]
    rows = ensemble.forecast(base[0].unionByName(base[1]), _weights(spark, sf_dir)[1], PAIR)
    return rounded(rows, predicted_close=7, lower_bound=7, upper_bound=7)


_SCORES = "\nUNION ALL ".join(f"SELECT '{t}' AS model, '{f}' AS feature, abs(corr({f}, {t})) AS importance FROM mx" for t in ("target_next_close", "target_direction") for f in features.FEATURES)


@query(f"""WITH mx AS ({SQL['feature_matrix_33']}), s AS ({_SCORES}),
k AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY importance DESC, feature) AS rank FROM s WHERE importance IS NOT NULL AND NOT isnan(importance))
SELECT model, feature, round(importance, 5) AS importance, rank FROM k WHERE rank <= 5""")
def top_features_by_correlation(spark, sf_dir):
    """The five features of the largest absolute correlation with each target."""
    rows = rounded(matrix(spark, sf_dir), **{c: d for c, d in _digits().items()})
    names = [(t, f) for t in ("target_next_close", "target_direction") for f in features.FEATURES]
    # a constant feature has none
    related = lambda f, t: F.abs(F.try_divide(F.covar_pop(f, t), F.stddev_pop(f) * F.stddev_pop(t)))
    sums = rows.agg(*[related(F.col(f).cast("double"), F.col(t).cast("double")).alias(f"{t}-{f}") for t, f in names])
    long = sums.unpivot([], [f"{t}-{f}" for t, f in names], "name", "importance").where("importance is not null")
    found = long.select(F.split("name", "-")[0].alias("model"), F.split("name", "-")[1].alias("feature"), "importance")
    return rounded(forecasts.top_features(found).withColumn("rank", F.col("rank").cast("long")), importance=5)


def _digits():
    from .series_queries import FEATURE_DIGITS

    return FEATURE_DIGITS


@query("""WITH b AS (SELECT event_type AS ticker, time_bucket(INTERVAL '15 minutes', ts) AS ts, arg_max(value, event_id) AS close FROM events GROUP BY 1, 2)
SELECT ticker, CAST(ts AS DATE) AS ds, min(ts) AS ts, arg_min(close, ts) AS close FROM b GROUP BY 1, 2""")
def first_row_of_day(spark, sf_dir):
    """Of several rows of a day the first one counts."""
    rows = tables.intraday_bars(spark, sf_dir).select(KEY, F.to_date("ts").alias("ds"), "ts", "close")
    return features.first_of_day(rows, "ds", ["ts"])


@query("""SELECT o_orderkey, array_to_string(list_filter(list_transform(string_split(' ' || lower(o_orderpriority) || ', ,' || o_orderstatus || ' ,', ','), lambda t: upper(trim(t))), lambda t: t <> ''), '|') AS tickers FROM orders""")
def clean_ticker_lists(spark, sf_dir):
    """Lists of tickers as users write them."""
    text = F.concat(F.lit(" "), F.lower("o_orderpriority"), F.lit(", ,"), "o_orderstatus", F.lit(" ,"))
    return tables.table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(landed.clean_tickers(text), "|").alias("tickers"))
