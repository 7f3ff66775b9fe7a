"""Queries over landed payloads, keyed writes, models and streams."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..functions import lineage
from ..functions.lineage import cut, scratch
from ..functions.series import GATES, KEY, long_enough
from ..operators import boosting, changepoints, ensemble, factors, forecasts, linear, sentiment, serving, strategy, trees
from ..sources import keyed, landed, stored, tables
from ..streaming import bars as streams
from .registry import BARS, DAILY_SENTIMENT, HEADLINES, INTRADAY, query, recurrences, rounded
from .series_queries import matrix

KEYS = [KEY, "ds"]
# The stored table ends where the batch, with other values, has already begun.
OLD = "old AS (SELECT * FROM bars WHERE ds < DATE '1997-01-01'), new AS (SELECT ticker, ds, open, high, low, close * 2 AS close, volume FROM bars WHERE ds >= DATE '1996-10-01')"


def _old_new(spark, sf_dir):
    bars = tables.daily_bars(spark, sf_dir)
    return bars.where("ds < date '1997-01-01'"), bars.where("ds >= date '1996-10-01'").withColumn("close", F.col("close") * 2)


@query(f"WITH {BARS}, {OLD} SELECT * FROM old UNION ALL SELECT n.* FROM new n ANTI JOIN old USING (ticker, ds)")
def keyed_insert_first(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    return keyed.insert_first(old, new, KEYS, ["close"])


@query(f"WITH {BARS}, {OLD} SELECT o.* FROM old o ANTI JOIN new USING (ticker, ds) UNION ALL SELECT * FROM new")
def keyed_upsert_last(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    return keyed.upsert_last(old, new, KEYS, [F.col("close").desc()])


@query(f"WITH {BARS}, {OLD}, part AS (SELECT * FROM new WHERE ticker < '3') SELECT o.* FROM old o WHERE ticker NOT IN (SELECT ticker FROM part) UNION ALL SELECT * FROM part")
def replace_by_key(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    return keyed.replace_keys(old, new.where("ticker < '3'"), [KEY])


@query(f"WITH {BARS}, {OLD} SELECT o.* FROM old o ANTI JOIN new USING (ticker, ds)")
def delete_by_key(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    return keyed.delete_keys(old, new, KEYS)


@query(f"""WITH {BARS}, {OLD} SELECT *, TIMESTAMP '2024-01-01' AS run_at FROM old UNION ALL SELECT *, TIMESTAMP '2024-01-02' FROM new""")
def append_with_run_stamp(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    first = old.withColumn("run_at", F.lit("2024-01-01").cast("timestamp"))
    again = keyed.append_run(first, new, "2024-01-02")
    return keyed.append_run(again, new, "2024-01-02")


@query(f"WITH {BARS}, {OLD} SELECT * FROM old UNION ALL SELECT n.* FROM new n ANTI JOIN old USING (ticker, ds)")
def stored_keyed_table(spark, sf_dir):
    """The same insert through a partitioned Parquet table: only the touched partitions are written."""
    old, new = _old_new(spark, sf_dir)
    year = lambda df: df.withColumn("year", F.year("ds"))
    path = scratch(spark, "bars")
    keyed.save(year(old), path, ["year"], KEYS)
    stored = spark.read.parquet(path)
    touched = year(new).select("year").distinct()
    merged = keyed.insert_first(stored.join(touched, "year", "left_semi").select(*stored.columns), year(new).select(*stored.columns), KEYS, ["close"])
    keyed.save(cut(merged), path, ["year"], KEYS)
    return spark.read.parquet(path).drop("year")


def _payloads(bars, time_text, series, period):
    """Landed JSON of a ticker and period, as a fetch gives it."""
    number = lambda c: F.col(c).cast("string")
    point = F.struct(*[number(c).alias(f"{k}. {c}") for k, c in enumerate(["open", "high", "low", "close", "volume"], 1)])
    points = bars.groupBy(KEY, period.alias("period")).agg(F.map_from_entries(F.collect_list(F.struct(time_text, point))).alias("m"))
    return points.select(KEY, F.to_json(F.struct(F.col("m").alias(series))).alias("payload"))


@query(f"WITH {BARS} SELECT ticker, 'landed' AS source, '1d' AS interval, CAST(ds AS TIMESTAMP) AS ts, open, high, low, close, volume FROM bars")
def payload_json_daily(spark, sf_dir):
    payloads = _payloads(tables.daily_bars(spark, sf_dir), F.date_format("ds", "yyyy-MM-dd"), "Time Series (Daily)", F.date_format("ds", "yyyy-MM"))
    return landed.series_bars(payloads, "Time Series (Daily)", "UTC", "1d", "landed")[0]


@query(f"WITH {INTRADAY} SELECT ticker, 'landed' AS source, '15m' AS interval, ts, open, high, low, close, volume FROM intraday")
def payload_json_bars(spark, sf_dir):
    at = F.date_format(F.from_utc_timestamp("ts", "US/Eastern"), "yyyy-MM-dd HH:mm:ss")
    payloads = _payloads(tables.intraday_bars(spark, sf_dir), at, "Time Series (15min)", F.to_date("ts"))
    return landed.series_bars(payloads, "Time Series (15min)", "US/Eastern", "15m", "landed")[0]


@query(f"WITH {BARS} SELECT DISTINCT ticker, 'limit of ' || ticker AS reason FROM bars")
def payload_rejects(spark, sf_dir):
    bars = tables.daily_bars(spark, sf_dir)
    good = _payloads(bars, F.date_format("ds", "yyyy-MM-dd"), "Time Series (Daily)", F.date_format("ds", "yyyy-MM"))
    notice = bars.select(KEY).distinct().select(KEY, F.to_json(F.struct(F.concat(F.lit("limit of "), KEY).alias("Note"))).alias("payload"))
    return landed.series_bars(good.union(notice), "Time Series (Daily)", "UTC", "1d", "landed")[1]


@query(f"WITH {BARS} SELECT ticker, 'wide' AS source, '1d' AS interval, CAST(ds AS TIMESTAMP) AS ts, open, high, low, close, volume FROM bars")
def wide_csv_bars(spark, sf_dir):
    path = scratch(spark, "wide")
    wide = tables.daily_bars(spark, sf_dir).select(F.col("ds").alias("Date"), F.col("open").alias("Open"), F.col("high").alias("High"), F.col("low").alias("LOW"), F.col("close").alias("Close"), F.col("volume").alias("Volume"), F.col(KEY).alias("Ticker"))
    wide.write.option("header", True).csv(path)
    return landed.read_wide_csv(spark, path, F.col("ticker"), "wide", "1d")


TITLE_SQL = "trim(regexp_replace(headline, '[^A-Za-z ]', '', 'g'))"
#: Items of a landed feed or news payload.
ITEMS = 50
AS_OF = "1995-07-10"


def _titled(spark, sf_dir):
    title = F.trim(F.regexp_replace("headline", "[^A-Za-z ]", ""))
    return tables.headlines(spark, sf_dir).select(KEY, "published_at", title.alias("title"), F.concat(F.lit("https://example.org/"), "source").alias("link"))


def _fetches(rows):
    """At most ``ITEMS`` rows of a ticker make a payload, however many share a ticker or time."""
    return rows.groupBy(KEY, F.expr(f"monotonically_increasing_id() div {ITEMS}").alias("fetch"))


@query(f"""WITH {HEADLINES}, t AS (SELECT ticker, 'rss' AS source, published_at, {TITLE_SQL} AS headline, 'https://example.org/' || source AS url FROM headlines)
SELECT * FROM t WHERE headline <> '' AND published_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY""")
def rss_xml_headlines(spark, sf_dir):
    """Every other item has a local time with an offset."""
    east = F.col("published_at") - F.expr("interval 5 hours")
    at = F.when(F.second("published_at") % 2 == 0, F.concat(F.date_format("published_at", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))).otherwise(F.concat(F.date_format(east, "d MMM yyyy HH:mm:ss"), F.lit(" -0500")))
    item = F.concat(F.lit("<item><title>"), "title", F.lit("</title><link>"), "link", F.lit("</link><pubDate>"), at, F.lit("</pubDate></item>"))
    body = F.array_join(F.collect_list(item), "")
    docs = _fetches(_titled(spark, sf_dir).where("title <> ''")).agg(F.concat(F.lit("<rss><channel>"), body, F.lit("</channel></rss>")).alias("xml"))
    return landed.rss_headlines(landed.rss_items(docs), F.lit(AS_OF).cast("timestamp"))


@query(f"""WITH {HEADLINES}, t AS (SELECT ticker, 'newsapi' AS source, published_at, {TITLE_SQL} AS headline, 'https://example.org/' || source AS url FROM headlines),
k AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY published_at DESC, headline) AS n FROM t WHERE headline <> '' AND published_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY)
SELECT * EXCLUDE (n) FROM k WHERE n <= 20""")
def news_json_headlines(spark, sf_dir):
    rows = _titled(spark, sf_dir)
    removed = rows.select(KEY, "published_at", F.lit("[Removed]").alias("title"), "link")
    article = F.struct("title", F.col("link").alias("url"), F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"))
    payloads = _fetches(rows.unionByName(removed)).agg(F.to_json(F.struct(F.collect_list(article).alias("articles"))).alias("payload"))
    return landed.news_headlines(payloads, F.lit(AS_OF).cast("timestamp"))


@query(f"""WITH {DAILY_SENTIMENT}, {BARS}, to_day AS (SELECT m.*, (SELECT min(b.ds) FROM bars b WHERE b.ticker = m.ticker AND b.ds >= m.ds) AS bar FROM mood m)
SELECT ticker, bar AS ds, round(sum(sentiment_compound * article_count) / sum(article_count), 8) AS sentiment_compound, sum(pos_count)::bigint AS pos_count, sum(neg_count)::bigint AS neg_count,
sum(article_count)::bigint AS article_count FROM to_day WHERE bar IS NOT NULL GROUP BY 1, 2""")
def sentiment_roll_forward(spark, sf_dir):
    mood = sentiment.daily(sentiment.by_lexicon(tables.headlines(spark, sf_dir)))
    return rounded(sentiment.roll_forward(mood, tables.daily_bars(spark, sf_dir).select(KEY, "ds")), sentiment_compound=8)


@query(f"WITH {BARS} SELECT ticker, 'one' AS source, '1d' AS interval, CAST(ds AS TIMESTAMP) AS ts, open, high, low, close, volume FROM bars")
def stored_bars_of_source(spark, sf_dir):
    """Two sources and two grains in one table; one of each is read."""
    path = scratch(spark, "stored")
    bars = tables.daily_bars(spark, sf_dir).withColumn("ts", F.col("ds").cast("timestamp")).drop("ds")
    kinds = F.array(*[F.struct(F.lit(s).alias("source"), F.lit(i).alias("interval")) for s in ("one", "two") for i in ("1d", "15m")])
    keyed.save(bars.withColumn("k", F.explode(kinds)).select("*", "k.*").drop("k"), path, ["source", "interval"], [KEY, "ts"])
    return stored.stored_bars(spark, path, "one", "1d")


@query(f"""WITH {HEADLINES} SELECT ticker, upper(ticker) || ' stock' AS keyword, CASE WHEN ticker < '3' THEN 2 ELSE 1 END AS n_feeds, count(*) AS n_headlines
FROM headlines GROUP BY ticker""")
def ticker_keywords(spark, sf_dir):
    rows = [(t, f"{t.upper()} stock", ["a", "b"] if t < "3" else ["a"]) for t in tables.TICKERS]
    found = stored.with_keyword(tables.headlines(spark, sf_dir), stored.dimension(spark, rows))
    return found.groupBy(KEY, "keyword", "n_feeds").agg(F.count("*").alias("n_headlines"))


# --- models: rows are checked by the tests against closed forms ---

MODELS = ["ar5", "trend_season", "gbt", "leafwise"]
TREES = ["gbt", "leafwise"]


@query(f"""WITH {BARS}, d AS (SELECT ticker, ds, close - lag(close) OVER w AS y FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY ds)),
x AS (SELECT *, lag(y, 1) OVER w AS x1, lag(y, 5) OVER w AS x5 FROM d WINDOW w AS (PARTITION BY ticker ORDER BY ds))
SELECT ticker, count(*) AS n, {', '.join(f"round(sign(sum({e})) * log10(1 + abs(sum({e}))), 6) AS {a}" for e, a in (("y * y", "yy"), ("x1 * y", "x1y"), ("x1 * x5", "x1x5")))}
FROM x WHERE x5 IS NOT NULL AND y IS NOT NULL GROUP BY 1""")
def least_squares_sums(spark, sf_dir):
    g = linear.gram(linear.ar_rows(tables.daily_bars(spark, sf_dir)))
    cell = lambda i, j, name: F.round(F.signum(F.col("g")[6 * i + j]) * F.log10(1 + F.abs(F.col("g")[6 * i + j])), 6).alias(name)
    return g.select(KEY, "n", cell(5, 5, "yy"), cell(0, 5, "x1y"), cell(0, 4, "x1x5"))


CROSS = f"""WITH {BARS}, d AS (SELECT ticker, ds, close - lag(close) OVER w AS y FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY ds)),
x AS (SELECT *, lag(y, 1) OVER w AS x1, lag(y, 5) OVER w AS x5 FROM d WINDOW w AS (PARTITION BY ticker ORDER BY ds))
SELECT ticker, count(*) AS n, {', '.join(f"round(sign(sum({e})) * log10(1 + abs(sum({e}))), 6) AS {a}" for e, a in (("y * y", "yy"), ("x1 * y", "x1y"), ("x1 * x5", "x1x5")))}
FROM x WHERE x5 IS NOT NULL AND y IS NOT NULL GROUP BY 1"""


@query(CROSS)
def least_squares_update(spark, sf_dir):
    """Factors of the bars before 1997 are stored and take in those since; their cross products are those of all bars."""
    rows = linear.ar_rows(tables.daily_bars(spark, sf_dir))
    old, new = (rows.where(f"year(ds) {sign} 1997") for sign in ("<", ">="))
    found = factors.update(lineage.stored(factors.factors(old), "factors"), new)
    column = lambda j: F.array(*[F.col("r")[6 * i + j] for i in range(6)])
    dot = lambda i, j: F.aggregate(F.zip_with(column(i), column(j), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    cell = lambda i, j, name: F.round(F.signum(dot(i, j)) * F.log10(1 + F.abs(dot(i, j))), 6).alias(name)
    return found.select(KEY, "n", cell(5, 5, "yy"), cell(0, 5, "x1y"), cell(0, 4, "x1x5"))


@query(f"""WITH {BARS}, span AS (SELECT ticker, min(ds) AS a, max(ds) AS b, max(abs(close)) AS m FROM bars GROUP BY 1),
x AS (SELECT ticker, m, close / m AS y, (ds - a) / greatest(b - a, 1)::double AS t FROM bars JOIN span USING (ticker)),
h AS (SELECT *, greatest(t - 0.4, 0) AS h FROM x),
c AS (SELECT ticker, any_value(m) AS m, count(*) AS n, avg(y) AS y, avg(t) AS t, avg(h) AS h, regr_sxx(t, t) AS tt, regr_sxx(h, h) AS hh, regr_sxy(h, t) AS th, regr_sxy(y, t) AS ty, regr_sxy(y, h) AS hy FROM h GROUP BY 1),
p AS (SELECT *, hh - th * th / tt AS own, hy - th * ty / tt AS pull FROM c),
w AS (SELECT *, sign(pull) * greatest(abs(pull) - 0.5, 0) / own AS hinge FROM p)
SELECT ticker, n, round((y - (ty - th * hinge) / tt * t - hinge * h), 6) AS level, round((ty - th * hinge) / tt, 6) AS slope, round(hinge, 6) AS hinge FROM w""")
def one_hinge_trend(spark, sf_dir):
    """A line with one hinge under an L1 penalty, in units of the largest close: a closed form."""
    bars = tables.daily_bars(spark, sf_dir)
    span = bars.groupBy(KEY).agg(F.min("ds").alias("first"), F.max("ds").alias("last"), F.max(F.abs("close")).alias("top"))
    rows = changepoints.design(bars.join(span.select(KEY, "top"), KEY).select(KEY, "ds", (F.col("close") / F.col("top")).alias("y")), span, changes=1, weekly=0, yearly=0)
    return rounded(changepoints.lasso_of(factors.factors(rows), [0.0, 0.0, 0.5]), level=6, slope=6, hinge=6)


def _bars(spark, sf_dir):
    """Daily bars, stored: the models read them many times, and each time would read all orders."""
    return lineage.stored(tables.daily_bars(spark, sf_dir), "bars")


@query()
def ar5_forecast(spark, sf_dir):
    return linear.ar_forecast(long_enough(_bars(spark, sf_dir), GATES["forecast"]))


@query(f"""WITH {BARS}, d AS (SELECT ticker, ds, close, close - lag(close) OVER w AS y FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY ds)),
x AS (SELECT *, lag(y) OVER w AS x FROM d WINDOW w AS (PARTITION BY ticker ORDER BY ds)),
f AS (SELECT ticker, max(ds) AS ds, arg_max(close, ds) AS close, arg_max(y, ds) AS y, count(x) AS n, sum(x * y) / sum(x * x) AS b, sum(y * y) FILTER (x IS NOT NULL) - sum(x * y) * sum(x * y) / sum(x * x) AS rss FROM x GROUP BY 1 HAVING count(*) >= 60),
s AS (SELECT *, unnest(range(1, 8)) AS h FROM f),
v AS (SELECT *, sqrt(rss / (n - 1)) * sqrt(list_sum(list_transform(range(1, h + 1), lambda i: pow((1 - pow(b, i)) / (1 - b), 2)))) AS se, close + y * b * (1 - pow(b, h)) / (1 - b) AS p FROM s),
days AS (SELECT ticker, list_filter(list_transform(range(1, 15), lambda i: CAST(ds + CAST(i AS INT) AS DATE)), lambda d: isodow(d) < 6) AS days FROM f)
SELECT ticker, 'ar1' AS model, days[h] AS forecast_date, round(p, 4) AS predicted_close, round(p - {linear.Z95} * se, 4) AS lower_bound, round(p + {linear.Z95} * se, 4) AS upper_bound FROM v JOIN days USING (ticker)""")
def ar1_forecast(spark, sf_dir):
    """One lag, where coefficient, path and error have closed forms."""
    bars = long_enough(_bars(spark, sf_dir), GATES["forecast"])
    return rounded(linear.ar_forecast(bars, p=1), predicted_close=4, lower_bound=4, upper_bound=4)


@query()
def trend_season_forecast(spark, sf_dir):
    return linear.trend_forecast(long_enough(_bars(spark, sf_dir), GATES["forecast"]))


class Fits:
    """The tree models of one call, fitted in step when the first is asked for, and the matrix they are read from.

    ``held``: False for models that have not seen the held-out rows, True for those that have seen all.  Nothing outlives
    the object: a query makes its own, unless the caller hands one in as ``models``.
    """

    def __init__(self, spark, sf_dir, kinds=TREES, held=(False,), rounds=300):
        self.matrix = lineage.stored(matrix(spark, sf_dir, labelled=False), "matrix")
        self.labelled = long_enough(self.matrix.where("target_next_close is not null"), GATES["trees"])
        self.wanted = {(k, h): replace(boosting.KINDS[k], held=h, rounds=rounds) for k in kinds for h in held}
        self.found = None

    def _fitted(self, held):
        self.found = self.found or boosting.learn(self.labelled, self.wanted)
        return {k: m for (k, h), m in self.found.items() if h == held}

    def holdout(self, kinds=TREES):
        found = self._fitted(False)
        return boosting.holdout({k: found[k] for k in kinds}, self.labelled)

    def whole(self):
        """The models that have seen all rows."""
        return self._fitted(True)


@query()
def gbt_holdout(spark, sf_dir, models=None):
    """Second-order boosting on the held-out bars."""
    return (models or Fits(spark, sf_dir, ["gbt"])).holdout(["gbt"]).withColumn("naive", F.col("previous"))


@query()
def leafwise_holdout(spark, sf_dir, models=None):
    """Leaf-wise boosting on the held-out bars."""
    return (models or Fits(spark, sf_dir, ["leafwise"])).holdout(["leafwise"])


@query()
def rf_holdout(spark, sf_dir):
    """A random forest on the held-out bars."""
    rows = lineage.stored(matrix(spark, sf_dir), "matrix")
    return trees.holdout(long_enough(rows, GATES["trees"]), "forest", "forest")


#: What the stumps see of a bar: columns with few values.
STUMP = {"weekday": "dayofweek(ds)", "month": "month(ds)", "orders": "volume", "earlier": "lag(volume) OVER (PARTITION BY ticker ORDER BY ds)"}
STUMP_SQL = BARS + """,
x AS (SELECT dayofweek(ds) + 1 AS weekday, month(ds) AS month, volume AS orders, coalesce(lag(volume) OVER w, 0) AS earlier, lead(close) OVER w / close - 1 AS y FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY ds)),
long AS (SELECT unnest(['weekday','month','orders','earlier']) AS feature, unnest([weekday, month, orders, earlier]) AS v, (SELECT avg(y) FROM x) - y AS g FROM x WHERE y IS NOT NULL),
cells AS (SELECT feature, v AS edge, sum(g) AS g, count(*) AS n FROM long GROUP BY 1, 2),
sums AS (SELECT feature, edge, sum(g) OVER w AS gl, sum(n) OVER w AS nl, sum(g) OVER (PARTITION BY feature) AS g, sum(n) OVER (PARTITION BY feature) AS n FROM cells WINDOW w AS (PARTITION BY feature ORDER BY edge)),
kinds AS (SELECT unnest(['gbt','leafwise']) AS model, unnest([1, 0]) AS l2, unnest([1, 20]) AS least),
gains AS (SELECT *, (gl * gl / (nl + l2) + (g - gl) * (g - gl) / (n - nl + l2) - g * g / (n + l2)) / 2 AS gain FROM sums, kinds WHERE nl >= least AND n - nl >= least),
best AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY gain DESC) AS k FROM gains)
SELECT model, feature, edge::double AS edge, round(gain, 4) AS gain, round(-gl / (nl + l2), 6) AS left_weight, round(-(g - gl) / (n - nl + l2), 6) AS right_weight FROM best WHERE k = 1"""


@query(f"WITH {STUMP_SQL}")
def boosted_stumps(spark, sf_dir):
    """The first split of both growers over all bars: feature, edge, gain and the weights of the two leaves."""
    bars = tables.daily_bars(spark, sf_dir)
    ahead = "lead(close) OVER (PARTITION BY ticker ORDER BY ds) / close - 1 as y"
    rows = bars.selectExpr("ticker", "ds", *[f"cast(coalesce({e}, 0) as double) as {c}" for c, e in STUMP.items()], ahead)
    made = boosting.blocks(lineage.stored(rows, "stump-rows"), list(STUMP), "y", ["ticker", "ds"])
    found = boosting.fit(made, [replace(boosting.KINDS[k], rounds=1, depth=1, rate=1.0, rows=1.0, columns=1.0) for k in TREES])
    out = []
    for name, tree in zip(TREES, found, strict=True):
        f, b = int(tree.feature[0, 0]), int(tree.bin[0, 0])
        out.append((name, made.inputs[f], float(made.edges[f][b]), float(tree.gain[0, 0]), float(tree.value[0, 1]), float(tree.value[0, 2])))
    rows = spark.createDataFrame(out, "model string, feature string, edge double, gain double, left_weight double, right_weight double")
    return rounded(rows, gain=4, left_weight=6, right_weight=6)


@query()
def feature_importance_top5(spark, sf_dir, models=None):
    """By share of the gain of all splits."""
    models = models or Fits(spark, sf_dir, held=(True,))
    return forecasts.top_features(boosting.importances(models.whole(), spark))


def _tree_forecasts(spark, sf_dir, models, bars=None):
    return boosting.forecast(models.whole(), bars or _bars(spark, sf_dir), models.matrix)


@query()
def tree_forecast_7d(spark, sf_dir, models=None):
    return _tree_forecasts(spark, sf_dir, models or Fits(spark, sf_dir, held=(True,)))


def _stack(spark, sf_dir, models=None, bars=None):
    """The held-out predictions of all models, stored as they are read several times."""
    models = models or Fits(spark, sf_dir)
    bars = long_enough(bars or _bars(spark, sf_dir), GATES["stack"])
    return lineage.stored(ensemble.stack([models.holdout(), linear.linear_holdout(bars)]), "stack")


@query()
def holdout_stack(spark, sf_dir, models=None):
    return _stack(spark, sf_dir, models)


@query()
def ridge_meta_weights(spark, sf_dir, models=None):
    return ensemble.meta_weights(_stack(spark, sf_dir, models), MODELS)


@query()
def model_comparison(spark, sf_dir, models=None):
    """Errors of all models and the ensemble; horizon: steps ahead of the forecast that is scored."""
    stacked = _stack(spark, sf_dir, models)
    wide = ensemble.combine(stacked, ensemble.meta_weights(stacked, MODELS), MODELS)
    long = wide.unpivot([KEY, "ds", "actual"], [*MODELS, "ensemble"], "model", "predicted")
    scores = forecasts.comparison(forecasts.errors(long, [KEY, "model"]))
    horizon = F.when(F.col("model").isin("ar5", "trend_season"), "1 to 30").when(F.col("model") == "ensemble", "in sample").otherwise("1")
    return scores.withColumn("horizon", horizon)


@query()
def ensemble_forecast(spark, sf_dir, models=None):
    models = models or Fits(spark, sf_dir, held=(False, True))
    bars = _bars(spark, sf_dir)
    weights = ensemble.meta_weights(_stack(spark, sf_dir, models, bars), MODELS)
    base = _tree_forecasts(spark, sf_dir, models, bars).unionByName(linear.ar_forecast(bars)).unionByName(linear.trend_forecast(bars))
    return ensemble.forecast(base, weights, MODELS)


@query()
def ensemble_strategy(spark, sf_dir, models=None):
    """Strategy metrics of trading on every model and on the ensemble over the held-out bars."""
    stacked = _stack(spark, sf_dir, models)
    wide = ensemble.combine(stacked, ensemble.meta_weights(stacked, MODELS), MODELS)
    return serving.ranked(strategy.metrics(wide.unpivot([KEY, "ds", "actual", "previous"], [*MODELS, "ensemble"], "model", "predicted")), "alpha")


# --- streams: over the given table, in files that each hold rows of all days ---


def _landed(rows, tag, batches=3):
    """Files of rows dealt out at random, and how many of them make one of some batches."""
    path = scratch(rows.sparkSession, tag)
    files = max(batches, rows.rdd.getNumPartitions())
    rows.repartition(files).write.mode("append").parquet(path)
    return path, -(-files // batches)


def _landed_events(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events")
    path, files = _landed(events, "events")
    return streams.read(spark, path, events.schema, files)


@query("SELECT event_type AS ticker, ts, value AS price, event_id AS seq FROM events")
def stream_dedupe_bars(spark, sf_dir):
    """Every event lands twice, as in overlapping fetches; each comes out once."""
    events = tables.table(spark, sf_dir, "events")
    path, files = _landed(events.unionByName(events), "events", 2)
    stream = streams.dedupe(tables.ticks(streams.read(spark, path, events.schema, files)), [KEY, "ts", "seq"], late="40 days")
    return streams.run_available(stream, scratch(spark, "deduped"), [KEY, "ts", "seq"], "append")


@query(f"WITH {INTRADAY} SELECT * FROM intraday")
def stream_bars_15m(spark, sf_dir):
    stream = streams.tumbling(tables.ticks(_landed_events(spark, sf_dir)), late="40 days")
    return streams.run_available(stream, scratch(spark, "bars"), [KEY, "ts"])


@query(f"WITH {INTRADAY} SELECT * FROM intraday")
def stream_late_backfill(spark, sf_dir):
    """The first ten days land last: they are behind the watermark and lost to the stream, and a batch over what came late brings their bars."""
    events = tables.table(spark, sf_dir, "events")
    edge = events.agg(F.date_trunc("day", F.min("ts")) + F.expr("interval 10 days")).first()[0]
    late = F.col("ts") < F.lit(edge)
    path, target = scratch(spark, "events"), scratch(spark, "bars")
    for part in (events.where(~late), events.where(late)):
        part.write.mode("append").parquet(path)
        bars = streams.tumbling(tables.ticks(streams.read(spark, path, events.schema, 1 << 20)))
        table = streams.run_available(bars, target, [KEY, "ts"])
    return streams.backfill(table, streams.batch_bars(tables.ticks(events.where(late))), [KEY, "ts"])


@query(f"WITH {DAILY_SENTIMENT} SELECT ticker, ds, round(sentiment_compound, 8) AS sentiment_compound, pos_count, neg_count, article_count FROM mood")
def stream_sentiment_daily(spark, sf_dir):
    rows = tables.headlines(spark, sf_dir)
    path, files = _landed(rows, "headlines")
    stream = streams.daily_sentiment(sentiment.by_lexicon(streams.read(spark, path, rows.schema, files)), late="400 days")
    return rounded(streams.run_available(stream, scratch(spark, "mood"), KEYS), sentiment_compound=8)


@query("WITH RECURSIVE " + INTRADAY + "," + recurrences("intraday", "ts") + """, zs AS (SELECT ticker, ts, CASE WHEN rn >= 30 THEN (close - avg(close) OVER z) / nullif(stddev_samp(close) OVER z, 0) END AS zscore
FROM ind WINDOW z AS (PARTITION BY ticker ORDER BY ts ROWS 29 PRECEDING))
SELECT ticker, ts, close, round(rsi_14, 6) AS rsi_14, round(macd, 8) AS macd, round(macd_signal, 8) AS macd_signal, round(macd_hist, 8) AS macd_hist, round(bb_middle, 8) AS bb_middle,
round(bb_upper, 6) AS bb_upper, round(bb_lower, 6) AS bb_lower, round(zscore, 6) AS zscore, CASE WHEN zscore >= 2.0 THEN 'HIGH' WHEN zscore <= -2.0 THEN 'LOW' END AS flag
FROM ind JOIN zs USING (ticker, ts)""")
def stream_indicators(spark, sf_dir, batches=8):
    """Bars land up to four days late, in ``batches`` micro-batches, so every batch brings bars of days that earlier ones have begun.

    The stream is stopped after half of them and started again from its checkpoint.  A closing row takes the watermark past the last bar.
    """
    bars = lineage.stored(tables.intraday_bars(spark, sf_dir).select(KEY, "ts", "close"), "bars")
    landing = F.col("ts") + F.make_dt_interval(secs=F.pmod(F.xxhash64(KEY, "ts"), F.lit(4 * 86400)).cast("decimal(18,6)"))
    first, last = bars.agg(F.min("ts"), F.max("ts") + F.expr("interval 4 days")).first()
    rows = bars.withColumn("_landing", landing)
    path, target = scratch(spark, "bars"), scratch(spark, "indicators")
    files = bars.rdd.getNumPartitions()
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for half in range(2):
            for k in range(half * batches // 2, (half + 1) * batches // 2):
                edges = [F.lit(first + (last - first) * i / batches) for i in (k, k + 1)] if first else [F.lit(None)] * 2
                part = rows.where((F.col("_landing") >= edges[0]) & ((F.col("_landing") < edges[1]) | F.lit(k + 1 == batches))).drop("_landing")
                part = part.unionByName(streams.closing(bars, after="7 days")) if k + 1 == batches else part
                part.repartition(files).write.mode("append").parquet(path)
            stream = streams.indicators(streams.read(spark, path, bars.schema, files=files))
            found = streams.run_available(stream, target, [KEY, "ts"], "append")
    finally:
        spark.conf.set(provider, before)
    return rounded(found, rsi_14=6, macd=8, macd_signal=8, macd_hist=8, bb_middle=8, bb_upper=6, bb_lower=6, zscore=6)
