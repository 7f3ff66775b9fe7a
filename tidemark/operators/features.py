"""The feature matrix: one row per bar, 33 named features, in one pass over blocks of the series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import stored
from ..functions.long_series import from_end, month, numbered
from ..functions.recurrence import deal, inside, own
from ..functions.series import KEY, change, lag, ordered, rolling
from .anomalies import fences, flagged, with_scores
from .indicators import ALPHAS, WARM_UP, look_back, with_indicators

LAGS, WINDOWS = (1, 2, 3, 5, 10), (5, 10, 20)
# The names and order of the features.
FEATURES = [
    "close_lag_1", "close_lag_2", "close_lag_3", "close_lag_5", "close_lag_10",
    "return_1d", "return_5d",
    "rolling_mean_5", "rolling_mean_10", "rolling_mean_20",
    "rolling_std_5", "rolling_std_10", "rolling_std_20",
    "open", "high", "low", "volume", "hl_range", "volume_change",
    "rsi_14", "macd", "macd_signal", "macd_hist", "bb_position", "bb_width",
    "zscore", "is_anomaly",
    "sentiment_compound", "sentiment_3d", "sentiment_change", "pos_count", "neg_count", "article_count",
]
INDICATORS = ["rsi_14", "macd", "macd_signal", "macd_hist", "bb_upper", "bb_middle", "bb_lower"]
MOOD = ["sentiment_compound", "pos_count", "neg_count", "article_count"]


def price_features(rows: DataFrame, key: str | list[str] = KEY, time: str = "ds") -> DataFrame:
    """Lags, returns, rolling statistics, range and volume change."""
    at = {"key": key, "time": time}
    columns = {f"close_lag_{k}": lag("close", k, **at) for k in LAGS}
    columns |= {f"return_{k}d": change("close", k, **at) for k in (1, 5)}
    columns |= {f"rolling_mean_{n}": rolling(F.avg, "close", n, **at) for n in WINDOWS}
    columns |= {f"rolling_std_{n}": rolling(F.stddev_samp, "close", n, **at) for n in WINDOWS}
    columns |= {"hl_range": F.col("high") - F.col("low"), "volume_change": change("volume", 1, **at)}
    return rows.withColumns(columns)


def targets(rows: DataFrame, key: str | list[str] = KEY, time: str = "ds", day: str = "ds") -> DataFrame:
    """The next close, its day and whether it is higher; null (and 0) on the last bar."""
    order = ordered(key, time)
    ahead = F.lead("close", 1).over(order)
    return rows.withColumns({"target_day": F.lead(day, 1).over(order), "target_next_close": ahead, "target_direction": F.coalesce((ahead > F.col("close")).cast("int"), F.lit(0))})


def first_of_day(rows: DataFrame, day: str, order: list[str]) -> DataFrame:
    """The first row of each ticker and day by ``order``, for tables that hold several."""
    rest = [c for c in rows.columns if c not in (KEY, day)]
    first = rows.groupBy(KEY, day).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_s"))
    return first.select(KEY, day, *[F.col(f"_s.{c}").alias(c) for c in rest]).select(*rows.columns)


def frame(bars: DataFrame, sentiment: DataFrame | None = None, time: str = "ds") -> DataFrame:
    """Every bar with all columns that look back or ahead in its series, in one pass: indicators (null while warming up), scores, price and sentiment features, targets."""
    rows, at = numbered(bars, month(time), time=time), (inside(KEY), "_i")
    if sentiment is None:
        rows = rows.withColumns({c: F.lit(0.0 if c == MOOD[0] else 0) for c in MOOD})
    else:
        rows = rows.join(sentiment.select(KEY, time, *MOOD), [KEY, time], "left").na.fill(0, MOOD)
    rows = with_scores(with_indicators(deal(rows, look_back() + 1, 1, ALPHAS)))
    rows = rows.withColumns({c: F.when(F.col("_i") >= WARM_UP - 1, F.col(c)) for c in INDICATORS})
    rows = targets(price_features(rows, *at), *at, day=time)
    # three rows, not three days; incomplete windows count as no sentiment
    rows = rows.withColumns({
        "sentiment_3d": F.coalesce(rolling(F.avg, "sentiment_compound", 3, *at), F.lit(0.0)),
        "sentiment_change": F.coalesce(F.col("sentiment_compound") - lag("sentiment_compound", 1, *at), F.lit(0.0)),
    })
    return own(rows)


def flagged_frame(bars: DataFrame, sentiment: DataFrame | None = None, time: str = "ds") -> DataFrame:
    """The frame with anomaly flags; it is stored once, as the fences are statistics of whole series."""
    rows = stored(frame(bars, sentiment, time), "bar-frame")
    return flagged(rows, fences(rows, time=time))


def feature_matrix(rows: DataFrame, time: str = "ds", labelled: bool = True) -> DataFrame:
    """All features and targets of a flagged frame.

    Rows need ten closes before them and a mean of 20 and, if ``labelled``, a target; any other missing feature is 0.
    A bar counts as anomalous where the score of its flag is 2 or more, whichever rule flagged it.
    """
    width = F.col("bb_upper") - F.col("bb_lower")
    rows = rows.withColumn("zscore", F.coalesce("zscore", F.lit(0.0))).withColumns({
        "bb_position": F.try_divide(F.col("close") - F.col("bb_lower"), width),
        "bb_width": F.try_divide(width, "bb_middle"),
        "is_anomaly": (F.abs("zscore") >= 2.0).cast("int"),
    })
    rows = rows.dropna(subset=["close_lag_10", "rolling_mean_20", *(["target_next_close"] if labelled else [])])
    return rows.na.fill(0, FEATURES).select(KEY, time, "close", *FEATURES, "target_day", "target_next_close", "target_direction")


def holdout(rows: DataFrame, n: int = 30, time: str = "ds") -> DataFrame:
    """Mark the last n rows of each series; rows of equal time count as one, a row without a time is not among them."""
    return from_end(rows, n, time=time).withColumn("is_holdout", F.col("_back").isNotNull()).drop("_back")
