"""Table schemas and the session settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BARS = "ticker string, source string, interval string, ts timestamp, open double, high double, low double, close double, volume long"
INDICATORS = "ticker string, ts timestamp, rsi_14 double, macd double, macd_signal double, macd_hist double, bb_upper double, bb_middle double, bb_lower double"
ANOMALIES = "ticker string, ts timestamp, close double, zscore double, flag string"
FORECASTS = "ticker string, model string, forecast_date date, predicted_close double, lower_bound double, upper_bound double, run_at timestamp"
HEADLINES = "ticker string, source string, published_at timestamp, headline string, url string"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def utc(df: DataFrame) -> DataFrame:
    """Time columns without zone become UTC timestamps (watermarks need that)."""
    return df.withColumns({c: F.col(c).cast("timestamp") for c, kind in df.dtypes if kind == "timestamp_ntz"})
