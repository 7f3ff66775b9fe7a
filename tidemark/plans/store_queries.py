"""Queries over stores that grow: summaries of returns, landed payloads as a source, keyed tables by partition."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import day_sketches
from ..functions.lineage import scratch, stored
from ..functions.series import KEY
from ..operators import anomalies
from ..sources import payload_source, tables
from ..sources.keyed_store import KeyedStore
from ..streaming import bars as streams
from .registry import BARS, INTRADAY, QFLAGS, query, rounded
from .table_queries import KEYS, OLD, _old_new, _payloads

FENCES = """SELECT ticker, round(q1 - 1.5 * (q3 - q1), 6) AS fence_low, round(q3 + 1.5 * (q3 - q1), 6) AS fence_high, round(mean, 6) AS fence_mean, round(sd, 6) AS fence_sd FROM """
SPAN = """(SELECT ticker, quantile_cont(r, 0.25) AS q1, quantile_cont(r, 0.75) AS q3, avg(r) AS mean, stddev_samp(r) AS sd FROM rets
WHERE r IS NOT NULL AND ds BETWEEN DATE '1994-03-01' AND DATE '1997-06-30' GROUP BY 1)"""


def _stored_returns(spark, sf_dir):
    """The returns up to 1996 are stored first, those since then added."""
    path = scratch(spark, "returns")
    rows = stored(anomalies.scored(tables.daily_bars(spark, sf_dir), time="ds"), "scored-bars")
    for part in (rows.where("ds < date '1997-01-01'"), rows.where("ds >= date '1997-01-01'")):
        anomalies.add_returns(part, path, F.date_format("ds", "yyyy-MM"), files=1)
    return path


def _shown(fences):
    return rounded(fences, fence_low=6, fence_high=6, fence_mean=6, fence_sd=6)


@query(f"WITH {BARS}, {QFLAGS} {FENCES} fences")
def sketched_fences(spark, sf_dir):
    """Fences of all months, from stored summaries that took in the later years by themselves."""
    return _shown(anomalies.stored_fences(spark, _stored_returns(spark, sf_dir)))


@query(f"WITH {BARS}, {QFLAGS} {FENCES} {SPAN}")
def sketched_span_fences(spark, sf_dir):
    """Fences of a span of months."""
    return _shown(anomalies.stored_fences(spark, _stored_returns(spark, sf_dir), first="1994-03", last="1997-06"))


@query("""SELECT event_type AS ticker, count(*) AS n, round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.99), 6) AS p99
FROM events WHERE value IS NOT NULL AND ts < (SELECT date_trunc('day', min(ts)) + INTERVAL 10 DAY FROM events) GROUP BY 1""")
def tick_quantiles_span(spark, sf_dir):
    """Quantiles of the prices of the first ten days, from a store with one period a day."""
    ticks, path = tables.ticks(tables.table(spark, sf_dir, "events")), scratch(spark, "ticks")
    day_sketches.add(ticks, path, "price", F.date_format("ts", "yyyy-MM-dd"))
    last = ticks.agg(F.date_format(F.min("ts") + F.expr("interval 9 days"), "yyyy-MM-dd")).first()[0]
    found = day_sketches.quantiles(spark, path, [0.1, 0.5, 0.99], last=last)
    return found.select(KEY, "n", *[F.round(F.col("q")[k], 6).alias(name) for k, name in enumerate(["p10", "p50", "p99"])])


DAILY, QUARTER = "Time Series (Daily)", "Time Series (15min)"


@query(f"WITH {BARS} SELECT ticker, 'landed' AS source, '1d' AS interval, CAST(ds AS TIMESTAMP) AS ts, open, high, low, close, volume FROM bars")
def payload_source_daily(spark, sf_dir):
    """Landed files read by the data source."""
    path = scratch(spark, "landing")
    _payloads(tables.daily_bars(spark, sf_dir), F.date_format("ds", "yyyy-MM-dd"), DAILY, F.date_format("ds", "yyyy-MM")).write.json(path)
    return payload_source.payloads(spark, path, DAILY)


@query(f"WITH {BARS} SELECT DISTINCT ticker, 'limit of ' || ticker AS reason FROM bars")
def payload_source_rejects(spark, sf_dir):
    path, bars = scratch(spark, "landing"), tables.daily_bars(spark, sf_dir)
    _payloads(bars, F.date_format("ds", "yyyy-MM-dd"), DAILY, F.date_format("ds", "yyyy-MM")).write.json(path)
    notice = F.to_json(F.struct(F.concat(F.lit("limit of "), KEY).alias("Note")))
    bars.select(KEY).distinct().select(KEY, notice.alias("payload")).write.mode("append").json(path)
    return payload_source.payloads(spark, path, DAILY, rows="rejects")


@query(f"WITH {INTRADAY} SELECT ticker, 'landed' AS source, '15m' AS interval, ts, open, high, low, close, volume FROM intraday")
def payload_source_stream(spark, sf_dir, batches=4):
    """Files land in ``batches`` parts; the stream stops after each and starts again from its checkpoint."""
    at = F.date_format(F.from_utc_timestamp("ts", "US/Eastern"), "yyyy-MM-dd HH:mm:ss")
    landed = stored(_payloads(tables.intraday_bars(spark, sf_dir), at, QUARTER, F.to_date("ts")), "payloads")
    path, target = scratch(spark, "landing"), scratch(spark, "bars")
    for k in range(batches):
        landed.where(F.pmod(F.xxhash64("payload"), F.lit(batches)) == k).write.mode("append").json(path)
        stream = payload_source.payloads(spark, path, QUARTER, True, zone="US/Eastern", interval="15m", log=f"{target}/files")
        found = streams.run_available(stream, target, [KEY, "ts"], "append")
    return found


ROWS = "ticker string, ds date, open double, high double, low double, close double, volume long"


def _store(spark, table, parts):
    return KeyedStore(spark, scratch(spark, "keyed"), ROWS, tuple(KEYS), parts).create(table)


MONTHS = {"month": "date_format(ds, 'yyyy-MM')"}


@query(f"WITH {BARS}, {OLD} SELECT o.* FROM old o ANTI JOIN new USING (ticker, ds) UNION ALL SELECT * FROM new")
def stored_upsert(spark, sf_dir):
    """The batch's months are read and written, the others stay as they are."""
    old, new = _old_new(spark, sf_dir)
    store = _store(spark, old, MONTHS)
    store.upsert_last(new, [F.col("close").desc()])
    return store.table()


@query(f"WITH {BARS}, {OLD} SELECT o.* FROM old o ANTI JOIN new USING (ticker, ds)")
def stored_delete(spark, sf_dir):
    """Months that lose all rows go with their folders."""
    old, new = _old_new(spark, sf_dir)
    store = _store(spark, old, MONTHS)
    store.delete_keys(new)
    return store.table()


@query(f"WITH {BARS}, {OLD}, part AS (SELECT * FROM new WHERE ticker < '3') SELECT o.* FROM old o WHERE ticker NOT IN (SELECT ticker FROM part) UNION ALL SELECT * FROM part")
def stored_replace(spark, sf_dir):
    """The key is the ticker, so that is the partition too."""
    old, new = _old_new(spark, sf_dir)
    store = KeyedStore(spark, scratch(spark, "keyed"), ROWS, (KEY,), {"part": KEY}).create(old)
    store.replace_keys(new.where("ticker < '3'"))
    return store.table()
