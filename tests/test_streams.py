"""Indicators of a stream: buckets of state, several batches, a stop and a restart."""

import datetime

import numpy as np
import pandas as pd

from tidemark.streaming import bars as streams

START = datetime.datetime(2024, 1, 1)


class Cell:
    """A state of one key, as the engine keeps it."""

    def __init__(self):
        self.held, self.most = {}, 0

    def exists(self):
        return bool(self.held)

    def get(self):
        return self.held[()]

    def update(self, value):
        self.held[()] = value

    def containsKey(self, key):
        return key in self.held

    def getValue(self, key):
        self.most = max(self.most, len(self.held[key][0]))
        return self.held[key]

    def updateValue(self, key, value):
        self.held[key] = value

    def removeKey(self, key):
        del self.held[key]

    def keys(self):
        return iter(list(self.held))


class Handle:
    def __init__(self):
        self.timers, self.cells = [], {}

    def registerTimer(self, at):
        self.timers.append(at)

    def getValueState(self, name, *schema):
        return self.cells.setdefault(name, Cell())

    getMapState = getValueState


def frame(times, closes):
    return pd.DataFrame({"ticker": "A", "ts": pd.to_datetime(times), "close": closes})


def test_a_call_holds_one_bucket():
    rng = np.random.default_rng(0)
    times = [START + datetime.timedelta(hours=int(h)) for h in rng.permutation(24 * 6)]
    closes = {t: float(c) for t, c in zip(times, rng.normal(100, 5, len(times)), strict=True)}
    handle, indicators = Handle(), streams.Indicators()
    indicators.init(handle)
    for part in np.array_split(np.arange(len(times)), 7):  # batches with rows of all days
        list(indicators.handleInputRows(("A",), iter([frame([times[i] for i in part], [closes[times[i]] for i in part])]), None))
    assert len(handle.timers) == 6 and len(set(handle.timers)) == 6  # one a bucket, not one a row
    out = [pd.concat(indicators.handleExpiredTimer(("A",), None, None)) for _ in reversed(sorted(handle.timers))]
    assert all(len(o) == 24 and o.ts.dt.date.nunique() == 1 for o in out) and handle.cells["waiting"].most == 24
    got, state = pd.concat([o.astype(object) for o in out]), None
    assert got.ts.tolist() == sorted(times)
    for row in got.itertuples(index=False):
        state, want = streams.step(state, closes[row.ts.to_pydatetime()])
        assert [None if pd.isna(v) else v for v in row[3:]] == list(want)
    assert list(indicators.handleExpiredTimer(("A",), None, None)) == []


def test_batches_with_late_rows_and_a_restart(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(k, START + datetime.timedelta(hours=3 * i), float(c)) for k in "AB" for i, c in enumerate(rng.normal(100, 5, 160))]
    late = [r for r in rows if r[1].hour == 9]  # come a batch later, inside the watermark
    batch = {r: min(7, (r[1] - START).days // 3 + (r in late)) for r in rows}
    schema, landed, target = "ticker string, ts timestamp, close double", str(tmp_path / "landed"), str(tmp_path / "out")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for half in ((0, 1, 2, 3), (4, 5, 6, 7)):
            for k in half:
                part = spark.createDataFrame([r for r in rows if batch[r] == k] + [(None, None, 1.0)], schema)
                if k == 7:
                    part = part.union(streams.closing(spark.createDataFrame(rows, schema), "9 days"))
                part.coalesce(1).write.mode("append").parquet(landed)
            stream = streams.indicators(streams.read(spark, landed, spark.createDataFrame(rows, schema).schema), late="4 days")
            streams.run_available(stream, target, ["ticker", "ts"], "append")
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    got = streams.last_versions(spark, f"{target}/table", ["ticker", "ts"], keep_batch=True).toPandas()
    assert got._batch.nunique() >= 5 and got._batch.min() < 4 < got._batch.max()  # before and after the restart
    for k in "AB":
        own, state = got[got.ticker == k].sort_values("ts"), None
        mine = sorted(r for r in rows if r[0] == k)
        assert own.ts.tolist() == [r[1] for r in mine]
        for row, (_, _, close) in zip(own.drop(columns="_batch").itertuples(index=False), mine, strict=True):
            state, want = streams.step(state, close)
            assert [None if pd.isna(v) else v for v in row[3:]] == list(want)
