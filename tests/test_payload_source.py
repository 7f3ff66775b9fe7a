"""The payload data source: odd files, zones, many partitions, streams that stop, fail and start again."""

import datetime
import json
import os
import subprocess
import sys
from pathlib import Path

import pytest

from tidemark.sources import landed, payload_source
from tidemark.sources.payload_source import Files, PayloadStream, dealt, listed

SERIES = "Time Series (15min)"


def point(close, **more):
    return {"1. open": "1", "2. high": "2.5", "3. low": 0.5, "4. close": close, "5. volume": "7", **more}


def fetch(ticker, points):
    return json.dumps({"ticker": ticker, "payload": json.dumps({SERIES: points})})


def land(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    part = folder / f".{name}"
    part.write_text("\n".join(lines))
    part.rename(folder / name)


def odd(folder):
    land(folder, "a.json", fetch("A", {"2024-01-02 09:30:00": point("3"), "2024-07-02 09:30:00": point(None), "x": point("4"), "2024-07-02 09:45:00": point("5", **{"5. volume": "many"})}))
    land(folder, "b.json", "", "nonsense", "[1]", json.dumps({"ticker": "B", "payload": "{"}), json.dumps({"ticker": "B"}), json.dumps({"ticker": "B", "payload": '{"Note": "limit"}'}), json.dumps({"ticker": "B", "payload": "{}"}))
    land(folder, "c.json", fetch(None, {"2024-11-03 01:30:00": point("6"), "2024-03-10 02:30:00": point("7")}), fetch("E", {}))
    land(folder, "_d.json", fetch("D", {"2024-01-02 09:30:00": point("8")}))
    land(folder, "empty.json")


def utc(*at):
    return datetime.datetime(*at)


def test_odd_lines(spark, tmp_path):
    odd(tmp_path / "in")
    read = lambda **o: payload_source.payloads(spark, str(tmp_path / "in"), SERIES, zone="US/Eastern", interval="15m", **o)
    rows = sorted((r["ticker"] or "", r["ts"], r["close"], r["volume"], r["low"]) for r in read().collect())
    want = [("", utc(2024, 3, 10, 7, 30), 7.0, 7, 0.5), ("", utc(2024, 11, 3, 5, 30), 6.0, 7, 0.5), ("A", utc(2024, 1, 2, 14, 30), 3.0, 7, 0.5), ("A", utc(2024, 7, 2, 13, 45), 5.0, None, 0.5)]
    assert [(t, ts.replace(tzinfo=None), *r) for t, ts, *r in rows] == want
    reasons = sorted((r["ticker"] or "", r["reason"]) for r in read(rows="rejects").collect())
    assert reasons == [("", "not JSON"), ("", "not JSON"), ("B", "limit"), ("B", "no series"), ("B", "not JSON"), ("B", "not JSON")]
    assert sorted(map(str, read(size="1").collect())) == sorted(map(str, read().collect()))


def test_equal_to_the_built_in_reader(spark, tmp_path):
    odd(tmp_path / "in")
    got = payload_source.payloads(spark, str(tmp_path / "in"), SERIES, zone="US/Eastern", interval="15m")
    payloads = spark.read.schema("ticker string, payload string").json(str(tmp_path / "in"))
    want = landed.series_bars(payloads, SERIES, "US/Eastern", "15m", "landed")[0]
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_rejects_of_both_readers(spark, tmp_path):
    kinds = ["{", None, "", "{}", '{"Note": "limit"}', '{"Information": "key"}', "5", "null", fetch("x", {})]
    land(tmp_path / "in", "a.json", *[json.dumps({"ticker": str(k), "payload": p}) for k, p in enumerate(kinds)])
    got = payload_source.payloads(spark, str(tmp_path / "in"), SERIES, rows="rejects").collect()
    payloads = spark.read.schema("ticker string, payload string").json(str(tmp_path / "in"))
    want = landed.series_bars(payloads, SERIES, "UTC", "15m", "landed")[1].collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and {r.reason for r in got} == {"not JSON", "no series", "limit", "key"}


def test_nothing_landed(spark, tmp_path):
    assert payload_source.payloads(spark, str(tmp_path / "none"), SERIES).count() == 0


def test_dealing():
    assert dealt([("a", 5), ("b", 5), ("c", 20), ("d", 1)], 10) == [Files(("a", "b")), Files(("c",)), Files(("d",))] and dealt([], 10) == []


def test_offsets_mean_the_same_files(tmp_path):
    """A new reader of the same log gives the same files to an offset, whatever landed since and however old it says it is."""
    folder, options = tmp_path / "in", {"path": str(tmp_path / "in"), "series": SERIES, "log": str(tmp_path / "log")}
    land(folder, "m.json", "{}")
    first = PayloadStream(options)
    assert first.latestOffset() == {"entry": 1} == first.latestOffset()
    land(folder, "a.json", "{}")
    os.utime(folder / "a.json", (0, 0))
    again = PayloadStream(options)
    assert again.latestOffset() == {"entry": 2}
    assert again.partitions({"entry": 0}, {"entry": 1}) == [Files(("m.json",))] and again.partitions({"entry": 1}, {"entry": 2}) == [Files(("a.json",))]
    assert again.partitions({"entry": 2}, {"entry": 2}) == [] and [n for n, _ in listed(str(folder))] == ["a.json", "m.json"]


def test_interrupted_stream_repeats_nothing(spark, tmp_path):
    """The second batch fails after its rows are written; started again, every row is in the table once, files that landed meanwhile too."""
    folder, target, seen = tmp_path / "in", tmp_path / "out", []
    hour = lambda k: {f"2024-01-02 {k:02d}:00:00": point(str(k))}

    def run(fail):
        def write(batch, n):
            seen.append(n)
            batch.write.mode("overwrite").parquet(f"{target}/table/batch={n}")
            if n == fail:
                raise RuntimeError("lost")

        stream = payload_source.payloads(spark, str(folder), SERIES, True, log=str(tmp_path / "log"))
        stream.writeStream.trigger(availableNow=True).option("checkpointLocation", str(target / "progress")).foreachBatch(write).start().awaitTermination()

    land(folder, "z.json", fetch("A", hour(1)))
    run(None)
    land(folder, "y.json", fetch("A", hour(2)))
    with pytest.raises(Exception, match="lost"):
        run(1)
    land(folder, "x.json", fetch("A", hour(3)))
    run(None)
    run(None)
    rows = [(r["batch"], r["close"]) for r in spark.read.parquet(f"{target}/table").collect()]
    assert sorted(rows) == [(0, 1.0), (1, 2.0), (2, 3.0)] and seen == [0, 1, 1, 2]


def test_from_another_folder(tmp_path):
    """Planner and readers find the package wherever the driver runs."""
    land(tmp_path / "in", "a.json", fetch("A", {"2024-01-02 09:30:00": point("3")}))
    code = f"""
import sys; sys.path.insert(0, {str(Path(__file__).parents[1])!r})
from pyspark.sql import SparkSession
from tidemark import ship
from tidemark.sources import payload_source
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
ship(spark)
assert payload_source.payloads(spark, {str(tmp_path / "in")!r}, {SERIES!r}).count() == 1
stream = payload_source.payloads(spark, {str(tmp_path / "in")!r}, {SERIES!r}, True, log={str(tmp_path / "log")!r})
q = stream.writeStream.format("parquet").option("path", {str(tmp_path / "o")!r}).option("checkpointLocation", {str(tmp_path / "c")!r}).trigger(availableNow=True).start()
q.awaitTermination()
assert spark.read.parquet({str(tmp_path / "o")!r}).count() == 1
"""
    (tmp_path / "elsewhere").mkdir()
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path / "elsewhere", check=True, timeout=180)
