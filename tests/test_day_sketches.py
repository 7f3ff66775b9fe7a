"""Quantiles from stored summaries against a percentile over all values."""

import math
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.functions import day_sketches

SHARES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
KIND = "ticker string, day string, r double"


def values(seed, n):
    draw = random.Random(seed)
    kinds = [
        lambda: draw.gauss(0, 1),
        lambda: draw.choice([-1.0, 0.0, -0.0, 1.0, 1.0]),
        lambda: draw.uniform(1, 1.000001),
        lambda: draw.choice([-1, 1]) * 2.0 ** draw.randint(-1074, 1000),
        lambda: draw.choice([math.inf, -math.inf, 5e-324, -5e-324, 1e308]),
    ]
    return [draw.choice(kinds)() for _ in range(n)]


def same(a, b):
    return a == b or (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-12)


def expected(rows, first=None, last=None):
    """Linear between neighbours, as a percentile does it; NaN is the largest."""
    held = {}
    for ticker, day, r in rows:
        if day is not None and r is not None and (first is None or day >= first) and (last is None or day <= last):
            held.setdefault(ticker, []).append(r)
    out = {}
    for ticker, found in held.items():
        found.sort(key=lambda v: (math.isnan(v), v))
        spots = [(len(found) - 1) * s for s in SHARES]
        pairs = [(found[math.floor(p)], found[math.ceil(p)], p - math.floor(p)) for p in spots]
        out[ticker] = (len(found), [a if a == b else a + f * (b - a) for a, b, f in pairs])
    return out


def check(spark, path, rows, ordered, **span):
    found = {r["ticker"]: (r["n"], r["q"]) for r in day_sketches.quantiles(spark, path, SHARES, ordered=ordered, **span).collect()}
    want = expected(rows, **span)
    assert set(found) == set(want)
    for ticker, (n, q) in want.items():
        assert found[ticker][0] == n and all(map(same, found[ticker][1], q)), (ticker, found[ticker], q)


@pytest.mark.parametrize("ordered", [1, 1 << 16])
def test_any_values_any_span(spark, tmp_path, ordered):
    """With ``ordered=1`` every cell of unequal values is cut into parts until each holds one value."""
    path = str(tmp_path / "store")
    rows = [(draw, f"2024-01-{1 + i % 9:02d}", v) for draw in ("A", "B", None) for i, v in enumerate(values(str(draw), 700))]
    rows += [("N", "2024-01-02", math.nan), ("N", "2024-01-03", 1.0), ("E", "2024-01-01", None), ("A", None, 7.0), ("ONE", "2024-01-05", 3.5)]
    table = spark.createDataFrame(rows, KIND)
    for part in (table.where("day < '2024-01-05'"), table.where("day >= '2024-01-05'"), table.where("day is null")):
        day_sketches.add(part, path, "r", F.col("day"), files=2)
    check(spark, path, rows, ordered)
    check(spark, path, rows, ordered, first="2024-01-03", last="2024-01-06")
    check(spark, path, rows, ordered, first="2025-01-01")


def test_new_periods_leave_old_ones_alone(spark, tmp_path):
    """Added without the old values being there at all; a period that is written again gives way."""
    path = tmp_path / "store"
    rows = [("A", f"2024-01-{1 + i % 4:02d}", float(i)) for i in range(400)]
    table = spark.createDataFrame(rows, KIND)
    day_sketches.add(table.where("day <= '2024-01-02'"), str(path), "r", F.col("day"), files=1)
    away = tmp_path / "away"
    (path / "values").rename(away)
    day_sketches.add(table.where("day > '2024-01-02'"), str(path), "r", F.col("day"), files=1)
    for folder in away.glob("_p=*"):
        folder.rename(path / "values" / folder.name)
    before = {p: p.stat().st_mtime_ns for p in Path(path).rglob("_p=2024-01-01/*.parquet")}
    day_sketches.add(table.where("day = '2024-01-03'"), str(path), "r", F.col("day"), files=1)
    assert before and before == {p: p.stat().st_mtime_ns for p in Path(path).rglob("_p=2024-01-01/*.parquet")}
    check(spark, str(path), rows, 1 << 16)


def test_cells_never_fall(spark):
    found = sorted({v for v in values("cells", 3000) if not math.isnan(v)})
    rows = spark.createDataFrame([(v,) for v in [*found, math.nan]], "v double").select("v", day_sketches.cell(F.col("v")).alias("c")).collect()
    cells = {r["v"]: r["c"] for r in rows if not math.isnan(r["v"])}
    assert all(cells[a] <= cells[b] for a, b in zip(found, found[1:], strict=False))
    assert all(r["c"] > max(cells.values()) for r in rows if math.isnan(r["v"]))


def test_moments_far_from_zero(spark, tmp_path):
    """Summaries keep the deviation of values that differ in the tenth digit."""
    rows = [("A", f"d{i % 3}", 1e6 + (i % 10) * 1e-4) for i in range(999)]
    day_sketches.add(spark.createDataFrame(rows, KIND), str(tmp_path / "s"), "r", F.col("day"))
    got = day_sketches.moments(day_sketches.span_summaries(spark, str(tmp_path / "s"), "string")).first()
    mean = math.fsum(r[2] for r in rows) / 999
    sd = math.sqrt(math.fsum((r[2] - mean) ** 2 for r in rows) / 998)
    assert got["n"] == 999 and math.isclose(got["mean"], mean, rel_tol=1e-14) and math.isclose(got["sd"], sd, rel_tol=1e-5)


def test_only_held_cells_are_scanned(spark, tmp_path):
    rows = [("A", "d", float(i)) for i in range(1, 1000)]
    day_sketches.add(spark.createDataFrame(rows, KIND), str(tmp_path / "s"), "r", F.col("day"))
    plan = day_sketches.quantiles(spark, str(tmp_path / "s"), [0.5])._jdf.queryExecution().executedPlan().toString()
    pushed = [part for part in plan.split("PushedFilters:")[1:] if "_c" in part.split("ReadSchema")[0]]
    assert pushed and any("EqualTo(_c" in part or "In(_c" in part for part in pushed)


def test_empty(spark, tmp_path):
    day_sketches.add(spark.createDataFrame([], KIND), str(tmp_path / "s"), "r", F.col("day"))
    assert day_sketches.quantiles(spark, str(tmp_path / "s"), [0.5]).collect() == []
