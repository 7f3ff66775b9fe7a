"""Comparison of a Spark result with DuckDB's, whatever the order of rows and columns."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return db


def plain(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if pd.api.types.is_numeric_dtype(frame[c]):
            frame[c] = frame[c].astype(float)
        elif "datetime" in str(frame[c].dtype):
            frame[c] = pd.to_datetime(frame[c]).dt.tz_localize(None).astype("datetime64[us]").astype(str)
        else:
            frame[c] = frame[c].map(lambda v: "NaT" if v is None or v is pd.NaT or v != v else str(v).replace(" 00:00:00", ""))
    keys = [c for c in frame.columns if not pd.api.types.is_numeric_dtype(frame[c])]
    return frame.sort_values(keys + [c for c in frame.columns if c not in keys]).reset_index(drop=True)


def assert_same(got: pd.DataFrame, want: pd.DataFrame) -> None:
    assert sorted(got.columns) == sorted(want.columns)
    pd.testing.assert_frame_equal(plain(got), plain(want), check_dtype=False, rtol=1e-9, atol=1e-9)
