"""Side-by-side run of a registered query and its SQL."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [
        tuple(None if pd.isna(value) else value for value in row)
        for row in frame.astype(object).itertuples(index=False)
    ]
    return sorted(rows, key=lambda row: tuple((value is None, str(value)) for value in row))


def difference(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    """What differs first, or None. Values are compared exactly."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    kinds = {
        name: (ours[name].dtype.kind, theirs[name].dtype.kind)
        for name in ours.columns
        if "O" not in (ours[name].dtype.kind, theirs[name].dtype.kind)
        and ours[name].dtype != theirs[name].dtype
    }
    left, right = _canonical(ours), _canonical(theirs)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(left)} rows differ, first {wrong[0]}"
    return f"types {kinds}" if kinds else None
