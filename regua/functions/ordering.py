"""Sort keys with NULLs last in both directions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ascending(*columns: str | Column) -> list[Column]:
    return [_column(c).asc_nulls_last() for c in columns]


def descending(*columns: str | Column) -> list[Column]:
    return [_column(c).desc_nulls_last() for c in columns]


def _column(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
