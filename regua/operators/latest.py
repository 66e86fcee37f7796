"""The most recent year of a table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from regua.sources.tables import partition_values, read_table


def latest_year(df: DataFrame, year: str = "ano") -> DataFrame:
    return df.agg(F.max(year).alias(year))


def keep_latest(df: DataFrame, year: str = "ano") -> DataFrame:
    """Rows of the most recent year.

    The maximum stays a scalar subquery: over a table partitioned by year it
    runs first and only the matching partition is read, with no trip through
    the driver program.
    """
    return df.where(F.col(year) == latest_year(df, year).scalar())


def newest(df: DataFrame, years: Iterable[int], year: str = "ano") -> int | None:
    """The largest of ``years`` that has rows, asked from the largest down.

    Each question opens files of one partition, and the first is the last one unless a
    partition is empty, which counts as no year, as it does for a maximum.
    """
    for value in sorted(set(years), reverse=True):
        if not df.where(F.col(year) == value).limit(1).isEmpty():
            return value
    return None


def keep_newest(
    spark: SparkSession, source: str, schema: T.StructType | str | None = None, year: str = "ano"
) -> DataFrame:
    """Rows of the most recent year of a stored table, by path (with a slash) or by catalog name.

    The years come from names of folders or partitions, so no file of an older year is opened, not even its footer.
    A table that is not partitioned by year first is scanned as in ``keep_latest``, and so is one with a
    year that is no number. ``schema`` of a path saves Spark a look into some file while planning.
    """
    table = read_table(spark, source, schema) if "/" in source else spark.table(source)
    values = partition_values(spark, source, year)
    if values is None:
        return keep_latest(table, year)
    numbers = [v for v in values if v != "__HIVE_DEFAULT_PARTITION__"]
    if not all(v.lstrip("-").isdigit() for v in numbers):
        return keep_latest(table, year)
    found = newest(table, map(int, numbers), year)
    return table.where(F.lit(False) if found is None else F.col(year) == found)
