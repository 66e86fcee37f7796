"""External tables over the analytical layer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from regua.schemas import GOLD_PARTITIONS, GOLD_TABLES


def _quoted(text: str) -> str:
    """A SQL literal of any text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, database: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION {_quoted(location)}")


def create_external_table(
    spark: SparkSession,
    name: str,
    columns: Mapping[str, str],
    location: str,
    partitions: Sequence[str] = GOLD_PARTITIONS,
) -> None:
    listed = {**columns, **{p: "int" for p in partitions if p not in columns}}
    fields = ", ".join(f"`{column}` {kind}" for column, kind in listed.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet "
        f"PARTITIONED BY ({', '.join(partitions)}) LOCATION {_quoted(location)}"
    )


def repair_partitions(spark: SparkSession, name: str) -> None:
    spark.sql(f"MSCK REPAIR TABLE {name}")


def register_gold(
    spark: SparkSession,
    database: str,
    gold: str,
    tables: Mapping[str, Mapping[str, str]] = GOLD_TABLES,
) -> None:
    """Make the analytical tables under ``gold`` visible as ``database.gold_<name>``."""
    create_database(spark, database, gold)
    for table, columns in tables.items():
        name = f"{database}.gold_{table}"
        create_external_table(spark, name, columns, f"{gold.rstrip('/')}/{table}")
        repair_partitions(spark, name)
