"""Partitioned Parquet tables and raw landing folders."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from regua.schemas import LOAD_COLUMN, Entity
from regua.sources.tables import names_in

# Fixed value: the folder of a partition without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def write_partitioned(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = ("ano",),
    *,
    order: Sequence[str] = (),
    gather: bool = True,
) -> None:
    """Replace the partitions present in ``df`` and leave all others alone.

    Without gathering, every task writes a file into every partition it holds
    rows of. The rebalance hint shuffles by the partition columns, merges small
    shuffle blocks and, unlike a plain repartition, cuts a partition holding a
    large part of all rows into pieces of the advisory size. Turn it off when
    the input already arrives in the order of its partitions. The hint needs adaptive
    execution; without it a large partition lands in one task.

    ``order`` sorts rows within each file, so that a filter on these columns
    skips row groups. The writer sorts by the partition columns in any case.
    """
    if gather:
        df = df.hint("rebalance", *partitions)
    if order:
        df = df.sortWithinPartitions(*partitions, *order)
    (
        df.write.mode("overwrite")
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def land_delimited(df: DataFrame, bronze: str, entity: Entity, load: str = "manual") -> None:
    """Write a raw load where :func:`regua.sources.delimited.read_entity` looks for it."""
    (
        df.write.mode("overwrite")
        .options(header=True, sep=entity.sep, encoding=entity.encoding)
        .csv(f"{bronze.rstrip('/')}/{entity.name}/{LOAD_COLUMN}={load}")
    )


def among(columns: Sequence[str], partitions: Collection[tuple]) -> Column:
    """Whether a row is in one of the partitions (values of ``columns``, nulls included); prunes a scan."""
    each = [
        reduce(Column.__and__, (F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(columns, own)))
        for own in sorted(partitions, key=repr)
    ]
    return reduce(Column.__or__, each, F.lit(False))


def remove_partition(spark: SparkSession, path: str, values: Mapping[str, object]) -> bool:
    """Remove the folder of one partition, which dynamic overwriting cannot empty; False if there is none."""
    folder = path.rstrip("/")
    for column, value in values.items():
        wanted = f"{column}={NO_VALUE if value is None else value}"
        name = next((n for n in names_in(spark, folder) if unquote(n) == wanted), None)
        if name is None:
            return False
        folder = f"{folder}/{name}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
