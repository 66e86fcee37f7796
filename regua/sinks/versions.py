"""Publishing without a gap: new files first, then the catalog turns to them.

Overwriting a partition in place has a moment in which readers meet old files that are gone or
half of the new ones. Here every publication writes into a folder of its own, and when all of it is there, the
catalog's partitions are pointed at it, one statement each. So a reader sees a partition as it was or
as it is, whole; one that has begun its scan goes on reading the old files, which stay until ``retire``.
A publication that breaks off before the first statement has changed nothing; one that breaks off
between two has turned some partitions, and is simply repeated. Whether a table of several partitions
turns at one instant is not promised: each partition does.

Only partitions present in the frame are published, as with a dynamic overwrite.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from regua.sinks.catalog import _quoted
from regua.sinks.files import NO_VALUE, write_partitioned
from regua.sources.tables import names_in

VERSIONS = "versoes"


def _folders(spark: SparkSession, root: str, depth: int) -> list[str]:
    """Partition folders below ``root`` as relative paths."""
    if depth == 0:
        return [""]
    return [
        f"{name}/{rest}".rstrip("/")
        for name in names_in(spark, root)
        if "=" in name
        for rest in _folders(spark, f"{root}/{name}", depth - 1)
    ]


def _spec(folder: str) -> str:
    """``ano=2023/uf=SP`` as a partition of SQL."""
    pairs = (part.split("=", 1) for part in folder.split("/"))
    return ", ".join(f"`{c}` = {'NULL' if v == NO_VALUE else _quoted(unquote(v))}" for c, v in pairs)


def publish(
    df: DataFrame, table: str, root: str, partitions: Sequence[str] = ("ano",), *, order: Sequence[str] = ()
) -> str:
    """Write ``df`` as a version below ``root`` and turn the partitions of ``table`` to it; returns its folder."""
    spark = df.sparkSession
    # The time goes first, so names sort by age.
    folder = f"{root.rstrip('/')}/{VERSIONS}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    write_partitioned(df, folder, partitions, order=order)
    turn(spark, table, folder, len(partitions))
    return folder


def turn(spark: SparkSession, table: str, folder: str, depth: int = 1) -> None:
    """Point the partitions of ``table`` at those in ``folder``; repeating it changes nothing more."""
    fresh = _folders(spark, folder, depth)
    known = {row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    for place in fresh:
        where = _quoted(f"{folder}/{place}")
        if place in known:
            spark.sql(f"ALTER TABLE {table} PARTITION ({_spec(place)}) SET LOCATION {where}")
        else:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({_spec(place)}) LOCATION {where}")


def locations(spark: SparkSession, table: str) -> dict[str, str]:
    """Where each partition of ``table`` lies, from the catalog."""
    found = {}
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        told = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({_spec(row[0])})")
        found[row[0]] = told.where("col_name = 'Location'").first()["data_type"]
    return found


def retire(spark: SparkSession, table: str, root: str, unused_for: float = 86_400) -> list[str]:
    """Remove versions that no partition points at and that are older than ``unused_for`` seconds; returns their names.

    The age is that of the version, so it must exceed the longest reader and the longest publication.
    """
    base = f"{root.rstrip('/')}/{VERSIONS}"
    used = set(locations(spark, table).values())
    limit = time.time_ns() - int(unused_for * 1e9)
    gone = []
    for name in sorted(names_in(spark, base)):
        inside = f"/{VERSIONS}/{name}/"
        if int(name.split("-")[0]) >= limit or any(inside in f"{place}/" for place in used):
            continue
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/{name}")
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        gone.append(name)
    return gone
