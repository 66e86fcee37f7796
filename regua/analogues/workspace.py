"""Conformed and analytical tables over the driver's data, written once.

The analytical questions are asked of stored tables, so their tables are built
the first time one is needed and read by every later question of the same
application. They live in the shared scratch folder, where no lost executor can
take them away.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from regua.analogues import views
from regua.plans.gold import gold_indicator, gold_micro, gold_national
from regua.schemas import ENTITIES, GOLD_ORDER, GOLD_PARTITIONS
from regua.session import scratch_path
from regua.sinks.files import write_partitioned
from regua.sources.tables import read_table

_stored: dict[tuple[str, str, str], tuple[str, DataFrame]] = {}
_building = threading.RLock()


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str, str]:
    """The table over the data as they are now: other files, sizes or times are other data."""
    jvm = spark.sparkContext._jvm
    listed = []
    for table in ("orders", "customer", "nation"):
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{table}.parquet")
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for status in files.listStatus(path):
            listed.append(
                f"{status.getPath()} {status.getLen()} {status.getModificationTime()}"
            )
    return spark.sparkContext.applicationId, "\n".join(listed), name


def stored(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    build: Callable[[], DataFrame],
) -> DataFrame:
    """The table ``name`` over ``sf_dir``, written by ``build`` if nobody has yet.

    It is laid out like the table whose part it plays. The frame that reads it is kept as well, since it holds the file listing.
    """
    key = _key(spark, sf_dir, name)
    with _building:
        if key not in _stored:
            path = scratch_path(spark, name)
            if name in ENTITIES:
                partitions, order = ENTITIES[name].partitions, ENTITIES[name].order
            else:
                partitions, order = GOLD_PARTITIONS, GOLD_ORDER.get(name, ())
            write_partitioned(build(), path, partitions, order=order)
            _stored[key] = path, read_table(spark, path)
        return _stored[key][1]


def path_of(spark: SparkSession, sf_dir: str, name: str) -> str:
    return _stored[_key(spark, sf_dir, name)][0]


def silver_micro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "aluno", lambda: views.micro(spark, sf_dir))


def silver_pair(spark: SparkSession, sf_dir: str, entity: str) -> tuple[DataFrame, DataFrame]:
    suffix = "municipio" if entity == views.CITY else "uf"
    pupils = silver_micro(spark, sf_dir)
    return (
        stored(spark, sf_dir, suffix, lambda: views.results(pupils, entity)),
        stored(spark, sf_dir, f"meta_{suffix}", lambda: views.targets(pupils, entity)),
    )


def _gold_indicator(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return gold_indicator(*silver_pair(spark, sf_dir, entity), entity, views.TARGET_YEARS)


def gold_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(
        spark,
        sf_dir,
        "indicador_municipio",
        lambda: _gold_indicator(spark, sf_dir, views.CITY),
    )


def gold_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(
        spark, sf_dir, "indicador_uf", lambda: _gold_indicator(spark, sf_dir, views.STATE)
    )


def gold_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build() -> DataFrame:
        pupils = silver_micro(spark, sf_dir)
        country = stored(spark, sf_dir, "meta_brasil", lambda: views.national(pupils))
        return gold_national(country, views.TARGET_YEARS)

    return stored(spark, sf_dir, "indicador_brasil", build)


def gold_pupils(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(
        spark,
        sf_dir,
        "aluno_municipio",
        lambda: gold_micro(silver_micro(spark, sf_dir), cut=views.CUT),
    )
