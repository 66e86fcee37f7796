"""Delimited raw files, one folder per entity and load date."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, types as T

from regua.functions.numeric import cast_columns
from regua.schemas import LOAD_COLUMN, Entity


def read_entity(
    spark: SparkSession,
    bronze: str,
    entity: Entity,
    *,
    loads: Sequence[str] | None = None,
    infer: bool = False,
    decimal_mark: str = ".",
) -> DataFrame:
    """Read every load of an entity, or only the loads named.

    Columns are found by the header of each load, so their order, extra columns
    and columns that came later do not matter (a load without a column has NULL
    there), and declared ones get their declared type. Text that does not fit
    becomes NULL. Only header lines are read ahead; ``infer`` asks for type
    inference instead, at the price of a second pass over the files chosen. A
    file whose header differs from that of its load is refused, not read askew.
    """
    path = f"{bronze.rstrip('/')}/{entity.name}"
    options = {"header": True, "sep": entity.sep, "encoding": entity.encoding}
    if infer:
        return read_text_columns(spark, path, options, loads, infer=True)
    return declare_types(read_text_columns(spark, path, options, loads), entity, decimal_mark)


def read_text_columns(
    spark: SparkSession,
    path: str,
    options: dict,
    loads: Sequence[str] | None = None,
    infer: bool = False,
) -> DataFrame:
    """All columns as text (or as inferred), with the load date kept exactly as the folder says."""
    folders = load_folders(spark, path)
    if loads is not None:
        absent = sorted(set(loads) - set(folders))
        if absent:
            raise FileNotFoundError(f"{path} has no load {', '.join(absent)}")
        folders = {load: folders[load] for load in loads}
    if not folders:
        raise FileNotFoundError(f"{path} has no folder {LOAD_COLUMN}=...")
    parts = []
    for names, group in by_header(spark, folders, options).items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, LOAD_COLUMN)])
        reader = spark.read.schema(schema).options(**options, enforceSchema=False, basePath=path)
        part = reader.csv(group)
        if infer:
            found = spark.read.options(**options, inferSchema=True).csv(group)
            kinds = {f.name: f.dataType.simpleString() for f in found.schema if f.name in names}
            part = cast_columns(part, kinds)
        parts.append(part)
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), _alike(parts))
    return whole.select(*[name for name in whole.columns if name != LOAD_COLUMN], LOAD_COLUMN)


def load_folders(spark: SparkSession, path: str) -> dict[str, str]:
    """The folder of each load date, by listing names only."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = {}
    for status in files.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{LOAD_COLUMN}="):
            found[unquote(name.split("=", 1)[1])] = status.getPath().toString()
    return dict(sorted(found.items()))


def by_header(
    spark: SparkSession, folders: dict[str, str], options: dict
) -> dict[tuple[str, ...], list[str]]:
    """Folders of loads with the same header, so that each header is one scan."""
    found: dict[tuple[str, ...], list[str]] = {}
    for folder in folders.values():
        names = spark.read.options(**options).csv(folder).columns
        found.setdefault(tuple(names), []).append(folder)
    return found


def declare_types(df: DataFrame, entity: Entity, decimal_mark: str = ".") -> DataFrame:
    present = {name: kind for name, kind in entity.types.items() if name in df.columns}
    return cast_columns(df, present, decimal_mark)


def _alike(parts: list[DataFrame]) -> list[DataFrame]:
    """Columns that were inferred differently from load to load become text in all."""
    kinds: dict[str, set[str]] = {}
    for part in parts:
        for name, kind in part.dtypes:
            kinds.setdefault(name, set()).add(kind)
    mixed = {name for name, own in kinds.items() if len(own) > 1}
    return [
        part.withColumns({n: part[n].cast("string") for n in part.columns if n in mixed})
        for part in parts
    ]
