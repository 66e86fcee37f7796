"""Columnar tables, by path or by catalog name."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A Parquet table. A declared schema saves opening files while planning."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_layer(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_table(spark, f"{root.rstrip('/')}/{name}")


def scan_catalog(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"{database}.{table}")


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, by listing it; none if there is no such folder."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []


def text_of(spark: SparkSession, file: str) -> str:
    """A small file as text, also one that Spark's readers hide."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def partition_values(spark: SparkSession, source: str, column: str) -> list[str] | None:
    """The values of a partition column, from names alone; None if ``source`` is not partitioned by it first.

    ``source`` is a path (it has a slash) or the name of a catalog table. No file is
    opened: a path costs one listing of its folders, a table one question to the catalog.
    """
    if "/" in source:
        names = names_in(spark, source)
    else:
        kinds = spark.sql(f"DESCRIBE TABLE {source}").where("col_name = '# Partition Information'")
        if kinds.isEmpty():
            return None
        names = [row[0].split("/")[0] for row in spark.sql(f"SHOW PARTITIONS {source}").collect()]
    found = {unquote(n.split("=", 1)[1]) for n in names if n.startswith(f"{column}=")}
    if not found and any(not n.startswith(("_", ".")) for n in names):
        return None
    return sorted(found)
