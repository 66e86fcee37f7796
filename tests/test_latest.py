"""The latest year from names of partitions."""

import pytest
from pyspark.sql import functions as F

from regua.operators.latest import keep_latest, keep_newest
from regua.sinks.catalog import create_database, create_external_table, repair_partitions
from regua.sinks.files import write_partitioned
from regua.sources.tables import partition_values

SCHEMA = "id int, ano int"


@pytest.fixture
def table(spark, tmp_path):
    rows = [(i, 2000 + i % 4) for i in range(40)]
    write_partitioned(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "t"))
    return tmp_path / "t"


def years(df):
    return {r.ano for r in df.select("ano").collect()}


def spoil(table, but):
    for file in table.rglob("*.parquet"):
        if f"ano={but}" not in str(file):
            file.write_bytes(b"no parquet")
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)


def test_no_file_of_an_older_year_is_opened(spark, table):
    spoil(table, but=2003)
    assert years(keep_newest(spark, str(table), SCHEMA)) == {2003}
    with pytest.raises(Exception, match="parquet|Parquet"):
        keep_latest(spark.read.schema(SCHEMA).parquet(str(table))).collect()


def test_an_empty_latest_partition_is_no_year(spark, table):
    empty = spark.createDataFrame([], "id int").coalesce(1)
    empty.write.parquet(str(table / "ano=2004"))
    (table / "ano=2005").mkdir()
    assert set(partition_values(spark, str(table), "ano")) == {"2000", "2001", "2002", "2003", "2004", "2005"}
    found = keep_newest(spark, str(table), SCHEMA)
    assert years(found) == years(keep_latest(spark.read.parquet(str(table)))) == {2003}


def test_a_missing_year_does_not_count(spark, tmp_path):
    write_partitioned(spark.createDataFrame([(1, None), (2, 1999)], SCHEMA), str(tmp_path / "t"))
    assert years(keep_newest(spark, str(tmp_path / "t"), SCHEMA)) == {1999}
    write_partitioned(spark.createDataFrame([(1, None)], SCHEMA), str(tmp_path / "n"))
    assert keep_newest(spark, str(tmp_path / "n"), SCHEMA).collect() == []


def test_tables_without_such_partitions_are_scanned(spark, tmp_path):
    df = spark.createDataFrame([(1, 2001), (2, 2002)], SCHEMA)
    df.write.parquet(str(tmp_path / "flat"))
    assert partition_values(spark, str(tmp_path / "flat"), "ano") is None
    assert years(keep_newest(spark, str(tmp_path / "flat"), SCHEMA)) == {2002}
    df.withColumn("uf", F.lit("SP")).write.partitionBy("uf", "ano").parquet(str(tmp_path / "second"))
    assert partition_values(spark, str(tmp_path / "second"), "ano") is None
    assert years(keep_newest(spark, str(tmp_path / "second"))) == {2002}
    assert partition_values(spark, str(tmp_path / "absent"), "ano") == []


def test_catalog_tables(spark, table, tmp_path):
    create_database(spark, "regua_latest", str(tmp_path / "db"))
    create_external_table(spark, "regua_latest.t", {"id": "int"}, str(table))
    repair_partitions(spark, "regua_latest.t")
    spoil(table, but=2003)
    assert partition_values(spark, "regua_latest.t", "ano") == ["2000", "2001", "2002", "2003"]
    assert years(keep_newest(spark, "regua_latest.t")) == {2003}
    df = spark.createDataFrame([(1, 2001), (2, 2002)], SCHEMA)
    df.write.saveAsTable("regua_latest.flat", path=str(tmp_path / "flat"))
    assert partition_values(spark, "regua_latest.flat", "ano") is None
    assert years(keep_newest(spark, "regua_latest.flat")) == {2002}
    spark.sql("DROP DATABASE regua_latest CASCADE")
