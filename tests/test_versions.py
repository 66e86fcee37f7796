"""Publishing by version: readers see old or new rows, crashes leave the old ones."""

import pytest
from pyspark.sql import functions as F

from regua.sinks import versions
from regua.sinks.catalog import create_database, create_external_table
from regua.sources.tables import names_in


def frame(spark, mark, years=(2023, 2024)):
    return spark.range(100).select(
        F.element_at(F.array(*map(F.lit, years)), (F.col("id") % len(years) + 1).cast("int")).alias("ano"),
        "id", F.lit(mark).alias("marca"))


@pytest.fixture()
def table(spark, tmp_path, request):
    database = f"versoes_{abs(hash(request.node.name)) % 10**8}"
    create_database(spark, database, str(tmp_path / "db"))
    create_external_table(spark, f"{database}.t", {"id": "bigint", "marca": "string"}, str(tmp_path / "t"))
    yield f"{database}.t", str(tmp_path / "t")
    spark.sql(f"DROP DATABASE {database} CASCADE")


def shown(spark, name):
    return {(r.ano, r.marca): r.n for r in spark.table(name).groupBy("ano", "marca").agg(F.count("*").alias("n")).collect()}


def test_partitions_turn_and_others_stay(spark, table):
    name, root = table
    versions.publish(frame(spark, "a"), name, root)
    assert shown(spark, name) == {(2023, "a"): 50, (2024, "a"): 50}
    versions.publish(frame(spark, "b", (2024, 2025)), name, root)
    assert shown(spark, name) == {(2023, "a"): 50, (2024, "b"): 50, (2025, "b"): 50}


def test_null_and_odd_partition_values(spark, tmp_path):
    create_database(spark, "versoes_odd", str(tmp_path / "db"))
    create_external_table(spark, "versoes_odd.t", {"id": "bigint", "uf": "string"}, str(tmp_path / "t"), ("ano", "uf"))
    rows = [(1, 2024, "São Paulo"), (2, None, "a/b=c'd"), (3, 2024, None), (4, None, None)]
    df = spark.createDataFrame(rows, "id bigint, ano int, uf string")
    for _ in range(2):
        versions.publish(df, "versoes_odd.t", str(tmp_path / "t"), ("ano", "uf"))
        found = sorted(map(tuple, spark.table("versoes_odd.t").select("id", "ano", "uf").collect()))
        assert found == rows
    spark.sql("DROP DATABASE versoes_odd CASCADE")


def test_a_reader_during_the_write_sees_whole_versions(spark, table, monkeypatch):
    name, root = table
    versions.publish(frame(spark, "a"), name, root)
    reading = spark.table(name).toLocalIterator()
    read = [next(reading)]  # begun before the publication, ended after it
    seen, real = [], versions.turn

    def watched(*arguments):
        seen.append(shown(spark, name))  # all files are written, nothing is turned
        real(*arguments)

    monkeypatch.setattr(versions, "turn", watched)
    versions.publish(frame(spark, "b"), name, root)
    assert seen == [{(2023, "a"): 50, (2024, "a"): 50}]
    read += reading
    assert len(read) == 100 and {r.marca for r in read} == {"a"}
    assert shown(spark, name) == {(2023, "b"): 50, (2024, "b"): 50}


def test_a_crash_leaves_the_old_rows(spark, table, monkeypatch):
    name, root = table
    versions.publish(frame(spark, "a"), name, root)
    with monkeypatch.context() as m:
        m.setattr(versions, "turn", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            versions.publish(frame(spark, "b"), name, root)
    assert shown(spark, name) == {(2023, "a"): 50, (2024, "a"): 50}
    versions.publish(frame(spark, "b"), name, root)
    assert shown(spark, name) == {(2023, "b"): 50, (2024, "b"): 50}


def test_retire_keeps_what_is_used_or_young(spark, table):
    name, root = table
    versions.publish(frame(spark, "a"), name, root)
    versions.publish(frame(spark, "b", (2024,)), name, root)
    versions.publish(frame(spark, "c", (2024,)), name, root)
    assert versions.retire(spark, name, root) == []
    assert len(versions.retire(spark, name, root, unused_for=0)) == 1
    assert len(names_in(spark, f"{root}/{versions.VERSIONS}")) == 2
    assert shown(spark, name) == {(2023, "a"): 50, (2024, "c"): 100}
