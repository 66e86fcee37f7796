"""Every registered query against its SQL on another engine, exactly."""

import pytest

import __spark_entry__ as registered
from compare import connect, difference
from regua.analogues.oracle import ORACLE
from regua.analogues.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    with connect(SF) as connection:
        yield connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(registered.queries())
    assert set(ORACLE) <= set(registered.oracle_sql())


def test_flagship(spark):
    df = registered.entry(spark)
    assert df.columns == [
        "ano", "rede", "status_meta", "qtd_municipios", "media_resultado", "gap_medio"]
    assert df.count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_same_answer(spark, duck, name):
    ours = QUERIES[name](spark, SF).toPandas()
    theirs = duck.execute(ORACLE[name]).df()
    assert len(ours) > 0
    assert difference(ours, theirs) is None


def in_order(frame):
    return [tuple(None if v != v else v for v in row) for row in frame[sorted(frame.columns)].itertuples(index=False)]


@pytest.mark.parametrize("name", [
    "q01_below_target_latest", "q02_entity_history", "q04_lowest_micro_rate", "q05_largest_gaps",
    "q06_mean_by_network", "q07_situation_band", "q08_national_summary", "topk_lowest"])
def test_same_order(spark, duck, name):
    assert in_order(QUERIES[name](spark, SF).toPandas()) == in_order(duck.execute(ORACLE[name]).df())


def test_sort_cannot_be_left_out(spark, duck, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    monkeypatch.setattr(DataFrame, "orderBy", lambda self, *columns: self)
    unsorted = QUERIES["sort_nulls_last"](spark, SF).toPandas()
    assert difference(unsorted, duck.execute(ORACLE["sort_nulls_last"]).df()) is not None


def test_full_sort_in_order(spark, duck, monkeypatch):
    query, sql = QUERIES["sort_all_nulls_last"], ORACLE["sort_all_nulls_last"]
    theirs = in_order(duck.execute(sql).df())
    assert len(theirs) > 120
    assert in_order(query(spark, SF).toPandas()) == theirs

    from pyspark.sql.classic.dataframe import DataFrame

    monkeypatch.setattr(DataFrame, "orderBy", lambda self, *columns: self)
    assert in_order(query(spark, SF).toPandas()) != theirs
