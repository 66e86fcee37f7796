"""The questions asked by SQL table functions equal the functions over frames, order included."""

import pytest
from pyspark.sql import functions as F

from regua.analogues import views, workspace
from regua.plans import reports
from regua.sinks.questions import register_questions

SF = "/root/testdata/sf0.01"
DATABASE = "regua_perguntas"
NAMES = ("indicador_municipio", "indicador_uf", "indicador_brasil", "aluno_municipio")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    spark.sql(f"CREATE DATABASE {DATABASE} LOCATION '{tmp_path_factory.mktemp('perguntas')}'")
    makers = (workspace.gold_city, workspace.gold_state, workspace.gold_country, workspace.gold_pupils)
    found = {}
    for name, make in zip(NAMES, makers):
        found[name] = make(spark, SF)
        path = workspace.path_of(spark, SF, name)
        spark.sql(f"CREATE TABLE {DATABASE}.gold_{name} USING parquet LOCATION '{path}'")
        spark.sql(f"MSCK REPAIR TABLE {DATABASE}.gold_{name}")
    assert len(register_questions(spark, DATABASE, cut=views.CUT)) == 12
    before = spark.catalog.currentDatabase()
    spark.sql(f"USE {DATABASE}")
    yield found
    spark.sql(f"USE {before}")
    spark.sql(f"DROP DATABASE {DATABASE} CASCADE")


def by_frames(t):
    city, state, country, micro = (t[name] for name in NAMES)
    return {
        "q01_abaixo_da_meta()": reports.below_target_latest(city),
        "q01_abaixo_da_meta(7)": reports.below_target_latest(city, 7),
        "q02_historico(305)": reports.entity_history(city, 305),
        "q02_historico()": reports.entity_history(city),
        "q03_ranking_estados()": reports.state_ranking(state),
        "q04_menor_taxa_microdados()": reports.lowest_micro_rate(micro, cut=views.CUT),
        "q05_maiores_gaps()": reports.largest_gaps(city),
        "q05_maiores_gaps(0)": reports.largest_gaps(city, 0),
        "q06_media_por_rede()": reports.mean_by_network(city),
        "q07_situacao_nacional()": reports.national_situation(country),
        "q08_resumo_nacional()": reports.national_summary(country),
        "q09_distribuicao_status()": reports.status_distribution(city),
        "q10_faixas_de_gap()": reports.gap_bands(city),
        "q11_oficial_x_microdados()": reports.official_vs_micro(city, micro, cut=views.CUT),
        "q11_oficial_x_microdados(3)": reports.official_vs_micro(city, micro, 3, cut=views.CUT),
        "q12_melhores_e_piores()": reports.best_worst(city),
        "q12_melhores_e_piores(400)": reports.best_worst(city, 400),
    }


def test_answers_and_order(spark, tables):
    for call, expected in by_frames(tables).items():
        found = spark.sql(f"SELECT * FROM {call}")
        assert found.columns == expected.columns, call
        assert [tuple(r) for r in found.collect()] == [tuple(r) for r in expected.collect()], call


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_arguments_reach_the_plan(spark, tables):
    assert "TakeOrderedAndProject(limit=20," in plan(spark.sql("SELECT * FROM q05_maiores_gaps()"))
    assert "EqualTo(id_municipio,305)" in plan(spark.sql("SELECT * FROM q02_historico(305)"))
    rates = plan(spark.sql("SELECT * FROM q11_oficial_x_microdados(9)"))
    assert "row_number(), 9, Partial" in rates and "BroadcastNestedLoop" not in rates and "Cartesian" not in rates


def test_functions_join_with_other_tables(spark, tables):
    spark.createDataFrame([(1,), (2,)], "id int").createOrReplaceTempView("outra")
    joined = spark.sql("SELECT COUNT(*) FROM q05_maiores_gaps(5) CROSS JOIN outra")
    assert joined.first()[0] == 10


def test_copies_of_rows_in_both_ends(spark, tables, tmp_path):
    """Equal rows count copy by copy, as over frames."""
    city = tables["indicador_municipio"]
    few = city.where(F.col("ano") == city.agg(F.max("ano")).first()[0]).orderBy("id_municipio", "rede").limit(4)
    few.unionAll(few).unionAll(few.limit(1)).write.partitionBy("ano").parquet(str(tmp_path / "few"))
    spark.sql(f"CREATE DATABASE {DATABASE}_2 LOCATION '{tmp_path / 'db'}'")
    try:
        for name in NAMES:
            path = tmp_path / "few" if name == "indicador_municipio" else workspace.path_of(spark, SF, name)
            spark.sql(f"CREATE TABLE {DATABASE}_2.gold_{name} USING parquet LOCATION '{path}'")
            spark.sql(f"MSCK REPAIR TABLE {DATABASE}_2.gold_{name}")
        register_questions(spark, f"{DATABASE}_2", cut=views.CUT)
        spark.sql(f"USE {DATABASE}_2")
        stored = spark.read.parquet(str(tmp_path / "few"))
        for k in (2, 5, 7, 20):
            found = spark.sql(f"SELECT * FROM q12_melhores_e_piores({k})").collect()
            assert [tuple(r) for r in found] == [tuple(r) for r in reports.best_worst(stored, k).collect()]
    finally:
        spark.sql(f"USE {DATABASE}")
        spark.sql(f"DROP DATABASE {DATABASE}_2 CASCADE")
