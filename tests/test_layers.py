"""Sinks, catalog and the whole flow from raw files to tables."""

import pytest
from pyspark.sql import functions as F

from regua.operators.quality import QualityError
from regua.plans import medallion, reports
from regua.schemas import ENTITIES, GOLD_TABLES, MICRODATA_NAMES
from regua.sinks.files import write_partitioned
from regua.sources.delimited import read_entity
from regua.sources.tables import read_layer, read_table, scan_catalog

TARGETS = ",".join(f"meta_alfabetizacao_{year}" for year in range(2024, 2031))


def land(root, name, lines, load="manual"):
    entity = ENTITIES[name]
    folder = root / name / f"dt_carga={load}"
    folder.mkdir(parents=True)
    text = "\n".join(lines) + "\n"
    (folder / f"{name}.csv").write_text(text, encoding=entity.encoding)


@pytest.fixture
def bronze(tmp_path):
    root = tmp_path / "bronze"
    targets = "60,64,67,71,74,77,80"
    land(root, "meta_brasil", [
        f"ano,rede,taxa_alfabetizacao,{TARGETS},percentual_participacao",
        f"2024,Pública,59.2,{targets},87"])
    land(root, "meta_uf", [
        f"ano,sigla_uf,rede,taxa_alfabetizacao,{TARGETS},percentual_participacao",
        f"2024,SP,Pública,55,{targets},90"])
    land(root, "meta_municipio", [
        f"ano,id_municipio,rede,taxa_alfabetizacao,{TARGETS},percentual_participacao",
        f"2024,3550308,Municipal,55,{targets},90"])
    land(root, "uf", [
        "ano,sigla_uf,serie,rede,taxa_alfabetizacao,media_portugues",
        "2024,SP,2,5,61.53,745.1", "2024,SP,2,3,58.0,742.2"])
    land(root, "municipio", [
        "ano,id_municipio,serie,rede,taxa_alfabetizacao,media_portugues",
        "2024,3550308,2,3,54.5,741.0", "2023,3550308,2,3,50,739.5"])
    pupils = [("2024", f"p{i}", "3", str(740 + i), "1" if i >= 3 else "0") for i in range(6)]
    pupils.append(("2024", "px", "3", "", ""))
    land(root, "aluno", [
        ";".join(MICRODATA_NAMES),
        *[f"{ano};35;SP;{pid};2;9;{rede};3550308;São Paulo;1.0;{score};{flag}"
          for ano, pid, rede, score, flag in pupils]])
    return root


def test_whole_flow(spark, bronze, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    medallion.run(spark, str(bronze), silver, gold, "regua_test")

    pupil = read_layer(spark, silver, "aluno")
    assert {"dt_carga", "rede_codigo", "rede_descricao", "fl_alfabetizado_calculado"} <= set(
        pupil.columns)
    assert (tmp_path / "silver/aluno/ano=2024/sigla_uf=SP").is_dir()

    for name, columns in GOLD_TABLES.items():
        table = scan_catalog(spark, "regua_test", f"gold_{name}")
        assert dict(table.dtypes) == {**columns, "ano": "int"}
        assert table.count() == {"indicador_municipio": 2, "indicador_uf": 2}.get(name, 1)

    units = scan_catalog(spark, "regua_test", "gold_aluno_municipio").first()
    assert (units.nome_municipio, units.qtd_alunos) == ("São Paulo", 7)
    assert units.taxa_alfabetizacao_microdados == 50.0
    assert units.taxa_alfabetizacao_calculada_743 == 42.86

    city = scan_catalog(spark, "regua_test", "gold_indicador_municipio")
    assert [(r.ano, r.gap_meta) for r in reports.below_target_latest(city).collect()] == [
        (2024, -5.5)]
    plain = spark.sql(
        "SELECT ano, COUNT(*) AS n FROM regua_test.gold_indicador_municipio "
        "WHERE ano = (SELECT MAX(ano) FROM regua_test.gold_indicador_municipio) GROUP BY ano"
    )
    assert [tuple(r) for r in plain.collect()] == [(2024, 1)]
    difference = reports.official_vs_micro(
        city, scan_catalog(spark, "regua_test", "gold_aluno_municipio")).collect()
    assert [r.diferenca_oficial_vs_microdados for r in difference] == [11.64]

    medallion.run(spark, str(bronze), silver, gold)
    assert read_layer(spark, gold, "indicador_municipio").count() == 2
    spark.sql("DROP DATABASE regua_test CASCADE")


def test_failed_gate_stops_before_gold(spark, bronze, tmp_path):
    extra = bronze / "aluno/dt_carga=again"
    extra.mkdir()
    source = bronze / "aluno/dt_carga=manual/aluno.csv"
    (extra / "copy.csv").write_bytes(source.read_bytes())
    with pytest.raises(QualityError, match="duplicate_key"):
        medallion.run(spark, str(bronze), str(tmp_path / "s"), str(tmp_path / "g"))
    assert not (tmp_path / "g").exists()
    medallion.run(
        spark, str(bronze), str(tmp_path / "s"), str(tmp_path / "g"), loads=["manual"])
    assert (tmp_path / "g/aluno_municipio").is_dir()


def test_overwrite_leaves_other_years_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    whole = spark.createDataFrame([(2023, "old"), (2024, "old")], "ano int, v string")
    write_partitioned(whole, path)
    for _ in range(2):
        write_partitioned(spark.createDataFrame([(2024, "new")], "ano int, v string"), path)
    assert {(r.ano, r.v) for r in read_table(spark, path).collect()} == {
        (2023, "old"), (2024, "new")}


def test_missing_partition_value_survives(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(2024, None, 1), (None, "SP", 2)]
    df = spark.createDataFrame(rows, "ano int, sigla_uf string, v int")
    write_partitioned(df, path, ["ano", "sigla_uf"])
    assert {(r.ano, r.sigla_uf, r.v) for r in read_table(spark, path).collect()} == {
        (2024, None, 1), (None, "SP", 2)}


def test_gathering_limits_files_and_splits_a_large_year(spark, tmp_path):
    """Nearly all rows in one year: one file for the small year, several for the large."""
    df = spark.range(0, 400000, 1, 16).select(
        F.when(F.col("id") % 1000 == 0, 2023).otherwise(2024).alias("ano"),
        F.sha2(F.col("id").cast("string"), 256).alias("texto"))
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, "4m")
    try:
        write_partitioned(df, str(tmp_path / "t"))
    finally:
        spark.conf.set(advisory, before)
    files = {year: len(list((tmp_path / f"t/ano={year}").glob("*.parquet")))
             for year in (2023, 2024)}
    assert files[2023] <= 2 and 2 <= files[2024] < 16
    assert read_table(spark, str(tmp_path / "t")).count() == 400000


def test_rows_are_sorted_within_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 50000, 1, 8).select(
        (2020 + F.col("id") % 3).cast("int").alias("ano"),
        F.concat(F.lit("U"), F.col("id") % 5).alias("sigla_uf"),
        F.pmod(F.xxhash64("id"), F.lit(700)).cast("int").alias("id_municipio"))
    layout = ENTITIES["aluno"]
    write_partitioned(df, path, layout.partitions, order=layout.order)
    files = [str(f) for f in (tmp_path / "t").rglob("*.parquet")]
    assert len(files) >= 15
    for file in files:
        ids = [r.id_municipio for r in spark.read.parquet(file).collect()]
        assert ids == sorted(ids)


def test_states_from_files_to_questions(spark, bronze, tmp_path):
    """Every band, a missing target, a missing result, a network without targets, worked out by hand."""
    later = "64,67,71,74,77,80"
    land(bronze, "uf", [
        "ano,sigla_uf,serie,rede,taxa_alfabetizacao,media_portugues",
        "2024,AA,2,5,60.0,750", "2024,BB,2,5,57.5,745", "2024,CC,2,5,52.0,744",
        "2024,DD,2,5,45.5,730", "2024,EE,2,5,30.0,700", "2024,FF,2,5,,", "2024,GG,2,5,70.0,760",
        "2024,HH,2,3,40.0,720", "2023,AA,2,5,55.0,740"], "2025-01")
    land(bronze, "meta_uf", [
        f"ano,sigla_uf,rede,taxa_alfabetizacao,{TARGETS},percentual_participacao",
        *[f"2024,{uf},Pública,50,60,{later},90" for uf in ("AA", "BB", "CC", "DD", "EE", "FF")],
        f"2024,GG,Pública,50,,{later},90", f"2023,AA,Pública,50,60,{later},90"], "2025-01")
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    loads = {"uf": ["2025-01"], "meta_uf": ["2025-01"], "aluno": ["manual"]}
    medallion.run(spark, str(bronze), silver, gold, loads=loads)
    state = read_layer(spark, gold, "indicador_uf")

    ranking = reports.state_ranking(state).collect()
    assert [(r.sigla_uf, r.taxa_alfabetizacao_resultado, r.meta_ano, r.gap_meta, r.status_meta)
            for r in ranking] == [
        ("GG", 70.0, None, None, "SEM_META"),
        ("AA", 60.0, 60.0, 0.0, "ATINGIU_META"),
        ("BB", 57.5, 60.0, -2.5, "ABAIXO_META"),
        ("CC", 52.0, 60.0, -8.0, "ABAIXO_META"),
        ("DD", 45.5, 60.0, -14.5, "ABAIXO_META"),
        ("HH", 40.0, None, None, "SEM_META"),
        ("EE", 30.0, 60.0, -30.0, "ABAIXO_META"),
        ("FF", None, 60.0, None, "ABAIXO_META"),
    ]
    assert [tuple(r) for r in reports.status_distribution(state).collect()] == [
        (2023, "Pública", "SEM_META", 1, 55.0, None),
        (2024, "Municipal", "SEM_META", 1, 40.0, None),
        (2024, "Pública", "ABAIXO_META", 5, 46.25, -13.75),
        (2024, "Pública", "ATINGIU_META", 1, 60.0, 0.0),
        (2024, "Pública", "SEM_META", 1, 70.0, None),
    ]
    assert [tuple(r) for r in reports.gap_bands(state).collect()] == [
        (2024, "Municipal", "Mais de 20 p.p. abaixo", 1, 40.0, None),
        (2024, "Pública", "Mais de 20 p.p. abaixo", 3, 50.0, -30.0),
        (2024, "Pública", "Entre 10 e 20 p.p. abaixo", 1, 45.5, -14.5),
        (2024, "Pública", "Entre 5 e 10 p.p. abaixo", 1, 52.0, -8.0),
        (2024, "Pública", "Até 5 p.p. abaixo", 1, 57.5, -2.5),
        (2024, "Pública", "Atingiu ou superou", 1, 60.0, 0.0),
    ]


@pytest.mark.parametrize("infer", [False, True])
def test_loads_are_read_by_their_own_headers(spark, tmp_path, infer):
    city = ENTITIES["municipio"]
    land(tmp_path, "municipio", ["ano,id_municipio,serie,rede,taxa_alfabetizacao", "2024,1,2,3,50.5"], "2024-01")
    land(tmp_path, "municipio", ["id_municipio,ano,serie,rede,taxa_alfabetizacao,media_portugues",
                                 "2,2025,2,3,60.5,745.5"], "2025-01")

    def read(loads=None):
        df = read_entity(spark, str(tmp_path), city, loads=loads, infer=infer)
        return df, {r.id_municipio: r.asDict() for r in df.collect()}

    old, rows = read(["2024-01"])
    assert rows[1]["taxa_alfabetizacao"] == 50.5 and set(rows) == {1}
    assert "media_portugues" not in old.columns
    assert all("2024-01" in f for f in old.inputFiles())
    new, rows = read(["2025-01"])
    assert (rows[2]["ano"], rows[2]["media_portugues"], rows[2]["dt_carga"]) == (2025, 745.5, "2025-01")
    assert all("2025-01" in f for f in new.inputFiles())
    _, rows = read()
    assert rows[1]["media_portugues"] is None and rows[2]["media_portugues"] == 745.5
    assert (rows[1]["ano"], rows[2]["ano"]) == (2024, 2025)
    with pytest.raises(FileNotFoundError, match="2026"):
        read(["2026"])


def test_a_header_that_differs_within_a_load_is_refused(spark, tmp_path):
    land(tmp_path, "municipio", ["ano,id_municipio", "2024,1"], "x")
    (tmp_path / "municipio/dt_carga=x/other.csv").write_text("id_municipio,ano\n1,2024\n")
    with pytest.raises(Exception, match="header|CSV"):
        read_entity(spark, str(tmp_path), ENTITIES["municipio"]).collect()


def test_locations_may_hold_quotes(spark, tmp_path):
    from regua.sinks import catalog

    where = tmp_path / "it's"
    write_partitioned(spark.createDataFrame([(2024, "v")], "ano int, v string"), str(where / "t"))
    catalog.create_database(spark, "regua_quote", str(where))
    catalog.create_external_table(spark, "regua_quote.t", {"v": "string"}, str(where / "t"))
    catalog.repair_partitions(spark, "regua_quote.t")
    assert spark.table("regua_quote.t").count() == 1
    spark.sql("DROP DATABASE regua_quote CASCADE")
