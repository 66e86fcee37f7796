from pathlib import Path

import pytest
from pyspark.sql import functions as F

from regua.operators import conform
from regua.operators.quality import cast_losses
from regua.schemas import ENTITIES, MICRODATA_NAMES
from regua.sources.delimited import read_entity, read_text_columns


def write(folder: Path, entity, load, lines, encoding=None):
    target = folder / entity.name / f"dt_carga={load}"
    target.mkdir(parents=True)
    text = "\n".join(lines) + "\n"
    (target / f"{entity.name}.csv").write_text(text, encoding=encoding or entity.encoding)


def test_network_code_and_label(spark):
    texts = ["5", " 3 ", "Pública", "9", None, "3.0"]
    rows = conform.add_network(spark.createDataFrame([(t,) for t in texts], "rede string"))
    assert [(r.rede, r.rede_codigo, r.rede_descricao) for r in rows.collect()] == [
        ("5", 5, "Pública"),
        ("3", 3, "Municipal"),
        ("Pública", None, "Pública"),
        ("9", 9, "9"),
        (None, None, None),
        ("3.0", 3, "Municipal"),
    ]


def test_no_network_column_no_change(spark):
    df = spark.createDataFrame([(1,)], "ano int")
    assert conform.add_network(df).columns == ["ano"]


def test_integer_network_is_accepted(spark):
    row = conform.add_network(spark.createDataFrame([(2,)], "rede int")).first()
    assert (row.rede, row.rede_codigo, row.rede_descricao) == ("2", 2, "Estadual")


def test_cut_score_counts_missing_as_below(spark):
    df = spark.createDataFrame([(743.0,), (742.999,), (None,)], "proficiencia_lp double")
    flagged = conform.flag_cut_score(df)
    assert [r.fl_alfabetizado_calculado for r in flagged.collect()] == [1, 0, 0]
    assert dict(flagged.dtypes)["fl_alfabetizado_calculado"] == "int"


def test_prefix_and_key_casts_touch_only_their_columns(spark):
    df = spark.createDataFrame(
        [("2024", " RS ", "44.67", "x", "60", "nome", "1.5")],
        "ano string, sigla_uf string, taxa_a string, meta_b string, percentual_c string, "
        "nome string, proporcao_d string",
    )
    typed = conform.cast_keys(conform.cast_by_prefix(df))
    assert dict(typed.dtypes) == {
        "ano": "int", "sigla_uf": "string", "taxa_a": "double", "meta_b": "double",
        "percentual_c": "double", "nome": "string", "proporcao_d": "double",
    }
    assert typed.first() == (2024, "RS", 44.67, None, 60.0, "nome", 1.5)


def test_columns_are_found_by_header_not_position(spark, tmp_path):
    city = ENTITIES["municipio"]
    write(
        tmp_path, city, "manual",
        ["extra,rede,id_municipio,ano,media_portugues,taxa_alfabetizacao,serie",
         "e1,3,3550308,2024,740.25,55.5,2", "e2,5,3304557.0,2023,,,2"],
    )
    rows = read_entity(spark, str(tmp_path), city).orderBy("extra").collect()
    assert [(r.ano, r.id_municipio, r.rede, r.taxa_alfabetizacao, r.extra) for r in rows] == [
        (2024, 3550308, "3", 55.5, "e1"), (2023, 3304557, "5", None, "e2"),
    ]


def test_pupil_file_separator_encoding_and_mark(spark, tmp_path):
    pupil = ENTITIES["aluno"]
    header = ";".join(MICRODATA_NAMES)
    write(
        tmp_path, pupil, "manual",
        [header, "2024;35; SP ;000123;2;77;3;3550308;São Paulo;1,5;743,0;1",
         "2024;35;SP;000124;2;77;3;3550308;São Paulo;1,5;;0"],
    )
    raw = read_entity(spark, str(tmp_path), pupil, decimal_mark=",")
    rows = conform.conform_microdata(raw, decimal_mark=",").orderBy("id_aluno").collect()
    assert rows[0].nome_municipio == "São Paulo"
    assert rows[0].id_aluno == "000123" and rows[0].sigla_uf == "SP"
    assert [(r.proficiencia_lp, r.fl_alfabetizado_calculado) for r in rows] == [
        (743.0, 1), (None, 0),
    ]
    options = {"header": True, "sep": ";", "encoding": "ISO-8859-1"}
    text = read_text_columns(spark, f"{tmp_path}/aluno", options)
    lost = {r["column"]: r["violations"] for r in cast_losses(text, pupil.types, "aluno").collect()}
    assert lost["VL_PROFICIENCIA_LP"] == 1 and lost["VL_PESO_ALUNO_LP"] == 2
    assert lost["CO_MUNICIPIO"] == 0
    found = cast_losses(text, pupil.types, "aluno", ",").agg(F.sum("violations")).first()[0]
    assert found == 0


def test_loads_are_read_together_or_by_name(spark, tmp_path):
    country = ENTITIES["meta_brasil"]
    for load, rate in (("007", "55.9"), ("20240201", "59.2")):
        write(tmp_path, country, load, ["ano,rede,taxa_alfabetizacao", f"2024,Pública,{rate}"])
    both = read_entity(spark, str(tmp_path), country)
    assert sorted(r.dt_carga for r in both.collect()) == ["007", "20240201"]
    one = read_entity(spark, str(tmp_path), country, loads=["007"])
    assert [r.taxa_alfabetizacao for r in one.collect()] == [55.9]


def test_a_load_with_another_header_is_read_by_its_own(spark, tmp_path):
    country = ENTITIES["meta_brasil"]
    write(tmp_path, country, "a", ["ano,rede,taxa_alfabetizacao", "2024,Pública,59.2"])
    write(tmp_path, country, "b", ["rede,ano,taxa_alfabetizacao", "Pública,2024,59.2"])
    rows = read_entity(spark, str(tmp_path), country).collect()
    assert {(r.dt_carga, r.ano, r.rede, r.taxa_alfabetizacao) for r in rows} == {
        ("a", 2024, "Pública", 59.2), ("b", 2024, "Pública", 59.2)}


def test_inference_is_opt_in(spark, tmp_path):
    country = ENTITIES["meta_brasil"]
    write(tmp_path, country, "manual", ["ano,rede,meta_alfabetizacao_2030", "2024,5,80"])
    declared = dict(read_entity(spark, str(tmp_path), country).dtypes)
    inferred = dict(read_entity(spark, str(tmp_path), country, infer=True).dtypes)
    assert (declared["rede"], declared["meta_alfabetizacao_2030"]) == ("string", "double")
    assert (inferred["rede"], inferred["meta_alfabetizacao_2030"]) == ("int", "int")
