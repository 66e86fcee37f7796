from pyspark.sql import functions as F

from regua.operators.conform import conform_aggregate
from regua.operators.rollup import rate_rollup
from regua.operators.targets import attach_targets, compare_with_target
from regua.plans import reports
from regua.plans.gold import gold_indicator, gold_national
from regua.schemas import ENTITIES, GOLD_TABLES, TARGET_YEARS

import pytest

# Invented: a year with a result beyond its target, one just short of it, one without any target.
NATIONAL = [
    (2025, "Pública", 51.5, 40.0, 49.5, 52.0, 54.0, 56.0, 58.0, 60.0, 81.0),
    (2024, "Pública", 44.1, 44.8, 47.25, 49.75, 52.25, 54.75, 57.25, 60.0, 79.5),
    (2023, "Pública", 40.3, 44.8, 47.25, 49.75, 52.25, 54.75, 57.25, 60.0, 78.0),
]


@pytest.fixture(scope="module")
def national(spark):
    raw = spark.createDataFrame(NATIONAL, ENTITIES["meta_brasil"].schema())
    return gold_national(conform_aggregate(raw))


def states(spark, results, targets):
    """Gold rows from (ano, uf, rede, result) and (ano, uf, rede, target of 2024)."""
    result = spark.createDataFrame(
        [(a, u, 2, r, t, 740.0, *[None] * 9) for a, u, r, t in results], ENTITIES["uf"].schema()
    )
    target = spark.createDataFrame(
        [(a, u, r, 50.0, m, *[None] * 6, 90.0) for a, u, r, m in targets],
        ENTITIES["meta_uf"].schema(),
    )
    return gold_indicator(conform_aggregate(result), conform_aggregate(target), "sigla_uf")


def test_national_view(national):
    rows = reports.national_situation(national).collect()
    assert [(r.ano, r.meta_ano, r.gap_meta, r.status_meta, r.faixa_situacao) for r in rows] == [
        (2023, None, None, "SEM_META", "Crítico"),
        (2024, 44.8, -0.7, "ABAIXO_META", "Pouco abaixo da meta"),
        (2025, 49.5, 2.0, "ATINGIU_META", "Acima ou dentro da meta"),
    ]


def test_national_summary(national):
    rows = reports.national_summary(national).collect()
    assert [tuple(r) for r in rows] == [
        (2023, 40.3, None, None, 1), (2024, 44.1, 44.8, -0.7, 1), (2025, 51.5, 49.5, 2.0, 1),
    ]


def test_gold_columns_match_their_declaration(spark, national):
    declared = {**GOLD_TABLES["indicador_brasil"], "ano": "int"}
    assert dict(national.dtypes) == declared
    state = states(spark, [(2024, "CE", "5", 85.31)], [(2024, "CE", "Pública", 80.0)])
    assert dict(state.dtypes) == {**GOLD_TABLES["indicador_uf"], "ano": "int"}


def test_code_meets_text_and_other_networks_have_no_target(spark):
    gold = states(
        spark,
        [(2024, "MG", "5", 72.08), (2024, "MG", "3", 70.0), (2024, "AC", "5", 51.38),
         (2023, "MG", "5", 60.0)],
        [(2024, "MG", "Pública", 63.21), (2023, "MG", "Pública", 63.21),
         (2024, "AC", "Pública", None)],
    )
    found = {(r.ano, r.sigla_uf, r.rede): (r.meta_ano, r.gap_meta, r.status_meta)
             for r in gold.collect()}
    assert found == {
        (2024, "MG", "Pública"): (63.21, 8.87, "ATINGIU_META"),
        (2024, "MG", "Municipal"): (None, None, "SEM_META"),
        (2024, "AC", "Pública"): (None, None, "SEM_META"),
        (2023, "MG", "Pública"): (None, None, "SEM_META"),
    }


def test_target_without_result_counts_as_missed(spark):
    row = states(spark, [(2024, "RR", "5", None)], [(2024, "RR", "Pública", 60.0)]).first()
    assert (row.meta_ano, row.gap_meta, row.status_meta) == (60.0, None, "ABAIXO_META")


def test_gap_of_zero_is_reached(spark):
    row = states(spark, [(2024, "RR", "5", 60.0)], [(2024, "RR", "Pública", 60.0)]).first()
    assert (row.gap_meta, row.status_meta) == (0.0, "ATINGIU_META")


def test_year_beyond_the_targets(spark):
    columns = ", ".join(f"meta_alfabetizacao_{y} double" for y in TARGET_YEARS)
    df = spark.createDataFrame(
        [(2031, 50.0, *[60.0] * 7)], f"ano int, taxa_alfabetizacao_resultado double, {columns}"
    )
    row = compare_with_target(df).first()
    assert (row.meta_ano, row.status_meta) == (None, "SEM_META")


def test_left_join_keeps_results_and_repeats_for_repeated_targets(spark):
    results = [(2024, "CE", "5", 85.0), (2024, "SP", "5", 60.0)]
    once = [(2024, "CE", "Pública", 80.0)]
    assert states(spark, results, once).count() == 2
    assert states(spark, results, once * 3).count() == 4


def test_targets_need_the_same_year(spark):
    row = states(spark, [(2024, "CE", "5", 85.0)], [(2023, "CE", "Pública", 80.0)]).first()
    assert row.status_meta == "SEM_META"


def test_missing_network_never_matches(spark):
    results = spark.createDataFrame([(2024, "CE", None)], "ano int, sigla_uf string, rede string")
    targets = spark.createDataFrame(
        [(2024, "CE", None, 80.0, 90.0)],
        "ano int, sigla_uf string, rede_descricao string, meta_alfabetizacao_2024 double, "
        "percentual_participacao double",
    )
    joined = attach_targets(
        results.withColumn("rede_descricao", F.col("rede")), targets, "sigla_uf", [2024]
    )
    assert joined.count() == 1 and joined.first().meta_alfabetizacao_2024 is None


def pupils(spark):
    rows = [
        (2024, "SP", 1, "A", "Municipal", "p1", 750.0, 1, 1),
        (2024, "SP", 1, "A", "Municipal", "p2", 700.0, 0, 0),
        (2024, "SP", 1, "A", "Municipal", "p3", None, None, 0),
        (2024, "SP", 1, "A", "Estadual", "p4", 743.0, 1, 1),
        (2023, "SP", 1, "A", "Municipal", "p1", None, None, 0),
    ]
    return spark.createDataFrame(
        rows,
        "ano int, sigla_uf string, id_municipio int, nome_municipio string, "
        "rede_descricao string, id_aluno string, proficiencia_lp double, in_alfabetizado int, "
        "fl_alfabetizado_calculado int",
    )


@pytest.mark.parametrize("unique", [False, True])
def test_rollup_keeps_both_denominators(spark, unique):
    rows = rate_rollup(pupils(spark), ids_unique=unique).collect()
    found = {(r.ano, r.rede_descricao): tuple(r)[5:] for r in rows}
    assert found == {
        (2024, "Municipal"): (3, 725.0, 50.0, 33.33),
        (2024, "Estadual"): (1, 743.0, 100.0, 100.0),
        (2023, "Municipal"): (1, None, None, 0.0),
    }


def test_rollup_counts_repeated_pupils_once(spark):
    doubled = pupils(spark).unionAll(pupils(spark))
    rows = rate_rollup(doubled).where("ano = 2024 and rede_descricao = 'Municipal'").collect()
    assert [r.qtd_alunos for r in rows] == [3]


def test_unique_ids_need_the_year(spark):
    with pytest.raises(ValueError):
        rate_rollup(pupils(spark), ["id_municipio"], ids_unique=True)
