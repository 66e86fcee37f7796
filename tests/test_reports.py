import random

import pytest
from pyspark.sql import functions as F

from regua.operators.ranking import best_and_worst, keep_extremes
from regua.plans import reports
from regua.plans.reports import BEST, WORST

CITY_SCHEMA = (
    "ano int, id_municipio int, serie int, rede string, taxa_alfabetizacao_resultado double, "
    "meta_ano double, gap_meta double, status_meta string"
)
MICRO_SCHEMA = (
    "ano int, sigla_uf string, id_municipio int, nome_municipio string, rede string, "
    "qtd_alunos bigint, media_proficiencia_lp double, taxa_alfabetizacao_microdados double, "
    "taxa_alfabetizacao_calculada_743 double"
)


def city(spark, rows):
    """From (ano, id, rede, result, gap); the status follows from the gap."""
    full = []
    for ano, entity, rede, result, gap in rows:
        status = "SEM_META" if gap is None else "ATINGIU_META" if gap >= 0 else "ABAIXO_META"
        target = None if gap is None or result is None else round(result - gap, 2)
        full.append((ano, entity, 2, rede, result, target, gap, status))
    return spark.createDataFrame(full, CITY_SCHEMA)


def micro(spark, rows):
    """From (ano, id, rede, computed rate)."""
    return spark.createDataFrame(
        [(a, "SP", i, f"C{i}", r, 10, 740.0, 50.0, c) for a, i, r, c in rows], MICRO_SCHEMA
    )


def last(number):
    """Sort key that puts None at the end."""
    return (number is None, 0 if number is None else number)


def test_below_target_takes_the_latest_year_and_orders_by_gap(spark):
    df = city(
        spark,
        [(2023, 1, "M", 10.0, -50.0), (2024, 1, "M", 50.0, -5.0), (2024, 2, "M", 40.0, -9.0),
         (2024, 3, "M", 70.0, 3.0), (2024, 4, "M", None, None)],
    )
    rows = reports.below_target_latest(df).collect()
    assert [(r.id_municipio, r.gap_meta) for r in rows] == [(2, -9.0), (1, -5.0)]
    assert [r.id_municipio for r in reports.below_target_latest(df, 1).collect()] == [2]
    assert [r.ano for r in reports.largest_gaps(df, 1).collect()] == [2023]


def test_history_is_ordered(spark):
    df = city(
        spark,
        [(2024, 3550308, "P", 1.0, None), (2023, 3550308, "P", 2.0, None),
         (2024, 3550308, "M", 3.0, None), (2024, 9, "M", 4.0, None)],
    )
    rows = reports.entity_history(df).collect()
    assert [(r.ano, r.rede) for r in rows] == [(2023, "P"), (2024, "M"), (2024, "P")]


def test_ids_may_be_text_on_either_side(spark):
    text = city(spark, [(2024, 3550308, "M", 60.0, None), (2024, 9, "M", 1.0, None)]).withColumn(
        "id_municipio", F.col("id_municipio").cast("string"))
    assert reports.entity_history(text).count() == 1
    units = micro(spark, [(2024, 3550308, "M", 50.0)])
    row = reports.official_vs_micro(text, units).first()
    assert (row.id_municipio, row.diferenca_oficial_vs_microdados) == ("3550308", 10.0)


def test_state_ranking_puts_missing_results_last(spark):
    rows = [(2024, uf, 2, "Pública", rate, 740.0, None, None, "SEM_META")
            for uf, rate in [("AC", None), ("CE", 85.0), ("SP", 60.0)]]
    state = spark.createDataFrame(
        rows,
        "ano int, sigla_uf string, serie int, rede string, taxa_alfabetizacao_resultado double, "
        "media_portugues double, meta_ano double, gap_meta double, status_meta string",
    )
    assert [r.sigla_uf for r in reports.state_ranking(state).collect()] == ["CE", "SP", "AC"]


def test_lowest_rates_put_missing_last(spark):
    df = micro(spark, [(2024, 1, "M", None), (2024, 2, "M", 9.0), (2024, 3, "M", 5.0),
                       (2023, 4, "M", 0.0)])
    assert [r.id_municipio for r in reports.lowest_micro_rate(df).collect()] == [3, 2, 1]


def test_means_round_half_up_and_skip_missing(spark):
    df = city(spark, [(2024, 1, "M", 50.0, None), (2024, 2, "M", 50.01, None),
                      (2024, 3, "M", None, None)])
    row = reports.mean_by_network(df).first()
    assert (row.media_taxa_alfabetizacao, row.qtd_registros) == (50.01, 3)


def test_distributions(spark):
    df = city(spark, [(2024, 1, "M", 50.0, -5.0), (2024, 2, "M", 40.0, -7.0),
                      (2024, 3, "M", 70.0, 0.0), (2024, 4, "M", 30.0, None),
                      (2023, 5, "M", 30.0, -21.0)])
    status = reports.status_distribution(df).collect()
    assert [tuple(r)[:4] for r in status] == [
        (2023, "M", "ABAIXO_META", 1), (2024, "M", "ABAIXO_META", 2),
        (2024, "M", "ATINGIU_META", 1), (2024, "M", "SEM_META", 1),
    ]
    assert sum(r.qtd_municipios for r in status) == df.count()
    band = reports.gap_bands(df).collect()
    assert [(r.faixa_gap, r.qtd_municipios, r.gap_medio) for r in band] == [
        ("Entre 5 e 10 p.p. abaixo", 1, -7.0), ("Até 5 p.p. abaixo", 1, -5.0),
        ("Atingiu ou superou", 1, 0.0), ("Mais de 20 p.p. abaixo", 1, None),
    ]


def test_comparison_meets_every_year_of_the_unit_records(spark):
    official = city(spark, [(2024, 1, "M", 60.0, None), (2023, 1, "M", 10.0, None)])
    units = micro(spark, [(2023, 1, "M", 50.0), (2025, 1, "M", 75.0), (2025, 1, "P", 0.0)])
    rows = reports.official_vs_micro(official, units).collect()
    assert [(r.ano, r.taxa_calculada_microdados, r.diferenca_oficial_vs_microdados)
            for r in rows] == [(2024, 75.0, -15.0), (2024, 50.0, 10.0)]


@pytest.mark.parametrize("seed, k", [(1, 5), (2, 5), (3, 40), (4, 400)])
def test_comparison_equals_brute_force_with_a_hot_key(spark, seed, k):
    """A third of both sides shares one key, with copies, ties and missing rates."""
    rng = random.Random(seed)

    def rate():
        return None if rng.random() < 0.2 else round(rng.choice([50.0, rng.uniform(0, 100)]), 2)

    def key():
        return 1 if rng.random() < 0.34 else rng.randrange(2, 8)

    official = [(2024, key(), rng.choice("MP"), rate(), None) for _ in range(120)]
    official += official[:20]
    units = [(rng.randrange(2000, 2025), key(), rng.choice("MP"), rate()) for _ in range(300)]
    pairs = []
    for _, entity, rede, taxa, _ in official:
        for ano, other, network, computed in units:
            if (entity, rede) == (other, network):
                missing = taxa is None or computed is None
                gap = None if missing else abs(taxa - computed)
                order = (missing, 0 if missing else -gap, entity, rede, last(taxa), ano)
                pairs.append((order, (entity, rede, taxa, computed)))
    pairs.sort(key=lambda pair: pair[0])

    found = reports.official_vs_micro(
        city(spark, official).repartition(7), micro(spark, units).repartition(5), k
    ).collect()
    got = [(r.id_municipio, r.rede, r.taxa_oficial, r.taxa_calculada_microdados) for r in found]
    distances = [(None if None in row[2:] else abs(row[2] - row[3])) for row in got]
    best = [(None if None in row[2:] else abs(row[2] - row[3])) for _, row in pairs[:k]]
    assert distances == best
    # Equal orders may swap only rows that differ in nothing but the missing side.
    assert [row[:3] for row in got] == [row[:3] for _, row in pairs[:k]]


def test_extremes_bound_every_key(spark):
    df = spark.range(30000).selectExpr(
        "cast(id % 3 as int) as chave", "cast(id as double) as valor", "id as desempate"
    )
    kept = keep_extremes(df, ["chave"], "valor", ["desempate"], 4)
    counts = {r.chave: r["count"] for r in kept.groupBy("chave").count().collect()}
    assert counts == {0: 8, 1: 8, 2: 8}
    assert kept.agg({"valor": "max"}).first()[0] == 29999.0


def test_extremes_are_cut_below_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as chave", "cast(id as double) as valor", "id as d")
    plan = keep_extremes(df, ["chave"], "valor", ["d"], 4)._jdf.queryExecution().toString()
    tree = plan[plan.index("== Physical Plan"):]
    # Each of the three branches has one below its shuffle and one above.
    assert tree.count("WindowGroupLimit") >= 6
    assert "Partial" in tree and "Final" in tree


def test_copies_are_kept_as_often_as_they_count(spark):
    df = spark.createDataFrame([(1, 5.0, 1)] * 7 + [(1, 6.0, 2)], "chave int, valor double, d int")
    kept = keep_extremes(df, ["chave"], "valor", ["d"], 3).collect()
    assert sorted(tuple(r) for r in kept) == [(1, 5.0, 1)] * 3 + [(1, 6.0, 2)]


def numbered(rows, k):
    """What numbering the whole table from both ends would give."""
    ties = lambda row: (row[1], row[2])
    by_best = sorted(range(len(rows)), key=lambda i: (
        rows[i][3] is None, 0 if rows[i][3] is None else -rows[i][3], ties(rows[i]), i))
    by_worst = sorted(range(len(rows)), key=lambda i: (last(rows[i][3]), ties(rows[i]), i))
    top = set(by_best[:k])
    bottom = set(by_worst[:k]) - top
    return sorted(
        [(BEST, rows[i][1], str(rows[i][3])) for i in top]
        + [(WORST, rows[i][1], str(rows[i][3])) for i in bottom]
    )


@pytest.mark.parametrize("size", [0, 1, 7, 15, 20, 60])
@pytest.mark.parametrize("copies", [1, 3])
def test_best_and_worst_equal_numbering(spark, size, copies):
    rng = random.Random(size)
    rows = [(2024, i, "M", rng.choice([None, 50.0, 60.5, float(rng.randrange(100))]), None)
            for i in range(size)] * copies
    found = reports.best_worst(city(spark, rows)).collect()
    got = sorted((r.tipo_ranking, r.id_municipio, str(r.taxa_alfabetizacao_resultado))
                 for r in found)
    assert got == numbered(rows, 10)


def test_fifteen_rows_overlap_as_best(spark):
    rows = [(2024, i, "M", float(i), None) for i in range(15)]
    found = reports.best_worst(city(spark, rows)).collect()
    labels = [r.tipo_ranking for r in found]
    assert labels == [BEST] * 10 + [WORST] * 5
    assert [r.id_municipio for r in found] == list(range(14, -1, -1))


def test_best_and_worst_keeps_columns(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 3.0)], "k int, v double")
    ranked = best_and_worst(df, "v", ["k"], 1, ("alto", "baixo"), "lado")
    assert {(r.lado, r.k) for r in ranked.collect()} == {("alto", 2), ("baixo", 1)}
