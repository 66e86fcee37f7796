import pytest

from regua.operators import quality
from regua.operators.quality import QualityError, enforce


def scored(spark, wrong, total, missing=0):
    """``total`` pupils of whom ``wrong`` have a flag that contradicts the score."""
    rows = [(2024, f"p{i}", 800.0, 0 if i < wrong else 1, 1, "Municipal") for i in range(total)]
    rows += [(2024, f"m{i}", None, 1, 1, "Municipal") for i in range(missing)]
    return spark.createDataFrame(
        rows,
        "ano int, id_aluno string, proficiencia_lp double, in_alfabetizado int, "
        "id_municipio int, rede_descricao string",
    )


def only(report):
    rows = report.collect()
    assert len(rows) == 1
    return rows[0]


@pytest.mark.parametrize(
    "wrong, total, severity",
    [(0, 100, "ok"), (1, 100, "warn"), (2, 100, "fail"), (7, 700, "warn"), (0, 0, "ok")],
)
def test_cut_agreement_tolerates_one_percent(spark, wrong, total, severity):
    row = only(quality.check_cut_agreement(scored(spark, wrong, total), "aluno"))
    assert (row.violations, row.total, row.severity) == (wrong, total, severity)


def test_cut_agreement_total_includes_missing_scores(spark):
    row = only(quality.check_cut_agreement(scored(spark, 2, 100, missing=100), "aluno"))
    assert (row.total, row.pct, row.severity) == (200, 1.0, "warn")


def test_cut_agreement_ignores_missing_flags(spark):
    df = spark.createDataFrame(
        [(800.0, None), (None, 0), (700.0, 1), (743.0, 0), (743.0, 1), (742.0, 0)],
        "proficiencia_lp double, in_alfabetizado int",
    )
    assert only(quality.check_cut_agreement(df, "aluno")).violations == 2


def test_range_is_closed_and_accepts_missing(spark):
    df = spark.createDataFrame(
        [(100.0, 0.0, -5.0), (100.01, None, 500.0), (None, -0.01, 1.0)],
        "taxa_a double, meta_b double, proporcao_c double",
    )
    rows = {r["column"]: (r.violations, r.severity) for r in quality.check_range(df, "t").collect()}
    assert rows == {"taxa_a": (1, "fail"), "meta_b": (1, "fail")}


def test_range_without_percentages_is_empty(spark):
    assert quality.check_range(spark.range(3).toDF("x"), "t").count() == 0


def test_duplicates(spark):
    df = spark.createDataFrame(
        [(2024, "a"), (2024, "a"), (2023, "a"), (2024, None), (2024, "b")],
        "ano int, id_aluno string",
    )
    row = only(quality.check_duplicates(df, "aluno"))
    assert (row.violations, row.total, row.severity) == (1, 4, "fail")
    assert [tuple(r) for r in quality.duplicate_keys(df, ["ano", "id_aluno"]).collect()] == [
        (2024, "a", 2)
    ]


def cities(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id_municipio int")


@pytest.mark.parametrize(
    "ids, known, violations, total, severity",
    [
        ([1, 1, 2, None], [1, 2, 3], 0, 2, "ok"),
        (range(100), range(1, 100), 1, 100, "warn"),
        (range(100), range(2, 100), 2, 100, "fail"),
        ([None], [1], 0, 0, "fail"),
        ([], [1], 0, 0, "fail"),
    ],
)
def test_referential(spark, ids, known, violations, total, severity):
    row = only(quality.check_referential(cities(spark, ids), cities(spark, known), "aluno"))
    assert (row.violations, row.total, row.severity) == (violations, total, severity)


def test_orphans(spark):
    found = quality.orphan_keys(cities(spark, [1, 2, 2, None]), cities(spark, [1]), "id_municipio")
    assert [r.id_municipio for r in found.collect()] == [2]


def whole_report(spark, micro, rate=50.0, repeats=1):
    results = spark.createDataFrame([(1, rate)], "id_municipio int, taxa_alfabetizacao double")
    targets = spark.createDataFrame(
        [(2024, 1, "Municipal", 60.0)] * repeats,
        "ano int, id_municipio int, rede_descricao string, meta_alfabetizacao_2024 double",
    )
    return quality.quality_report(micro, results, targets)


def test_clean_tables_pass(spark):
    report = whole_report(spark, scored(spark, 1, 100))
    assert {r["check"]: r.severity for r in report.collect()} == {
        "duplicate_key": "ok", "range_0_100": "ok", "negative": "ok", "cut_agreement": "warn",
        "not_null": "ok", "referential": "ok", "target_key": "ok",
    }
    enforce(report)


def test_repeated_target_keys_only_warn(spark):
    enforce(whole_report(spark, scored(spark, 0, 10), repeats=2))


def test_first_failed_gate_is_named(spark):
    twice = scored(spark, 0, 2).unionAll(scored(spark, 0, 2))
    with pytest.raises(QualityError, match="duplicate_key on aluno.ano,id_aluno: 2 of 2"):
        enforce(whole_report(spark, twice, rate=101.0))


def test_negative_score_and_missing_network(spark):
    df = spark.createDataFrame(
        [(-1.0, None), (None, "x")], "proficiencia_lp double, rede_descricao string"
    )
    assert only(quality.check_negative(df, "aluno")).violations == 1
    assert only(quality.check_not_null(df, "aluno")).severity == "fail"
