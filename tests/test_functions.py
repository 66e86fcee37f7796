import math
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from regua.functions import bands
from regua.functions.labels import NETWORK_LABELS, label_for
from regua.functions.numeric import percentage, rate, safe_round, text_to_double, text_to_int


def values(spark, rows, schema, expression):
    return [row[0] for row in spark.createDataFrame(rows, schema).select(expression).collect()]


def test_safe_round_works_on_the_decimal_value(spark):
    given = [(1.005,), (2.675,), (-1.005,), (0.125,), (None,), (64.0,)]
    assert values(spark, given, "x double", safe_round(F.col("x"), 2)) == [
        1.01, 2.68, -1.01, 0.13, None, 64.0,
    ]


@pytest.mark.parametrize("huge", [1e30, -1e27, float("inf"), None])
def test_safe_round_keeps_what_no_decimal_holds(spark, huge):
    assert values(spark, [(huge,)], "x double", safe_round(F.col("x"), 2)) == [huge]


def test_safe_round_keeps_nan(spark):
    found = values(spark, [(float("nan"),)], "x double", safe_round(F.col("x"), 2))
    assert math.isnan(found[0])


def test_safe_round_rounds_once(spark):
    given = [(12.3449999999,), (12.345,), (99.9949999975,)]
    assert values(spark, given, "x double", safe_round(F.col("x"), 2)) == [12.34, 12.35, 99.99]


def test_percentage_is_exact(spark):
    """Against whole-number arithmetic, beyond a million rows too."""
    rng = random.Random(7)
    rows = [(1_999_899, 1_999_999), (0, 1), (1, 1), (1, 800), (3, 0), (0, 0)]
    rows += [(rng.randrange(n + 1), n) for n in (rng.randrange(1, 5000) for _ in range(1500))]
    rows += [(rng.randrange(n + 1), n) for n in (rng.randrange(10**6, 10**10) for _ in range(1500))]
    for digits in (2, 4):
        expected = [
            None if not n else float(
                (Decimal(k) * 100 / Decimal(n)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)
            )
            for k, n in rows
        ]
        column = percentage(F.col("k"), F.col("n"), digits)
        assert values(spark, rows, "k bigint, n bigint", column) == expected
    assert values(spark, rows[:1], "k bigint, n bigint", percentage(F.col("k"), F.col("n"))) == [99.99]


def test_text_to_int(spark):
    texts = ["3", " 3 ", "3.0", "3.", "-2.9", "+4", "Pública", "", "3d", "1e3", "9" * 11, None]
    assert values(spark, [(t,) for t in texts], "s string", text_to_int(F.col("s"))) == [
        3, 3, 3, 3, -2, 4, None, None, None, None, None, None,
    ]


def test_decimal_mark_is_an_option(spark):
    rows = [("743,5",), ("743.5",), (None,)]
    column = F.col("s")
    assert values(spark, rows, "s string", text_to_double(column)) == [None, 743.5, None]
    assert values(spark, rows, "s string", text_to_double(column, ",")) == [743.5, 743.5, None]


def test_rate_leaves_missing_flags_out(spark):
    df = spark.createDataFrame([(1,), (0,), (1,), (None,)], "flag int")
    assert df.agg(rate(F.col("flag"))).first()[0] == 66.67


def test_unknown_code_keeps_its_text(spark):
    rows = [(0, "0"), (5, "5"), (9, "9"), (None, "Pública"), (None, None)]
    label = label_for(F.col("code"), F.col("text"), NETWORK_LABELS)
    assert values(spark, rows, "code int, text string", label) == [
        "Total", "Pública", "9", "Pública", None,
    ]


def test_distance_bands_have_no_reachable_hole(spark):
    reached, (near, middle, far), worst = (
        bands.DISTANCE_REACHED,
        [name for _, _, name in bands.DISTANCE_BANDS],
        bands.DISTANCE_WORST,
    )
    expected = {
        0.0: reached, 3.5: reached, -0.01: near, -5.0: near, -5.01: middle, -10.0: middle,
        -10.01: far, -20.0: far, -20.01: worst, None: worst,
    }
    rows = [(gap,) for gap in expected]
    assert values(spark, rows, "g double", bands.distance_band(F.col("g"))) == list(
        expected.values()
    )
    every = spark.range(-3000, 1).select((F.col("id") / 100).alias("g"))
    labels = every.groupBy(bands.distance_band(F.col("g")).alias("b")).count().collect()
    assert {row["b"]: row["count"] for row in labels} == {
        reached: 1, near: 500, middle: 500, far: 1000, worst: 1000,
    }


def test_situation_bands(spark):
    rows = [(0.0,), (-5.0,), (-5.01,), (-15.0,), (-15.01,), (None,)]
    assert values(spark, rows, "g double", bands.situation_band(F.col("g"))) == [
        "Acima ou dentro da meta", "Pouco abaixo da meta", "Atenção", "Atenção", "Crítico",
        "Crítico",
    ]


def test_rate_of_no_flags_is_missing(spark):
    assert spark.createDataFrame([(None,)], "flag int").agg(rate(F.col("flag"))).first()[0] is None
