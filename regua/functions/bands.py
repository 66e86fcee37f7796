"""Bands over a gap that is already rounded to two decimals.

Both scales leave holes between their closed intervals (-5.00 to -5.01). They
are harmless only because no rounded gap can fall into one. A NULL gap matches
no interval and therefore gets the worst label.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

Band = tuple[float, float, str]

# Labels and limits of the two scales.
SITUATION_REACHED = "Acima ou dentro da meta"
SITUATION_BANDS: Sequence[Band] = (
    (-5, -0.01, "Pouco abaixo da meta"),
    (-15, -5.01, "Atenção"),
)
SITUATION_WORST = "Crítico"

DISTANCE_REACHED = "Atingiu ou superou"
DISTANCE_BANDS: Sequence[Band] = (
    (-5, -0.01, "Até 5 p.p. abaixo"),
    (-10, -5.01, "Entre 5 e 10 p.p. abaixo"),
    (-20, -10.01, "Entre 10 e 20 p.p. abaixo"),
)
DISTANCE_WORST = "Mais de 20 p.p. abaixo"


def _band(gap: Column, reached: str, bands: Sequence[Band], worst: str) -> Column:
    label = F.when(gap >= 0, reached)
    for low, high, name in bands:
        label = label.when(gap.between(low, high), name)
    return label.otherwise(worst)


def situation_band(gap: Column) -> Column:
    return _band(gap, SITUATION_REACHED, SITUATION_BANDS, SITUATION_WORST)


def distance_band(gap: Column) -> Column:
    return _band(gap, DISTANCE_REACHED, DISTANCE_BANDS, DISTANCE_WORST)
