"""Rates recomputed from unit records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from regua.functions.numeric import rate, safe_round
from regua.schemas import CUT_SCORE

# The key of the stored rollup, as the four names it gives to its measures below.
ROLLUP_KEYS = ("ano", "sigla_uf", "id_municipio", "nome_municipio", "rede_descricao")


def rate_rollup(
    micro: DataFrame,
    keys: Sequence[str] = ROLLUP_KEYS,
    *,
    cut: int = CUT_SCORE,
    ids_unique: bool = False,
) -> DataFrame:
    """Pupils, mean score, official rate and cut-score rate per key.

    The two rates differ in their denominators: a missing official flag leaves
    the first, a missing score stays in the second as "below the cut".

    An exact distinct count has to shuffle every unit record once. When the
    duplicate gate has already shown ``(ano, id_aluno)`` to be unique, pass
    ``ids_unique`` and plain counting gives the same number from map-side sums
    alone. That needs ``ano`` among the keys.
    """
    if ids_unique and "ano" not in keys:
        raise ValueError("ids are only unique within a year")
    pupils = F.count("id_aluno") if ids_unique else F.countDistinct("id_aluno")
    return micro.groupBy(*keys).agg(
        pupils.alias("qtd_alunos"),
        safe_round(F.avg("proficiencia_lp"), 4).alias("media_proficiencia_lp"),
        rate(F.col("in_alfabetizado")).alias("taxa_alfabetizacao_microdados"),
        rate(F.col("fl_alfabetizado_calculado")).alias(f"taxa_alfabetizacao_calculada_{cut}"),
    )
