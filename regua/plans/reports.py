"""The twelve analytical questions over the analytical tables.

Rankings end with a total tie-break so that a limit always keeps the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from regua.functions.bands import distance_band, situation_band
from regua.functions.numeric import safe_round
from regua.functions.ordering import ascending, descending
from regua.operators.latest import keep_latest
from regua.operators.ranking import best_and_worst, keep_extremes, top_k
from regua.operators.targets import BELOW
from regua.schemas import CUT_SCORE

CITY = "id_municipio"
STATE = "sigla_uf"
RESULT = "taxa_alfabetizacao_resultado"

# The municipality followed over time, and the ranking labels.
FOLLOWED_CITY = 3550308
BEST, WORST = "TOP_10_MELHORES", "TOP_10_PIORES"

_CITY_TIES = (CITY, "rede", "serie", "ano")
_CITY_VIEW = ("ano", CITY, "rede", RESULT, "meta_ano", "gap_meta", "status_meta")


def _mean(column: str) -> Column:
    return safe_round(F.avg(column), 2)


def below_target_latest(city: DataFrame, k: int = 50) -> DataFrame:
    """Municipalities below target in the latest year, widest gap first."""
    below = keep_latest(city).where(F.col("status_meta") == BELOW)
    return top_k(below, ascending("gap_meta"), _CITY_TIES, k).select(*_CITY_VIEW)


def entity_history(city: DataFrame, entity_id: int = FOLLOWED_CITY) -> DataFrame:
    """One municipality over the years.

    The id may be stored as number or text. The value takes the column's type,
    not the other way round, so that the comparison reaches the file scan.
    """
    chosen = city.where(F.col(CITY) == F.lit(entity_id).cast(city.schema[CITY].dataType))
    return chosen.orderBy(*ascending("ano", "rede", "serie")).select(*_CITY_VIEW)


def state_ranking(state: DataFrame) -> DataFrame:
    """All states and networks of the latest year, best result first."""
    ties = ascending(STATE, "rede", "serie")
    return (
        keep_latest(state)
        .orderBy(*descending(RESULT), *ties)
        .select(
            "ano",
            STATE,
            "rede",
            RESULT,
            "media_portugues",
            "meta_ano",
            "gap_meta",
            "status_meta",
        )
    )


def lowest_micro_rate(micro: DataFrame, k: int = 100, cut: int = CUT_SCORE) -> DataFrame:
    """Lowest recomputed rates of the latest year."""
    computed = f"taxa_alfabetizacao_calculada_{cut}"
    ties = (CITY, "rede", STATE, "nome_municipio")
    return top_k(keep_latest(micro), ascending(computed), ties, k).select(
        "ano",
        STATE,
        CITY,
        "nome_municipio",
        "rede",
        "qtd_alunos",
        "media_proficiencia_lp",
        "taxa_alfabetizacao_microdados",
        computed,
    )


def largest_gaps(city: DataFrame, k: int = 20) -> DataFrame:
    """Widest gaps below target over all years."""
    below = city.where(F.col("status_meta") == BELOW)
    return top_k(below, ascending("gap_meta"), _CITY_TIES, k).select(*_CITY_VIEW)


def mean_by_network(city: DataFrame) -> DataFrame:
    means = city.groupBy("ano", "rede").agg(
        _mean(RESULT).alias("media_taxa_alfabetizacao"),
        F.count(F.lit(1)).alias("qtd_registros"),
    )
    return means.orderBy(*ascending("ano", "rede"))


def national_situation(national: DataFrame) -> DataFrame:
    """National results with a four-step reading of the gap."""
    return national.select(
        "ano",
        "rede",
        RESULT,
        "meta_ano",
        "gap_meta",
        "status_meta",
        situation_band(F.col("gap_meta")).alias("faixa_situacao"),
    ).orderBy(*ascending("ano", "rede"))


def national_summary(national: DataFrame) -> DataFrame:
    summary = national.groupBy("ano").agg(
        _mean(RESULT).alias("media_resultado_brasil"),
        _mean("meta_ano").alias("media_meta_brasil"),
        _mean("gap_meta").alias("gap_medio_brasil"),
        F.count(F.lit(1)).alias("qtd_redes"),
    )
    return summary.orderBy(*ascending("ano"))


def _distribution(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy("ano", "rede", by).agg(
        F.count(F.lit(1)).alias("qtd_municipios"),
        _mean(RESULT).alias("media_resultado"),
        _mean("gap_meta").alias("gap_medio"),
    )


def status_distribution(city: DataFrame) -> DataFrame:
    """Rows, mean result and mean gap per year, network and status."""
    return _distribution(city, "status_meta").orderBy(*ascending("ano", "rede", "status_meta"))


def gap_bands(city: DataFrame) -> DataFrame:
    """The latest year by distance from the target."""
    banded = keep_latest(city).withColumn("faixa_gap", distance_band(F.col("gap_meta")))
    return _distribution(banded, "faixa_gap").orderBy(
        *ascending("ano", "rede", "gap_medio", "faixa_gap")
    )


def official_vs_micro(
    city: DataFrame, micro: DataFrame, k: int = 50, cut: int = CUT_SCORE
) -> DataFrame:
    """Largest differences between the official and the recomputed rate.

    Years are deliberately not matched: unit records may be from another year,
    so a latest result meets every year of its municipality and network. Only
    the extremes of either side of a key can win; joining just those bounds the
    pairs of a key by a constant, however many rows share it.
    """
    computed = f"taxa_alfabetizacao_calculada_{cut}"
    keys = [CITY, "rede"]
    official_ties = ["serie", RESULT]
    micro_ties = ["_micro_ano", STATE, "nome_municipio"]
    if city.schema[CITY].dataType != micro.schema[CITY].dataType:
        # One side stores the id as text: compare as text.
        city, micro = (df.withColumn(CITY, F.col(CITY).cast("string")) for df in (city, micro))
    official = keep_latest(city).select("ano", *keys, "serie", RESULT)
    recomputed = micro.select(
        *keys, STATE, "nome_municipio", F.col("ano").alias("_micro_ano"), computed
    )
    pairs = keep_extremes(official, keys, RESULT, official_ties, k).join(
        keep_extremes(recomputed, keys, computed, micro_ties, k), on=keys
    )
    difference = F.col(RESULT) - F.col(computed)
    ties = [*keys, *official_ties, *micro_ties]
    return top_k(pairs, descending(F.abs(difference)), ties, k).select(
        "ano",
        CITY,
        "nome_municipio",
        "rede",
        F.col(RESULT).alias("taxa_oficial"),
        F.col(computed).alias("taxa_calculada_microdados"),
        safe_round(difference, 2).alias("diferenca_oficial_vs_microdados"),
    )


def best_worst(city: DataFrame, k: int = 10) -> DataFrame:
    """Best and worst results of the latest year; a row in both is among the best."""
    latest = keep_latest(city).select(*_CITY_VIEW, "serie")
    ranked = best_and_worst(latest, RESULT, _CITY_TIES, k, (BEST, WORST))
    ties = ascending(*_CITY_TIES)
    return ranked.orderBy(*ascending("tipo_ranking"), *descending(RESULT), *ties).drop("serie")
