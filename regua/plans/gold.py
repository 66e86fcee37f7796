"""Conformed tables to analytical tables."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from regua.operators.rollup import rate_rollup
from regua.operators.targets import attach_targets, compare_with_target
from regua.schemas import (
    CUT_SCORE,
    GOLD_ORDER,
    GOLD_PARTITIONS,
    TARGET_YEARS,
    target_columns,
)
from regua.sinks.files import among, remove_partition, write_partitioned
from regua.sources.tables import read_layer


def gold_micro(micro: DataFrame, *, cut: int = CUT_SCORE, ids_unique: bool = False) -> DataFrame:
    """Unit records by year, state, municipality and network."""
    rolled = rate_rollup(micro, cut=cut, ids_unique=ids_unique)
    return rolled.withColumnRenamed("rede_descricao", "rede")


def gold_indicator(
    results: DataFrame,
    targets: DataFrame,
    entity: str,
    years: Sequence[int] = TARGET_YEARS,
) -> DataFrame:
    """Results of municipalities or states beside their targets."""
    joined = attach_targets(results, targets, entity, years).select(
        "ano",
        entity,
        "serie",
        F.col("rede_descricao").alias("rede"),
        F.col("taxa_alfabetizacao").alias("taxa_alfabetizacao_resultado"),
        "media_portugues",
        *target_columns(years),
        "percentual_participacao",
    )
    return compare_with_target(joined, years)


def gold_national(national: DataFrame, years: Sequence[int] = TARGET_YEARS) -> DataFrame:
    """The national table carries result and targets already; nothing is joined."""
    chosen = national.select(
        "ano",
        F.col("rede_descricao").alias("rede"),
        F.col("taxa_alfabetizacao").alias("taxa_alfabetizacao_resultado"),
        *target_columns(years),
        "percentual_participacao",
    )
    return compare_with_target(chosen, years)


#: The conformed table whose rows each analytical table follows.
FOLLOWED = {
    "aluno_municipio": "aluno",
    "indicador_municipio": "municipio",
    "indicador_uf": "uf",
    "indicador_brasil": "meta_brasil",
}


def build_gold(
    spark: SparkSession,
    silver: str,
    gold: str,
    *,
    ids_unique: bool = False,
    years: Collection[int | None] | None = None,
) -> None:
    """Write the analytical tables, all years or only those named.

    Every analytical row depends on conformed rows of its own year alone, so the named years
    come out as in a full build. A year without rows is taken away.
    """

    def read(name: str) -> DataFrame:
        table = read_layer(spark, silver, name)
        return table if years is None else table.where(among(GOLD_PARTITIONS, {(y,) for y in years}))

    tables = {
        "aluno_municipio": gold_micro(read("aluno"), ids_unique=ids_unique),
        "indicador_municipio": gold_indicator(
            read("municipio"), read("meta_municipio"), "id_municipio"
        ),
        "indicador_uf": gold_indicator(read("uf"), read("meta_uf"), "sigla_uf"),
        "indicador_brasil": gold_national(read("meta_brasil")),
    }
    for name, table in tables.items():
        path = f"{gold.rstrip('/')}/{name}"
        write_partitioned(table, path, GOLD_PARTITIONS, order=GOLD_ORDER.get(name, ()))
        if years is not None:
            present = {row.ano for row in read(FOLLOWED[name]).select("ano").distinct().collect()}
            for year in set(years) - present:
                remove_partition(spark, path, {"ano": year})
