"""Results against targets: join, target of the year, gap, status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from regua.functions.numeric import safe_round
from regua.schemas import TARGET_PREFIX, TARGET_YEARS, target_columns

# Status labels.
NO_TARGET = "SEM_META"
REACHED = "ATINGIU_META"
BELOW = "ABAIXO_META"


def attach_targets(
    results: DataFrame,
    targets: DataFrame,
    entity: str,
    years: Sequence[int] = TARGET_YEARS,
) -> DataFrame:
    """Every result, with the targets published for its year, entity and network.

    No strategy is forced: both sides grow with the number of entities, so a
    broadcast is left to the optimizer's size check, and a key that holds many
    results is split at run time by the adaptive skew join.
    """
    keys = ["ano", entity, "rede_descricao"]
    wanted = [*keys, *target_columns(years), "percentual_participacao"]
    return results.join(targets.select(*wanted), on=keys, how="left")


def target_for_year(df: DataFrame, years: Sequence[int] = TARGET_YEARS) -> DataFrame:
    """``meta_ano``: the target column named after the row's own year."""
    branches = [F.when(F.col("ano") == y, F.col(f"{TARGET_PREFIX}{y}")) for y in years]
    return df.withColumn("meta_ano", F.coalesce(*branches))


def target_gap(df: DataFrame) -> DataFrame:
    difference = F.col("taxa_alfabetizacao_resultado") - F.col("meta_ano")
    return df.withColumn("gap_meta", safe_round(difference, 2))


def target_status(df: DataFrame) -> DataFrame:
    """A target without a result has no gap and counts as missed."""
    return df.withColumn(
        "status_meta",
        F.when(F.col("meta_ano").isNull(), NO_TARGET)
        .when(F.col("gap_meta") >= 0, REACHED)
        .otherwise(BELOW),
    )


def compare_with_target(df: DataFrame, years: Sequence[int] = TARGET_YEARS) -> DataFrame:
    return df.transform(target_for_year, years).transform(target_gap).transform(target_status)
