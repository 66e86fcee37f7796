"""Conforming steps: names, types, trimmed keys, network labels, cut-score flag."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F

from regua.functions.labels import NETWORK_LABELS, label_for
from regua.functions.numeric import cast_columns, text_to_int
from regua.schemas import CUT_SCORE, DOUBLE_PREFIXES, KEY_TYPES, MICRODATA_NAMES, MICRODATA_TYPES


def rename_columns(df: DataFrame, names: Mapping[str, str] = MICRODATA_NAMES) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def trim_keys(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({name: F.trim(F.col(name).cast("string")) for name in columns})


def cast_by_prefix(df: DataFrame, prefixes: tuple[str, ...] = DOUBLE_PREFIXES) -> DataFrame:
    chosen = [name for name in df.columns if name.startswith(prefixes)]
    return cast_columns(df, dict.fromkeys(chosen, "double"))


def cast_keys(df: DataFrame, types: Mapping[str, str] = KEY_TYPES) -> DataFrame:
    """Type the key columns that exist; text keys are trimmed as well."""
    present = {name: kind for name, kind in types.items() if name in df.columns}
    typed = cast_columns(df, present)
    return trim_keys(typed, [name for name, kind in present.items() if kind == "string"])


def cast_microdata(
    df: DataFrame,
    types: Mapping[str, str] = MICRODATA_TYPES,
    *,
    trimmed: tuple[str, ...] = ("sigla_uf",),
    decimal_mark: str = ".",
) -> DataFrame:
    return trim_keys(cast_columns(df, types, decimal_mark), trimmed)


def add_network(df: DataFrame, labels: Mapping[int, str] = NETWORK_LABELS) -> DataFrame:
    """Add code and label of the school network.

    Result tables carry the code and target tables the label; after this step
    both carry both wherever the text allows it. Unknown text is its own label.
    """
    if "rede" not in df.columns:
        return df
    trimmed = trim_keys(df, ["rede"])
    with_code = trimmed.withColumn("rede_codigo", text_to_int(F.col("rede")))
    return with_code.withColumn(
        "rede_descricao", label_for(F.col("rede_codigo"), F.col("rede"), labels)
    )


def flag_cut_score(
    df: DataFrame,
    score: str = "proficiencia_lp",
    cut: float = CUT_SCORE,
    flag: str = "fl_alfabetizado_calculado",
) -> DataFrame:
    """1 at or above the cut, else 0. A missing score counts as below."""
    return df.withColumn(flag, F.when(F.col(score) >= cut, 1).otherwise(0))


def conform_aggregate(df: DataFrame, labels: Mapping[int, str] = NETWORK_LABELS) -> DataFrame:
    return df.transform(cast_by_prefix).transform(cast_keys).transform(add_network, labels)


def conform_microdata(
    df: DataFrame,
    labels: Mapping[int, str] = NETWORK_LABELS,
    cut: float = CUT_SCORE,
    decimal_mark: str = ".",
) -> DataFrame:
    return (
        df.transform(rename_columns)
        .transform(cast_microdata, decimal_mark=decimal_mark)
        .transform(flag_cut_score, cut=cut)
        .transform(add_network, labels)
    )
