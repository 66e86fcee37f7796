"""Top-k, best-and-worst, and the extremes of a key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from regua.functions.ordering import ascending, descending


def top_k(df: DataFrame, order: Sequence[Column], ties: Sequence[str], k: int) -> DataFrame:
    """First ``k`` rows; each task keeps its own ``k`` before they meet."""
    return df.orderBy(*order, *ascending(*ties)).limit(k)


def best_and_worst(
    df: DataFrame,
    value: str,
    ties: Sequence[str],
    k: int,
    labels: tuple[str, str],
    label: str = "tipo_ranking",
) -> DataFrame:
    """The ``k`` highest and ``k`` lowest rows, the former winning an overlap.

    Two bounded sorts replace two numberings of the whole table, which would
    have to pass through one task. Among at most ``2k`` rows, each row found at
    the top then takes one equal row away from the bottom.
    """
    best = top_k(df, descending(value), ties, k).withColumn(label, F.lit(labels[0]))
    worst = top_k(df, ascending(value), ties, k).withColumn(label, F.lit(labels[1]))
    equal = W.partitionBy(*df.columns)
    is_best = F.col(label) == labels[0]
    return (
        best.unionByName(worst)
        .withColumn("_in_best", F.count_if(is_best).over(equal))
        .withColumn("_position", F.row_number().over(equal.orderBy(is_best.desc())))
        .where(is_best | (F.col("_position") > 2 * F.col("_in_best")))
        .drop("_in_best", "_position")
    )


def keep_extremes(
    df: DataFrame, keys: Sequence[str], value: str, ties: Sequence[str], k: int
) -> DataFrame:
    """Per key, the rows that can be among the ``k`` farthest from any number.

    Farthest from a given number means lowest or highest; farthest from NULL
    means first by tie-break. Everything else can be left out before a join
    that ranks by distance.

    Each of the three is a numbering with a single bound, which Spark applies
    below the shuffle too: every task drops what is beyond its own ``k`` rows of
    a key, so a large key is never sorted in one place. That holds up to
    ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000); a larger ``k`` gives the
    same rows at a higher price. Copies of a row travel as a count. A copy beyond the
    largest of its three counts has ``k`` rows before it in every order.
    """
    order = W.partitionBy(*keys)
    ends = (
        [*ascending(value, *ties)],
        [*descending(value), *ascending(*ties)],
        [*ascending(*ties)],
    )
    branches = [
        df.withColumn("_nth", F.row_number().over(order.orderBy(*end)))
        .where(F.col("_nth") <= k)
        .groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        for end in ends
    ]
    kept = reduce(DataFrame.unionAll, branches).groupBy(*df.columns).agg(
        F.max("_copies").alias("_copies")
    )
    copies = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy")
    return kept.select(*df.columns, copies).drop("_copy")
