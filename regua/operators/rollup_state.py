"""A rollup that grows load by load: stored sums and bitmaps instead of the unit records.

Sums and counts of a load can be added to those of others. A count of distinct pupils cannot,
so each pupil gets a number once, and the state holds bitmaps of these numbers, which can be united:
exact, and without the unit records of earlier loads. One state answers every subset of its keys.

Below a folder lie two tables. ``numeros`` has a number for each pupil ever seen; numbers are dealt
in the order of the keys, so the pupils of a municipality stand side by side and share few bitmaps
(4 KB for 32,768 numbers, and one that is nearly empty packs to a few bytes). ``estado`` has, for each
load and key, one row of sums and a row for each bitmap; a load is replaced by one write.

Defined results: those of ``rate_rollup`` over the rows of all loads. A pupil without an id is in the
sums and not in the distinct count; null keys are keys; a load that is taken in again replaces itself; a
load named without rows is taken out. Numbers are never taken back. One writer at a time; one
that was interrupted is repeated, since pupils numbered before keep their numbers.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from regua.functions.numeric import percentage, safe_round
from regua.operators.rollup import ROLLUP_KEYS
from regua.schemas import CUT_SCORE, LOAD_COLUMN
from regua.sinks.files import remove_partition, write_partitioned
from regua.sources.tables import names_in, read_layer

NUMBERS, STATE = "numeros", "estado"
ID, SCORE, OFFICIAL, BY_CUT = "id_aluno", "proficiencia_lp", "in_alfabetizado", "fl_alfabetizado_calculado"
MEASURES = (SCORE, OFFICIAL, BY_CUT)
#: Numbers of one task lie this far apart from those of the next one.
TASK_NUMBERS = 1 << 33


def _numbers(spark: SparkSession, path: str) -> DataFrame:
    if not any(name.endswith(".parquet") for name in names_in(spark, f"{path}/{NUMBERS}")):
        return spark.createDataFrame([], f"{ID} string, numero bigint")
    return read_layer(spark, path, NUMBERS)


def _number_new(pairs: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Give a number to every pupil that has none."""
    known = _numbers(pairs.sparkSession, path)
    last = known.agg(F.max("numero")).first()[0]
    base = 0 if last is None else (last // TASK_NUMBERS + 1) * TASK_NUMBERS
    new = pairs.groupBy(ID).agg(F.min(F.struct(*keys)).alias("lugar")).join(known, ID, "left_anti")
    # Ranges run over place and id, so a large municipality is cut like any other stretch.
    dealt = new.repartitionByRange("lugar", ID).sortWithinPartitions("lugar", ID)
    number = F.lit(base).cast("bigint") + F.monotonically_increasing_id()
    dealt.select(ID, number.alias("numero")).write.mode("append").parquet(f"{path}/{NUMBERS}")


def add_loads(
    micro: DataFrame,
    path: str,
    loads: Collection[str],
    keys: Sequence[str] = ROLLUP_KEYS,
    *,
    load: str = LOAD_COLUMN,
) -> None:
    """Take the rows of the named loads into the state below ``path``; the rest of ``micro`` is left alone."""
    spark, path, loads = micro.sparkSession, path.rstrip("/"), sorted(loads)
    rows = micro.where(F.col(load).isin(loads)).withColumn(ID, F.col(ID).cast("string"))
    # Copies of a pupil collapse before they are shuffled by id.
    pairs = rows.where(F.col(ID).isNotNull()).select(load, *keys, ID).distinct()
    _number_new(pairs, path, keys)
    sums = rows.groupBy(load, *keys).agg(
        *[F.sum(m).alias(f"soma_{m}") for m in MEASURES], *[F.count(m).alias(f"n_{m}") for m in MEASURES]
    )
    number = F.col("numero")
    maps = (
        pairs.join(_numbers(spark, path), ID)
        .groupBy(load, *keys, F.bitmap_bucket_number(number).alias("faixa"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("mapa"))
    )
    whole = sums.unionByName(maps, allowMissingColumns=True)
    write_partitioned(whole, f"{path}/{STATE}", (load,), order=keys)
    present = {row[0] for row in rows.select(load).distinct().collect()}
    for name in set(loads) - present:
        remove_partition(spark, f"{path}/{STATE}", {load: name})


def rollup_of_state(
    spark: SparkSession, path: str, keys: Sequence[str] = ROLLUP_KEYS, *, cut: int = CUT_SCORE
) -> DataFrame:
    """The answer of ``rate_rollup`` over all loads taken in, for any of the keys of the state."""
    added = [f"{kind}_{m}" for kind in ("soma", "n") for m in MEASURES]
    # Bitmaps of one stretch of numbers are united first; the row of sums has no stretch.
    united = read_layer(spark, path, STATE).groupBy(*keys, "faixa").agg(
        *[F.sum(name).alias(name) for name in added], F.bitmap_count(F.bitmap_or_agg("mapa")).alias("alunos")
    )
    total = united.groupBy(*keys).agg(F.sum("alunos").alias("alunos"), *[F.sum(n).alias(n) for n in added])
    rate = lambda m: percentage(F.col(f"soma_{m}"), F.col(f"n_{m}"))
    mean = F.try_divide(F.col(f"soma_{SCORE}"), F.col(f"n_{SCORE}"))
    return total.select(
        *keys,
        F.col("alunos").alias("qtd_alunos"),
        safe_round(mean, 4).alias("media_proficiencia_lp"),
        rate(OFFICIAL).alias("taxa_alfabetizacao_microdados"),
        rate(BY_CUT).alias(f"taxa_alfabetizacao_calculada_{cut}"),
    )
