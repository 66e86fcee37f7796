"""Quality gates as one tidy report.

Each row of a report is one check on one column:
``check, table, column, violations, total, pct, severity``.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from regua.functions.numeric import cast_to, percentage
from regua.schemas import CUT_SCORE, ENTITIES, PERCENT_PREFIXES

log = logging.getLogger(__name__)

OK, WARN, FAIL = "ok", "warn", "fail"

# Fixed value: percentage of violations up to which the lenient gates only warn.
TOLERATED_PCT = 1


class QualityError(ValueError):
    """A gate failed."""


def _graded(
    counts: DataFrame, tolerated_pct: int | Column | None = 0, empty_fails: bool = False
) -> DataFrame:
    """Add percentage and severity. ``None`` tolerates any number of violations."""
    violations, total = F.col("violations"), F.col("total")
    fails = F.lit(False) if tolerated_pct is None else violations * 100 > total * tolerated_pct
    if empty_fails:
        fails = fails | (total == 0)
    pct = F.when(total > 0, percentage(violations, total, 4)).otherwise(0.0)
    severity = F.when(fails, FAIL).when(violations > 0, WARN).otherwise(OK)
    return counts.select(
        "check", "table", "column", violations, total, pct.alias("pct"), severity.alias("severity")
    )


def _tally(df: DataFrame, table: str, checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Count the violations of all checks in a single pass over the table."""
    if not checks:
        return df.sparkSession.createDataFrame(
            [],
            "check string, table string, column string, violations bigint, total bigint",
        )
    wide = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(bad).alias(f"bad_{i}") for i, (_, _, bad) in enumerate(checks)],
    )
    rows = [
        F.struct(
            F.lit(check).alias("check"),
            F.lit(table).alias("table"),
            F.lit(column).alias("column"),
            F.col(f"bad_{i}").alias("violations"),
            F.col("total"),
        )
        for i, (check, column, _) in enumerate(checks)
    ]
    return wide.select(F.inline(F.array(*rows)))


def _outside_percent(name: str) -> Column:
    return (F.col(name) < 0) | (F.col(name) > 100)


def _disagrees_with_cut(score: str, flag: str, cut: float) -> Column:
    above = F.col(score) >= cut
    return (above & (F.col(flag) != 1)) | (~above & (F.col(flag) != 0))


def check_range(
    df: DataFrame, table: str, prefixes: tuple[str, ...] = PERCENT_PREFIXES
) -> DataFrame:
    """Percentages outside 0 to 100. NULL is accepted."""
    names = [name for name in df.columns if name.startswith(prefixes)]
    return _graded(_tally(df, table, [("range_0_100", n, _outside_percent(n)) for n in names]))


def check_negative(df: DataFrame, table: str, column: str = "proficiencia_lp") -> DataFrame:
    return _graded(_tally(df, table, [("negative", column, F.col(column) < 0)]))


def check_cut_agreement(
    df: DataFrame,
    table: str,
    score: str = "proficiencia_lp",
    flag: str = "in_alfabetizado",
    cut: float = CUT_SCORE,
) -> DataFrame:
    """Official flag against the cut score, as a share of all rows.

    A NULL score or flag cannot disagree but still counts in the total.
    """
    bad = _disagrees_with_cut(score, flag, cut)
    return _graded(_tally(df, table, [("cut_agreement", flag, bad)]), TOLERATED_PCT)


def check_not_null(df: DataFrame, table: str, column: str = "rede_descricao") -> DataFrame:
    return _graded(_tally(df, table, [("not_null", column, F.col(column).isNull())]))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("qtd")).where(F.col("qtd") > 1)


def check_duplicates(
    df: DataFrame,
    table: str,
    key: Sequence[str] = ("ano", "id_aluno"),
    check: str = "duplicate_key",
    tolerated_pct: int | None = 0,
) -> DataFrame:
    """Number of duplicated keys among all keys.

    Copies of one key collapse before the shuffle, and the second level only
    adds up counts, so a key with very many copies costs nothing extra.
    """
    groups = df.groupBy(*key).agg(F.count(F.lit(1)).alias("qtd"))
    counts = groups.agg(
        F.count_if(F.col("qtd") > 1).alias("violations"), F.count(F.lit(1)).alias("total")
    )
    return _graded(_labelled(counts, check, table, ",".join(key)), tolerated_pct)


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def orphan_keys(df: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``df`` that the reference does not know."""
    return distinct_keys(df, key).join(distinct_keys(reference, key), on=key, how="left_anti")


def check_referential(
    df: DataFrame, reference: DataFrame, table: str, key: str = "id_municipio"
) -> DataFrame:
    """Share of the distinct keys that the reference lacks; no key at all fails.

    A marked left join yields both numbers at once, where counting orphans and
    keys separately would reduce the unit records to their keys twice.
    """
    known = distinct_keys(reference, key).withColumn("_known", F.lit(True))
    marked = distinct_keys(df, key).join(known, on=key, how="left")
    counts = marked.agg(
        F.count_if(F.col("_known").isNull()).alias("violations"),
        F.count(F.lit(1)).alias("total"),
    )
    return _graded(
        _labelled(counts, "referential", table, key), TOLERATED_PCT, empty_fails=True
    )


def _unfolded(wide: DataFrame, rows: Sequence[tuple[str, str, str, str, str]]) -> DataFrame:
    """One row of counts as report rows (check, table, column, violations, total) named by columns of ``wide``."""
    structs = [
        F.struct(
            F.lit(check).alias("check"),
            F.lit(table).alias("table"),
            F.lit(column).alias("column"),
            F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations"),
            F.coalesce(total, F.lit(0)).cast("bigint").alias("total"),
        )
        for check, table, column, violations, total in rows
    ]
    return wide.select(F.inline(F.array(*structs)))


def check_microdata(micro: DataFrame, reference: DataFrame, cut: float = CUT_SCORE) -> DataFrame:
    """The row-level gates on unit records and the referential one, from a single pass.

    Counts are kept by municipality, so their sums give the row gates and their
    keys the municipalities to look for in the reference.
    """
    key = "id_municipio"
    checks = [
        ("negative", "proficiencia_lp", F.col("proficiencia_lp") < 0),
        (
            "cut_agreement",
            "in_alfabetizado",
            _disagrees_with_cut("proficiencia_lp", "in_alfabetizado", cut),
        ),
        ("not_null", "rede_descricao", F.col("rede_descricao").isNull()),
    ]
    by_city = micro.groupBy(key).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(bad).alias(f"bad_{i}") for i, (_, _, bad) in enumerate(checks)],
    )
    known = distinct_keys(reference, key).withColumn("_known", F.lit(True))
    named = F.col(key).isNotNull()
    wide = by_city.join(known, on=key, how="left").agg(
        F.sum("total").alias("total"),
        *[F.sum(f"bad_{i}").alias(f"bad_{i}") for i in range(len(checks))],
        F.count_if(named & F.col("_known").isNull()).alias("orphans"),
        F.count_if(named).alias("cities"),
    )
    rows = [
        (check, "aluno", column, F.col(f"bad_{i}"), F.col("total"))
        for i, (check, column, _) in enumerate(checks)
    ]
    rows.append(("referential", "aluno", key, F.col("orphans"), F.col("cities")))
    lenient = F.col("check").isin("cut_agreement", "referential")
    # No municipality at all fails too.
    missing = (F.col("check") == "referential") & (F.col("total") == 0)
    return _graded(
        _unfolded(wide, rows), F.when(missing, -1).when(lenient, TOLERATED_PCT).otherwise(0)
    )


def check_targets(
    targets: DataFrame,
    key: Sequence[str] = ("ano", "id_municipio", "rede_descricao"),
    prefixes: tuple[str, ...] = PERCENT_PREFIXES,
) -> DataFrame:
    """Percentages of the targets and repeated target keys, from a single pass.

    The last row is advice only: repeated target keys multiply results in the
    later join without making it wrong.
    """
    table = "meta_municipio"
    names = [name for name in targets.columns if name.startswith(prefixes)]
    by_key = targets.groupBy(*key).agg(
        F.count(F.lit(1)).alias("qtd"),
        *[F.count_if(_outside_percent(name)).alias(f"bad_{i}") for i, name in enumerate(names)],
    )
    wide = by_key.agg(
        F.sum("qtd").alias("total"),
        *[F.sum(f"bad_{i}").alias(f"bad_{i}") for i in range(len(names))],
        F.count_if(F.col("qtd") > 1).alias("repeated"),
        F.count(F.lit(1)).alias("keys"),
    )
    rows = [
        ("range_0_100", table, name, F.col(f"bad_{i}"), F.col("total"))
        for i, name in enumerate(names)
    ]
    rows.append(("target_key", table, ",".join(key), F.col("repeated"), F.col("keys")))
    return _graded(_unfolded(wide, rows), F.when(F.col("check") == "target_key", 100).otherwise(0))


def quality_report(
    micro: DataFrame, results: DataFrame, targets: DataFrame, *, cut: float = CUT_SCORE
) -> DataFrame:
    """All gates on unit records, municipal results and municipal targets.

    Unit records are read twice, once for their ids and once for everything
    else, targets once, and results once beside their part as the reference.
    """
    parts = [
        check_duplicates(micro, "aluno", ENTITIES["aluno"].key),
        check_range(results, "municipio"),
        check_microdata(micro, results, cut),
        check_targets(targets),
    ]
    return reduce(DataFrame.unionByName, parts)


def cast_losses(
    text: DataFrame, types: Mapping[str, str], table: str, decimal_mark: str = "."
) -> DataFrame:
    """Non-empty texts that their declared type cannot hold, per column.

    Such values silently become NULL when a file is read. The usual reason is a
    decimal mark other than the one the reader was told.
    """
    def lost(name: str, kind: str) -> Column:
        typed = cast_to(F.col(name), T.StringType(), kind, decimal_mark)
        return (F.trim(F.col(name)) != "") & typed.isNull()

    texts = {f.name for f in text.schema if isinstance(f.dataType, T.StringType)}
    checks = [
        ("cast_loss", name, lost(name, kind))
        for name, kind in types.items()
        if kind != "string" and name in texts
    ]
    return _graded(_tally(text, table, checks), None)


def enforce(report: DataFrame) -> None:
    """Log the warnings and raise on the first failed gate, in report order."""
    rows: Iterable = report.collect()
    failed = None
    for row in rows:
        where = f"{row['table']}.{row['column']}"
        counts = f"{row['violations']} of {row['total']} ({row['pct']}%)"
        message = f"{row['check']} on {where}: {counts}"
        if row["severity"] == FAIL and failed is None:
            failed = message
        elif row["severity"] != OK:
            log.warning(message)
    if failed:
        raise QualityError(failed)


def _labelled(counts: DataFrame, check: str, table: str, column: str) -> DataFrame:
    return counts.withColumns(
        {"check": F.lit(check), "table": F.lit(table), "column": F.lit(column)}
    )
