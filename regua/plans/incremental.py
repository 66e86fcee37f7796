"""Loading what is new: raw load folders found once, and only touched partitions rewritten.

A ledger beside the conformed tables says which load folders have been taken in, each
with a signature of its files. A run compares it with the folders that are there, reads
the new and the changed ones, and replaces the partitions that they touch: rows of the
same loads go, rows of other loads stay, the new rows come in. So the answer is that of
a full rebuild, and a run that is repeated, or starts again after a crash, changes nothing
more. The ledger notes a load before its rows are written and again afterwards. Where one
was begun and not ended, files may be missing that held rows of other loads too, so all loads of
that table are read again.

Signatures come from file names, sizes and times; no file is opened for them. The
driver handles names of loads and values of partitions, never rows.

Not followed: a load folder that is taken away (landing is append-only; its rows stay).
A load that brings a column unknown to the table rewrites the whole table, as a rebuild would.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from regua.operators.quality import enforce, quality_report
from regua.plans.gold import build_gold
from regua.plans.silver import conformed, options_for
from regua.schemas import ENTITIES, LOAD_COLUMN, Entity
from regua.session import scratch_path
from regua.sinks.catalog import register_gold
from regua.sinks.files import among, remove_partition, write_partitioned
from regua.sources.delimited import read_entity
from regua.sources.tables import names_in, read_layer, read_table

#: Folders below the conformed layer.
LEDGER, DUE = "controle_cargas", "controle_pendentes"
BEGUN, ENDED = "iniciada", "concluida"
_LEDGER_SCHEMA = f"entidade string, {LOAD_COLUMN} string, assinatura string, situacao string, ordem long"


class Change(NamedTuple):
    """What a run did to one entity."""

    entity: str
    loads: tuple[str, ...]
    partitions: tuple[tuple, ...]

    @property
    def years(self) -> set:
        return {values[0] for values in self.partitions}


# --- the ledger -------------------------------------------------------------------


def signatures(spark: SparkSession, bronze: str, entity: Entity) -> dict[str, str]:
    """A signature of the files of each load folder; folders without data files are left out."""
    root = f"{bronze.rstrip('/')}/{entity.name}"
    if not any(name.startswith(f"{LOAD_COLUMN}=") for name in names_in(spark, root)):
        return {}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    # The content column is never asked for, so only listings are read.
    mark = F.xxhash64(F.substring_index("path", "/", -1), "length", "modificationTime")
    found = (
        files.select(F.regexp_extract("path", f"/{LOAD_COLUMN}=([^/]+)/", 1).alias("load"), mark.alias("mark"))
        .where(F.col("load") != "")
        .groupBy("load")
        .agg(F.count(F.lit(1)).alias("n"), F.bit_xor("mark").alias("mark"))
    )
    return {unquote(row.load): f"{row.n}-{row.mark & (1 << 64) - 1:016x}" for row in found.collect()}


def ledger(spark: SparkSession, silver: str) -> DataFrame:
    """Everything noted so far: entity, load, signature, state, order."""
    path = f"{silver.rstrip('/')}/{LEDGER}"
    if not names_in(spark, path):
        return spark.createDataFrame([], _LEDGER_SCHEMA)
    return spark.read.schema(_LEDGER_SCHEMA).json(path)


def _known(spark: SparkSession, silver: str, entity: Entity) -> dict[str, tuple[str, str]]:
    """The last signature and state noted for each load."""
    last = (
        ledger(spark, silver)
        .where(F.col("entidade") == entity.name)
        .groupBy(LOAD_COLUMN)
        .agg(F.max_by(F.struct("assinatura", "situacao"), "ordem").alias("last"))
    )
    return {row[LOAD_COLUMN]: (row.last.assinatura, row.last.situacao) for row in last.collect()}


def _note(spark: SparkSession, silver: str, entity: Entity, marks: Mapping[str, str], state: str) -> None:
    order = ledger(spark, silver).agg(F.coalesce(F.max("ordem"), F.lit(0))).first()[0] + 1
    rows = [(entity.name, load, mark, state, order) for load, mark in sorted(marks.items())]
    frame = spark.createDataFrame(rows, _LEDGER_SCHEMA).coalesce(1)
    frame.write.mode("append").json(f"{silver.rstrip('/')}/{LEDGER}")


# --- one entity -------------------------------------------------------------------


def _partitions(df: DataFrame, columns: Sequence[str]) -> set[tuple]:
    return {tuple(row) for row in df.select(*columns).distinct().collect()}


def load_entity(
    spark: SparkSession,
    bronze: str,
    silver: str,
    name: str,
    conform: Callable[[DataFrame], DataFrame] | None = None,
    **reading,
) -> Change:
    """Take in the new and changed loads of an entity. Only their folders and the partitions touched are read.

    ``conform`` makes conformed rows of raw ones, by default as ``build_silver`` does.
    """
    entity = ENTITIES[name]
    present, known = signatures(spark, bronze, entity), _known(spark, silver, entity)
    wanted = {load: mark for load, mark in present.items() if known.get(load) != (mark, ENDED)}
    if any(state == BEGUN for _, state in known.values()):
        wanted = present
    if not wanted:
        return Change(name, (), ())
    _note(spark, silver, entity, wanted, BEGUN)
    staged_at = scratch_path(spark, f"carga_{name}")
    reading["loads"] = sorted(wanted)
    if conform is None:
        fresh = conformed(spark, bronze, name, **reading)
    else:
        fresh = conform(read_entity(spark, bronze, entity, **reading))
    fresh.write.parquet(staged_at)
    staged = spark.read.parquet(staged_at)
    path, columns = f"{silver.rstrip('/')}/{name}", entity.partitions
    whole, touched = staged, _partitions(staged, columns)
    emptied: set[tuple] = set()
    if any("=" in n for n in names_in(spark, path)):
        table = read_table(spark, path)
        own = F.coalesce(F.col(LOAD_COLUMN).isin(sorted(wanted)), F.lit(False))
        if set(staged.columns) - set(table.columns):
            # A column that the table does not have yet: all partitions are written with it.
            touched |= _partitions(table, columns)
        elif known.keys() & wanted.keys():
            # A load read before may have left rows in partitions that it no longer has.
            touched |= _partitions(table.where(own), columns)
        kept = table.where(among(columns, touched)).where(~own)
        emptied = touched - _partitions(staged, columns) - _partitions(kept, columns)
        # New files replace the partitions when the job commits, after these have been read.
        whole = staged.unionByName(kept, allowMissingColumns=True)
    write_partitioned(whole, path, columns, order=entity.order)
    for values in emptied:
        remove_partition(spark, path, dict(zip(columns, values)))
    _note(spark, silver, entity, wanted, ENDED)
    return Change(name, tuple(sorted(wanted)), tuple(sorted(touched, key=repr)))


# --- the whole flow ---------------------------------------------------------------


def load_silver(spark: SparkSession, bronze: str, silver: str, **reading) -> dict[str, Change]:
    """Take in what is new of every entity that has landed; options as of ``build_silver``."""
    return {name: load_entity(spark, bronze, silver, name, **options_for(name, reading)) for name in ENTITIES}


def update(
    spark: SparkSession, bronze: str, silver: str, gold: str, database: str | None = None, **reading
) -> dict[str, Change]:
    """Bring all layers up to date: new loads, the gates, and the analytical tables of the years touched.

    The gates look at pupils of the years touched and at the other tables whole. If they fail,
    nothing analytical is written, and the years stay due: they are noted before the gates and
    done with afterwards, so the next run takes them up again, also without a new load.
    """
    changes = load_silver(spark, bronze, silver, **reading)
    due = {year for change in changes.values() for year in change.years} | _years_due(spark, silver)
    if not due:
        return changes
    _set_years_due(spark, silver, due)
    pupils = read_layer(spark, silver, "aluno").where(among(("ano",), {(y,) for y in due}))
    enforce(quality_report(pupils, read_layer(spark, silver, "municipio"), read_layer(spark, silver, "meta_municipio")))
    build_gold(spark, silver, gold, ids_unique=True, years=sorted(due, key=repr))
    if database:
        register_gold(spark, database, gold)
    _set_years_due(spark, silver, set())
    return changes


def _years_due(spark: SparkSession, silver: str) -> set:
    path = f"{silver.rstrip('/')}/{DUE}"
    if not names_in(spark, path):
        return set()
    return {row.ano for row in spark.read.schema("ano int, vazio boolean").json(path).where("not vazio").collect()}


def _set_years_due(spark: SparkSession, silver: str, years: set) -> None:
    rows = [(year, False) for year in sorted(years, key=repr)] or [(None, True)]
    frame = spark.createDataFrame(rows, "ano int, vazio boolean").coalesce(1)
    frame.write.mode("overwrite").json(f"{silver.rstrip('/')}/{DUE}")
