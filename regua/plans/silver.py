"""Raw files to conformed tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from regua.operators.conform import conform_aggregate, conform_microdata
from regua.schemas import ENTITIES
from regua.sinks.files import write_partitioned
from regua.sources.delimited import read_entity


def conformed(spark: SparkSession, bronze: str, name: str, **reading) -> DataFrame:
    """One entity, typed and with network code and label."""
    raw = read_entity(spark, bronze, ENTITIES[name], **reading)
    if name == "aluno":
        return conform_microdata(raw, decimal_mark=reading.get("decimal_mark", "."))
    return conform_aggregate(raw)


def build_silver(
    spark: SparkSession, bronze: str, silver: str, *, gather: bool = True, **reading
) -> None:
    """Write all entities. ``gather=False`` saves the shuffle before each write
    where raw files already hold few partitions each.

    Each reading option (``loads``, ``decimal_mark``, ``infer``) is either one value for
    all entities or a mapping from entity to value; entities it leaves out get
    the default.
    """
    for name, entity in ENTITIES.items():
        write_partitioned(
            conformed(spark, bronze, name, **options_for(name, reading)),
            f"{silver.rstrip('/')}/{name}",
            entity.partitions,
            order=entity.order,
            gather=gather,
        )


def options_for(name: str, reading: Mapping[str, object]) -> dict[str, object]:
    """The reading options of one entity."""
    return {
        option: value[name] if isinstance(value, Mapping) else value
        for option, value in reading.items()
        if not isinstance(value, Mapping) or name in value
    }
