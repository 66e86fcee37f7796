"""Raw files to queryable analytical tables, with the gates in between."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regua.operators.quality import enforce, quality_report
from regua.plans.gold import build_gold
from regua.plans.silver import build_silver
from regua.sinks.catalog import register_gold
from regua.sources.tables import read_layer


def check_silver(spark: SparkSession, silver: str) -> DataFrame:
    return quality_report(
        read_layer(spark, silver, "aluno"),
        read_layer(spark, silver, "municipio"),
        read_layer(spark, silver, "meta_municipio"),
    )


def run(
    spark: SparkSession,
    bronze: str,
    silver: str,
    gold: str,
    database: str | None = None,
    **silver_options,
) -> None:
    """Build both layers. A failed gate stops before anything analytical is written.

    Further options go to :func:`regua.plans.silver.build_silver`.
    """
    build_silver(spark, bronze, silver, **silver_options)
    enforce(check_silver(spark, silver))
    # The duplicate gate has passed, so counting ids needs no distinct.
    build_gold(spark, silver, gold, ids_unique=True)
    if database:
        register_gold(spark, database, gold)
