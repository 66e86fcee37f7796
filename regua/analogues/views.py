"""The driver's order tables seen as pupils, results and targets.

An order plays a pupil, its customer's nation the state, a slice of the
customers the municipality, and the order priority the school network, as a
code in results and as text in targets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from regua.functions.numeric import rate, safe_round
from regua.operators.conform import conform_aggregate, conform_microdata
from regua.schemas import TARGET_PREFIX
from regua.sources.tables import read_table

CUT = 250000
TARGET_YEARS = tuple(range(1996, 2002))
LABELS = {1: "URGENT", 2: "HIGH", 3: "MEDIUM", 4: "NOT SPECIFIED", 5: "LOW"}
UNTARGETED = "LOW"
CITIES_PER_STATE = 20

CITY, STATE = "id_municipio", "sigla_uf"


# Declared, so that planning a query reads no file.
_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", _SCHEMAS[name])


def raw_micro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit records under the column names of the raw file."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey).join(
        nations, customers.c_nationkey == nations.n_nationkey
    )
    city = F.col("c_nationkey") * 100 + F.col("c_custkey") % CITIES_PER_STATE
    status = F.col("o_orderstatus")
    return joined.select(
        F.year("o_orderdate").alias("NU_ANO_AVALIACAO"),
        F.col("n_nationkey").alias("CO_UF"),
        F.col("n_name").alias("SG_UF"),
        F.col("o_orderkey").cast("string").alias("ID_ALUNO"),
        F.lit(2).alias("TP_SERIE"),
        F.col("o_custkey").cast("int").alias("ID_ESCOLA"),
        F.substring("o_orderpriority", 1, 1).alias("TP_DEPENDENCIA"),
        city.cast("int").alias("CO_MUNICIPIO"),
        F.concat(F.lit("São "), F.col("n_name")).alias("NO_MUNICIPIO"),
        (F.col("c_acctbal") / 100).alias("VL_PESO_ALUNO_LP"),
        F.col("o_totalprice").alias("VL_PROFICIENCIA_LP"),
        F.when(status == "F", 1).when(status == "O", 0).alias("IN_ALFABETIZADO"),
    )


def micro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform_microdata(raw_micro(spark, sf_dir), LABELS, CUT)


def raw_results(pupils: DataFrame, entity: str) -> DataFrame:
    """Official results per entity, with the network as a code."""
    return (
        pupils.groupBy("ano", entity, "rede")
        .agg(
            rate(F.col("in_alfabetizado")).alias("taxa_alfabetizacao"),
            safe_round(F.avg("proficiencia_lp"), 4).alias("media_portugues"),
        )
        .select(
            "ano", entity, F.lit(2).alias("serie"), "rede", "taxa_alfabetizacao", "media_portugues"
        )
    )


def raw_targets(pupils: DataFrame, entity: str) -> DataFrame:
    """Targets per entity, with the network as text, published every year.

    All target years come out of one pass; the years of publication are those
    of the unit records.
    """
    yearly = [
        rate(F.when(F.col("ano") == year, F.col("fl_alfabetizado_calculado"))).alias(
            f"{TARGET_PREFIX}{year}"
        )
        for year in TARGET_YEARS
    ]
    answered = F.col("in_alfabetizado").isNotNull().cast("int")
    targets = (
        pupils.where(F.col("rede_descricao") != UNTARGETED)
        .groupBy(entity, F.col("rede_descricao").alias("rede"))
        .agg(*yearly, rate(answered).alias("percentual_participacao"))
    )
    years = pupils.agg(F.array_sort(F.collect_set("ano")).alias("anos")).scalar()
    return targets.select(F.explode(years).alias("ano"), "*")


def raw_national(pupils: DataFrame) -> DataFrame:
    """National result and targets side by side.

    One pass over the unit records leaves a row per year and network; the
    targets of a network are then taken from its own few rows.
    """
    answered = F.col("in_alfabetizado").isNotNull().cast("int")
    by_year = pupils.groupBy("ano", F.col("rede_descricao").alias("rede")).agg(
        rate(F.col("in_alfabetizado")).alias("taxa_alfabetizacao"),
        rate(F.col("fl_alfabetizado_calculado")).alias("_calculada"),
        rate(answered).alias("percentual_participacao"),
    )
    targeted = F.col("rede") != UNTARGETED
    network = W.partitionBy("rede")
    return by_year.select(
        "ano",
        "rede",
        "taxa_alfabetizacao",
        *[
            F.max(F.when(targeted & (F.col("ano") == year), F.col("_calculada")))
            .over(network)
            .alias(f"{TARGET_PREFIX}{year}")
            for year in TARGET_YEARS
        ],
        "percentual_participacao",
    )


def results(pupils: DataFrame, entity: str) -> DataFrame:
    return conform_aggregate(raw_results(pupils, entity), LABELS)


def targets(pupils: DataFrame, entity: str) -> DataFrame:
    return conform_aggregate(raw_targets(pupils, entity), LABELS)


def national(pupils: DataFrame) -> DataFrame:
    return conform_aggregate(raw_national(pupils), LABELS)
