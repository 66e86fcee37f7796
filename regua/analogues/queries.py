"""Every operator and question, run over the driver's tables.

Conforming steps work on the raw tables. What follows conforming reads the
stored conformed pupils, and the twelve questions read stored analytical
tables, as in the layered flow of :mod:`regua.plans`; see
:mod:`regua.analogues.workspace`.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from regua.analogues import views, workspace
from regua.analogues.views import CITY, CUT, LABELS, STATE, TARGET_YEARS
from regua.functions.numeric import rate
from regua.functions.ordering import ascending, descending
from regua.operators import conform, quality, rollup_state, targets
from regua.operators.latest import keep_latest, keep_newest
from regua.operators.ranking import top_k
from regua.operators.rollup import rate_rollup
from regua.plans import gold, incremental, reports
from regua.schemas import ENTITIES, LOAD_COLUMN, TARGET_PREFIX
from regua.session import scratch_path
from regua.sinks import catalog, versions
from regua.sinks.files import land_delimited, write_partitioned
from regua.sinks.questions import register_questions
from regua.sources.delimited import read_entity
from regua.sources.tables import read_table, scan_catalog
from regua.streaming import feed

Query = Callable[[SparkSession, str], DataFrame]

FOLLOWED_CITY = 217
NEW_YEARS = 1999
FEED_FIELDS = {
    "event_id": "bigint",
    "event_ts": "string",
    "user_id": "bigint",
    "event_type": "string",
    "value": "double",
    "props": "string",
}


def _as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Whole numbers with gaps, shown as text: clients that turn such columns
    into floating point would blur the difference between 1 and 1.0."""
    return df.withColumns({name: F.col(name).cast("string") for name in columns})


# --- sources -----------------------------------------------------------------


def _raw_city(spark: SparkSession, sf: str) -> DataFrame:
    return views.raw_results(workspace.silver_micro(spark, sf), CITY)


def _landed_city(spark: SparkSession, sf: str) -> str:
    bronze = scratch_path(spark, "bronze")
    land_delimited(_raw_city(spark, sf), bronze, ENTITIES["municipio"])
    return bronze


def csv_roundtrip_comma(spark: SparkSession, sf: str) -> DataFrame:
    return read_entity(spark, _landed_city(spark, sf), ENTITIES["municipio"])


def csv_roundtrip_semicolon_latin1(spark: SparkSession, sf: str) -> DataFrame:
    bronze = scratch_path(spark, "bronze")
    land_delimited(views.raw_micro(spark, sf), bronze, ENTITIES["aluno"])
    return _as_text(read_entity(spark, bronze, ENTITIES["aluno"]), "IN_ALFABETIZADO")


def csv_infer_types(spark: SparkSession, sf: str) -> DataFrame:
    return read_entity(spark, _landed_city(spark, sf), ENTITIES["municipio"], infer=True)


def partition_discovery(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads, read together; the load date comes from the folder."""
    bronze = scratch_path(spark, "bronze")
    raw = views.raw_micro(spark, sf)
    recent = F.col("NU_ANO_AVALIACAO") >= NEW_YEARS
    land_delimited(raw.where(~recent), bronze, ENTITIES["aluno"], "2024-01-15")
    land_delimited(raw.where(recent), bronze, ENTITIES["aluno"], "2024-02-15")
    loaded = read_entity(spark, bronze, ENTITIES["aluno"])
    return loaded.groupBy("dt_carga", F.col("NU_ANO_AVALIACAO").alias("ano")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def partition_load_select(spark: SparkSession, sf: str) -> DataFrame:
    """Two of three loads, one of which has a column that the other lacks."""
    bronze = scratch_path(spark, "bronze")
    city, raw = ENTITIES["municipio"], _raw_city(spark, sf)
    recent = F.col("ano") >= NEW_YEARS
    land_delimited(raw.where(~recent), bronze, city, "2024-01")
    note = F.concat(F.lit("x"), CITY)
    land_delimited(raw.where(recent).withColumn("observacao", note), bronze, city, "2025-01")
    land_delimited(raw.select("ano", "rede"), bronze, city, "2026-01")
    return read_entity(spark, bronze, city, loads=["2024-01", "2025-01"])


def parquet_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A whole stored entity."""
    workspace.silver_pair(spark, sf, CITY)
    return read_table(spark, workspace.path_of(spark, sf, "municipio"))


def parquet_scan_pushed_filter(spark: SparkSession, sf: str) -> DataFrame:
    return views.table(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


def _gold_columns(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema if f.name != "ano"}


def _gold_database(spark: SparkSession, sf: str) -> tuple[str, list[str]]:
    """A database with the four analytical tables, and their names."""
    stored = {
        "indicador_municipio": workspace.gold_city(spark, sf),
        "indicador_uf": workspace.gold_state(spark, sf),
        "indicador_brasil": workspace.gold_country(spark, sf),
        "aluno_municipio": workspace.gold_pupils(spark, sf),
    }
    database = _fresh_name(spark, "regua_gold")
    catalog.create_database(spark, database, scratch_path(spark, database))
    for name, df in stored.items():
        table = f"{database}.gold_{name}"
        location = workspace.path_of(spark, sf, name)
        catalog.create_external_table(spark, table, _gold_columns(df), location)
        catalog.repair_partitions(spark, table)
    return database, list(stored)


def catalog_table_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Database, external tables and partitions over the stored layer, then a scan."""
    database, stored = _gold_database(spark, sf)
    shown = []
    for name in stored:
        df = scan_catalog(spark, database, f"gold_{name}")
        entity = next((c for c in (CITY, STATE) if c in df.columns), None)
        units = name == "aluno_municipio"
        shown.append(
            df.select(
                F.lit(name).alias("tabela"),
                "ano",
                (F.col(CITY if units else entity) if entity else F.lit(None)).cast("string").alias("chave"),
                "rede",
                F.col("taxa_alfabetizacao_microdados" if units else reports.RESULT).alias("taxa"),
                F.col("nome_municipio" if units else "status_meta").alias("marca"),
            )
        )
    return reduce(DataFrame.unionAll, shown)


def catalog_repair_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """A table over existing files sees nothing until it is repaired."""
    df = workspace.gold_pupils(spark, sf)
    database = _fresh_name(spark, "regua_repair")
    table = f"{database}.gold_aluno_municipio"
    catalog.create_database(spark, database, scratch_path(spark, database))
    location = workspace.path_of(spark, sf, "aluno_municipio")
    catalog.create_external_table(spark, table, _gold_columns(df), location)
    before = spark.table(table).count()
    catalog.repair_partitions(spark, table)
    return (
        spark.table(table)
        .groupBy("ano")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("n_rows_before", F.lit(before).cast("bigint"))
    )


def publish_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Every year is published, then the new ones again as a second version; the table shows the last of each."""
    df = workspace.gold_pupils(spark, sf).withColumn("versao", F.lit(1))
    database = _fresh_name(spark, "regua_versions")
    root = scratch_path(spark, database)
    table = f"{database}.gold_aluno_municipio"
    catalog.create_database(spark, database, root)
    catalog.create_external_table(spark, table, _gold_columns(df), f"{root}/tabela")
    versions.publish(df, table, f"{root}/tabela")
    versions.publish(df.where(F.col("ano") >= NEW_YEARS).withColumn("versao", F.lit(2)), table, f"{root}/tabela")
    return spark.table(table)


def questions_in_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Three of the SQL table functions, with arguments of their own."""
    database, _ = _gold_database(spark, sf)
    register_questions(spark, database, CUT)
    before = spark.catalog.currentDatabase()
    spark.sql(f"USE {database}")
    try:
        calls = ("q01_abaixo_da_meta(30)", f"q02_historico({FOLLOWED_CITY})", "q05_maiores_gaps()")
        asked = [spark.sql(f"SELECT '{call[:3]}' AS pergunta, * FROM {call}") for call in calls]
    finally:
        spark.sql(f"USE {before}")
    return reduce(DataFrame.unionAll, asked)


def _fresh_name(spark: SparkSession, prefix: str) -> str:
    return f"{prefix}_{scratch_path(spark, '').split('/')[-2]}"


# --- sinks -------------------------------------------------------------------


def parquet_partitioned_write(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "municipio")
    results = views.results(workspace.silver_micro(spark, sf), CITY)
    write_partitioned(results, path, order=ENTITIES["municipio"].order)
    return read_table(spark, path)


def parquet_two_level_write(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "aluno")
    layout = ENTITIES["aluno"]
    write_partitioned(views.micro(spark, sf), path, layout.partitions, order=layout.order)
    return _as_text(read_table(spark, path), "in_alfabetizado")


def dynamic_partition_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """A second write holding only the recent years leaves the older ones alone."""
    path = scratch_path(spark, "municipio")
    whole = _raw_city(spark, sf)
    write_partitioned(whole.withColumn("versao", F.lit(1)), path)
    again = whole.where(F.col("ano") >= NEW_YEARS).withColumn("versao", F.lit(2))
    write_partitioned(again, path)
    return read_table(spark, path)


# --- conforming --------------------------------------------------------------


def rename_columns(spark: SparkSession, sf: str) -> DataFrame:
    return _as_text(conform.rename_columns(views.raw_micro(spark, sf)), "in_alfabetizado")


def cast_by_prefix(spark: SparkSession, sf: str) -> DataFrame:
    """Text columns; the priority is no number and becomes NULL."""
    texts = views.table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("string").alias("taxa_preco"),
        F.col("o_custkey").cast("string").alias("meta_cliente"),
        F.col("o_orderpriority").alias("percentual_prioridade"),
        F.year("o_orderdate").cast("string").alias("proporcao_ano"),
        F.col("o_orderstatus").alias("nome_taxa"),
    )
    return conform.cast_by_prefix(texts)


def cast_keys_if_present(spark: SparkSession, sf: str) -> DataFrame:
    """Padded text keys, and no ``serie`` column at all."""
    texts = views.raw_micro(spark, sf).select(
        F.col("NU_ANO_AVALIACAO").cast("string").alias("ano"),
        F.concat(F.col("CO_MUNICIPIO").cast("string"), F.lit(".0")).alias(CITY),
        F.concat(F.lit("  "), F.col("SG_UF"), F.lit(" ")).alias(STATE),
        F.col("ID_ALUNO").alias("id_aluno"),
    )
    return conform.cast_keys(texts)


def cast_microdata(spark: SparkSession, sf: str) -> DataFrame:
    raw = views.raw_micro(spark, sf)
    texts = raw.select(*[F.col(name).cast("string").alias(name) for name in raw.columns])
    typed = conform.cast_microdata(conform.rename_columns(texts))
    return _as_text(typed, "in_alfabetizado")


def trim_keys(spark: SparkSession, sf: str) -> DataFrame:
    padded = views.table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit("   ")).alias("rede"),
        F.concat(F.col("o_orderstatus"), F.lit(" ")).alias(STATE),
    )
    return conform.trim_keys(padded, ["rede", STATE])


def _mixed_networks(spark: SparkSession, sf: str) -> DataFrame:
    """Networks as padded code, as text, as unknown code and missing."""
    code = F.substring("o_orderpriority", 1, 1)
    label = F.expr("substring(o_orderpriority, 3)")
    status = F.col("o_orderstatus")
    return views.table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("ano"),
        F.col("o_orderkey").cast("string").alias("id_aluno"),
        F.when(status == "F", F.concat(F.lit(" "), code, F.lit(" ")))
        .when(status == "O", label)
        .when(code != "5", "9")
        .alias("rede"),
    )


def code_to_label(spark: SparkSession, sf: str) -> DataFrame:
    return _as_text(conform.add_network(_mixed_networks(spark, sf), LABELS), "rede_codigo")


def conform_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    raw = _raw_city(spark, sf)
    # A column outside the prefixes and keys keeps the type it was read with.
    kept = ("media_portugues",)
    texts = raw.select(
        *[F.col(n) if n in kept else F.col(n).cast("string").alias(n) for n in raw.columns]
    )
    return conform.conform_aggregate(texts, LABELS)


def cut_score_flag(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of partly delivered orders are missing and count as below."""
    orders = views.table(spark, sf, "orders")
    scored = orders.select(
        F.col("o_orderkey").cast("string").alias("id_aluno"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("proficiencia_lp"),
    )
    return conform.flag_cut_score(scored, cut=CUT)


# --- targets -----------------------------------------------------------------


def _joined(spark: SparkSession, sf: str, entity: str) -> DataFrame:
    pupils = workspace.silver_micro(spark, sf)
    return targets.attach_targets(
        views.results(pupils, entity), views.targets(pupils, entity), entity, TARGET_YEARS
    ).withColumnRenamed("taxa_alfabetizacao", "taxa_alfabetizacao_resultado")


def _join_left_targets(entity: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return _joined(spark, sf, entity).select(
            "ano",
            entity,
            "rede_codigo",
            "rede_descricao",
            "taxa_alfabetizacao_resultado",
            *[f"{TARGET_PREFIX}{year}" for year in TARGET_YEARS],
            "percentual_participacao",
        )

    return query


_TARGET_KEYS = ("ano", CITY, "rede_descricao", "taxa_alfabetizacao_resultado")


def target_for_year(spark: SparkSession, sf: str) -> DataFrame:
    dated = targets.target_for_year(_joined(spark, sf, CITY), TARGET_YEARS)
    return dated.select(*_TARGET_KEYS, "meta_ano")


def target_gap(spark: SparkSession, sf: str) -> DataFrame:
    dated = targets.target_for_year(_joined(spark, sf, CITY), TARGET_YEARS)
    return targets.target_gap(dated).select(*_TARGET_KEYS, "meta_ano", "gap_meta")


def target_status(spark: SparkSession, sf: str) -> DataFrame:
    compared = targets.compare_with_target(_joined(spark, sf, CITY), TARGET_YEARS)
    return compared.select(*_TARGET_KEYS, "meta_ano", "gap_meta", "status_meta")


def _gold(entity: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        pupils = workspace.silver_micro(spark, sf)
        return gold.gold_indicator(
            views.results(pupils, entity), views.targets(pupils, entity), entity, TARGET_YEARS
        )

    return query


def gold_national(spark: SparkSession, sf: str) -> DataFrame:
    return gold.gold_national(views.national(workspace.silver_micro(spark, sf)), TARGET_YEARS)


def gold_micro_city(spark: SparkSession, sf: str) -> DataFrame:
    return gold.gold_micro(workspace.silver_micro(spark, sf), cut=CUT)


def incremental_load(spark: SparkSession, sf: str) -> DataFrame:
    """Unit records that land in two loads and are taken in by three runs, the last of which finds nothing."""
    bronze, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    raw, pupil = views.raw_micro(spark, sf), ENTITIES["aluno"]
    second = F.col("ID_ALUNO").cast("bigint") % 3 == 0

    def load() -> int:
        conformed = lambda df: conform.conform_microdata(df, LABELS, CUT)
        return len(incremental.load_entity(spark, bronze, silver, "aluno", conformed).loads)

    land_delimited(raw.where(~second), bronze, pupil, "2024-01-15")
    taken = [load()]
    land_delimited(raw.where(second), bronze, pupil, "2024-02-15")
    taken += [load(), load()]
    rolled = gold.gold_micro(read_table(spark, f"{silver}/aluno"), cut=CUT)
    return rolled.withColumn("cargas_por_execucao", F.lit("-".join(map(str, taken))))


# --- filters, joins, aggregates, sorts ---------------------------------------


def latest_year(spark: SparkSession, sf: str) -> DataFrame:
    latest = keep_latest(workspace.gold_city(spark, sf))
    return latest.groupBy("ano").agg(F.count(F.lit(1)).alias("n_rows"))


def latest_year_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """All rows of the latest year, which is known from the names of folders."""
    city = workspace.gold_city(spark, sf)
    return keep_newest(spark, workspace.path_of(spark, sf, "indicador_municipio"), city.schema)


def filter_equals(spark: SparkSession, sf: str) -> DataFrame:
    below = _gold(CITY)(spark, sf).where(F.col("status_meta") == targets.BELOW)
    return below.select("ano", CITY, "rede", "gap_meta", "status_meta")


def _supplier_cities(spark: SparkSession, sf: str) -> DataFrame:
    city = F.col("s_nationkey") * 100 + F.col("s_suppkey") % views.CITIES_PER_STATE
    return views.table(spark, sf, "supplier").select(city.cast("int").alias(CITY))


def join_anti_orphans(spark: SparkSession, sf: str) -> DataFrame:
    pupils = workspace.silver_micro(spark, sf)
    return quality.orphan_keys(pupils, _supplier_cities(spark, sf), CITY)


def distinct_keys(spark: SparkSession, sf: str) -> DataFrame:
    return quality.distinct_keys(workspace.silver_micro(spark, sf), CITY)


def rollup(spark: SparkSession, sf: str) -> DataFrame:
    keys = ("ano", STATE, CITY, "rede")
    return rate_rollup(workspace.silver_micro(spark, sf), keys, cut=CUT)


def rollup_from_state(spark: SparkSession, sf: str) -> DataFrame:
    """Three loads, taken in one after another; orders ship in several of them. Two sets of keys from one state."""
    year = F.year("l_shipdate")
    lines = views.table(spark, sf, "lineitem").select(
        F.concat(F.lit("carga-"), year % 3).alias(LOAD_COLUMN),
        year.alias("ano"),
        F.col("l_returnflag").alias("rede"),
        F.col("l_linenumber").alias("serie"),
        F.col("l_orderkey").alias("id_aluno"),
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity")).alias("proficiencia_lp"),
        F.when(F.col("l_returnflag") != "A", (F.col("l_linestatus") == "F").cast("int")).alias("in_alfabetizado"),
        (F.col("l_quantity") >= 25).cast("int").alias("fl_alfabetizado_calculado"),
    )
    path, keys = scratch_path(spark, "rollup"), ("ano", "rede", "serie")
    for load in range(3):
        rollup_state.add_loads(lines, path, [f"carga-{load}"], keys)
    fine = rollup_state.rollup_of_state(spark, path, keys, cut=CUT)
    coarse = rollup_state.rollup_of_state(spark, path, ("rede",), cut=CUT)
    return _as_text(fine.unionByName(coarse, allowMissingColumns=True), "ano", "serie")


def agg_count_distinct(spark: SparkSession, sf: str) -> DataFrame:
    lines = views.table(spark, sf, "lineitem").withColumn("ano", F.year("l_shipdate"))
    return lines.groupBy("ano", "l_returnflag").agg(
        F.countDistinct("l_orderkey").alias("qtd_pedidos"), F.count(F.lit(1)).alias("n_rows")
    )


def agg_flag_rate(spark: SparkSession, sf: str) -> DataFrame:
    return (
        workspace.silver_micro(spark, sf)
        .groupBy("ano", STATE)
        .agg(
            rate(F.col("in_alfabetizado")).alias("taxa_oficial"),
            rate(F.col("fl_alfabetizado_calculado")).alias("taxa_calculada"),
        )
    )


_RESULT_TIES = (CITY, "rede", "ano")


def _city_results(spark: SparkSession, sf: str) -> DataFrame:
    return views.results(workspace.silver_micro(spark, sf), CITY).select(
        "ano", CITY, "rede", "taxa_alfabetizacao", "media_portugues"
    )


def _gappy_results(spark: SparkSession, sf: str) -> DataFrame:
    return _city_results(spark, sf).select(
        "ano",
        CITY,
        "rede",
        F.when(F.col("ano") != NEW_YEARS, F.col("taxa_alfabetizacao")).alias("taxa"),
        "media_portugues",
    )


def sort_all_nulls_last(spark: SparkSession, sf: str) -> DataFrame:
    """A full sort, every row of it."""
    return _gappy_results(spark, sf).orderBy(*descending("taxa"), *ascending(*_RESULT_TIES))


def sort_nulls_last(spark: SparkSession, sf: str) -> DataFrame:
    """Both ends of the sort of ``sort_all_nulls_last``, missing rates included."""
    gappy = _gappy_results(spark, sf)
    ordered = [*descending("taxa"), *ascending(*_RESULT_TIES)]
    backwards = [F.col("taxa").asc_nulls_first(), *[F.col(c).desc() for c in _RESULT_TIES]]
    ends = (
        gappy.orderBy(*order).limit(60).select(F.lit(name).alias("ponta"), "*")
        for name, order in (("inicio", ordered), ("fim", backwards))
    )
    return reduce(DataFrame.unionAll, ends)


def topk_lowest(spark: SparkSession, sf: str) -> DataFrame:
    return top_k(_city_results(spark, sf), ascending("taxa_alfabetizacao"), _RESULT_TIES, 50)


# --- quality -----------------------------------------------------------------


def dq_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    lines = views.table(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("ano"), F.col("l_orderkey").alias("id_aluno")
    )
    return quality.check_duplicates(lines, "lineitem")


def dq_range(spark: SparkSession, sf: str) -> DataFrame:
    """Prices above 100 and balances below 0 after scaling; missing for some."""
    orders = views.table(spark, sf, "orders")
    customers = views.table(spark, sf, "customer")
    scaled = orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        (F.col("o_totalprice") / 4000).alias("taxa_preco"),
        (F.col("c_acctbal") / 100).alias("meta_saldo"),
        F.when(F.col("o_orderstatus") != "P", F.col("c_acctbal")).alias("percentual_saldo"),
        F.col("o_totalprice").alias("proporcao_preco"),
    )
    return quality.check_range(scaled, "orders")


def dq_negative(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_negative(views.table(spark, sf, "customer"), "customer", "c_acctbal")


def dq_cut_agreement(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_cut_agreement(workspace.silver_micro(spark, sf), "aluno", cut=CUT)


def dq_referential(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_referential(
        workspace.silver_micro(spark, sf), _supplier_cities(spark, sf), "aluno"
    )


def dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_not_null(code_to_label(spark, sf), "orders")


def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    """All gates over the stored conformed tables."""
    results, targets_ = workspace.silver_pair(spark, sf, CITY)
    return quality.quality_report(workspace.silver_micro(spark, sf), results, targets_, cut=CUT)


# --- feed --------------------------------------------------------------------


def _land_feed(spark: SparkSession, sf: str, broken: bool = False) -> str:
    """Events as JSON lines of encoded envelopes; error events may be cut short."""
    event = F.to_json(
        F.struct(
            "event_id",
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_ts"),
            "user_id",
            "event_type",
            "value",
            "props",
        )
    )
    if broken:
        cut = F.substring_index(event, '"value"', 1)
        event = F.when(F.col("event_type") == "error", cut).otherwise(event)
    source = scratch_path(spark, "feed")
    encoded = F.base64(F.encode(event, "UTF-8"))
    views.table(spark, sf, "events").select(
        F.struct(encoded.alias("data")).alias("kinesis")
    ).write.json(source)
    return source


def _ingest(
    spark: SparkSession, source: str, target: str, checkpoint: str, files: int | None = None
) -> int:
    envelopes = feed.read_envelopes(spark, source, files)
    return feed.ingest(envelopes, target, checkpoint, FEED_FIELDS).total


def stream_envelope_ingest(spark: SparkSession, sf: str) -> DataFrame:
    target = scratch_path(spark, "eventos")
    _ingest(spark, _land_feed(spark, sf), target, scratch_path(spark, "checkpoint"))
    stored = feed.read_events(spark, target, fields=FEED_FIELDS)
    stamped = F.col("_ingestion_ts").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}\+00:00$")
    return stored.select(*FEED_FIELDS, stamped.alias("stamped"))


def stream_bad_records(spark: SparkSession, sf: str) -> DataFrame:
    """Both outputs: whole events by their id, cut ones by their original text."""
    target = scratch_path(spark, "eventos")
    _ingest(spark, _land_feed(spark, sf, broken=True), target, scratch_path(spark, "checkpoint"))
    good = feed.read_events(spark, target, feed.VALID, FEED_FIELDS)
    bad = feed.read_events(spark, target, feed.INVALID, FEED_FIELDS)
    original = F.unbase64("rejected").cast("string")
    return good.select(
        feed.STATE_COLUMN, F.col("event_id").cast("string").alias("event")
    ).unionByName(bad.select(feed.STATE_COLUMN, original.alias("event")))


def stream_empty_batch(spark: SparkSession, sf: str) -> DataFrame:
    """A second run finds nothing new: it reports 0 and adds no rows."""
    source = _land_feed(spark, sf)
    target, checkpoint = scratch_path(spark, "eventos"), scratch_path(spark, "checkpoint")
    first = _ingest(spark, source, target, checkpoint)
    second = _ingest(spark, source, target, checkpoint)
    stored = feed.read_events(spark, target, fields=FEED_FIELDS)
    return stored.agg(
        F.lit(first).cast("bigint").alias("reported_first"),
        F.lit(second).cast("bigint").alias("reported_second"),
        F.count(F.lit(1)).alias("stored"),
    )


def stream_redelivery(spark: SparkSession, sf: str) -> DataFrame:
    """Every event is delivered twice, half of the copies in a later run, and stored once."""
    source = _land_feed(spark, sf)
    target, checkpoint = scratch_path(spark, "eventos"), scratch_path(spark, "checkpoint")
    once = {"once_within": "24 hours", "key": ("event_id",)}
    envelopes = spark.read.schema(feed.ENVELOPE).json(source)
    envelopes.where(F.xxhash64("kinesis.data") % 2 == 0).write.mode("append").json(source)
    feed.ingest(feed.read_envelopes(spark, source), target, checkpoint, FEED_FIELDS, **once)
    envelopes.where(F.xxhash64("kinesis.data") % 2 != 0).dropDuplicates().write.mode("append").json(source)
    second = feed.ingest(feed.read_envelopes(spark, source), target, checkpoint, FEED_FIELDS, **once).total
    stored = feed.read_events(spark, target, fields=FEED_FIELDS)
    return stored.select("event_id", "event_type", F.lit(second).cast("bigint").alias("stored_again"))


# --- the twelve questions ----------------------------------------------------


def _on_city(question: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: question(workspace.gold_city(spark, sf))


def _on_state(question: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: question(workspace.gold_state(spark, sf))


def _on_country(question: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: question(workspace.gold_country(spark, sf))


def q02_entity_history(spark: SparkSession, sf: str) -> DataFrame:
    return reports.entity_history(workspace.gold_city(spark, sf), FOLLOWED_CITY)


def q04_lowest_micro_rate(spark: SparkSession, sf: str) -> DataFrame:
    return reports.lowest_micro_rate(workspace.gold_pupils(spark, sf), cut=CUT)


def q11_official_vs_micro(spark: SparkSession, sf: str) -> DataFrame:
    return reports.official_vs_micro(
        workspace.gold_city(spark, sf), workspace.gold_pupils(spark, sf), cut=CUT
    )


QUERIES: dict[str, Query] = {
    "csv_roundtrip_comma": csv_roundtrip_comma,
    "csv_roundtrip_semicolon_latin1": csv_roundtrip_semicolon_latin1,
    "csv_infer_types": csv_infer_types,
    "partition_discovery": partition_discovery,
    "partition_load_select": partition_load_select,
    "parquet_scan": parquet_scan,
    "parquet_scan_pushed_filter": parquet_scan_pushed_filter,
    "catalog_table_scan": catalog_table_scan,
    "catalog_repair_partitions": catalog_repair_partitions,
    "publish_versions": publish_versions,
    "questions_in_catalog": questions_in_catalog,
    "parquet_partitioned_write": parquet_partitioned_write,
    "parquet_two_level_write": parquet_two_level_write,
    "dynamic_partition_overwrite": dynamic_partition_overwrite,
    "rename_columns": rename_columns,
    "cast_by_prefix": cast_by_prefix,
    "cast_keys_if_present": cast_keys_if_present,
    "cast_microdata": cast_microdata,
    "trim_keys": trim_keys,
    "code_to_label": code_to_label,
    "conform_aggregate": conform_aggregate,
    "cut_score_flag": cut_score_flag,
    "target_for_year": target_for_year,
    "target_gap": target_gap,
    "target_status": target_status,
    "latest_year": latest_year,
    "latest_year_by_name": latest_year_by_name,
    "filter_equals": filter_equals,
    "join_left_targets_city": _join_left_targets(CITY),
    "join_left_targets_state": _join_left_targets(STATE),
    "join_anti_orphans": join_anti_orphans,
    "distinct_keys": distinct_keys,
    "rate_rollup": rollup,
    "rollup_from_state": rollup_from_state,
    "agg_count_distinct": agg_count_distinct,
    "agg_flag_rate": agg_flag_rate,
    "sort_nulls_last": sort_nulls_last,
    "sort_all_nulls_last": sort_all_nulls_last,
    "topk_lowest": topk_lowest,
    "dq_duplicates": dq_duplicates,
    "dq_range": dq_range,
    "dq_negative": dq_negative,
    "dq_cut_agreement": dq_cut_agreement,
    "dq_referential": dq_referential,
    "dq_not_null": dq_not_null,
    "dq_report": dq_report,
    "stream_envelope_ingest": stream_envelope_ingest,
    "stream_bad_records": stream_bad_records,
    "stream_empty_batch": stream_empty_batch,
    "stream_redelivery": stream_redelivery,
    "gold_micro_city": gold_micro_city,
    "incremental_load": incremental_load,
    "gold_city": _gold(CITY),
    "gold_state": _gold(STATE),
    "gold_national": gold_national,
    "q01_below_target_latest": _on_city(reports.below_target_latest),
    "q02_entity_history": q02_entity_history,
    "q03_state_ranking": _on_state(reports.state_ranking),
    "q04_lowest_micro_rate": q04_lowest_micro_rate,
    "q05_largest_gaps": _on_city(reports.largest_gaps),
    "q06_mean_by_network": _on_city(reports.mean_by_network),
    "q07_situation_band": _on_country(reports.national_situation),
    "q08_national_summary": _on_country(reports.national_summary),
    "q09_status_distribution": _on_city(reports.status_distribution),
    "q10_gap_band": _on_city(reports.gap_bands),
    "q11_official_vs_micro": q11_official_vs_micro,
    "q12_best_worst": _on_city(reports.best_worst),
}
