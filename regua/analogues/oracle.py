"""The same questions as plain SQL over the driver's tables."""

from __future__ import annotations

TARGET_YEARS = range(1996, 2002)
CUT = 250000
NEW_YEARS = 1999
FOLLOWED_CITY = 217
TARGETS = [f"meta_alfabetizacao_{year}" for year in TARGET_YEARS]


def rounded(value: str, digits: int) -> str:
    kept = "".join(
        f" WHEN ABS({value}) < {limit} THEN CAST(ROUND(CAST({value} AS DECIMAL(38,{scale})), {digits}) AS DOUBLE)"
        for limit, scale in ((1000, 12), (1000000, 9), (1000000000, 6))
    )
    return f"CASE{kept} ELSE ROUND({value}, {digits}) END"


def percentage(part: str, whole: str, digits: int = 2) -> str:
    """Whole numbers only, rounded half up once."""
    doubled = f"CAST({part} AS HUGEINT) * {2 * 10 ** (digits + 2)} + {whole}"
    return f"CAST(({doubled}) // (2 * {whole}) AS DOUBLE) / {10**digits}"


def mean(value: str, digits: int = 2) -> str:
    return rounded(f"AVG({value})", digits)


def rate(flag: str) -> str:
    return percentage(f"SUM({flag})", f"COUNT({flag})")


def label(code: str, text: str) -> str:
    return (
        f"CASE {code} WHEN 1 THEN 'URGENT' WHEN 2 THEN 'HIGH' WHEN 3 THEN 'MEDIUM' "
        f"WHEN 4 THEN 'NOT SPECIFIED' WHEN 5 THEN 'LOW' ELSE {text} END"
    )


RAW_MICRO = """
raw_micro AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS NU_ANO_AVALIACAO,
         CAST(n_nationkey AS INTEGER) AS CO_UF,
         n_name AS SG_UF,
         CAST(o_orderkey AS VARCHAR) AS ID_ALUNO,
         CAST(2 AS INTEGER) AS TP_SERIE,
         CAST(o_custkey AS INTEGER) AS ID_ESCOLA,
         substr(o_orderpriority, 1, 1) AS TP_DEPENDENCIA,
         CAST(c_nationkey * 100 + c_custkey % 20 AS INTEGER) AS CO_MUNICIPIO,
         'São ' || n_name AS NO_MUNICIPIO,
         c_acctbal / 100 AS VL_PESO_ALUNO_LP,
         o_totalprice AS VL_PROFICIENCIA_LP,
         CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS INTEGER) AS IN_ALFABETIZADO
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
)"""

MICRO = f"""{RAW_MICRO},
micro AS (
  SELECT NU_ANO_AVALIACAO AS ano, CO_UF AS id_uf, SG_UF AS sigla_uf, ID_ALUNO AS id_aluno,
         TP_SERIE AS serie, ID_ESCOLA AS id_escola, TP_DEPENDENCIA AS rede,
         CO_MUNICIPIO AS id_municipio, NO_MUNICIPIO AS nome_municipio,
         VL_PESO_ALUNO_LP AS peso_aluno_lp, VL_PROFICIENCIA_LP AS proficiencia_lp,
         IN_ALFABETIZADO AS in_alfabetizado,
         CAST(CASE WHEN VL_PROFICIENCIA_LP >= {CUT} THEN 1 ELSE 0 END AS INTEGER)
           AS fl_alfabetizado_calculado,
         CAST(TP_DEPENDENCIA AS INTEGER) AS rede_codigo,
         {label("CAST(TP_DEPENDENCIA AS INTEGER)", "TP_DEPENDENCIA")} AS rede_descricao
  FROM raw_micro
)"""


def results(entity: str) -> str:
    return f"""
raw_result AS (
  SELECT ano, {entity}, CAST(2 AS INTEGER) AS serie, rede,
         {rate("in_alfabetizado")} AS taxa_alfabetizacao,
         {mean("proficiencia_lp", 4)} AS media_portugues
  FROM micro GROUP BY ano, {entity}, rede
),
result AS (
  SELECT *, CAST(rede AS INTEGER) AS rede_codigo,
         {label("CAST(rede AS INTEGER)", "rede")} AS rede_descricao
  FROM raw_result
)"""


def targets(entity: str) -> str:
    yearly = ",\n".join(
        f"{rate(f'CASE WHEN ano = {y} THEN fl_alfabetizado_calculado END')} "
        f"AS meta_alfabetizacao_{y}"
        for y in TARGET_YEARS
    )
    return f"""
target AS (
  SELECT p.ano, t.* FROM (
    SELECT {entity}, rede_descricao, {yearly},
           {rate("CASE WHEN in_alfabetizado IS NOT NULL THEN 1 ELSE 0 END")}
             AS percentual_participacao
    FROM micro WHERE rede_descricao <> 'LOW' GROUP BY {entity}, rede_descricao
  ) t CROSS JOIN (SELECT DISTINCT ano FROM micro WHERE ano IS NOT NULL) p
)"""


_CASES = " ".join(f"WHEN {y} THEN meta_alfabetizacao_{y}" for y in TARGET_YEARS)
PICK = f"CASE ano {_CASES} END"
TARGET_LIST = ", ".join(TARGETS)
STATUS = """CASE WHEN meta_ano IS NULL THEN 'SEM_META'
            WHEN gap_meta >= 0 THEN 'ATINGIU_META' ELSE 'ABAIXO_META' END"""


def joined(entity: str) -> str:
    on = f"r.ano = t.ano AND r.{entity} = t.{entity} AND r.rede_descricao = t.rede_descricao"
    chosen = ", ".join(f"t.{name}" for name in TARGETS)
    return f"""WITH {MICRO}, {results(entity)}, {targets(entity)},
joined AS (
  SELECT r.ano, r.{entity}, r.serie, r.rede_codigo, r.rede_descricao,
         r.taxa_alfabetizacao AS taxa_alfabetizacao_resultado, r.media_portugues,
         {chosen}, t.percentual_participacao
  FROM result r LEFT JOIN target t ON {on}
)"""


def compared(source: str) -> str:
    gap = rounded("taxa_alfabetizacao_resultado - meta_ano", 2)
    return f"""
dated AS (SELECT *, {PICK} AS meta_ano FROM {source}),
gapped AS (SELECT *, {gap} AS gap_meta FROM dated),
compared AS (SELECT *, {STATUS} AS status_meta FROM gapped)"""


def gold(entity: str) -> str:
    return f"""{joined(entity)}, {compared("joined")},
gold AS (
  SELECT ano, {entity}, serie, rede_descricao AS rede, taxa_alfabetizacao_resultado,
         media_portugues, {TARGET_LIST}, percentual_participacao, meta_ano, gap_meta, status_meta
  FROM compared
)"""


def rollup(keys: str) -> str:
    return f"""
  SELECT {keys},
         COUNT(DISTINCT id_aluno) AS qtd_alunos,
         {mean("proficiencia_lp", 4)} AS media_proficiencia_lp,
         {rate("in_alfabetizado")} AS taxa_alfabetizacao_microdados,
         {rate("fl_alfabetizado_calculado")} AS taxa_alfabetizacao_calculada_{CUT}
  FROM micro GROUP BY ALL"""


GOLD_MICRO = f"""
gold_micro AS ({rollup("ano, sigla_uf, id_municipio, nome_municipio, rede_descricao AS rede")})"""

_NATIONAL_TARGETS = ", ".join(
    f"MAX(CASE WHEN ano = {y} AND rede <> 'LOW' THEN calculada END) OVER (PARTITION BY rede) "
    f"AS meta_alfabetizacao_{y}"
    for y in TARGET_YEARS
)
NATIONAL = f"""WITH {MICRO},
by_year AS (
  SELECT ano, rede_descricao AS rede,
         {rate("in_alfabetizado")} AS taxa_alfabetizacao_resultado,
         {rate("fl_alfabetizado_calculado")} AS calculada,
         {rate("CASE WHEN in_alfabetizado IS NOT NULL THEN 1 ELSE 0 END")}
           AS percentual_participacao
  FROM micro GROUP BY ano, rede_descricao
),
country AS (
  SELECT ano, rede, taxa_alfabetizacao_resultado, {_NATIONAL_TARGETS}, percentual_participacao
  FROM by_year
), {compared("country")}"""

CITY_VIEW = """ano, id_municipio, rede, taxa_alfabetizacao_resultado, meta_ano, gap_meta,
  status_meta"""
CITY = gold("id_municipio")
STATE = gold("sigla_uf")
LATEST = "ano = (SELECT MAX(ano) FROM gold)"
CITY_TIES = "id_municipio, rede, serie, ano"


def report_row(check: str, table: str, column: str, bad: str, total: str, limit: int) -> str:
    """One row of a quality report over counts named by the caller."""
    return f"""
  SELECT '{check}' AS "check", '{table}' AS "table", '{column}' AS "column",
         CAST({bad} AS BIGINT) AS violations, CAST({total} AS BIGINT) AS total,
         CASE WHEN {total} > 0
              THEN {percentage(bad, total, 4)} ELSE 0.0 END AS pct,
         CASE WHEN {bad} * 100 > {total} * {limit} THEN 'fail'
              WHEN {bad} > 0 THEN 'warn' ELSE 'ok' END AS severity"""


def row_check(check: str, table: str, column: str, bad: str, source: str, limit: int = 0) -> str:
    count = f"COUNT(*) FILTER (WHERE {bad})"
    return report_row(check, table, column, count, "COUNT(*)", limit) + f" FROM {source}"


def key_check(check: str, table: str, key: str, source: str, limit: int = 0) -> str:
    listed = key.replace(" ", "")
    count = "COUNT(*) FILTER (WHERE qtd > 1)"
    groups = f"(SELECT {key}, COUNT(*) AS qtd FROM {source} GROUP BY {key})"
    return report_row(check, table, listed, count, "COUNT(*)", limit) + f" FROM {groups}"


def outside(column: str) -> str:
    return f"{column} < 0 OR {column} > 100"


DISAGREES = f"""(proficiencia_lp >= {CUT} AND in_alfabetizado <> 1)
    OR (proficiencia_lp < {CUT} AND in_alfabetizado <> 0)"""
SUPPLIER_CITIES = """
supplier_city AS (
  SELECT DISTINCT CAST(s_nationkey * 100 + s_suppkey % 20 AS INTEGER) AS id_municipio FROM supplier
)"""


def referential(reference: str) -> str:
    orphan = f"id_municipio NOT IN (SELECT id_municipio FROM {reference})"
    source = "(SELECT DISTINCT id_municipio FROM micro)"
    return row_check("referential", "aluno", "id_municipio", orphan, source, 1)


def dq_report() -> str:
    parts = [
        key_check("duplicate_key", "aluno", "ano, id_aluno", "micro"),
        row_check("range_0_100", "municipio", "taxa_alfabetizacao",
                  outside("taxa_alfabetizacao"), "result"),
        *[
            row_check("range_0_100", "meta_municipio", name, outside(name), "target")
            for name in [*TARGETS, "percentual_participacao"]
        ],
        row_check("negative", "aluno", "proficiencia_lp", "proficiencia_lp < 0", "micro"),
        row_check("cut_agreement", "aluno", "in_alfabetizado", DISAGREES, "micro", 1),
        row_check("not_null", "aluno", "rede_descricao", "rede_descricao IS NULL", "micro"),
        referential("result"),
        key_check("target_key", "meta_municipio", "ano, id_municipio, rede_descricao", "target",
                  100),
    ]
    head = f"WITH {MICRO}, {results('id_municipio')}, {targets('id_municipio')}"
    return head + " UNION ALL ".join(parts)


MIXED = """
mixed AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(o_orderkey AS VARCHAR) AS id_aluno,
         CASE WHEN o_orderstatus = 'F' THEN substr(o_orderpriority, 1, 1)
              WHEN o_orderstatus = 'O' THEN substr(o_orderpriority, 3)
              WHEN substr(o_orderpriority, 1, 1) <> '5' THEN '9' END AS rede
  FROM orders
),
labelled AS (
  SELECT *, TRY_CAST(rede AS INTEGER) AS rede_codigo,
         """ + label("TRY_CAST(rede AS INTEGER)", "rede") + """ AS rede_descricao
  FROM mixed
)"""

_TARGET_KEYS = "ano, id_municipio, rede_descricao, taxa_alfabetizacao_resultado"

# Labels and limits of the bands, here and in q07, and of the ranking in q12.
BANDED = f"""
banded AS (
  SELECT *, CASE WHEN gap_meta >= 0 THEN 'Atingiu ou superou'
                 WHEN gap_meta BETWEEN -5 AND -0.01 THEN 'Até 5 p.p. abaixo'
                 WHEN gap_meta BETWEEN -10 AND -5.01 THEN 'Entre 5 e 10 p.p. abaixo'
                 WHEN gap_meta BETWEEN -20 AND -10.01 THEN 'Entre 10 e 20 p.p. abaixo'
                 ELSE 'Mais de 20 p.p. abaixo' END AS faixa_gap
  FROM gold WHERE {LATEST}
)"""


def distribution(by: str, source: str) -> str:
    return f"""
SELECT ano, rede, {by}, COUNT(*) AS qtd_municipios,
       {mean("taxa_alfabetizacao_resultado")} AS media_resultado,
       {mean("gap_meta")} AS gap_medio
FROM {source} GROUP BY ano, rede, {by}"""


RESULT = "taxa_alfabetizacao_resultado"

# Results with gaps: the rate of one year is missing.
GAPPY = f"""
gappy AS (
  SELECT ano, id_municipio, rede, CASE WHEN ano <> {NEW_YEARS} THEN taxa_alfabetizacao END AS taxa,
         media_portugues
  FROM result
)"""


def end_of_sort(name: str, order: str) -> str:
    return f"(SELECT '{name}' AS ponta, * FROM gappy ORDER BY {order} LIMIT 60)"


ORACLE: dict[str, str] = {
    "csv_roundtrip_comma": f"""
WITH {MICRO}, {results("id_municipio")}
SELECT *, 'manual' AS dt_carga FROM raw_result""",
    "csv_roundtrip_semicolon_latin1": f"""
WITH {RAW_MICRO}
SELECT * REPLACE (CAST(IN_ALFABETIZADO AS VARCHAR) AS IN_ALFABETIZADO), 'manual' AS dt_carga
FROM raw_micro""",
    "csv_infer_types": f"""
WITH {MICRO}, {results("id_municipio")}
SELECT * REPLACE (CAST(rede AS INTEGER) AS rede), 'manual' AS dt_carga FROM raw_result""",
    "partition_discovery": f"""
SELECT CASE WHEN year(o_orderdate) >= {NEW_YEARS} THEN '2024-02-15' ELSE '2024-01-15' END
         AS dt_carga,
       CAST(year(o_orderdate) AS INTEGER) AS ano, COUNT(*) AS n_rows
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY ALL""",
    "parquet_scan": f"""
WITH {MICRO}, {results("id_municipio")} SELECT * FROM result""",
    "parquet_scan_pushed_filter": """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'""",
    "catalog_table_scan": " UNION ALL ".join(
        f"SELECT '{table}' AS tabela, ano, {entity} AS chave, rede, {rate_} AS taxa, {mark} AS marca "
        f"FROM ({source})"
        for table, entity, rate_, mark, source in (
            ("indicador_municipio", "CAST(id_municipio AS VARCHAR)", RESULT, "status_meta",
             f"{CITY} SELECT * FROM gold"),
            ("indicador_uf", "sigla_uf", RESULT, "status_meta", f"{STATE} SELECT * FROM gold"),
            ("indicador_brasil", "NULL", RESULT, "status_meta", f"{NATIONAL} SELECT * FROM compared"),
            ("aluno_municipio", "CAST(id_municipio AS VARCHAR)", "taxa_alfabetizacao_microdados",
             "nome_municipio", f"WITH {MICRO}, {GOLD_MICRO} SELECT * FROM gold_micro"),
        )
    ),
    "catalog_repair_partitions": f"""
WITH {MICRO}, {GOLD_MICRO}
SELECT ano, COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS n_rows_before FROM gold_micro GROUP BY ano""",
    "publish_versions": f"""
WITH {MICRO}, {GOLD_MICRO}
SELECT *, CAST(CASE WHEN ano >= {NEW_YEARS} THEN 2 ELSE 1 END AS INTEGER) AS versao FROM gold_micro""",
    "parquet_partitioned_write": f"""
WITH {MICRO}, {results("id_municipio")} SELECT * FROM result""",
    "parquet_two_level_write": f"""
WITH {MICRO}
SELECT * REPLACE (CAST(in_alfabetizado AS VARCHAR) AS in_alfabetizado) FROM micro""",
    "partition_load_select": f"""
WITH {MICRO}, {results("id_municipio")}
SELECT ano, id_municipio, serie, rede, taxa_alfabetizacao, media_portugues,
       CAST(NULL AS VARCHAR) AS observacao, '2024-01' AS dt_carga
FROM raw_result WHERE ano < {NEW_YEARS}
UNION ALL
SELECT ano, id_municipio, serie, rede, taxa_alfabetizacao, media_portugues,
       'x' || id_municipio, '2025-01'
FROM raw_result WHERE ano >= {NEW_YEARS}""",
    "dynamic_partition_overwrite": f"""
WITH {MICRO}, {results("id_municipio")}
SELECT *, CAST(CASE WHEN ano >= {NEW_YEARS} THEN 2 ELSE 1 END AS INTEGER) AS versao
FROM raw_result""",
    "rename_columns": f"""
WITH {MICRO}
SELECT * EXCLUDE (fl_alfabetizado_calculado, rede_codigo, rede_descricao)
         REPLACE (CAST(in_alfabetizado AS VARCHAR) AS in_alfabetizado)
FROM micro""",
    "cast_by_prefix": """
SELECT o_orderkey, o_totalprice AS taxa_preco, CAST(o_custkey AS DOUBLE) AS meta_cliente,
       TRY_CAST(o_orderpriority AS DOUBLE) AS percentual_prioridade,
       CAST(year(o_orderdate) AS DOUBLE) AS proporcao_ano, o_orderstatus AS nome_taxa
FROM orders""",
    "cast_keys_if_present": f"""
WITH {MICRO} SELECT ano, id_municipio, sigla_uf, id_aluno FROM micro""",
    "cast_microdata": f"""
WITH {MICRO}
SELECT * EXCLUDE (fl_alfabetizado_calculado, rede_codigo, rede_descricao)
         REPLACE (CAST(in_alfabetizado AS VARCHAR) AS in_alfabetizado)
FROM micro""",
    "trim_keys": """
SELECT o_orderkey, o_orderpriority AS rede, o_orderstatus AS sigla_uf FROM orders""",
    "code_to_label": f"""
WITH {MIXED}
SELECT * REPLACE (CAST(rede_codigo AS VARCHAR) AS rede_codigo) FROM labelled""",
    "conform_aggregate": f"""
WITH {MICRO}, {results("id_municipio")} SELECT * FROM result""",
    "cut_score_flag": f"""
SELECT CAST(o_orderkey AS VARCHAR) AS id_aluno,
       CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS proficiencia_lp,
       CAST(CASE WHEN o_orderstatus <> 'P' AND o_totalprice >= {CUT} THEN 1 ELSE 0 END AS INTEGER)
         AS fl_alfabetizado_calculado
FROM orders""",
    "target_for_year": f"""
{joined("id_municipio")}, {compared("joined")}
SELECT {_TARGET_KEYS}, meta_ano FROM dated""",
    "target_gap": f"""
{joined("id_municipio")}, {compared("joined")}
SELECT {_TARGET_KEYS}, meta_ano, gap_meta FROM gapped""",
    "target_status": f"""
{joined("id_municipio")}, {compared("joined")}
SELECT {_TARGET_KEYS}, meta_ano, gap_meta, status_meta FROM compared""",
    "latest_year": f"{CITY} SELECT ano, COUNT(*) AS n_rows FROM gold WHERE {LATEST} GROUP BY ano",
    "questions_in_catalog": f"""
{CITY}, below AS (
    SELECT {CITY_VIEW}, serie FROM gold WHERE status_meta = 'ABAIXO_META'
), q01 AS (
    SELECT {CITY_VIEW} FROM below WHERE {LATEST} ORDER BY gap_meta ASC NULLS LAST, {CITY_TIES} LIMIT 30
), q05 AS (
    SELECT {CITY_VIEW} FROM below ORDER BY gap_meta ASC NULLS LAST, {CITY_TIES} LIMIT 20
)
SELECT 'q01' AS pergunta, * FROM q01
UNION ALL SELECT 'q02', {CITY_VIEW} FROM gold WHERE id_municipio = {FOLLOWED_CITY}
UNION ALL SELECT 'q05', * FROM q05""",
    "latest_year_by_name": f"{CITY} SELECT * FROM gold WHERE {LATEST}",
    "filter_equals": f"""
{CITY} SELECT ano, id_municipio, rede, gap_meta, status_meta FROM gold
WHERE status_meta = 'ABAIXO_META'""",
    "join_left_targets_city": f"""
{joined("id_municipio")} SELECT * EXCLUDE (serie, media_portugues) FROM joined""",
    "join_left_targets_state": f"""
{joined("sigla_uf")} SELECT * EXCLUDE (serie, media_portugues) FROM joined""",
    "join_anti_orphans": f"""
WITH {MICRO}, {SUPPLIER_CITIES}
SELECT DISTINCT id_municipio FROM micro
WHERE id_municipio NOT IN (SELECT id_municipio FROM supplier_city)""",
    "distinct_keys": f"WITH {MICRO} SELECT DISTINCT id_municipio FROM micro",
    "rate_rollup": f"WITH {MICRO} {rollup('ano, sigla_uf, id_municipio, rede')}",
    "rollup_from_state": f"""
WITH micro AS (
  SELECT year(l_shipdate) AS ano, l_returnflag AS rede, l_linenumber AS serie, l_orderkey AS id_aluno,
         CASE WHEN l_linenumber <> 7 THEN l_quantity END AS proficiencia_lp,
         CASE WHEN l_returnflag <> 'A' THEN CAST(l_linestatus = 'F' AS INTEGER) END AS in_alfabetizado,
         CAST(l_quantity >= 25 AS INTEGER) AS fl_alfabetizado_calculado
  FROM lineitem)
{rollup("CAST(ano AS VARCHAR) AS ano, rede, CAST(serie AS VARCHAR) AS serie")}
UNION ALL
{rollup("CAST(NULL AS VARCHAR) AS ano, rede, CAST(NULL AS VARCHAR) AS serie")}""",
    "agg_count_distinct": """
SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, l_returnflag,
       COUNT(DISTINCT l_orderkey) AS qtd_pedidos, COUNT(*) AS n_rows
FROM lineitem GROUP BY ALL""",
    "agg_flag_rate": f"""
WITH {MICRO}
SELECT ano, sigla_uf, {rate("in_alfabetizado")} AS taxa_oficial,
       {rate("fl_alfabetizado_calculado")} AS taxa_calculada
FROM micro GROUP BY ano, sigla_uf""",
    "sort_nulls_last": f"WITH {MICRO}, {results('id_municipio')}, {GAPPY} "
    + end_of_sort("inicio", "taxa DESC NULLS LAST, id_municipio, rede, ano")
    + " UNION ALL "
    + end_of_sort("fim", "taxa ASC NULLS FIRST, id_municipio DESC, rede DESC, ano DESC"),
    "sort_all_nulls_last": f"WITH {MICRO}, {results('id_municipio')}, {GAPPY} "
    "SELECT * FROM gappy ORDER BY taxa DESC NULLS LAST, id_municipio, rede, ano",
    "topk_lowest": f"""
WITH {MICRO}, {results("id_municipio")}
SELECT ano, id_municipio, rede, taxa_alfabetizacao, media_portugues FROM result
ORDER BY taxa_alfabetizacao ASC NULLS LAST, id_municipio, rede, ano LIMIT 50""",
    "dq_duplicates": f"""
WITH lines AS (SELECT year(l_shipdate) AS ano, l_orderkey AS id_aluno FROM lineitem)
{key_check("duplicate_key", "lineitem", "ano, id_aluno", "lines")}""",
    "dq_range": f"""
WITH scaled AS (
  SELECT o_totalprice / 4000 AS taxa_preco, c_acctbal / 100 AS meta_saldo,
         CASE WHEN o_orderstatus <> 'P' THEN c_acctbal END AS percentual_saldo
  FROM orders JOIN customer ON o_custkey = c_custkey
)""" + " UNION ALL ".join(
        row_check("range_0_100", "orders", name, outside(name), "scaled")
        for name in ("taxa_preco", "meta_saldo", "percentual_saldo")
    ),
    "dq_negative": row_check("negative", "customer", "c_acctbal", "c_acctbal < 0", "customer"),
    "dq_cut_agreement": f"""
WITH {MICRO} {row_check("cut_agreement", "aluno", "in_alfabetizado", DISAGREES, "micro", 1)}""",
    "dq_referential": f"WITH {MICRO}, {SUPPLIER_CITIES} {referential('supplier_city')}",
    "dq_not_null": f"""
WITH {MIXED}
{row_check("not_null", "orders", "rede_descricao", "rede_descricao IS NULL", "labelled")}""",
    "dq_report": dq_report(),
    "stream_envelope_ingest": """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS event_ts, user_id, event_type, value,
       props, TRUE AS stamped
FROM events""",
    "stream_bad_records": f"""
SELECT 'valido' AS situacao, CAST(event_id AS VARCHAR) AS event
FROM events WHERE event_type <> 'error'
UNION ALL
SELECT 'invalido',
       '{{"event_id":' || event_id || ',"event_ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
       || '","user_id":' || user_id || ',"event_type":"' || event_type || '",'
FROM events WHERE event_type = 'error'""",
    "stream_empty_batch": """
SELECT COUNT(*) AS reported_first, CAST(0 AS BIGINT) AS reported_second, COUNT(*) AS stored
FROM events""",
    "stream_redelivery": "SELECT event_id, event_type, CAST(0 AS BIGINT) AS stored_again FROM events",
    "incremental_load": f"WITH {MICRO}, {GOLD_MICRO} SELECT *, '1-1-0' AS cargas_por_execucao FROM gold_micro",
    "gold_micro_city": f"WITH {MICRO}, {GOLD_MICRO} SELECT * FROM gold_micro",
    "gold_city": f"{CITY} SELECT * FROM gold",
    "gold_state": f"{STATE} SELECT * FROM gold",
    "gold_national": f"{NATIONAL} SELECT * FROM compared",
    "q01_below_target_latest": f"""
{CITY} SELECT {CITY_VIEW} FROM gold WHERE {LATEST} AND status_meta = 'ABAIXO_META'
ORDER BY gap_meta ASC NULLS LAST, {CITY_TIES} LIMIT 50""",
    "q02_entity_history": f"""
{CITY} SELECT {CITY_VIEW} FROM gold WHERE CAST(id_municipio AS VARCHAR) = '{FOLLOWED_CITY}'
ORDER BY ano, rede""",
    "q03_state_ranking": f"""
{STATE} SELECT ano, sigla_uf, rede, taxa_alfabetizacao_resultado, media_portugues, meta_ano,
       gap_meta, status_meta
FROM gold WHERE {LATEST} ORDER BY taxa_alfabetizacao_resultado DESC NULLS LAST""",
    "q04_lowest_micro_rate": f"""
WITH {MICRO}, {GOLD_MICRO}
SELECT * FROM gold_micro WHERE ano = (SELECT MAX(ano) FROM gold_micro)
ORDER BY taxa_alfabetizacao_calculada_{CUT} ASC NULLS LAST, id_municipio, rede, sigla_uf,
         nome_municipio
LIMIT 100""",
    "q05_largest_gaps": f"""
{CITY} SELECT {CITY_VIEW} FROM gold WHERE status_meta = 'ABAIXO_META'
ORDER BY gap_meta ASC NULLS LAST, {CITY_TIES} LIMIT 20""",
    "q06_mean_by_network": f"""
{CITY} SELECT ano, rede, {mean("taxa_alfabetizacao_resultado")} AS media_taxa_alfabetizacao,
       COUNT(*) AS qtd_registros
FROM gold GROUP BY ano, rede ORDER BY ano, rede""",
    "q07_situation_band": f"""
{NATIONAL} SELECT ano, rede, taxa_alfabetizacao_resultado, meta_ano, gap_meta, status_meta,
       CASE WHEN gap_meta >= 0 THEN 'Acima ou dentro da meta'
            WHEN gap_meta BETWEEN -5 AND -0.01 THEN 'Pouco abaixo da meta'
            WHEN gap_meta BETWEEN -15 AND -5.01 THEN 'Atenção'
            ELSE 'Crítico' END AS faixa_situacao
FROM compared ORDER BY ano, rede""",
    "q08_national_summary": f"""
{NATIONAL} SELECT ano, {mean("taxa_alfabetizacao_resultado")} AS media_resultado_brasil,
       {mean("meta_ano")} AS media_meta_brasil, {mean("gap_meta")} AS gap_medio_brasil,
       COUNT(*) AS qtd_redes
FROM compared GROUP BY ano ORDER BY ano""",
    "q09_status_distribution": f"{CITY} {distribution('status_meta', 'gold')}",
    "q10_gap_band": f"{CITY}, {BANDED} {distribution('faixa_gap', 'banded')}",
    "q11_official_vs_micro": f"""
{CITY}, {GOLD_MICRO}
SELECT g.ano, g.id_municipio, m.nome_municipio, g.rede,
       g.taxa_alfabetizacao_resultado AS taxa_oficial,
       m.taxa_alfabetizacao_calculada_{CUT} AS taxa_calculada_microdados,
       {rounded(f"g.taxa_alfabetizacao_resultado - m.taxa_alfabetizacao_calculada_{CUT}", 2)}
         AS diferenca_oficial_vs_microdados
FROM gold g JOIN gold_micro m ON g.id_municipio = m.id_municipio AND g.rede = m.rede
WHERE g.ano = (SELECT MAX(ano) FROM gold)
ORDER BY ABS(g.taxa_alfabetizacao_resultado - m.taxa_alfabetizacao_calculada_{CUT}) DESC NULLS LAST,
         g.id_municipio, g.rede, g.serie, g.taxa_alfabetizacao_resultado, m.ano, m.sigla_uf,
         m.nome_municipio
LIMIT 50""",
    "q12_best_worst": f"""
{CITY},
ranked AS (
  SELECT *,
    ROW_NUMBER() OVER (
      ORDER BY taxa_alfabetizacao_resultado DESC NULLS LAST, {CITY_TIES}) AS from_best,
    ROW_NUMBER() OVER (
      ORDER BY taxa_alfabetizacao_resultado ASC NULLS LAST, {CITY_TIES}) AS from_worst
  FROM gold WHERE {LATEST}
)
SELECT {CITY_VIEW},
       CASE WHEN from_best <= 10 THEN 'TOP_10_MELHORES' ELSE 'TOP_10_PIORES' END AS tipo_ranking
FROM ranked WHERE from_best <= 10 OR from_worst <= 10""",
}
