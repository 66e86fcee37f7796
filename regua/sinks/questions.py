"""The twelve questions as SQL table functions of a catalog database.

``USE <database>``, then ``SELECT * FROM q01_abaixo_da_meta(20)``. How many rows and which
municipality are arguments with defaults; the cut score is fixed with the table and given
when the functions are registered. Spark calls table functions without a database name, hence
the ``USE``. Answers equal those of :mod:`regua.plans.reports`, order included.

SQL wants a constant as a limit, which an argument is not. So the first rows are those
numbered up to ``k``: with the argument known, the optimizer makes a bounded sort of it, and
a bounded number of rows a key where there are keys. The filter on a municipality reaches the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import SparkSession

from regua.functions import bands
from regua.functions.numeric import KEPT
from regua.operators.targets import BELOW
from regua.plans.reports import BEST, CITY, FOLLOWED_CITY, RESULT, STATE, WORST
from regua.schemas import CUT_SCORE

CITY_VIEW = f"ano INT, {CITY} INT, rede STRING, {RESULT} DOUBLE, meta_ano DOUBLE, gap_meta DOUBLE, status_meta STRING"
MEANS = "qtd_municipios BIGINT, media_resultado DOUBLE, gap_medio DOUBLE"
TABLES = ("indicador_municipio", "indicador_uf", "indicador_brasil", "aluno_municipio")


class Question(NamedTuple):
    """A table function: its arguments, its columns, its query."""

    arguments: str
    columns: str
    query: str


def _names(columns: str) -> str:
    return ", ".join(column.split()[0] for column in columns.split(", "))


def _up(*columns: str) -> str:
    return ", ".join(f"{c} ASC NULLS LAST" for c in columns)


def _down(column: str) -> str:
    return f"{column} DESC NULLS LAST"


def _latest(table: str) -> str:
    return f"ano = (SELECT MAX(ano) FROM {table})"


def _first(source: str, columns: str, order: str) -> str:
    """The first ``k`` rows of a source, in order."""
    numbered = f"SELECT *, ROW_NUMBER() OVER (ORDER BY {order}) AS lugar FROM {source}"
    return f"SELECT {columns} FROM ({numbered}) WHERE lugar <= k ORDER BY lugar"


def _rounded(value: str) -> str:
    """As ``safe_round`` to two digits: half up on the decimal value."""
    sizes = " ".join(
        f"WHEN ABS({value}) < {limit:.0f} THEN CAST(ROUND(TRY_CAST({value} AS DECIMAL(38, {scale})), 2) AS DOUBLE)"
        for limit, scale in KEPT
    )
    return f"CASE {sizes} ELSE ROUND({value}, 2) END"


def _band(reached: str, limits: Sequence[bands.Band], worst: str) -> str:
    between = " ".join(f"WHEN gap_meta BETWEEN {low} AND {high} THEN '{label}'" for low, high, label in limits)
    return f"CASE WHEN gap_meta >= 0 THEN '{reached}' {between} ELSE '{worst}' END"


def _distribution(source: str, by: str, order: str) -> str:
    return (
        f"SELECT ano, rede, {by}, COUNT(*) AS qtd_municipios, {_rounded(f'AVG({RESULT})')} AS media_resultado, "
        f"{_rounded('AVG(gap_meta)')} AS gap_medio FROM {source} GROUP BY ano, rede, {by} ORDER BY {order}"
    )


def _extremes(source: str, keys: Sequence[str], value: str, ties: Sequence[str], columns: Sequence[str]) -> str:
    """Per key, the rows that can be among the ``k`` farthest from any number, with their copies."""
    listed = ", ".join(columns)
    ends = (_up(value, *ties), f"{_down(value)}, {_up(*ties)}", _up(*ties))
    branches = " UNION ALL ".join(
        f"SELECT {listed}, COUNT(*) AS copias FROM (SELECT *, ROW_NUMBER() OVER "
        f"(PARTITION BY {', '.join(keys)} ORDER BY {end}) AS lugar FROM {source}) WHERE lugar <= k GROUP BY {listed}"
        for end in ends
    )
    return (
        f"SELECT {listed}, EXPLODE(SEQUENCE(1, CAST(MAX(copias) AS INT))) AS copia "
        f"FROM ({branches}) GROUP BY {listed}"
    )


def _official_vs_micro(city: str, micro: str, computed: str) -> str:
    keys = [CITY, "rede"]
    official = f"(SELECT ano, {CITY}, rede, serie, {RESULT} FROM {city} WHERE {_latest(city)})"
    recomputed = f"(SELECT {CITY}, rede, {STATE}, nome_municipio, ano AS ano_micro, {computed} FROM {micro})"
    left = _extremes(official, keys, RESULT, ["serie", RESULT], ["ano", *keys, "serie", RESULT])
    right_columns = [*keys, STATE, "nome_municipio", "ano_micro", computed]
    right = _extremes(recomputed, keys, computed, ["ano_micro", STATE, "nome_municipio"], right_columns)
    pairs = f"(SELECT o.*, {', '.join(f'm.{c}' for c in right_columns[2:])} FROM ({left}) o JOIN ({right}) m USING ({CITY}, rede))"
    ties = [CITY, "rede", "serie", RESULT, "ano_micro", STATE, "nome_municipio"]
    shown = (
        f"ano, {CITY}, nome_municipio, rede, {RESULT} AS taxa_oficial, {computed} AS taxa_calculada_microdados, "
        f"{_rounded(f'({RESULT} - {computed})')} AS diferenca_oficial_vs_microdados"
    )
    return _first(pairs, shown, f"{_down(f'ABS({RESULT} - {computed})')}, {_up(*ties)}")


def _best_and_worst(city: str) -> str:
    """The ends of the latest year; what is in both counts as best, copy by copy."""
    columns = f"{_names(CITY_VIEW)}, serie"
    latest = f"(SELECT {columns} FROM {city} WHERE {_latest(city)})"
    ties = _up(CITY, "rede", "serie", "ano")
    best, worst = (
        f"SELECT {columns} FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY {order}) AS lugar FROM {latest}) WHERE lugar <= k"
        for order in (f"{_down(RESULT)}, {ties}", f"{_up(RESULT)}, {ties}")
    )
    return (
        f"SELECT {_names(CITY_VIEW)}, tipo_ranking FROM (SELECT *, '{BEST}' AS tipo_ranking FROM ({best}) UNION ALL "
        f"SELECT *, '{WORST}' AS tipo_ranking FROM ({worst} EXCEPT ALL {best})) "
        f"ORDER BY {_up('tipo_ranking')}, {_down(RESULT)}, {ties}"
    )


def questions(database: str, cut: int = CUT_SCORE, prefix: str = "gold_") -> dict[str, Question]:
    """All functions over the analytical tables of a database."""
    city, state, country, micro = (f"{database}.{prefix}{name}" for name in TABLES)
    computed = f"taxa_alfabetizacao_calculada_{cut}"
    k = "k INT DEFAULT {}".format
    city_ties, city_columns = _up(CITY, "rede", "serie", "ano"), _names(CITY_VIEW)
    below = f"status_meta = '{BELOW}'"
    state_view = f"ano INT, {STATE} STRING, rede STRING, {RESULT} DOUBLE, media_portugues DOUBLE, meta_ano DOUBLE, gap_meta DOUBLE, status_meta STRING"
    micro_view = (
        f"ano INT, {STATE} STRING, {CITY} INT, nome_municipio STRING, rede STRING, qtd_alunos BIGINT, "
        f"media_proficiencia_lp DOUBLE, taxa_alfabetizacao_microdados DOUBLE, {computed} DOUBLE"
    )
    country_view = f"ano INT, rede STRING, {RESULT} DOUBLE, meta_ano DOUBLE, gap_meta DOUBLE, status_meta STRING"
    situation = _band(bands.SITUATION_REACHED, bands.SITUATION_BANDS, bands.SITUATION_WORST)
    distance = _band(bands.DISTANCE_REACHED, bands.DISTANCE_BANDS, bands.DISTANCE_WORST)
    return {
        "q01_abaixo_da_meta": Question(
            k(50), CITY_VIEW, _first(f"{city} WHERE {_latest(city)} AND {below}", city_columns, f"{_up('gap_meta')}, {city_ties}")
        ),
        "q02_historico": Question(
            f"municipio INT DEFAULT {FOLLOWED_CITY}",
            CITY_VIEW,
            f"SELECT {city_columns} FROM {city} WHERE {CITY} = municipio ORDER BY {_up('ano', 'rede', 'serie')}",
        ),
        "q03_ranking_estados": Question(
            "",
            state_view,
            f"SELECT {_names(state_view)} FROM {state} WHERE {_latest(state)} ORDER BY {_down(RESULT)}, {_up(STATE, 'rede', 'serie')}",
        ),
        "q04_menor_taxa_microdados": Question(
            k(100),
            micro_view,
            _first(f"{micro} WHERE {_latest(micro)}", _names(micro_view), _up(computed, CITY, "rede", STATE, "nome_municipio")),
        ),
        "q05_maiores_gaps": Question(
            k(20), CITY_VIEW, _first(f"{city} WHERE {below}", city_columns, f"{_up('gap_meta')}, {city_ties}")
        ),
        "q06_media_por_rede": Question(
            "",
            "ano INT, rede STRING, media_taxa_alfabetizacao DOUBLE, qtd_registros BIGINT",
            f"SELECT ano, rede, {_rounded(f'AVG({RESULT})')} AS media_taxa_alfabetizacao, COUNT(*) AS qtd_registros "
            f"FROM {city} GROUP BY ano, rede ORDER BY {_up('ano', 'rede')}",
        ),
        "q07_situacao_nacional": Question(
            "",
            f"{country_view}, faixa_situacao STRING",
            f"SELECT {_names(country_view)}, {situation} AS faixa_situacao FROM {country} ORDER BY {_up('ano', 'rede')}",
        ),
        "q08_resumo_nacional": Question(
            "",
            "ano INT, media_resultado_brasil DOUBLE, media_meta_brasil DOUBLE, gap_medio_brasil DOUBLE, qtd_redes BIGINT",
            f"SELECT ano, {_rounded(f'AVG({RESULT})')} AS media_resultado_brasil, {_rounded('AVG(meta_ano)')} AS media_meta_brasil, "
            f"{_rounded('AVG(gap_meta)')} AS gap_medio_brasil, COUNT(*) AS qtd_redes FROM {country} GROUP BY ano ORDER BY {_up('ano')}",
        ),
        "q09_distribuicao_status": Question(
            "", f"ano INT, rede STRING, status_meta STRING, {MEANS}", _distribution(city, "status_meta", _up("ano", "rede", "status_meta"))
        ),
        "q10_faixas_de_gap": Question(
            "",
            f"ano INT, rede STRING, faixa_gap STRING, {MEANS}",
            _distribution(
                f"(SELECT *, {distance} AS faixa_gap FROM {city} WHERE {_latest(city)})", "faixa_gap", _up("ano", "rede", "gap_medio", "faixa_gap")
            ),
        ),
        "q11_oficial_x_microdados": Question(
            k(50),
            f"ano INT, {CITY} INT, nome_municipio STRING, rede STRING, taxa_oficial DOUBLE, taxa_calculada_microdados DOUBLE, "
            "diferenca_oficial_vs_microdados DOUBLE",
            _official_vs_micro(city, micro, computed),
        ),
        "q12_melhores_e_piores": Question(k(10), f"{CITY_VIEW}, tipo_ranking STRING", _best_and_worst(city)),
    }


def register_questions(spark: SparkSession, database: str, cut: int = CUT_SCORE, prefix: str = "gold_") -> list[str]:
    """Create the functions in ``database``, whose analytical tables must be there; their names."""
    found = questions(database, cut, prefix)
    for name, (arguments, columns, query) in found.items():
        spark.sql(
            f"CREATE OR REPLACE FUNCTION {database}.{name}({arguments}) RETURNS TABLE ({columns}) RETURN {query}"
        )
    return list(found)
