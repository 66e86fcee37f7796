"""The entities: where they come from, how they are typed, how they are stored."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

LOAD_COLUMN = "dt_carga"

# Columns with these prefixes are percentages, shares or targets.
DOUBLE_PREFIXES = ("taxa_", "meta_", "percentual_", "proporcao_")
PERCENT_PREFIXES = ("taxa_", "meta_", "percentual_")

TARGET_PREFIX = "meta_alfabetizacao_"
TARGET_YEARS = tuple(range(2024, 2031))
CUT_SCORE = 743

# Unit-record columns as delivered, and their names here.
MICRODATA_NAMES = {
    "NU_ANO_AVALIACAO": "ano",
    "CO_UF": "id_uf",
    "SG_UF": "sigla_uf",
    "ID_ALUNO": "id_aluno",
    "TP_SERIE": "serie",
    "ID_ESCOLA": "id_escola",
    "TP_DEPENDENCIA": "rede",
    "CO_MUNICIPIO": "id_municipio",
    "NO_MUNICIPIO": "nome_municipio",
    "VL_PESO_ALUNO_LP": "peso_aluno_lp",
    "VL_PROFICIENCIA_LP": "proficiencia_lp",
    "IN_ALFABETIZADO": "in_alfabetizado",
}

# Types of unit-record columns and of keys.
MICRODATA_TYPES = {
    "ano": "int",
    "id_uf": "int",
    "sigla_uf": "string",
    "id_municipio": "int",
    "id_aluno": "string",
    "id_escola": "int",
    "serie": "int",
    "peso_aluno_lp": "double",
    "proficiencia_lp": "double",
    "in_alfabetizado": "int",
}

KEY_TYPES = {"ano": "int", "id_municipio": "int", "serie": "int", "sigla_uf": "string"}


def target_columns(years=TARGET_YEARS, prefix: str = TARGET_PREFIX) -> list[str]:
    return [f"{prefix}{year}" for year in years]


@dataclass(frozen=True)
class Entity:
    """One named table of the raw and conformed layers."""

    name: str
    key: tuple[str, ...]
    types: Mapping[str, str] = field(default_factory=dict)
    partitions: tuple[str, ...] = ("ano",)
    order: tuple[str, ...] = ()
    sep: str = ","
    encoding: str = "UTF-8"

    def schema(self) -> T.StructType:
        """The declared columns, for callers that create such a table."""
        kinds = {"int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType()}
        return T.StructType([T.StructField(n, kinds[t]) for n, t in self.types.items()])


_TARGET_TYPES = {
    "rede": "string",
    "taxa_alfabetizacao": "double",
    **dict.fromkeys(target_columns(), "double"),
    "percentual_participacao": "double",
}
_RESULT_TYPES = {
    "serie": "int",
    "rede": "string",
    "taxa_alfabetizacao": "double",
    "media_portugues": "double",
}

ENTITIES = {
    entity.name: entity
    for entity in (
        Entity(
            "meta_brasil",
            ("ano", "rede"),
            {"ano": "int", **_TARGET_TYPES},
        ),
        Entity(
            "meta_uf",
            ("ano", "sigla_uf", "rede"),
            {"ano": "int", "sigla_uf": "string", **_TARGET_TYPES},
        ),
        Entity(
            "meta_municipio",
            ("ano", "id_municipio", "rede"),
            {"ano": "int", "id_municipio": "int", **_TARGET_TYPES},
            order=("id_municipio",),
        ),
        Entity(
            "uf",
            ("ano", "sigla_uf", "serie", "rede"),
            {
                "ano": "int",
                "sigla_uf": "string",
                **_RESULT_TYPES,
                **{f"proporcao_aluno_nivel_{level}": "double" for level in range(9)},
            },
        ),
        Entity(
            "municipio",
            ("ano", "id_municipio", "serie", "rede"),
            {"ano": "int", "id_municipio": "int", **_RESULT_TYPES},
            order=("id_municipio",),
        ),
        Entity(
            "aluno",
            ("ano", "id_aluno"),
            {
                raw: MICRODATA_TYPES.get(name, "string")
                for raw, name in MICRODATA_NAMES.items()
            },
            partitions=("ano", "sigla_uf"),
            order=("id_municipio",),
            sep=";",
            encoding="ISO-8859-1",
        ),
    )
}

GOLD_PARTITIONS = ("ano",)
# Column by which each analytical table is sorted within its files.
GOLD_ORDER = {"indicador_municipio": ("id_municipio",), "aluno_municipio": ("id_municipio",)}


def _gold_indicator(entity: tuple[str, str] | None) -> dict[str, str]:
    head = {entity[0]: entity[1], "serie": "int"} if entity else {}
    means = {"media_portugues": "double"} if entity else {}
    return {
        **head,
        "rede": "string",
        "taxa_alfabetizacao_resultado": "double",
        **means,
        **dict.fromkeys(target_columns(), "double"),
        "percentual_participacao": "double",
        "meta_ano": "double",
        "gap_meta": "double",
        "status_meta": "string",
    }


# Columns of the analytical tables; every one is partitioned by ``ano int``.
GOLD_TABLES = {
    "indicador_municipio": _gold_indicator(("id_municipio", "int")),
    "indicador_uf": _gold_indicator(("sigla_uf", "string")),
    "indicador_brasil": _gold_indicator(None),
    "aluno_municipio": {
        "sigla_uf": "string",
        "id_municipio": "int",
        "nome_municipio": "string",
        "rede": "string",
        "qtd_alunos": "bigint",
        "media_proficiencia_lp": "double",
        "taxa_alfabetizacao_microdados": "double",
        f"taxa_alfabetizacao_calculada_{CUT_SCORE}": "double",
    },
}

# Fields of a feed event, in the order they are stored.
EVENT_FIELDS = {
    "event_type": "string",
    "event_ts": "string",
    "ano": "int",
    "id_municipio": "int",
    "rede": "string",
    "taxa_alfabetizacao": "double",
    "media_portugues": "double",
    "fonte": "string",
}
