"""Codes and the labels that stand for them."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column, functions as F

# School network codes.
NETWORK_LABELS = {
    0: "Total",
    1: "Federal",
    2: "Estadual",
    3: "Municipal",
    4: "Privada",
    5: "Pública",
}


def label_for(code: Column, text: Column, labels: Mapping[int, str]) -> Column:
    """The label of a known code; otherwise the text itself."""
    pairs = chain.from_iterable((F.lit(key), F.lit(label)) for key, label in labels.items())
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), text)
