"""Numeric expressions with rules that do not depend on ANSI mode."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Decimals kept before rounding, by size of the value: some fifteen digits in all,
# coarser than the noise of a double and finer than any rounding asked for.
KEPT = ((1e3, 12), (1e6, 9), (1e9, 6))


def safe_round(value: Column, digits: int) -> Column:
    """Round half up on the decimal value, not on its binary neighbour.

    ``1.005`` is stored slightly below itself; going through a decimal first
    gives the same answer on every engine and for every summation order, as long
    as the error stays below the fifteenth digit. What is too large for that,
    infinity and NaN are rounded as they are.
    """
    value = value.cast("double")
    kept = [
        (F.abs(value) < limit, F.round(value.try_cast(T.DecimalType(38, scale)), digits).cast("double"))
        for limit, scale in KEPT
    ]
    (first, rounded), *others = kept
    found = F.when(first, rounded)
    for size, rounded in others:
        found = found.when(size, rounded)
    return found.otherwise(F.round(value, digits))


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` of ``whole`` in percent, both whole numbers, rounded half up once and exactly.

    NULL when ``whole`` is 0.
    """
    doubled = part.cast("bigint") * (2 * 10 ** (digits + 2)) + whole
    # The quotient is a whole number; rounding only takes back the division by doubles.
    return F.round((doubled - F.try_mod(doubled, 2 * whole)) / (2 * whole)) / 10**digits


def rate(flag: Column, digits: int = 2) -> Column:
    """Percentage of 1 in a 0/1 flag. Rows with a NULL flag are not counted."""
    return percentage(F.sum(flag), F.count(flag), digits)


def text_to_int(text: Column) -> Column:
    """Integer from text; ``3.0`` counts as 3, anything unreadable becomes NULL.

    Files that went through a tool which stores a gappy integer column as
    floating point carry the ``.0``. The pattern comes first because a refused
    cast raises and catches an exception per value, which costs some twenty
    times as much as the match.
    """
    readable = text.rlike(r"^\s*[+-]?\d+(\.\d*)?\s*$")
    return F.when(readable, F.substring_index(text, ".", 1).try_cast("int"))


def text_to_double(text: Column, decimal_mark: str = ".") -> Column:
    """Double from text; unreadable text becomes NULL."""
    if decimal_mark != ".":
        text = F.replace(text, F.lit(decimal_mark), F.lit("."))
    return text.try_cast("double")


def cast_to(column: Column, source: T.DataType, target: str, decimal_mark: str = ".") -> Column:
    """Cast to int, double or string without ever failing on a bad value."""
    if isinstance(source, T.StringType) and target == "int":
        return text_to_int(column)
    if isinstance(source, T.StringType) and target == "double":
        return text_to_double(column, decimal_mark)
    return column.try_cast(target)


def cast_columns(df: DataFrame, types: Mapping[str, str], decimal_mark: str = ".") -> DataFrame:
    """Cast the named columns that do not have their type yet."""
    schema = df.schema
    return df.withColumns(
        {
            name: cast_to(F.col(name), schema[name].dataType, kind, decimal_mark)
            for name, kind in types.items()
            if schema[name].dataType.simpleString() != kind
        }
    )
