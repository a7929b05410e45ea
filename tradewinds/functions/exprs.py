"""Column expressions with the library's rules: missing is NULL, never NaN; no division fails."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def not_in(column: Column, values: Iterable) -> Column:
    """True unless the value is in the list; a null isn't."""
    return ~F.coalesce(column.isin(list(values)), F.lit(False))


def ratio(a: Column, b: Column) -> Column:
    """``a / b``; null where ``b`` is 0."""
    return F.try_divide(a, b)


def sum0(column) -> Column:
    """A sum that is 0 where all is missing."""
    return F.coalesce(F.sum(column), F.lit(0.0))


def log_positive(column: Column) -> Column:
    """The logarithm of what is positive; null otherwise."""
    return F.when(column > 0, F.ln(column))


def number(column: Column) -> Column:
    """Text as a number; null where it is none."""
    return F.trim(column).try_cast("double")


def full_match(column: Column, pattern: str) -> Column:
    """Whether the whole text matches; a final line feed counts."""
    return column.rlike(rf"\A(?:{pattern})\z")


def floored(column: Column, low: float = 0.0) -> Column:
    """At least ``low``; a null stays null."""
    return F.when(column.isNotNull(), F.greatest(column, F.lit(low)))
