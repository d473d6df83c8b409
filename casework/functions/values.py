"""Numeric and ordering helpers with explicit null rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def least_strict(a: Column, b: Column) -> Column:
    """Smaller of two values; null when either is null."""
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def null_ranked(name: str) -> list[Column]:
    """Sort key parts that put null above every value.

    A minimum over ``struct(*null_ranked(c))`` therefore is "ascending, nulls
    last", a maximum is "descending, nulls first".
    """
    c = F.col(name)
    return [c.isNull().alias(f"{name}__null"), c.alias(name)]


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Rounded quotient, half away from zero; null when dividing by zero."""
    return F.round(F.try_divide(numerator, denominator), digits)
