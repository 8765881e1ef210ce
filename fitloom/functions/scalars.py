"""Arithmetic column expressions with explicit domains.

Spark returns NULL for a logarithm outside its domain. A silent NULL would drop
rows from later aggregates, so the functions here fail instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def interaction(left: str | Column, right: str | Column) -> Column:
    """Product of two columns."""
    return _col(left) * _col(right)


def nan_to_null(value: str | Column) -> Column:
    """NULL for NaN, so that only one kind of missing value remains."""
    x = _col(value)
    return F.when(~F.isnan(x), x)


def _inside(ok: Column, result: Column, x: Column, what: str) -> Column:
    failure = F.raise_error(F.concat(F.lit(f"{what}: value outside its domain: "), x.cast("string")))
    return F.when(x.isNull() | ok, result).otherwise(failure)


def checked_ln(value: str | Column) -> Column:
    x = _col(value)
    return _inside(x > 0, F.ln(x), x, "ln")


def checked_log1p(value: str | Column) -> Column:
    x = _col(value)
    return _inside(x > -1, F.log1p(x), x, "log1p")


def checked_sqrt(value: str | Column) -> Column:
    x = _col(value)
    return _inside(x >= 0, F.sqrt(x), x, "sqrt")


def checked_exp(value: str | Column) -> Column:
    return F.exp(_col(value))


def checked_expm1(value: str | Column) -> Column:
    return F.expm1(_col(value))
