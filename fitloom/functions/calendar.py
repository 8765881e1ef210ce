"""Calendar parts of a timestamp and their cyclic encodings."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalars import _col, interaction


def parse_timestamp(value: str | Column, fmt: str | None = None, strict: bool = True) -> Column:
    """Timestamp without time zone; malformed text fails, or is NULL when not strict."""
    x = _col(value)
    if fmt is None:
        parsed = x.try_cast("timestamp_ntz")
    else:
        valid = F.try_to_timestamp(x, F.lit(fmt)).isNotNull()
        parsed = F.when(valid, F.to_timestamp_ntz(x, F.lit(fmt)))
    if not strict:
        return parsed
    failure = F.raise_error(F.concat(F.lit("not a timestamp: "), x.cast("string")))
    return F.when(x.isNotNull(), F.coalesce(parsed, failure))


def calendar_columns(ts: str | Column) -> dict[str, Column]:
    """Hour, weekday (Monday is 0), month, year and day of month."""
    x = _col(ts)
    return {
        "hour": F.hour(x),
        "day_of_week": F.weekday(x),
        "month": F.month(x),
        "year": F.year(x),
        "day": F.dayofmonth(x),
    }


def cyclic(value: str | Column, period: float, offset: float = 0.0) -> tuple[Column, Column]:
    """Sine and cosine of a periodic value whose first position is ``offset``."""
    angle = (_col(value) - F.lit(offset)) * F.lit(2.0 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def with_calendar(df: DataFrame, ts: str, workingday: str = "workingday") -> DataFrame:
    """Add the calendar parts, their cyclic forms and hour x workingday.

    Two projections: the second one uses the columns of the first. Everything is
    narrow and stays inside one generated stage.
    """
    parts = df.withColumns(calendar_columns(ts))
    hour_sin, hour_cos = cyclic("hour", 24)
    week_sin, week_cos = cyclic("day_of_week", 7)
    month_sin, month_cos = cyclic("month", 12, offset=1)
    return parts.withColumns(
        {
            "hour_workingday_interaction": interaction("hour", workingday),
            "hour_sin": hour_sin,
            "hour_cos": hour_cos,
            "day_of_week_sin": week_sin,
            "day_of_week_cos": week_cos,
            "month_sin": month_sin,
            "month_cos": month_cos,
        }
    )
