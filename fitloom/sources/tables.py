"""Literal tables and generated columns."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_HEX_DIGITS = 13  # 52 bits, exact in a double


def literal_table(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """A table written out in code, with an explicit schema."""
    return spark.createDataFrame(list(rows), schema)


def numbered_rows(spark: SparkSession, n: int, start: int = 1, id_col: str = "id") -> DataFrame:
    """Consecutive ids, generated inside the tasks."""
    return spark.range(start, start + n).withColumnRenamed("id", id_col)


def hashed_uniform(key: str, name: str, seed: int, scale: float = 1.0) -> Column:
    """A number in (0, scale) that depends only on key, name and seed.

    Unlike a seeded random function it does not change with partitioning or retries.
    """
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"_{name}_{seed}")))
    whole = F.conv(F.substring(digest, 1, _HEX_DIGITS), 16, 10).cast("double")
    return (whole + 0.5) / F.lit(float(16**_HEX_DIGITS)) * F.lit(float(scale))


def hashed_normal(key: str, name: str, seed: int, scale: float = 1.0) -> Column:
    """A normal deviate (Box-Muller over two hashed uniforms) times ``scale``."""
    radius = F.sqrt(-2.0 * F.ln(hashed_uniform(key, f"{name}:r", seed)))
    angle = hashed_uniform(key, f"{name}:a", seed, 2.0 * math.pi)
    return radius * F.cos(angle) * F.lit(float(scale))


def hashed_integers(key: str, name: str, seed: int, low: int, high: int) -> Column:
    """An integer in [low, high)."""
    return (F.floor(hashed_uniform(key, name, seed, high - low)) + F.lit(low)).cast("bigint")
