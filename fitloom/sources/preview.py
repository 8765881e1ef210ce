"""Small samples for looking at a plan; never used when fitting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def preview(df: DataFrame, key: str | Sequence[str], n: int = 100) -> DataFrame:
    """The first ``n`` rows by key (a top-n, not a full sort)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(*keys).limit(n)


def preview_files(paths: Sequence[str], n: int = 3) -> list[str]:
    """The first ``n`` names of a file list."""
    return sorted(paths)[:n]
