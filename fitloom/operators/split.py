"""Train/test splits that depend on row keys, not on partitions."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import quoted

# The bucket around the cut is narrowed until it holds at most this many rows.
CUT_ROWS = 100_000


@dataclass(frozen=True)
class Split:
    """Both parts keep every column, so features and targets stay on their rows."""

    train: DataFrame
    test: DataFrame


def _names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def key_hash(key: str | Sequence[str], seed: int) -> Column:
    """32 hex digits computed from the key columns and the seed."""
    parts = [F.coalesce(quoted(k).cast("string"), F.lit("")) for k in _names(key)]
    return F.md5(F.concat_ws("_", *parts, F.lit(str(seed))))


def in_test(key: str | Sequence[str], fraction: float, seed: int = 42) -> Column:
    """True for about ``fraction`` of the keys.

    Rows with equal keys fall on the same side, so passing a group column gives a
    split that never parts a group.
    """
    if not 0.0 < fraction < 1.0:
        raise ValueError("the test share must lie between 0 and 1")
    cut = f"{int(fraction * 16**8):08x}"
    return F.substring(key_hash(key, seed), 1, 8) < F.lit(cut)


def with_side(df: DataFrame, test: Column, out: str = "side") -> DataFrame:
    """Name the side of each row instead of taking the table apart; one scan."""
    return df.withColumn(out, F.when(test, "test").otherwise("train"))


def hash_split(df: DataFrame, key: str | Sequence[str], fraction: float = 0.2, seed: int = 42) -> Split:
    """Two filters over the same rows; no shuffle, no count."""
    test = in_test(key, fraction, seed)
    return Split(train=df.where(~test), test=df.where(test))


def exact_test_rows(df: DataFrame, key: str | Sequence[str], fraction: float = 0.2, seed: int = 42) -> Column:
    """A predicate that holds for exactly ceil(fraction * n) rows: those of lowest hash.

    Rows of one key stay together, whatever their number: where the key repeats, the group
    at the cut is taken whole, so the share is the smallest one of whole groups that reaches
    the fraction.

    Rows are counted by the leading hash digits, 4096 counts at a time, and only the
    bucket that holds the cut is looked at again. Its last row to take is found by a
    bounded top-n, after which the split is a plain comparison with two literals.
    """
    keys = _names(key)
    if not 0.0 < fraction < 1.0:
        raise ValueError("the test share must lie between 0 and 1")
    hashed = df.select(key_hash(keys, seed).alias("h"), *[quoted(k) for k in keys])
    prefix, skipped, need = "", 0, None
    while True:
        inside = hashed.where(F.col("h").startswith(prefix)) if prefix else hashed
        digits = F.substring("h", len(prefix) + 1, 3)
        counts = sorted((r["d"], r["count"]) for r in inside.groupBy(digits.alias("d")).count().collect())
        if need is None:
            need = math.ceil(fraction * sum(n for _, n in counts))
        if need == 0:
            return F.lit(False)
        for step, rows in counts:
            if skipped + rows >= need:
                break
            skipped += rows
        prefix += step
        if rows <= CUT_ROWS:
            break
        if len(prefix) >= 32:
            return key_hash(keys, seed) <= F.lit(prefix)  # one key holds the whole bucket
    bucket = hashed.where(F.col("h").startswith(prefix)).orderBy("h", *[quoted(k) for k in keys])
    last = bucket.offset(need - skipped - 1).first()
    h = key_hash(keys, seed)
    low_key = F.lit(True)
    for k in reversed(keys):
        x = quoted(k)
        bound = F.lit(last[k])
        lower = F.when(x.isNull(), bound.isNotNull()).otherwise(F.coalesce(x < bound, F.lit(False)))
        low_key = lower | (x.eqNullSafe(bound) & low_key)
    return (h < F.lit(last["h"])) | ((h == F.lit(last["h"])) & low_key)


def exact_split(df: DataFrame, key: str | Sequence[str], fraction: float = 0.2, seed: int = 42) -> Split:
    """Split with exact sizes, up to the last group where the key repeats."""
    test = exact_test_rows(df, key, fraction, seed)
    return Split(train=df.where(~test), test=df.where(test))
