"""Aggregates that fitting needs, written so that no task sees a whole column."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise, write_table
from .columns import present, quoted

# A running total over at most this many rows may use one ordinary window.
WINDOW_ROWS = 1_000_000
# monotonically_increasing_id has the partition above these bits, the row below them.
SLICE_BITS = 33


def by_type(df: DataFrame, names: Sequence[str]) -> dict[str, list[str]]:
    """Names grouped by their Spark type."""
    groups: dict[str, list[str]] = {}
    for name in names:
        groups.setdefault(df.schema[name].dataType.simpleString(), []).append(name)
    return groups


def _plain(name: str, dtype: T.DataType) -> Column:
    """The value to group by: NaN counts as missing and -0.0 equals 0.0."""
    x = quoted(name)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        x = F.when(~F.isnan(x), x + F.lit(0.0))
    return x.alias(name)


def value_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column, value, n) over several columns of one type, missing values left out.

    One shuffle for all columns. Each map task first combines its rows, so a value
    that holds a third of the table still leaves a task as a single row.
    """
    names = list(names)
    if len(by_type(df, names)) != 1:
        raise ValueError("value_counts needs columns of one type")
    narrow = df.select(*[_plain(n, df.schema[n].dataType) for n in names])
    long = narrow.unpivot([], [quoted(n) for n in names], "column", "value")
    return long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def distinct_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row with the exact number of distinct non-missing values per column."""
    return df.agg(*[F.count_distinct(present(df, n)).alias(n) for n in names])


def relative_frequencies(df: DataFrame, name: str) -> DataFrame:
    """(value, n, frequency) of one column; the denominator is its non-missing rows.

    The table of counts is written once, so the total and the result share it.
    """
    counts = materialise(value_counts(df, [name]), "counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.select("value", "n", (F.col("n") / F.lit(float(total))).alias("frequency"))


def means_and_deviations(df: DataFrame, names: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """Mean and population standard deviation per column, all from one aggregate."""
    parts = []
    for n in names:
        x = quoted(n).cast("double")
        x = F.when(~F.isnan(x), x)
        parts += [F.avg(x).alias(f"{n}\0mean"), F.stddev_pop(x).alias(f"{n}\0std")]
    row = df.agg(*parts).first()
    return {n: (row[f"{n}\0mean"], row[f"{n}\0std"]) for n in names}


def running_total(df: DataFrame, order_by: Sequence[str], amount: str, out: str, within: Sequence[str] = ()) -> DataFrame:
    """Running sum of ``amount`` in key order without a global window.

    The rows, which must be unique in (within, order_by), are range partitioned and
    written once so that a slice keeps its number. Each slice sums its own rows and
    adds the total of the slices before it. Only those totals, one row per slice and
    group, meet in one place.
    """
    keys = [*within, *order_by]
    sliced = materialise(df.repartitionByRange(*keys).withColumn("_slice", F.spark_partition_id()), "sliced")
    group = [*within] or [F.lit(0)]
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*within, "_slice")
        .agg(F.sum(amount).alias("_total"))
        .select(*within, "_slice", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(*within, "_slice").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    return (
        sliced.join(F.broadcast(offsets), [*within, "_slice"])
        .withColumn(out, F.col("_before") + F.sum(amount).over(inside))
        .drop("_before", "_slice")
    )


def written_in_order(df: DataFrame, order_by: Sequence[str], columns: Sequence[Column], name: str) -> tuple[str, list[int]]:
    """Write ``columns`` of rows that are unique in ``order_by`` in that order, moved once.

    Gives the path and the rows before each slice: a row's ``at`` holds its slice above
    ``SLICE_BITS`` and its place in it below, so :func:`place` numbers the rows from 0.
    """
    ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by).withColumn("at", F.monotonically_increasing_id())
    path = write_table(ordered.select(*columns, "at"), name, compression="zstd")
    slices = df.sparkSession.read.parquet(path).groupBy(F.shiftright("at", SLICE_BITS).alias("slice")).count()
    held = {r["slice"]: r["count"] for r in slices.collect()}
    return path, list(accumulate((held.get(i, 0) for i in range(max(held, default=-1))), initial=0))


def place(at: Column, before: Sequence[int]) -> Column:
    """The number of a row of :func:`written_in_order`."""
    offset = F.element_at(F.array(*[F.lit(b).cast("long") for b in before]), (F.shiftright(at, SLICE_BITS) + 1).cast("int"))
    return offset + at.bitwiseAND(F.lit((1 << SLICE_BITS) - 1))


def _running(df: DataFrame, order_by: list[str], amount: str, out: str, within: list[str], rows: int) -> DataFrame:
    if rows > WINDOW_ROWS:
        return running_total(df, order_by, amount, out, within)
    frame = Window.partitionBy(*(within or [F.lit(0)])).orderBy(*order_by)
    return df.withColumn(out, F.sum(amount).over(frame.rowsBetween(Window.unboundedPreceding, 0)))


def _order_statistics(df: DataFrame, ranks: dict[str, tuple[int, int]], rows: int) -> dict[str, tuple]:
    """Values at two 1-based ranks per column, from a table of double columns."""
    counts = value_counts(df, list(ranks))
    cumulated = _running(counts, ["value"], "n", "upto", ["column"], rows)
    low = reduce(lambda e, c: e.when(F.col("column") == c, ranks[c][0]), ranks, F)
    high = reduce(lambda e, c: e.when(F.col("column") == c, ranks[c][1]), ranks, F)
    found = cumulated.groupBy("column").agg(
        F.min(F.when(F.col("upto") >= low, F.col("value"))).alias("low"),
        F.min(F.when(F.col("upto") >= high, F.col("value"))).alias("high"),
    )
    return {r["column"]: (r["low"], r["high"]) for r in found.collect()}


def medians(df: DataFrame, names: Sequence[str], accuracy: int = 10_000) -> dict[str, float | None]:
    """Exact median per column, in two passes over the named columns.

    The first pass sketches a narrow value range around each middle. The second
    counts the values inside that range, folding everything below it into one row,
    and picks the middle ranks by running count. A column whose middle turns out to
    lie outside its range is counted in full.
    """
    names = list(names)
    if not names:
        return {}

    def number(n: str) -> Column:
        x = quoted(n).cast("double")
        return F.when(~F.isnan(x), x + F.lit(0.0)).alias(n)

    numbers = df.select(*[number(n) for n in names])
    margin = 5.0 / accuracy
    sketch = [F.count(quoted(n)).alias(f"{n}\0n") for n in names]
    sketch += [
        F.percentile_approx(quoted(n), [0.5 - margin, 0.5 + margin], accuracy).alias(f"{n}\0range") for n in names
    ]
    row = numbers.agg(*sketch).first()
    sizes = {n: row[f"{n}\0n"] for n in names}
    filled = [n for n in names if sizes[n] > 0]
    ranks = {n: ((sizes[n] + 1) // 2, sizes[n] // 2 + 1) for n in filled}
    result: dict[str, float | None] = {n: None for n in names}
    if not filled:
        return result

    below = F.lit(float("-inf"))
    lows = {n: row[f"{n}\0range"][0] for n in filled}
    folded = [
        F.when(quoted(n) < lows[n], below).when(quoted(n) <= row[f"{n}\0range"][1], quoted(n)).alias(n) for n in filled
    ]
    most = max(sizes.values())
    inside = _order_statistics(numbers.select(*folded), ranks, most)

    def hit(n: str) -> bool:
        low, high = inside.get(n, (None, None))
        return low is not None and high is not None and low >= lows[n]

    outside = [n for n in filled if not hit(n)]
    if outside:
        full = _order_statistics(numbers.select(*map(quoted, outside)), {n: ranks[n] for n in outside}, most)
        inside.update(full)
    for n in filled:
        low, high = inside[n]
        result[n] = low if low == high else (low + high) / 2.0
    return result


def modes(df: DataFrame, names: Sequence[str]) -> dict[str, object]:
    """Most frequent value per column; the lowest value wins a tie."""
    result: dict[str, object] = {n: None for n in names}
    for group in by_type(df, names).values():
        counts = value_counts(df, group)
        best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("m"), "value")).alias("best"))
        result.update({r["column"]: r["best"]["value"] for r in best.collect()})
    return result


def categories(df: DataFrame, name: str) -> DataFrame:
    """The distinct non-missing values of a column, as a table."""
    return value_counts(df, [name]).select("value")


def class_shares(df: DataFrame, label: str) -> DataFrame:
    """(label, n, share, majority): the prior of each class and which one is largest."""
    counts = materialise(value_counts(df, [label]), "classes")
    total, best = counts.agg(F.sum("n"), F.min(F.struct((-F.col("n")).alias("m"), "value"))).first()
    return counts.select(
        F.col("value").alias(label),
        "n",
        (F.col("n") / F.lit(float(total or 0))).alias("share"),
        F.col("value").eqNullSafe(F.lit(best["value"] if best else None)).alias("majority"),
    )


def key_hash64(df: DataFrame, on: Sequence[str], like: DataFrame | None = None) -> Column:
    """A 64-bit hash of the key; ``like`` gives the types to hash, so that two tables agree."""
    parts = []
    for c in on:
        x = quoted(c)
        if like is not None and like.schema[c].dataType != df.schema[c].dataType:
            x = x.try_cast(like.schema[c].dataType)
        parts.append(x)
    return F.xxhash64(*parts)


def frequent_key_hashes(df: DataFrame, on: Sequence[str], share: float = 0.0001, least: int = 100_000) -> dict[int, int]:
    """Rows of every key with over ``share`` of the rows and at least ``least`` of them, by hash.

    There are at most 1/share. A heavy-hitter sketch gives a superset in one pass that
    shuffles no keys; a second pass counts just those candidates.
    """
    hashes = df.select(key_hash64(df, on).alias("h"))
    candidates = hashes.stat.freqItems(["h"], share).first()[0]
    if not candidates:
        return {}
    counted = hashes.groupBy(F.when(F.col("h").isin(candidates), F.col("h")).alias("h")).count().collect()
    rows = sum(r["count"] for r in counted)
    return {r["h"]: r["count"] for r in counted if r["h"] is not None and r["count"] >= max(least, share * rows)}
