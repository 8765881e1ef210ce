"""Choosing, dropping, adding and renaming columns.

The choosers look at the schema only (the cardinality one runs an aggregate) and
return names; the rest are lazy projections that Catalyst collapses and prunes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DTYPE_GROUPS = {
    "object": (T.StringType,),
    "string": (T.StringType,),
    "number": (T.NumericType,),
    "datetime": (T.TimestampType, T.TimestampNTZType, T.DateType),
    "bool": (T.BooleanType,),
}


def quoted(name: str) -> Column:
    """Column by exact name, also when the name holds dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def present(df: DataFrame, name: str) -> Column:
    """The value of a column, NULL where it is missing: missing means NULL or NaN."""
    x = quoted(name)
    return F.when(~F.isnan(x), x) if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)) else x


def _require(df: DataFrame, names: Sequence[str]) -> None:
    unknown = [n for n in names if n not in df.columns]
    if unknown:
        raise KeyError(f"no such column: {unknown}")


def select_columns(df: DataFrame, names: str | Sequence[str]) -> DataFrame:
    wanted = [names] if isinstance(names, str) else list(names)
    _require(df, wanted)
    return df.select(*[quoted(n) for n in wanted])


def drop_columns(df: DataFrame, names: str | Sequence[str], missing_ok: bool = False) -> DataFrame:
    """Drop columns; an unknown name fails unless ``missing_ok``."""
    gone = [names] if isinstance(names, str) else list(names)
    if not missing_ok:
        _require(df, gone)
    return df.select(*[quoted(n) for n in df.columns if n not in set(gone)])


def derive(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add or replace columns in one projection."""
    return df.withColumns(dict(columns))


def overwrite_block(df: DataFrame, names: Sequence[str], fn: Callable[[Column], Column]) -> DataFrame:
    """Replace each named column by a function of itself."""
    _require(df, names)
    return df.withColumns({n: fn(quoted(n)) for n in names})


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    _require(df, list(names))
    return df.withColumnsRenamed(dict(names))


def columns_of_type(df: DataFrame, include: str | None = None, exclude: str | None = None) -> list[str]:
    """Names whose type is in the group ``include`` and not in the group ``exclude``."""
    return [
        f.name
        for f in df.schema
        if (include is None or isinstance(f.dataType, DTYPE_GROUPS[include]))
        and (exclude is None or not isinstance(f.dataType, DTYPE_GROUPS[exclude]))
    ]


def columns_containing(df: DataFrame, part: str) -> list[str]:
    return [n for n in df.columns if part in n]


def columns_except(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [n for n in df.columns if n not in set(names)]


def column_at(df: DataFrame, position: int) -> str:
    return df.columns[position]


def columns_by_cardinality(df: DataFrame, names: Sequence[str], threshold: int = 10) -> tuple[list[str], list[str]]:
    """Split names into those with fewer than ``threshold`` distinct values and the rest.

    One sketch pass first. Below its linear-counting range a sketch never reports
    more than a few over the true number of distinct values, so an estimate above
    twice the threshold proves "many"; only the columns left over, whose value sets
    are small, get the exact count.
    """
    names = list(names)
    if not names:
        return [], []
    estimates = df.agg(*[F.approx_count_distinct(present(df, n), 0.02).alias(n) for n in names]).first()
    unsure = [n for n in names if estimates[n] <= 2 * threshold]
    few: set[str] = set()
    if unsure:
        exact = df.agg(*[F.count_distinct(present(df, n)).alias(n) for n in unsure]).first()
        few = {n for n in unsure if exact[n] < threshold}
    return [n for n in names if n in few], [n for n in names if n not in few]


def is_missing(df: DataFrame, name: str) -> Column:
    """1 where the column is NULL or NaN, else 0."""
    return present(df, name).isNull().cast("int")


def class_probability(column: str = "probability", which: int = 1) -> Column:
    """One class of a probability vector."""
    return vector_to_array(F.col(column))[which]


def pick_positions(column: str, names: Mapping[str, int]) -> list[Column]:
    """Named columns for chosen positions of an array column."""
    return [F.col(column)[position].alias(name) for name, position in names.items()]


def features_and_target(df: DataFrame, target: str | Sequence[str]) -> tuple[list[str], list[str]]:
    """Feature names and target names of one table; the rows are never split apart."""
    targets = [target] if isinstance(target, str) else list(target)
    _require(df, targets)
    return columns_except(df, targets), targets
