"""Joins, lookups and unions keyed by columns instead of row positions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import quoted
from .stats import frequent_key_hashes, key_hash64

# Rows of one piece of a hot key; keys with more rows are cut into more pieces.
PIECE_ROWS = 1_000_000
LEAST_PIECES = 8
# A value of a looked-up column is frequent in the table that is scored if it holds this
# many rows and this share of them: below, it fits into a task of a thousand. The sketch that finds
# them keeps so many counters.
HOT_ROWS, HOT_VALUES, TRACKED = 5_000, 1_000, 10_000
# A joined table up to this size, counted before the join, is broadcast.
BROADCAST_BYTES = 32 << 20
# What a row's name takes beside it, and a looked-up value with its code, where rows are named.
NAME_BYTES, VALUE_BYTES = 64, 48


def _names(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _row_hash(df: DataFrame, spread_by: str | Sequence[str] | None) -> Column:
    """A hash that scatters rows and is the same when a lost task runs again.

    Naming the row key in ``spread_by`` keeps the scan from reading every column.
    """
    if spread_by is not None:
        return F.xxhash64(*[quoted(c) for c in _names(spread_by)])
    return F.xxhash64(*[quoted(f.name) for f in df.schema if "map<" not in f.dataType.simpleString()])


def _extent(df: DataFrame) -> tuple[int, int] | None:
    """Rows and bytes of the plain values of a table, from one aggregate; None with nested columns."""
    size = F.lit(0)
    for f in df.schema:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(quoted(f.name)), F.lit(0)) + 16
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.UserDefinedType)):
            return None
        else:
            size = size + 16
    rows, size = df.agg(F.count(F.lit(1)), F.sum(size.cast("bigint"))).first()
    return rows, size or 0


def counted_bytes(df: DataFrame) -> int | None:
    """Bytes of the plain values of a table, from one aggregate; None with nested columns."""
    extent = _extent(df)
    return None if extent is None else extent[1]


def inner_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    null_safe: bool = False,
    hot: Mapping[int, int] | Sequence[int] | None = None,
    spread_by: str | Sequence[str] | None = None,
) -> DataFrame:
    """Many-to-one inner join; the key appears once.

    With ``null_safe`` missing keys match each other. A right side whose counted size is
    small is broadcast, so the left rows stay where they are. Beyond that size, left keys
    that hold over a ten-thousandth of the rows are cut into pieces of ``PIECE_ROWS``, and
    only their few right rows are repeated once per piece. Those keys are measured; pass
    ``hot=[]`` where the left key is known to be unique, and the optimizer decides alone.
    """
    keys = _names(on)
    if hot is None:
        size = counted_bytes(right)
        if size is not None and size <= BROADCAST_BYTES:
            hot, right = [], F.broadcast(right)
        else:
            hot = frequent_key_hashes(left, keys)
    pairs = list(keys)
    if hot:
        hot_left = key_hash64(left, keys).isin(list(hot))
        hot_right = key_hash64(right, keys, like=left).isin(list(hot))
        most = max(hot.values()) if isinstance(hot, Mapping) else 0
        pieces = max(LEAST_PIECES, -(-most // PIECE_ROWS))
        salt = F.when(hot_left, F.pmod(_row_hash(left, spread_by), F.lit(pieces))).otherwise(F.lit(0)).cast("int")
        copies = F.when(hot_right, F.sequence(F.lit(0), F.lit(pieces - 1))).otherwise(F.array(F.lit(0)))
        left = left.withColumn("_salt", salt)
        right = right.withColumn("_salt", F.explode(copies))
        pairs.append("_salt")
    if not null_safe:
        return left.join(right, pairs, "inner").drop("_salt")
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in pairs})
    match = reduce(lambda a, b: a & b, [quoted(k).eqNullSafe(quoted(f"_right_{k}")) for k in pairs])
    return left.join(renamed, match, "inner").drop("_salt", *[f"_right_{k}" for k in pairs])


def lookup(
    df: DataFrame,
    column: str,
    dictionary: DataFrame,
    out: str,
    hot: DataFrame | None = None,
    small: bool = False,
    spread_by: str | Sequence[str] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Add ``out``, the dictionary's ``code`` for each value; unmatched rows get NULL.

    ``dictionary`` has unique string values in ``value``. ``small`` says that its size
    was checked, so it is broadcast. For a large one, ``hot`` lists the frequent values
    (a bounded number) by their digest in ``value``: they are answered by a broadcast,
    however long they are, and the rest is joined by key. Rows already answered are spread by a hash, so they crowd no partition.
    With ``strict`` a value that a large dictionary lacks fails, and ``column`` need not be moved for that.
    """
    text = as_text(df, column)
    entries = dictionary.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    if small:
        found = df.withColumn("_text", text).join(F.broadcast(entries), F.col("_text") == F.col("_value"), "left")
        return found.withColumn(out, F.col("_code")).drop("_text", "_value", "_code")
    spread = F.pmod(_row_hash(df, spread_by), F.lit(1 << 20)).cast("string")
    tagged = df.withColumns({"_text": text, "_spread": spread})
    if hot is not None:
        first = hot.select(F.col("value").alias("_hot_value"), F.col("code").alias("_hot_code"))
        tagged = tagged.join(F.broadcast(first), digest("_text") == F.col("_hot_value"), "left")
    else:
        tagged = tagged.withColumns({"_hot_value": F.lit(None).cast("string"), "_hot_code": F.lit(None).cast("double")})
    open_ = F.col("_hot_value").isNull() & F.col("_text").isNotNull()
    key = F.when(open_, F.col("_text"))
    if strict:
        key = key.when(F.col("_hot_value").isNotNull() & F.col("_hot_code").isNull(), unknown_category(column, F.col("_text")))
    tagged = tagged.withColumns({"_open": open_, "_key": key.otherwise(F.col("_spread"))})
    table = entries.withColumn("_live", F.lit(True))
    found = tagged.join(table, (F.col("_key") == F.col("_value")) & (F.col("_open") == F.col("_live")), "left")
    helpers = ["_text", "_spread", "_hot_value", "_hot_code", "_open", "_key", "_value", "_code", "_live"]
    code = F.coalesce("_hot_code", "_code")
    if strict:
        code = F.when(F.col("_open") & F.col("_code").isNull(), unknown_category(column, F.col("_key"))).otherwise(code)
    return found.withColumn(out, code).drop(*helpers)


def unknown_category(column: str, text: Column) -> Column:
    """A failure that names the value."""
    return F.raise_error(F.concat(F.lit(f"column {column}: unknown category: "), text))


def ways(df: DataFrame, sizes: Mapping[str, int | None]) -> tuple[list[str], bool]:
    """How several large dictionaries meet a table: which are broadcast, and whether the others
    are joined one by one.

    ``sizes`` are the counted bytes of the dictionaries. A table that would itself be broadcast
    moves for little, and meets all of them by one join; so does one that can't be measured. For
    any other, dictionaries of that size stay put, and the rest is joined one by one if the
    whole row, moved once for each, takes less than its name and value, and its name and code.
    """
    extent = None if None in sizes.values() else _extent(df)
    if extent is None or extent[1] <= BROADCAST_BYTES:
        return [], False
    rows, size = extent
    near, total = [], 0
    for c, held in sorted(sizes.items(), key=lambda item: item[1]):
        total += held
        if total <= BROADCAST_BYTES:
            near.append(c)
    rest = len(sizes) - len(near)
    return near, rest * size <= size + rows * NAME_BYTES + rest * rows * (2 * NAME_BYTES + VALUE_BYTES)


def _named_values(df: DataFrame, columns: Sequence[str], beside: Sequence[Column] = ()) -> DataFrame:
    """``(column, value)`` for each of the columns of a row, as a number and a text."""
    pairs = F.array(*[F.struct(F.lit(i).alias("column"), as_text(df, c).alias("value")) for i, c in enumerate(columns)])
    return df.select(*beside, F.inline(pairs))


def frequent_values(df: DataFrame, columns: Sequence[str]) -> list[tuple[int, str]]:
    """The frequent values of several columns, as number of the column and digest.

    One pass with one sketch over all columns; at most ``HOT_VALUES`` come back, whatever the
    table holds.
    """
    key = F.concat(F.col("column").cast("string"), F.lit(":"), digest("value"))
    rows = _named_values(df, columns).where("value is not null").select(key.alias("key"))
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(key, {HOT_VALUES}, {TRACKED})").alias("top")).first()
    least = max(HOT_ROWS, found["n"] / HOT_VALUES)
    pairs = (r["item"].split(":") for r in found["top"] or () if r["count"] >= least)
    return [(int(column), value) for column, value in pairs]


def hot_entries(df: DataFrame, dictionaries: Mapping[str, DataFrame], hot: Mapping[str, DataFrame]) -> DataFrame:
    """``(column, value, code)``: what is answered by broadcast, ``value`` as a digest.

    These are the frequent values of the fit, ``hot``, and those of ``df``: a frequent value of
    ``df`` that its dictionary has comes with its code, any other with NULL, so that it meets
    no task either. The number of rows is bounded by both lists.
    """
    columns = list(dictionaries)
    none = df.sparkSession.createDataFrame([], "column int, value string, code double")
    known = reduce(DataFrame.union, [hot[c].select(F.lit(i).alias("column"), "value", "code") for i, c in enumerate(columns)], none)
    if df.isStreaming:
        return known
    found = frequent_values(df, columns)
    if not found:
        return known
    listed = df.sparkSession.createDataFrame(found, "column int, value string")
    new = listed.join(F.broadcast(known), ["column", "value"], "left_anti")
    coded = [
        dictionaries[c].select(F.lit(i).alias("column"), digest("value").alias("value"), "code").join(F.broadcast(new), ["column", "value"], "left_semi")
        for i, c in enumerate(columns)
    ]
    return known.union(new.join(reduce(DataFrame.union, coded), ["column", "value"], "left").select("column", "value", "code"))


def lookup_many(
    df: DataFrame,
    dictionaries: Mapping[str, DataFrame],
    outs: Mapping[str, str],
    hot: DataFrame,
    spread_by: str | Sequence[str] | None = None,
) -> DataFrame:
    """:func:`lookup` for several large dictionaries ``(value, code)``, by one join.

    The columns become narrow rows of a row's name, a column and a value; those in ``hot``
    (as of :func:`hot_entries`) are answered by broadcast, the others meet all dictionaries at
    once, by column and value. The codes then meet their rows by name, so the wide row is
    moved once, however many columns there are. A row's name is a hash of ``spread_by``, or of
    the whole row, and a digest of the looked-up values: rows of one name have the same codes.
    """
    columns = list(dictionaries)
    texts = [F.concat(F.length(as_text(df, c)).cast("string"), F.lit(":"), as_text(df, c)) for c in columns]
    name = F.concat(F.hex(_row_hash(df, spread_by)), digest(F.concat_ws(",", *[F.coalesce(t, F.lit("-")) for t in texts])))
    wide = df.withColumn("_name", name)
    coded = _coded_values(wide, dictionaries, hot)
    codes = coded.where("code is not null").groupBy("_name")
    codes = codes.agg(*[F.max(F.when(F.col("column") == i, F.col("code"))).alias(outs[c]) for i, c in enumerate(columns)])
    return wide.join(codes, "_name", "left").drop("_name")


def _open_values(wide: DataFrame, columns: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Narrow rows ``(_name, column, value)`` that need a dictionary, and those answered at once."""
    rows = _named_values(wide, columns, [F.col("_name")]).where("value is not null")
    first = hot.select("column", F.col("value").alias("_digest"), "code", F.lit(True).alias("_hot"))
    told = rows.withColumn("_digest", digest("value")).join(F.broadcast(first), ["column", "_digest"], "left")
    return told.where("_hot is null").select("_name", "column", "value"), told.where("_hot").select("_name", "column", "code")


def _coded_values(wide: DataFrame, dictionaries: Mapping[str, DataFrame], hot: DataFrame) -> DataFrame:
    open_, answered = _open_values(wide, list(dictionaries), hot)
    tables = [t.select(F.lit(i).alias("column"), "value", "code") for i, t in enumerate(dictionaries.values())]
    return open_.join(reduce(DataFrame.union, tables), ["column", "value"]).select("_name", "column", "code").union(answered)


def digest(text: str | Column) -> Column:
    """128 bits that stand for a dictionary value in a list of frequent ones."""
    return F.md5(F.col(text).cast("binary") if isinstance(text, str) else text.cast("binary"))


def as_text(df: DataFrame, column: str) -> Column:
    """The form in which dictionaries store a value of this column."""
    x = quoted(column)
    if df.schema[column].dataType.simpleString() in ("float", "double"):
        x = F.when(~F.isnan(x), x + F.lit(0.0))
    return x.cast("string")


def concat_columns(left: DataFrame, right: DataFrame, key: str | Sequence[str], how: str = "outer") -> DataFrame:
    """Put two tables side by side, matching rows by a key that is unique in both.

    Columns of one and the same table need no join: ``select`` them together. ``how`` says
    which keys may stand on one side only: ``"exact"`` none, ``"left"`` and ``"right"`` those
    of that side, ``"outer"`` any; ``"inner"`` leaves them out. A key that is NULL or repeats
    on a side fails with its value, as does one that ``how`` doesn't allow.

    Rows of both sides are brought together by one aggregate over the key, which counts them
    as it goes: repeated keys are found in the pass that aligns the rows, and never multiply them.
    """
    keys = _names(key)
    if how not in ("exact", "inner", "left", "right", "outer"):
        raise ValueError(f"unknown kind of alignment: {how}")
    sides = {"left": left, "right": right}
    columns = {n: [c for c in t.columns if c not in keys] for n, t in sides.items()}
    twice = set(columns["left"]) & set(columns["right"])
    if twice:
        raise ValueError(f"columns of both sides: {sorted(twice)}")
    packed = []
    for name, table in sides.items():
        row = F.struct(F.lit(1).alias("_"), *[quoted(c) for c in columns[name]]).alias(f"_{name}")
        packed.append(table.select(*[quoted(k) for k in keys], row))
    rows = packed[0].unionByName(packed[1], allowMissingColumns=True).groupBy(*[quoted(k) for k in keys])
    aligned = rows.agg(*[f(f"_{n}").alias(f"_{a}{n}") for n in sides for f, a in ((F.count, "n"), (lambda c: F.first(c, ignorenulls=True), "x"))])
    shown = F.to_json(F.struct(*[quoted(k) for k in keys]), {"ignoreNullFields": "false"})
    n, m = F.col("_nleft"), F.col("_nright")
    wrong = F.when(reduce(lambda a, b: a | b, [quoted(k).isNull() for k in keys]), "a key is NULL: ")
    wrong = wrong.when(n > 1, "a key repeats on the left: ").when(m > 1, "a key repeats on the right: ")
    if how in ("exact", "left"):
        wrong = wrong.when(n == 0, "a key is missing on the left: ")
    if how in ("exact", "right"):
        wrong = wrong.when(m == 0, "a key is missing on the right: ")
    # the test stands in the filter, so no optimizer can prune it with the columns
    aligned = aligned.where(F.when(wrong.isNotNull(), F.raise_error(F.concat(wrong, shown)).cast("boolean")).otherwise(F.lit(True)))
    if how == "inner":
        aligned = aligned.where((n == 1) & (m == 1))
    out = [F.col(f"_x{name}")[c].alias(c) for name in sides for c in columns[name]]
    return aligned.select(*[quoted(k) for k in keys], *out)


def stack_columns(df: DataFrame, key: str | Sequence[str], columns: Mapping[str, str | Column]) -> DataFrame:
    """Several result columns of one table as a named matrix beside its key."""
    named = [(quoted(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()]
    return df.select(*[quoted(k) for k in _names(key)], *named)


def union_by_name(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables; columns meet by name, absent ones become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def stack_predictions(df: DataFrame, key: str | Sequence[str], predictions: Mapping[str, str]) -> DataFrame:
    """(key, target, prediction): prediction columns on top of each other, in one scan."""
    ids = [quoted(k) for k in _names(key)]
    named = df.select(*ids, *[quoted(c).alias(target) for target, c in predictions.items()])
    return named.unpivot(ids, [quoted(t) for t in predictions], "target", "prediction")
