"""Preprocessing that is fitted on one table and applied unchanged to any other.

Every class is an ordinary ML estimator or transformer: it works in a
``pyspark.ml.Pipeline``, its fitted state is plain data, and a fitted stage can be
saved and loaded. Applying a stage is always lazy.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from importlib import import_module

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise, write_table
from . import stats
from .columns import columns_of_type, is_missing, quoted
from .combine import as_text, digest, hot_entries, lookup, lookup_many, unknown_category, ways

# A dictionary up to this size is kept inside the fitted stage and broadcast.
SMALL_ENTRIES = 20_000
SMALL_BYTES = 4 << 20
# All dictionaries of one fit that are kept so, smallest first; the others stay tables.
SMALL_TOTAL_BYTES = 64 << 20
# A value above this share counts as frequent. There are at most 1/share of them; they are
# listed by digest, so a long one takes no more room than a short one.
HOT_SHARE = 0.0001
# Widest one-hot vector written out as single expressions. Wider ones go through a
# dictionary; the slots are the same.
INLINE_CATEGORIES = 500


class _Columns(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns to fit and replace", TypeConverters.toListString)

    def columns(self) -> list[str]:
        return self.getOrDefault(self.inputCols)


class _Spread(Params):
    spreadBy = Param(
        Params._dummy(), "spreadBy", "row key, used to scatter rows when a dictionary is too large to broadcast",
        TypeConverters.toListString,
    )


class _Fitted(Model, _Columns):
    state = Param(Params._dummy(), "state", "fitted values, as plain data", TypeConverters.identity)

    @classmethod
    def of(cls, columns: Sequence[str], state: dict):
        model = cls()
        model._set(inputCols=list(columns), state=state)
        return model

    def fitted(self) -> dict:
        return self.getOrDefault(self.state)


# --- numeric columns -------------------------------------------------------------


class StandardScale(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / population standard deviation; a constant column becomes 0."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> StandardScaleModel:
        found = stats.means_and_deviations(dataset, self.columns())
        return StandardScaleModel.of(self.columns(), {c: list(v) for c, v in found.items()})


class StandardScaleModel(_Fitted, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        scaled = {}
        for c, (mean, deviation) in self.fitted().items():
            x = quoted(c).cast("double")
            scaled[c] = (x - F.lit(mean)) / F.lit(deviation or 1.0)
        return dataset.withColumns(scaled)


class _Impute(Estimator, _Columns):
    def _values(self, dataset: DataFrame) -> dict[str, object]:
        raise NotImplementedError

    def _fit(self, dataset: DataFrame) -> ImputeModel:
        return ImputeModel.of(self.columns(), self._values(dataset))


class MedianImpute(_Impute, DefaultParamsReadable, DefaultParamsWritable):
    """Replace missing numbers by the exact median of the fitted table."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _values(self, dataset: DataFrame) -> dict[str, object]:
        return stats.medians(dataset, self.columns())


class ModeImpute(_Impute, DefaultParamsReadable, DefaultParamsWritable):
    """Replace missing values by the most frequent one."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _values(self, dataset: DataFrame) -> dict[str, object]:
        return stats.modes(dataset, self.columns())


class ImputeModel(_Fitted, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        filled = {}
        for c, value in self.fitted().items():
            x = quoted(c)
            if dataset.schema[c].dataType.simpleString() in ("float", "double"):
                x = F.when(~F.isnan(x), x)
            filled[c] = F.coalesce(x, F.lit(value))
        return dataset.withColumns(filled)


class MissingIndicator(Transformer, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Add ``<column>_missing`` (0/1), so a model can still see what was imputed."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({f"{c}_missing": is_missing(dataset, c) for c in self.columns()})


class FillNumbers(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Complete all numeric columns but the excluded ones for a model that takes no NULL.

    A column with missing values in the fitted table gets an indicator and its median;
    any other, such as the code of a value never seen, gets 0.
    """

    exclude = Param(Params._dummy(), "exclude", "keys and targets", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, exclude: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        excluded = set(self.getOrDefault(self.exclude))
        names = [c for c in columns_of_type(dataset, include="number") if c not in excluded]
        gaps = []
        if names:
            row = dataset.agg(*[F.sum(is_missing(dataset, c)).alias(c) for c in names]).first()
            gaps = [c for c in names if row[c]]
        fill: dict[str, object] = {c: 0 for c in names}
        if gaps:
            fill |= stats.medians(dataset, gaps)
        return PipelineModel([MissingIndicator(inputCols=gaps), ImputeModel.of(names, fill)])


# --- dictionaries ----------------------------------------------------------------


def _sized(counts: DataFrame) -> dict[str, tuple[int, int, int]]:
    """Per column: number of values, their text bytes, and the rows they cover."""
    rows = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("entries"),
        F.sum(F.octet_length(F.col("value").cast("string"))).alias("bytes"),
        F.sum("n").alias("rows"),
    )
    return {r["column"]: (r["entries"], r["bytes"], r["rows"]) for r in rows.collect()}


def _small_columns(sizes: dict[str, tuple[int, int, int]]) -> list[str]:
    """Columns whose dictionaries are read back: each small, and all of them within the limit."""
    small, total = [], 0
    for c, (entries, size, _) in sorted(sizes.items(), key=lambda item: item[1][1]):
        total += size + 16 * entries
        if entries <= SMALL_ENTRIES and size <= SMALL_BYTES and total <= SMALL_TOTAL_BYTES:
            small.append(c)
    return small


def _inline(rows: list, code) -> dict:
    return {"values": [r["text"] for r in rows], "codes": [float(code(i, r)) for i, r in enumerate(rows)]}


def _large_dictionary(counts: DataFrame, kind: str, rows: int, size: int) -> dict:
    """Code the values of one column as a table; only its frequent values are read back.

    Ordinal codes are places in a table written in order, so no task sorts the whole
    dictionary and each value moves once.
    """
    text = as_text(counts, "value").alias("value")
    if kind == "ordinal":
        path, before = stats.written_in_order(counts, ["value"], [text, F.col("n")], "dictionary")
        state = {"table": path, "before": before, "bytes": size}
    else:
        coded = counts.select(text, (F.col("n") / F.lit(float(rows))).alias("code"), "n")
        state = {"table": write_table(coded, "dictionary", compression="zstd"), "bytes": size}
    table = _dictionary(counts.sparkSession, state)
    hot = table.where(F.col("n") > HOT_SHARE * rows).select(digest("value").alias("value"), "code").collect()
    return state | {"hot": {"values": [r["value"] for r in hot], "codes": [r["code"] for r in hot]}}


def _dictionary(spark: SparkSession, state: dict) -> DataFrame:
    """``(value, code, n)`` of a large dictionary."""
    if "before" not in state:
        return spark.read.schema(f"{_ENTRY}, n long").parquet(state["table"])
    table = spark.read.schema("value string, n long, at long").parquet(state["table"])
    return table.select("value", stats.place(F.col("at"), state["before"]).cast("double").alias("code"), "n")


def _coded_counts(counts: DataFrame, names: Sequence[str], kind: str) -> dict[str, dict]:
    """Turn written value counts into dictionaries of ``kind`` ("ordinal" or "frequency").

    A dictionary whose checked size is small is read into the fitted state.
    """
    if not names:
        return {}
    counts = counts.where(F.col("column").isin(list(names)))
    sizes = _sized(counts)
    small = _small_columns(sizes)
    rows: dict[str, list] = {c: [] for c in names}
    if small:
        text = as_text(counts, "value").alias("text")
        for r in counts.where(F.col("column").isin(small)).select("column", "value", "n", text).collect():
            rows[r["column"]].append(r)
    state: dict[str, dict] = {}
    for c in names:
        if c in sizes and c not in small:
            entries, size, covered = sizes[c]
            state[c] = _large_dictionary(counts.where(F.col("column") == c), kind, covered, size + 16 * entries)
            continue
        ordered = sorted(rows[c], key=lambda r: r["value"])
        total = sizes[c][2] if c in sizes else 1
        state[c] = _inline(ordered, lambda i, r, total=total: i if kind == "ordinal" else r["n"] / total)
    return state


def _dictionaries(dataset: DataFrame, names: Sequence[str], kind: str) -> dict[str, dict]:
    """Fit dictionaries for several columns, with one shuffle per type of column."""
    state: dict[str, dict] = {}
    for group in stats.by_type(dataset, names).values():
        state |= _coded_counts(materialise(stats.value_counts(dataset, group), "values", compression="zstd"), group, kind)
    return {c: state[c] for c in names}


_ENTRY = "value string, code double"


def _entries(spark: SparkSession, inline: dict) -> DataFrame:
    return spark.createDataFrame(list(zip(inline["values"], inline["codes"])), _ENTRY)


class OrdinalEncode(Estimator, _Columns, _Spread, DefaultParamsReadable, DefaultParamsWritable):
    """Replace values by their position in the sorted list of fitted values.

    Numbers sort as numbers and text by code point. An unknown value fails, or
    becomes NULL with ``unknown="null"``; a missing value stays missing.
    """

    unknown = Param(Params._dummy(), "unknown", "error or null", TypeConverters.toString)

    @keyword_only
    def __init__(
        self, *, inputCols: list[str] | None = None, unknown: str = "error", spreadBy: list[str] | None = None
    ):
        super().__init__()
        self._setDefault(unknown="error", spreadBy=[])
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> DictionaryModel:
        state = {
            "columns": _dictionaries(dataset, self.columns(), "ordinal"),
            "unknown": self.getOrDefault(self.unknown),
            "spread_by": self.getOrDefault(self.spreadBy),
        }
        return DictionaryModel.of(self.columns(), state)


class FrequencyEncode(Estimator, _Columns, _Spread, DefaultParamsReadable, DefaultParamsWritable):
    """Replace values by their share among the non-missing fitted rows; unknown is NULL."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, spreadBy: list[str] | None = None):
        super().__init__()
        self._setDefault(spreadBy=[])
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> DictionaryModel:
        state = {
            "columns": _dictionaries(dataset, self.columns(), "frequency"),
            "unknown": "null",
            "spread_by": self.getOrDefault(self.spreadBy),
        }
        return DictionaryModel.of(self.columns(), state)


def checked(df: DataFrame, c: str, code: Column) -> Column:
    """``code``, or a failure where a value has none."""
    text = as_text(df, c)
    return F.when(text.isNull() | code.isNotNull(), code).otherwise(unknown_category(c, text))


def replaced(df: DataFrame, c: str, code: str, strict: bool) -> DataFrame:
    """The column by its code, at once: the value is moved no further."""
    return df.withColumn(c, checked(df, c, F.col(code)) if strict else F.col(code)).drop(code)


class DictionaryModel(_Fitted, MLReadable, MLWritable):
    """Replaces values by a fitted code, by broadcast or by a skew-proof join."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Small dictionaries are broadcast. Large ones are joined after the frequent values of
        the table, known or not, are answered by broadcast: one by one on a streaming table
        or where that moves less, else all by a single join."""
        state = self.fitted()
        spark = dataset.sparkSession
        order, spread = dataset.columns, state["spread_by"] or None
        out = {c: f"_coded_{i}" for i, c in enumerate(state["columns"])}
        strict = state["unknown"] == "error"
        large, hot = {}, {}
        for c, fitted in state["columns"].items():
            if "table" in fitted:
                large[c] = _dictionary(spark, fitted).select("value", "code")
                hot[c] = _entries(spark, fitted["hot"])
        done: set[str] = set()
        if dataset.isStreaming or len(large) == 1:
            for c, table in large.items():
                answered = hot_entries(dataset, {c: table}, {c: hot[c]}).select("value", "code")
                dataset = lookup(dataset, c, table, out[c], hot=answered, spread_by=spread)
        elif large:
            sizes = {c: state["columns"][c].get("bytes") for c in large}
            near, singly = ways(dataset, sizes)
            for c in near:
                dataset = replaced(lookup(dataset, c, large[c], out[c], small=True), c, out[c], strict)
            rest = {c: t for c, t in large.items() if c not in near}
            if singly:
                found = hot_entries(dataset, rest, hot)
                for c in sorted(rest, key=lambda c: -sizes[c]):
                    answered = found.where(F.col("column") == list(rest).index(c)).select("value", "code")
                    dataset = lookup(dataset, c, rest[c], out[c], hot=answered, spread_by=spread, strict=strict)
                    dataset = dataset.withColumn(c, F.col(out[c])).drop(out[c])
                done = set(large)
            else:
                done = set(near)
                if rest:
                    dataset = lookup_many(dataset, rest, out, hot_entries(dataset, rest, hot), spread)
        coded = {}
        for c, fitted in state["columns"].items():
            if c in done:
                continue
            if c not in large:
                dataset = lookup(dataset, c, _entries(spark, fitted), out[c], small=True)
            coded[c] = checked(dataset, c, F.col(out[c])) if strict else F.col(out[c])
        return dataset.select(*[coded[n].alias(n) if n in coded else quoted(n) for n in order])

    def write(self) -> MLWriter:
        return _DictionaryWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _DictionaryReader(cls)


class _DictionaryWriter(MLWriter):
    """Stores the parameters, and a copy of each large dictionary beside them."""

    def __init__(self, instance: DictionaryModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        for i, fitted in enumerate(self.instance.fitted()["columns"].values()):
            if "table" in fitted:
                _dictionary(self.sparkSession, fitted).write.parquet(f"{path}/dictionary-{i}")


class _DictionaryReader(MLReader):
    def __init__(self, cls: type[DictionaryModel]):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> DictionaryModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        DefaultParamsReader.getAndSetParams(model, metadata)
        model._resetUid(metadata["uid"])
        for i, fitted in enumerate(model.fitted()["columns"].values()):
            if "table" in fitted:
                fitted["table"] = f"{path}/dictionary-{i}"
                fitted.pop("before", None)
        return model


# --- one column per category -----------------------------------------------------


class OneHotEncode(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """One 0/1 column ``<column>=<value>`` per fitted category; unknown is all zeros.

    ``output="vector"`` puts the block of a column into one vector ``<column>_onehot``
    for a model; a column with many categories gets a sparse one with the same slots:
    categories in order, numbers as numbers. A missing value, NULL or NaN, is all zeros unless ``missingAsCategory``. The source columns are dropped.
    """

    output = Param(Params._dummy(), "output", "columns or vector", TypeConverters.toString)
    missingAsCategory = Param(Params._dummy(), "missingAsCategory", "give NULL a category", TypeConverters.toBoolean)

    @keyword_only
    def __init__(
        self, *, inputCols: list[str] | None = None, output: str = "columns", missingAsCategory: bool = False
    ):
        super().__init__()
        self._setDefault(output="columns", missingAsCategory=False)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> Model:
        vector, missing = self.getOrDefault(self.output) == "vector", self.getOrDefault(self.missingAsCategory)
        listed: dict[str, list] = {}
        wide: dict[str, tuple[dict, int]] = {}
        for group in stats.by_type(dataset, self.columns()).values():
            counts = materialise(stats.value_counts(dataset, group), "categories")
            sizes = _sized(counts)
            many = [c for c in group if vector and c in sizes and sizes[c][0] > INLINE_CATEGORIES]
            coded = _coded_counts(counts, many, "ordinal")
            wide |= {c: (coded[c], sizes[c][0]) for c in many}
            _read_categories(counts, [c for c in group if c not in wide], listed)
        narrow = self.model({c: listed[c] for c in self.columns() if c in listed})
        if not wide:
            return narrow
        return PipelineModel([narrow, *[s for c, (state, n) in wide.items() for s in _wide_one_hot(dataset, c, state, n, missing)]])

    def model(self, listed: dict[str, list]) -> OneHotModel:
        state = {
            "categories": listed,
            "output": self.getOrDefault(self.output),
            "missing": self.getOrDefault(self.missingAsCategory),
        }
        return OneHotModel.of(list(listed), state)


def _wide_one_hot(dataset: DataFrame, c: str, state: dict, n: int, missing: bool) -> list[Transformer]:
    """Stages that turn one column into a sparse vector over its sorted categories.

    The position comes from the dictionary; an unknown value gets a position beyond the
    vector, and so no slot. A missing value does too, or takes the slot after the last.
    """
    width = n + missing
    gone = f"`{c}` IS NULL" + (f" OR isnan(`{c}`)" if dataset.schema[c].dataType.simpleString() in ("float", "double") else "")
    beside = f"coalesce(CAST(`{c}_code` AS DOUBLE), CASE WHEN {gone} THEN {n}D ELSE {width}D END) AS `{c}_slot`"
    encoder = OneHotEncoder(inputCols=[f"{c}_slot"], outputCols=[f"{c}_onehot"], dropLast=True, handleInvalid="keep")
    return [
        SQLTransformer(statement=f"SELECT *, `{c}` AS `{c}_code` FROM __THIS__"),
        DictionaryModel.of([f"{c}_code"], {"columns": {f"{c}_code": state}, "unknown": "null", "spread_by": []}),
        SQLTransformer(statement=f"SELECT *, {beside} FROM __THIS__"),
        encoder.fit(dataset.sparkSession.createDataFrame([(float(width - 1),)], f"`{c}_slot` double")),
        DropColumns(inputCols=[c, f"{c}_code", f"{c}_slot"]),
    ]


def _read_categories(counts: DataFrame, names: Sequence[str], into: dict[str, list]) -> None:
    """Sorted texts of the categories of each column: one name for each column or class that
    the caller asked for, so as many as the plan or model holds anyway."""
    if not names:
        return
    text = as_text(counts, "value").alias("text")
    found: dict[str, list] = {c: [] for c in names}
    for r in counts.where(F.col("column").isin(list(names))).select("column", "value", text).collect():
        found[r["column"]].append(r)
    for c in names:
        into[c] = [r["text"] for r in sorted(found[c], key=lambda r: r["value"])]


def sorted_categories(dataset: DataFrame, names: Sequence[str]) -> dict[str, list[str]]:
    """The categories of several columns in order."""
    listed: dict[str, list] = {c: [] for c in names}
    for group in stats.by_type(dataset, names).values():
        _read_categories(materialise(stats.value_counts(dataset, group), "categories"), group, listed)
    return listed


class OneHotModel(_Fitted, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        state = self.fitted()
        added: dict[str, Column] = {}
        for c, values in state["categories"].items():
            text = as_text(dataset, c)
            flags = {f"{c}={v}": F.coalesce(text == F.lit(v), F.lit(False)).cast("double") for v in values}
            if state["missing"]:
                flags[f"{c}=NULL"] = text.isNull().cast("double")
            if state["output"] == "columns":
                added.update(flags)
            else:
                added[f"{c}_onehot"] = array_to_vector(F.array(*flags.values()))
        kept = [quoted(n) for n in dataset.columns if n not in state["categories"]]
        return dataset.select(*kept, *[col.alias(name) for name, col in added.items()])


def sparse_one_hot(columns: Sequence[str]) -> list[Estimator]:
    """Stages that build sparse ``<column>_onehot`` vectors; unknown and missing are all zeros.

    The indexer gives unseen values one extra last index and the encoder drops it. The
    fitted values live on the driver, like the width of the vector; for columns wider
    than that use ``FrequencyEncode``.
    """
    index = StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}_index" for c in columns],
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    )
    encode = OneHotEncoder(
        inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_onehot" for c in columns], dropLast=True
    )
    return [index, encode, DropColumns(inputCols=[*columns, *[f"{c}_index" for c in columns]])]


class RoutedEncode(Estimator, _Columns, _Spread, DefaultParamsReadable, DefaultParamsWritable):
    """Few distinct values: one-hot. ``threshold`` or more: frequency.

    One set of value counts answers both the choice and the encodings. The choice is
    part of the fitted model and does not change with later tables.
    """

    threshold = Param(Params._dummy(), "threshold", "distinct values from which on to use frequency", TypeConverters.toInt)
    output = Param(Params._dummy(), "output", "columns or vector", TypeConverters.toString)

    @keyword_only
    def __init__(
        self,
        *,
        inputCols: list[str] | None = None,
        threshold: int = 10,
        output: str = "columns",
        spreadBy: list[str] | None = None,
    ):
        super().__init__()
        self._setDefault(threshold=10, output="columns", spreadBy=[])
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        names = self.columns()
        limit = self.getOrDefault(self.threshold)
        few: dict[str, list] = {}
        many: dict[str, dict] = {}
        wide: list[tuple[str, dict, int]] = []
        for group in stats.by_type(dataset, names).values():
            counts = materialise(stats.value_counts(dataset, group), "routed")
            sizes = _sized(counts)
            low = [c for c in group if sizes.get(c, (0, 0, 0))[0] < limit]
            inline = [c for c in low if sizes.get(c, (0, 0, 0))[0] <= INLINE_CATEGORIES or self.getOrDefault(self.output) == "columns"]
            _read_categories(counts, inline, few)
            coded = _coded_counts(counts, [c for c in low if c not in inline], "ordinal")
            wide += [(c, state, sizes[c][0]) for c, state in coded.items()]
            many |= _coded_counts(counts, [c for c in group if c not in low], "frequency")
        low = [c for c in names if c in few]
        high = [c for c in names if c in many]
        stages: list[Transformer] = []
        if low:
            encoder = OneHotEncode(inputCols=low, output=self.getOrDefault(self.output))
            stages.append(encoder.model({c: few[c] for c in low}))
        stages += [s for c, state, n in wide for s in _wide_one_hot(dataset, c, state, n, False)]
        if high:
            state = {
                "columns": {c: many[c] for c in high},
                "unknown": "null",
                "spread_by": self.getOrDefault(self.spreadBy),
            }
            stages.append(DictionaryModel.of(high, state))
        return PipelineModel(stages)


# --- composition -----------------------------------------------------------------


class KeepColumns(Transformer, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Only the listed columns, as far as the table has them."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.select(*[quoted(c) for c in self.columns() if c in dataset.columns])


class DropColumns(Transformer, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Without the listed columns; absent ones are ignored."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.select(*[quoted(c) for c in dataset.columns if c not in set(self.columns())])


class FunctionStage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A stateless function DataFrame -> DataFrame as a stage.

    The function is stored by its import path, so it must be defined in a module.
    """

    function = Param(Params._dummy(), "function", "module:name of the function", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, function: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    @classmethod
    def of(cls, fn: Callable[[DataFrame], DataFrame]) -> FunctionStage:
        if not callable(fn) or "<" in fn.__qualname__:
            raise TypeError("FunctionStage needs a function defined at module level")
        return cls(function=f"{fn.__module__}:{fn.__qualname__}")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        module, name = self.getOrDefault(self.function).split(":")
        return getattr(import_module(module), name)(dataset)


class FeatureVector(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Collect every numeric and vector column but the excluded ones into ``features``.

    Which columns those are is decided on the fitted table and then fixed. A missing
    value fails when the features are used; impute it before.
    """

    exclude = Param(Params._dummy(), "exclude", "keys and targets", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, exclude: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> VectorAssembler:
        excluded = set(self.getOrDefault(self.exclude))
        names = [
            f.name
            for f in dataset.schema
            if f.name not in excluded and isinstance(f.dataType, (T.NumericType, T.BooleanType, VectorUDT))
        ]
        if not names:
            raise ValueError("no feature columns left")
        return VectorAssembler(inputCols=names, outputCol="features", handleInvalid="error")


def column_groups(groups: Sequence[tuple[str, Sequence[Estimator | Transformer], Sequence[str]]], keep: Sequence[str]):
    """Stages for several column groups; columns in no group and not in ``keep`` are dropped."""
    taken: set[str] = set()
    stages: list[Estimator | Transformer] = []
    listed: list[str] = list(keep)
    for name, parts, columns in groups:
        if taken & set(columns):
            raise ValueError(f"group {name} shares columns with another group")
        taken |= set(columns)
        listed += list(columns)
        stages += list(parts)
    return [KeepColumns(inputCols=listed), *stages]
