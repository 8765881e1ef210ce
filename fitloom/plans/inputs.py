"""Named inputs of a plan: what a job reads, bound to real tables and files at fit or predict.

A plan declares its inputs once. Each run hands in a binding, a mapping from input names to
DataFrames, paths or plain values. A binding is checked as a whole before anything is read;
its values become lazy tables, path lists and schemas, and the plan's upstream steps, functions of
inputs and of earlier steps, turn them into the table at the feature mark.
"""

from __future__ import annotations

import dataclasses
import hashlib
import importlib
import inspect
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources.csv_files import read_csv, read_schema_table
from ..sources.preview import preview, preview_files

Step = Callable[..., Any]
Steps = Step | Mapping[str, Step]


@dataclass(frozen=True)
class TableInput:
    """A DataFrame. ``columns`` it must have, by name or as names with Spark type names.

    ``fit_only`` inputs, such as a table of labels, may be left out when predicting; steps
    then get None. ``preview_key`` orders the rows that a preview looks at.
    """

    name: str
    columns: Sequence[str] | Mapping[str, str] = ()
    fit_only: bool = False
    preview_key: str | Sequence[str] | None = None

    def problem(self, value: Any) -> str | None:
        if not isinstance(value, DataFrame):
            return f"a DataFrame is needed, not {type(value).__name__}"
        found = {f.name: f.dataType.simpleString() for f in value.schema}
        absent = [c for c in self.columns if c not in found]
        if absent:
            return f"no such column: {absent}"
        wanted = self.columns if isinstance(self.columns, Mapping) else {}
        wrong = [f"{c} is {found[c]}, not {t}" for c, t in wanted.items() if found[c] != t]
        return "; ".join(wrong) or None

    def resolve(self, spark: SparkSession, value: DataFrame) -> DataFrame:
        return value

    def previewed(self, value: DataFrame, n: int, files: int) -> DataFrame:
        return preview(value, self.preview_key, n) if self.preview_key else value


@dataclass(frozen=True)
class PathsInput:
    """One path or a list of paths. A preview takes the first few by name."""

    name: str
    fit_only: bool = False

    def problem(self, value: Any) -> str | None:
        paths = [value] if isinstance(value, str) else value
        if not isinstance(paths, Sequence) or not paths or not all(isinstance(p, str) and p for p in paths):
            return "a path or a list of paths is needed"
        return None

    def resolve(self, spark: SparkSession, value: str | Sequence[str]) -> list[str]:
        return [value] if isinstance(value, str) else list(value)

    def previewed(self, value: str | Sequence[str], n: int, files: int) -> list[str]:
        return preview_files([value] if isinstance(value, str) else list(value), files)


@dataclass(frozen=True)
class SchemaInput:
    """A schema: the path of a table of columns and dtypes, or a Spark schema as it is."""

    name: str
    fit_only: bool = False

    def problem(self, value: Any) -> str | None:
        return None if isinstance(value, (str, T.StructType)) and value else "a path or a schema is needed"

    def resolve(self, spark: SparkSession, value: str | T.StructType) -> T.StructType:
        return read_schema_table(spark, value) if isinstance(value, str) else value

    def previewed(self, value: str | T.StructType, n: int, files: int) -> str | T.StructType:
        return value


@dataclass(frozen=True)
class ValueInput:
    """A plain value of one type, such as a threshold or a date."""

    name: str
    type: str = "float"
    fit_only: bool = False

    def problem(self, value: Any) -> str | None:
        return None if type(value).__name__ == self.type else f"{self.type} is needed, not {type(value).__name__}"

    def resolve(self, spark: SparkSession, value: Any) -> Any:
        return value

    def previewed(self, value: Any, n: int, files: int) -> Any:
        return value


Input = TableInput | PathsInput | SchemaInput | ValueInput
KINDS: dict[str, type] = {k.__name__: k for k in (TableInput, PathsInput, SchemaInput, ValueInput)}


def check_inputs(inputs: Sequence[Input], prepare: Steps | None) -> None:
    """Names must be distinct, and every step's parameters inputs or earlier steps."""
    names = [i.name for i in inputs]
    if len(set(names)) != len(names):
        raise ValueError(f"two inputs of one name: {names}")
    if not inputs:
        if isinstance(prepare, Mapping):
            raise ValueError("several steps need named inputs")
        return
    known = set(names)
    for name, step in _named(prepare).items():
        if name in known:
            raise ValueError(f"a step has the name of an input or of another step: {name}")
        strange = [p for p in inspect.signature(step).parameters if p not in known]
        if strange:
            raise ValueError(f"step {name}: no input or earlier step is called {strange}")
        known.add(name)
    if prepare is None and not (len(inputs) == 1 and isinstance(inputs[0], TableInput)):
        raise ValueError("inputs other than one table need a step that makes one table of them")


def _named(prepare: Steps | None) -> dict[str, Step]:
    if prepare is None:
        return {}
    return dict(prepare) if isinstance(prepare, Mapping) else {"prepare": prepare}


def _checked(inputs: Sequence[Input], binding: Mapping[str, Any], fitting: bool) -> None:
    problems = [f"{name}: no input of this name" for name in binding if name not in {i.name for i in inputs}]
    for i in inputs:
        if binding.get(i.name) is None:
            if fitting or not i.fit_only:
                problems.append(f"{i.name}: not bound")
        elif wrong := i.problem(binding[i.name]):
            problems.append(f"{i.name}: {wrong}")
    if problems:
        raise ValueError("; ".join(problems))


def table_at_mark(inputs: Sequence[Input], prepare: Steps | None, binding: Mapping[str, Any], fitting: bool) -> DataFrame:
    """The binding checked, resolved and passed through the steps; the last step's table.

    Only schemas and headers are read here; rows are read when the table is.
    """
    _checked(inputs, binding, fitting)
    tables = [v for v in binding.values() if isinstance(v, DataFrame)]
    spark = tables[0].sparkSession if tables else SparkSession.active()
    values = {i.name: None if binding.get(i.name) is None else i.resolve(spark, binding[i.name]) for i in inputs}
    out = values[inputs[0].name]
    for name, step in _named(prepare).items():
        out = values[name] = step(**{p: values[p] for p in inspect.signature(step).parameters})
    if not isinstance(out, DataFrame):
        raise TypeError(f"the last step must give a DataFrame, not {type(out).__name__}")
    return out


def previewed_binding(inputs: Sequence[Input], binding: Mapping[str, Any], n: int, files: int) -> dict[str, Any]:
    """A binding to the first ``n`` rows by key of each table that has a preview key, and to the
    first ``files`` files by name of each path list."""
    _checked(inputs, binding, True)
    return {i.name: i.previewed(binding[i.name], n, files) for i in inputs}


def read_files(file_names: list[str], schema: T.StructType) -> DataFrame:
    """A ready step: all files as one table, columns bound by name and typed by the schema."""
    return read_csv(SparkSession.active(), file_names, schema, mixed_headers=True)


# --- storing steps ------------------------------------------------------------------


def described(prepare: Steps | None, inputs: Sequence[Input]) -> dict[str, Any]:
    """Steps by import path and hash of their source, and the inputs, as plain values.

    A step is a function, or an object of a dataclass, whose fields are stored with it. One that
    cannot be imported by name, such as a lambda, is stored without a path: it has to be handed
    in again at load.
    """
    steps = []
    for name, step in _named(prepare).items():
        fields = {k: _plain(v) for k, v in vars(step).items()} if dataclasses.is_dataclass(step) else None
        code = step if fields is None else type(step)
        path = f"{code.__module__}:{code.__qualname__}" if _importable(code) else None
        steps.append({"name": name, "path": path, "fields": fields, "hash": _source_hash(code) if path else None})
    kinds = [{"kind": type(i).__name__, **{k: _plain(v) for k, v in vars(i).items()}} for i in inputs]
    return {"steps": steps, "several": isinstance(prepare, Mapping), "inputs": kinds}


def _plain(value: Any) -> Any:
    return dict(value) if isinstance(value, Mapping) else list(value) if isinstance(value, (list, tuple)) else value


def _importable(step: Step) -> bool:
    name = getattr(step, "__qualname__", "<")
    if "<" in name or getattr(step, "__module__", "__main__") == "__main__":
        return False
    try:
        return _imported(f"{step.__module__}:{name}") is step
    except (ImportError, AttributeError):
        return False


def _imported(path: str) -> Step:
    module, _, name = path.partition(":")
    found: Any = importlib.import_module(module)
    for part in name.split("."):
        found = getattr(found, part)
    return found


def _source_hash(step: Step) -> str:
    return hashlib.sha256(inspect.getsource(step).encode()).hexdigest()


def restored(stored: Mapping[str, Any], given: Steps | None, changed: str) -> tuple[Steps | None, tuple[Input, ...]]:
    """Steps and inputs as of :func:`described`. ``given`` steps take the place of stored ones.

    A stored step whose source is no longer the one it was stored with fails, unless
    ``changed`` is ``"accept"``.
    """
    inputs = tuple(KINDS[i["kind"]](**{k: v for k, v in i.items() if k != "kind"}) for i in stored["inputs"])
    if given is not None or not stored["steps"]:
        return given, inputs
    steps: dict[str, Step] = {}
    for s in stored["steps"]:
        if s["path"] is None:
            raise ValueError(f"step {s['name']} was stored without an import path: hand prepare in")
        code = _imported(s["path"])
        if changed != "accept" and _source_hash(code) != s["hash"]:
            raise ValueError(f"step {s['name']} ({s['path']}) has changed since the learner was saved")
        steps[s["name"]] = code if s["fields"] is None else code(**s["fields"])
    return (steps if stored["several"] else next(iter(steps.values()))), inputs
