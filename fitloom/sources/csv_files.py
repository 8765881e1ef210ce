"""CSV ingest with by-name typing, and the CSV sinks."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .csv_records import split_records

# The field texts that count as missing.
MISSING_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Declared dtype name -> Spark type. Half precision is widened to float.
DTYPE_NAMES = {
    "bool": T.BooleanType(),
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "uint8": T.ShortType(),
    "uint16": T.IntegerType(),
    "uint32": T.LongType(),
    "float16": T.FloatType(),
    "float32": T.FloatType(),
    "float64": T.DoubleType(),
    "object": T.StringType(),
    "string": T.StringType(),
    "category": T.StringType(),
    "datetime64[ns]": T.TimestampNTZType(),
}


# Numbers as a file spells them; other texts that Spark could cast, such as 1d, stay text.
WHOLE_NUMBER = r"^[+-]?[0-9]+$"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(?i:inf|infinity)$"
ROWS_PER_FILE = 1_000_000


def spark_type(dtype: str) -> T.DataType:
    """Spark type of a declared dtype name."""
    try:
        return DTYPE_NAMES[dtype.strip()]
    except KeyError:
        raise ValueError(f"unknown dtype name: {dtype!r}") from None


def read_schema_table(spark: SparkSession, path: str) -> T.StructType:
    """Turn a CSV with the columns ``column`` and ``dtype`` into a schema.

    The table has one row per data column, so reading it on the driver is bounded
    by the width of the data, not by its length.
    """
    table = spark.read.csv(path, header=True, schema="column string, dtype string", enforceSchema=False)
    return T.StructType([T.StructField(row["column"], spark_type(row["dtype"])) for row in table.collect()])


def _as_list(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.csv(path, header=True).columns


def _files_by_header(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """All files below the paths, grouped by their first line, from one job over all of them.

    Only the first block of a file is looked at, and one line of each is kept.
    """
    lines = spark.read.text(paths).select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("n"))
    first = lines.where("file_block_start = 0").groupBy("file_path").agg(F.min_by("value", "n").alias("header"))
    groups = first.groupBy("header").agg(F.sort_array(F.collect_list("file_path")).alias("files"))
    found = {tuple(next(csv.reader([r.header]))): [unquote(f) for f in r.files] for r in groups.collect()}
    return dict(sorted(found.items(), key=lambda group: group[1][0]))  # columns in the order of the first file by name


def _scan_split(spark: SparkSession, paths: list[str], header: list[str]) -> DataFrame:
    """All fields as text, of files that many tasks cut into records; headers are checked."""
    ddl = ", ".join(f"`{name.replace('`', '``')}` STRING" for name in header)
    options = {"mode": "FAILFAST", "escape": '"', "multiLine": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    rows = split_records(spark, paths).select("path", "first", F.from_csv("record", ddl, options).alias("row"))
    names = F.array(*[F.col("row").getField(name) for name in header])
    other = F.raise_error(F.concat(F.lit("another header in "), "path")).cast("boolean")
    data = F.when(~F.col("first"), True).when(names == F.array(*map(F.lit, header)), False).otherwise(other)
    return rows.where(data).select("row.*")


def _scan_text(spark: SparkSession, paths: list[str], header: list[str], multi_line: bool | str) -> DataFrame:
    if multi_line not in (True, False, "split"):
        raise ValueError(f"multi_line is True, False or 'split', not {multi_line!r}")
    if multi_line == "split":
        return _scan_split(spark, paths, header)
    strings = T.StructType([T.StructField(name, T.StringType()) for name in header])
    return spark.read.csv(
        paths,
        schema=strings,
        header=True,
        enforceSchema=False,
        mode="FAILFAST",
        multiLine=bool(multi_line),
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def _field(name: str, dtype: T.DataType) -> Column:
    text = F.col(f"`{name}`")
    if isinstance(dtype, T.StringType):  # text is taken as it stands, blanks included
        return F.when(~(text.isNull() | text.isin(*MISSING_MARKERS)), text).alias(name)
    missing = text.isNull() | F.trim(text).isin(*MISSING_MARKERS)
    parsed = F.trim(text).try_cast(dtype)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        parsed = F.when(~F.isnan(parsed), parsed)
    malformed = F.raise_error(F.concat(F.lit(f"column {name}: not a {dtype.simpleString()}: "), text))
    return F.when(~missing, F.coalesce(parsed, malformed)).alias(name)


def _inference_counts(name: str) -> list[Column]:
    text = F.col(f"`{name}`")
    present = F.when(~text.isin(*MISSING_MARKERS), F.trim(text))
    return [
        F.count(present).alias(f"{name}\0n"),
        F.count(F.when(present.rlike(WHOLE_NUMBER), present.try_cast("bigint"))).alias(f"{name}\0long"),
        F.count(F.when(present.rlike(NUMBER), present.try_cast("double"))).alias(f"{name}\0double"),
        F.count(F.when(present.isin("True", "TRUE", "true", "False", "FALSE", "false"), 1)).alias(f"{name}\0bool"),
    ]


def infer_schema(spark: SparkSession, paths: str | Sequence[str], multi_line: bool | str = False) -> T.StructType:
    """Infer long, double, boolean or string per column in one pass over all rows.

    All counters of all columns sit in a single aggregate, so the result of the
    pass is one row whatever the size of the files.
    """
    files = _as_list(paths)
    return _inferred(_scan_text(spark, files, _header(spark, files[0]), multi_line))


def _inferred(scan: DataFrame) -> T.StructType:
    row = scan.agg(*[c for name in scan.columns for c in _inference_counts(name)]).first()
    fields = []
    for name in scan.columns:
        n, as_long, as_double, as_bool = (row[f"{name}\0{kind}"] for kind in ("n", "long", "double", "bool"))
        if n == 0 or as_double == n:
            dtype: T.DataType = T.LongType() if 0 < n == as_long else T.DoubleType()
        else:
            dtype = T.BooleanType() if as_bool == n else T.StringType()
        fields.append(T.StructField(name, dtype))
    return T.StructType(fields)


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | Mapping[str, T.DataType] | None = None,
    mixed_headers: bool = False,
    multi_line: bool | str = False,
) -> DataFrame:
    """Read one or many CSV files as one table, binding columns by header name.

    ``schema`` maps names to types; names the files lack are ignored, columns it
    lacks are inferred. Every missing-value marker becomes NULL and a malformed
    field fails the read. With one header for all files there is a single scan
    that verifies each file's header; ``mixed_headers`` groups the files by header
    first, so the plan has one scan per distinct header, not per file.

    ``multi_line=True`` allows line ends inside quotes, one task a file. ``"split"`` does so
    with as many tasks a file as it has blocks: it reads the files twice, writes their records
    to the shared folder, and needs every quote to belong to a quoted field. It keeps ``\\r\\n``
    inside fields, which one task a file turns into ``\\n`` where the file's lines end so.
    """
    files = _as_list(paths)
    if not files:
        raise ValueError("no files given")
    by_header: dict[tuple[str, ...], list[str]] = {}
    if mixed_headers:
        by_header = _files_by_header(spark, files)
    else:
        by_header[tuple(_header(spark, files[0]))] = files

    declared: dict[str, T.DataType] = {}
    if schema is not None:
        declared = {f.name: f.dataType for f in schema} if isinstance(schema, T.StructType) else dict(schema)
    parts = []
    for header, group in by_header.items():
        types = dict(declared)
        scan = _scan_text(spark, group, list(header), multi_line)
        if any(name not in types for name in header):
            types = {f.name: f.dataType for f in _inferred(scan)} | types
        parts.append(scan.select(*[_field(name, types[name]) for name in header]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write the table as a folder of CSV files with a header and no row index.

    A file has at most ``rows_per_file`` rows, so that one with line ends inside its fields,
    which a single task must read, stays small.
    """
    writer = df.write.mode(mode).option("maxRecordsPerFile", rows_per_file).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
    writer.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def submission(scored: DataFrame, key: str | Sequence[str], outputs: Mapping[str, str | Column]) -> DataFrame:
    """Key columns plus named outputs of a scored table.

    The key travels with its row, so nothing is re-attached by position.
    """
    keys = _as_list(key)
    missing = [k for k in keys if k not in scored.columns]
    if not keys or missing:
        raise ValueError(f"the sink needs the row key; missing: {missing or 'key'}")
    if not outputs or set(outputs) & set(keys):
        raise ValueError("name at least one output, different from the key")
    columns = [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in outputs.items()]
    return scored.select(*keys, *columns)
