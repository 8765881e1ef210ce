from .csv_files import (
    MISSING_MARKERS,
    infer_schema,
    read_csv,
    read_schema_table,
    spark_type,
    submission,
    write_csv,
)
from .preview import preview, preview_files
from .tables import hashed_integers, hashed_normal, hashed_uniform, literal_table, numbered_rows

__all__ = [
    "MISSING_MARKERS",
    "hashed_integers",
    "hashed_normal",
    "hashed_uniform",
    "infer_schema",
    "literal_table",
    "numbered_rows",
    "preview",
    "preview_files",
    "read_csv",
    "read_schema_table",
    "spark_type",
    "submission",
    "write_csv",
]
