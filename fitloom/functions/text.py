"""Text column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import _col


def append_text(value: str | Column, suffix: str) -> Column:
    return F.concat(_col(value), F.lit(suffix))


def text_length(value: str | Column) -> Column:
    """Number of characters."""
    return F.char_length(_col(value))


def strip_line_ends(value: str | Column) -> Column:
    """Remove white space before each line end; the line ends themselves stay.

    Only ``\\n`` ends a line, so a carriage return before it goes as well.
    """
    return F.regexp_replace(_col(value), r"(?md)[ \t\r\f\x0B]+$", "")
