from .calendar import calendar_columns, cyclic, parse_timestamp, with_calendar
from .scalars import (
    checked_exp,
    checked_expm1,
    checked_ln,
    checked_log1p,
    checked_sqrt,
    interaction,
    nan_to_null,
)
from .text import append_text, strip_line_ends, text_length

__all__ = [
    "append_text",
    "calendar_columns",
    "checked_exp",
    "checked_expm1",
    "checked_ln",
    "checked_log1p",
    "checked_sqrt",
    "cyclic",
    "interaction",
    "nan_to_null",
    "parse_timestamp",
    "strip_line_ends",
    "text_length",
    "with_calendar",
]
