"""Time formats, parsing and ages."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .cells import cell, dtype, is_text

# Strptime directives, the Spark pattern letters with the same meaning, and the texts they read.
# The second pair reads one digit as well as two, as strptime does; it is only safe where the next character
# of the format is not a digit itself.
DIRECTIVES = {
    "d": (("dd", r"\d{2}"), ("d", r"\d{1,2}")),
    "m": (("MM", r"\d{2}"), ("M", r"\d{1,2}")),
    "y": (("yy", r"\d{2}"), ("yy", r"\d{2}")),
    "Y": (("yyyy", r"\d{4}"), ("yyyy", r"\d{4}")),
    "H": (("HH", r"\d{2}"), ("H", r"\d{1,2}")),
    "I": (("hh", r"\d{2}"), ("h", r"\d{1,2}")),
    "M": (("mm", r"\d{2}"), ("m", r"\d{1,2}")),
    "S": (("ss", r"\d{2}"), ("s", r"\d{1,2}")),
    "f": (("SSSSSS", r"\d{1,6}"), ("SSSSSS", r"\d{1,6}")),
    "j": (("DDD", r"\d{3}"), ("D", r"\d{1,3}")),
    "b": (("MMM", r"[A-Za-z]+"), ("MMM", r"[A-Za-z]+")),
    "B": (("MMMM", r"[A-Za-z]+"), ("MMMM", r"[A-Za-z]+")),
    "p": (("a", r"[AaPp][Mm]"), ("a", r"[AaPp][Mm]")),
}

# Format of the ends of a time range, default validity of a source in hours,
# and the first two-digit year that belongs to the previous century.
RANGE_END_FORMAT = "%d/%m/%Y %H.%M.%S"
DEFAULT_VOLATILITY_HOURS = 17520.0
CENTURY_PIVOT = 69

SECONDS_PER_HOUR = 3600.0


def translate(time_format: str) -> tuple[str, str]:
    """A strptime format as a Spark datetime pattern, and a regular expression for the shape of its texts."""
    parts: list[tuple[bool, str]] = []          # (is directive, letter or literal)
    chars = iter(time_format)
    for char in chars:
        if char != "%":
            parts.append((False, char))
            continue
        letter = next(chars, "")
        if letter == "%":
            parts.append((False, "%"))
        elif letter in DIRECTIVES:
            parts.append((True, letter))
        else:
            raise ValueError(f"time format {time_format!r}: directive '%{letter}' is not supported; "
                             f"known: {', '.join('%' + d for d in DIRECTIVES)}")
    pattern = shape = literal = ""
    for index, (is_directive, part) in enumerate([*parts, (True, "")]):
        if not is_directive:
            literal, shape = literal + part, shape + re.escape(part)
            continue
        if literal:
            plain = not re.search(r"[A-Za-z'\[\]{}#]", literal)
            pattern += literal if plain else "'" + literal.replace("'", "''") + "'"
            literal = ""
        if part:
            neighbours = parts[max(index - 1, 0):index] + parts[index + 1:index + 2]
            packed = any(d or p.isdigit() for d, p in neighbours)
            letters, texts = DIRECTIVES[part][0 if packed else 1]
            pattern, shape = pattern + letters, shape + texts
    return pattern, f"^{shape}$"


def spark_pattern(time_format: str) -> str:
    return translate(time_format)[0]


def parse_time(column: Column, time_format: str) -> Column:
    """Timestamp in a text, NULL if it does not follow the format.

    The shape is looked at first: a text the parser has to give up on costs an exception per cell.
    """
    pattern, shape = translate(time_format)
    parsed = F.when(column.rlike(shape), F.try_to_timestamp(column, F.lit(pattern)))
    directives = time_format.replace("%%", "")
    if "%y" in directives:
        # Two-digit years from the pivot on belong to the 1900s.
        parsed = F.when(F.year(parsed) >= 2000 + CENTURY_PIVOT,
                        parsed - F.make_ym_interval(F.lit(100))).otherwise(parsed)
    elif "%Y" not in directives:
        # Without a year strptime takes 1900 and Spark 1970.
        parsed = parsed - F.make_ym_interval(F.lit(70))
    return parsed


def timestamp(df: DataFrame, name: str, time_format: str | None = None) -> Column:
    """The cell as a timestamp: typed columns as they are, texts by their format."""
    column, data_type = cell(name), dtype(df, name)
    if not is_text(data_type):
        if not isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            raise ValueError(f"column {name!r} has type {data_type.simpleString()}, not a time")
        return column.cast("timestamp")
    if not time_format:
        raise ValueError(f"text column {name!r} needs a time format")
    return parse_time(column, time_format)


def instant(as_of: dt.datetime | str) -> Column:
    """The analysis time as a literal; without an offset, a wall-clock time in the session time zone."""
    if isinstance(as_of, dt.datetime):
        if as_of.tzinfo is not None:
            return F.lit(as_of)
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(as_of).cast("timestamp")


def seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def range_end(text: str) -> Column:
    """One end of a time range given as text."""
    return F.lit(dt.datetime.strptime(text, RANGE_END_FORMAT).strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


def dated_names(pattern: str, start: str, end: str, step_days: int) -> list[str]:
    """File names of a dated series: ``pattern`` filled in from ``start`` to ``end`` inclusive.

    A start or end that does not follow the pattern, or an end before the start, gives no names.
    """
    try:
        first, last = (dt.datetime.strptime(text, pattern) for text in (start, end))
    except ValueError:
        return []
    if step_days <= 0:
        raise ValueError("step_days must be positive")
    count = (last - first) // dt.timedelta(days=step_days) + 1
    return [(first + dt.timedelta(days=step_days * n)).strftime(pattern) for n in range(max(count, 0))]
