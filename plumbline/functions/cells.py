"""Column expressions for single cells: references, missing markers, numbers, key texts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for a missing cell, and the literal shape of a number that
# profiling counted in its original digits-only form.
MISSING_MARKERS = ("", "null", "nan")
DIGITS_ONLY_PATTERN = r"^\d+?(\.|\,)?\d+?$"

# Shape of a number text, with decimal comma or point. The JVM reads more than that (type suffixes, hexadecimal
# floats), and fails with an exception per cell on what is not a number at all. Nothing here backtracks.
NUMBER_PATTERN = (r"^\s*+[+-]?(?:\d++[.,]?\d*+(?:[eE][+-]?\d++)?|[.,]\d++(?:[eE][+-]?\d++)?"
                  r"|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*+$")

NULL_TEXT = "null"
KEY_SEPARATOR = ","


TYPED_PREFIX = "__typed_"       # of the typed companion of a text column in stored rows


def typed_name(column: str) -> str:
    return TYPED_PREFIX + column


def cell(name: str) -> Column:
    """Reference a column whatever characters its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def dtype(df: DataFrame, name: str) -> T.DataType:
    try:
        return df.schema[name].dataType
    except KeyError:
        raise ValueError(f"column {name!r} is not in the data; columns: {df.columns}") from None


def is_text(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.StringType, T.CharType, T.VarcharType))


def is_missing(df: DataFrame, name: str) -> Column:
    """True for NULL, for the marker texts and for NaN."""
    column, data_type = cell(name), dtype(df, name)
    if is_text(data_type):
        return column.isNull() | column.isin(*MISSING_MARKERS)
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def is_present(df: DataFrame, name: str) -> Column:
    return ~is_missing(df, name)


def all_filled(names: Iterable[str]) -> Column:
    """True when none of the columns is NULL: the rows every dimension but completeness sees."""
    condition = F.lit(True)
    for name in names:
        condition = condition & cell(name).isNotNull()
    return condition


def text_to_number(column: Column) -> Column:
    """Number in a text, with decimal comma or point; NULL if there is none."""
    return F.when(column.rlike(NUMBER_PATTERN), F.replace(column, F.lit(","), F.lit(".")).try_cast("double"))


def number(df: DataFrame, name: str, digits_only: bool = False) -> Column:
    """The cell as a double. NaN and unreadable texts are NULL, so aggregates skip them."""
    column, data_type = cell(name), dtype(df, name)
    value = text_to_number(column) if is_text(data_type) else column.try_cast("double")
    if digits_only:
        value = F.when(column.cast("string").rlike(DIGITS_ONLY_PATTERN), value)
    return F.when(~F.isnan(value), value)


def as_text(name: str) -> Column:
    """The cell as text, NULL written out as ``null``."""
    return F.coalesce(cell(name).cast("string"), F.lit(NULL_TEXT))


def key_cell(df: DataFrame, name: str) -> Column:
    """The cell as a grouping key: in a text column NULL and the text ``null`` are one key."""
    return F.coalesce(cell(name), F.lit(NULL_TEXT)) if is_text(dtype(df, name)) else cell(name)


def key_text(names: Sequence[str]) -> Column:
    """The values of a key set as one text, in the order the key set names them."""
    return F.concat_ws(KEY_SEPARATOR, *[as_text(n) for n in names])


def key_set_name(names: Sequence[str]) -> str:
    return "_".join(names)
