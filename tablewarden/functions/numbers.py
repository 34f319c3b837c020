"""Numeric coercion, safe ratios and rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.functions.text import strip, text_of

# What counts as a number in text.  Spark's cast also takes "1d" and "1f",
# which are no numbers in a data file.
NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"

FLOATS = (T.FloatType, T.DoubleType)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def nulls_for_nan(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every float column, so that one notion of missing is left."""
    floats = {
        f.name: nan_to_null(F.col(f"`{f.name}`"))
        for f in df.schema.fields
        if isinstance(f.dataType, FLOATS)
    }
    return df.withColumns(floats) if floats else df


def parse_number(c: Column) -> Column:
    """Text to double; what is no number is NULL."""
    text = c.cast("string")
    return nan_to_null(F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double")))


def number_of(df: DataFrame, name: str) -> Column:
    """Column ``name`` as double: parsed if text, cast if already numeric."""
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        d = c.cast("double")
        return nan_to_null(d) if isinstance(kind, FLOATS) else d
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("double")
    return parse_number(c)


def safe_float(c: Column, digits: int = 3) -> Column:
    """Rounded double; NULL where the value is missing, no number, NaN or infinite."""
    d = c.try_cast("double")
    finite = ~F.isnan(d) & (F.abs(d) != F.lit(float("inf")))
    return F.when(finite, F.round(d, digits))


def ratio(a: Column, b: Column) -> Column:
    """a / b as double, NULL where b is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def binary_label(df: DataFrame, label: str, positive: str | None) -> Column:
    """0/1 label: equality with ``positive`` if given, else the truncated number."""
    if positive is not None:
        hit = strip(text_of(df, label)) == F.lit(str(positive).strip())
        return F.coalesce(hit.cast("int"), F.lit(0))
    return F.coalesce(number_of(df, label), F.lit(0.0)).cast("long")
