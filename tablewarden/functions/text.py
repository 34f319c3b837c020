"""Text normalisation: trimming, missing tokens, row identity."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The tokens that stand for a missing category and a missing key part.
MISSING_CATEGORY = "<MISSING>"
MISSING_KEY_PART = "__MISSING__"
KEY_SEPARATOR = "||"
# Texts that count as a missing category, compared in lower case.
NULL_WORDS = ["nan", "none", "null"]

# Every character Python's str.strip() removes; Spark's trim() removes U+0020 only.
BLANKS = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip(c: Column) -> Column:
    """Remove leading and trailing blanks of any kind."""
    return F.btrim(c, F.lit(BLANKS))


def _type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def text_of(df: DataFrame, name: str) -> Column:
    """Column ``name`` as text; NaN is missing, booleans read ``True``/``False``."""
    c, kind = F.col(f"`{name}`"), _type_of(df, name)
    if isinstance(kind, T.BooleanType):
        return F.when(c, "True").when(~c, "False")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c.cast("string"))
    return c.cast("string")


def norm_category(
    c: Column,
    *,
    token: str = MISSING_CATEGORY,
    empty_is_missing: bool = True,
    null_words_are_missing: bool = True,
) -> Column:
    """Trimmed category text in which every kind of missing value is ``token``."""
    token = token.strip()
    if not token:
        raise ValueError("the missing token must not be blank")
    trimmed = strip(c.cast("string"))
    missing = trimmed.isNull()
    if empty_is_missing:
        missing = missing | (trimmed == "")
    if null_words_are_missing:
        missing = missing | F.lower(trimmed).isin(NULL_WORDS)
    return F.when(missing, F.lit(token)).otherwise(trimmed)


def clean_names(names: Iterable[str] | str) -> list[str]:
    """Trimmed, non-empty, first-seen-order unique column names."""
    given = [names] if isinstance(names, str) else list(names)
    for n in given:
        if not isinstance(n, str):
            raise TypeError(f"column names must be text, got {type(n).__name__}")
    return list(dict.fromkeys(n.strip() for n in given if n.strip()))


def row_id(
    df: DataFrame,
    keys: Sequence[str] | str,
    *,
    token: str = MISSING_KEY_PART,
    separator: str = KEY_SEPARATOR,
) -> Column:
    """One text per row joined from the key columns, missing parts as ``token``."""
    if not token.strip() or not separator:
        raise ValueError("token and separator must not be empty")
    names = clean_names(keys)
    if not names:
        raise ValueError("at least one key column is needed")
    unknown = [n for n in names if n not in df.columns]
    if unknown:
        raise KeyError(f"key columns not found: {unknown}")
    # coalesce first: concat_ws skips nulls and would shorten the id
    parts = [F.coalesce(text_of(df, n), F.lit(token)) for n in names]
    return F.concat_ws(separator, *parts)
