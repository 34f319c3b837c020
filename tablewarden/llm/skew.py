"""Joins whose keys may hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARE = 1000
SALTS = 64
FEW = 64


def hot_keys(counts: DataFrame, keys: Sequence[str], n: str = "n", share: int = SHARE) -> list[int]:
    """Hashes of the keys that hold more than one in ``share`` rows, and FEW rows at least; by that rule fewer than ``share``.

    The driver gets them as numbers: a join then needs no broadcast table to tell its hot keys, and a
    join without any stays a plain one.
    """
    total, most = counts.agg(F.sum(n), F.max(n)).first()
    if not total or most < FEW or most * share <= total:
        return []
    found = counts.where((F.col(n) >= FEW) & (F.col(n) * share > F.lit(total)))
    # so few rows need no shuffle to be told apart
    return sorted({r[0] for r in found.select(F.xxhash64(*keys)).collect()})


def _is_hot(keys: Sequence[str], hot: Sequence[int]) -> Column:
    return F.expr(f"xxhash64({', '.join(f'`{k}`' for k in keys)}) IN ({', '.join(f'{h}L' for h in hot)})")


def salted_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], hot: Sequence[int], spread: str, how: str = "inner"
) -> DataFrame:
    """Join on ``keys`` (not null, of one type on both sides), where rows of ``left`` with a key in ``hot`` are dealt
    to SALTS tasks by a hash of column ``spread``, and rows of ``right`` with such a key are
    repeated that often. A key that only shares its hash with a hot one is dealt out alike."""
    keys = list(keys)
    if not hot:
        return left.join(right, keys, how)
    salt = F.when(_is_hot(keys, hot), F.pmod(F.xxhash64(spread), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    last = F.when(_is_hot(keys, hot), F.lit(SALTS - 1)).otherwise(F.lit(0))
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
    return left.withColumn("_salt", salt).join(right, [*keys, "_salt"], how).drop("_salt")
