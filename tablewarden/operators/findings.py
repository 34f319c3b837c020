"""The common shape of check results: long rows that union into one table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASS, WARN, FAIL, SKIPPED = "pass", "warn", "fail", "skipped"
STATUSES = [PASS, WARN, FAIL, SKIPPED]
# How severe a finding is, from blocking to informative.
SEVERITIES = ["hard", "fixable", "risk", "info"]

COLUMNS = ["source", "code", "subject", "value", "severity", "status"]


def fact(source: str, code: str, subject: str, value: Column, severity: str, bad: Column) -> Column:
    """One finding as a struct; ``bad`` decides between pass and fail (hard) or warn."""
    worse = FAIL if severity == "hard" else WARN
    return F.struct(
        F.lit(source).alias("source"),
        F.lit(code).alias("code"),
        F.lit(subject).alias("subject"),
        value.cast("double").alias("value"),
        F.lit(severity).alias("severity"),
        F.when(F.coalesce(bad, F.lit(False)), F.lit(worse)).otherwise(F.lit(PASS)).alias("status"),
    )


def facts_of(one_row: DataFrame, facts: Sequence[Column]) -> DataFrame:
    """Explode the facts of a one-row aggregate into finding rows."""
    return one_row.select(F.explode(F.array(*facts)).alias("_f")).select("_f.*")


def findings(
    df: DataFrame, *, source: str, code: str, subject: Column, value: Column, severity: str, bad: Column
) -> DataFrame:
    """One finding per row of ``df``."""
    worse = FAIL if severity == "hard" else WARN
    return df.select(
        F.lit(source).alias("source"),
        F.lit(code).alias("code"),
        subject.cast("string").alias("subject"),
        value.cast("double").alias("value"),
        F.lit(severity).alias("severity"),
        F.when(F.coalesce(bad, F.lit(False)), F.lit(worse)).otherwise(F.lit(PASS)).alias("status"),
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def worst_status(status: Column) -> Column:
    """Aggregate: the worst of the statuses of a group; skipped counts least."""
    rank = (
        F.when(status == FAIL, 3).when(status == WARN, 2).when(status == PASS, 1).otherwise(0)
    )
    return F.element_at(F.array(*[F.lit(s) for s in (SKIPPED, PASS, WARN, FAIL)]), F.max(rank) + 1)
