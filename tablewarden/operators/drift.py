"""Diagnostics of an assigned split: overlap, time order, balance, sizes and drift."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.functions.numbers import number_of, ratio
from tablewarden.functions.text import MISSING_KEY_PART
from tablewarden.operators.findings import FAIL, PASS, WARN
from tablewarden.operators.ks_search import PARTS, KsSearch
from tablewarden.operators.splits import EXCLUDED

# The smallest acceptable parts.
MIN_SIZES = {"train": 500, "val": 100, "test": 100}

ROWS_PER_BUCKET = 1_000_000


def group_overlap(assigned: DataFrame, group: Sequence[str], *, allowed: int = 0) -> DataFrame:
    """How many groups have rows in more than one part."""
    part = F.col("split")
    per_group = (
        assigned.filter(part != EXCLUDED)
        .groupBy(*[F.coalesce(F.col(f"`{g}`").cast("string"), F.lit(MISSING_KEY_PART)) for g in group])
        .agg(F.min(part).alias("lo"), F.max(part).alias("hi"))
    )
    return per_group.agg(
        F.count("*").alias("n_groups"), F.count_if(F.col("lo") != F.col("hi")).alias("n_overlapping")
    ).withColumn("status", F.when(F.col("n_overlapping") > allowed, FAIL).otherwise(PASS))


def late_rows(assigned: DataFrame, column: str) -> dict[str, Column]:
    """Per later part: is a row of it older than the newest row of an earlier part."""
    t, part = F.col(f"`{column}`"), F.col("split")
    # two values, fetched as text: they become literals of the column's type
    newest = assigned.agg(*[F.max(F.when(part == p, t)).cast("string").alias(p) for p in ("train", "val")]).first()
    kind = assigned.schema[column].dataType
    train, val = (F.lit(newest[p]).cast(kind) for p in ("train", "val"))
    return {"val": (part == "val") & (t < train), "test": (part == "test") & (t < F.greatest(train, val))}


def time_inversion(assigned: DataFrame, column: str, *, allowed: int = 0) -> DataFrame:
    """Rows of a later part that are older than the newest row of an earlier part."""
    part, late = F.col("split"), late_rows(assigned, column)
    late = F.when(part == "val", late["val"]).otherwise(late["test"])
    return (
        assigned.filter(part.isin("val", "test"))
        .groupBy("split")
        .agg(F.count("*").alias("n"), F.count_if(late).alias("n_inverted"))
        .withColumn("status", F.when(F.col("n_inverted") > allowed, FAIL).otherwise(PASS))
    )


def label_imbalance(assigned: DataFrame, y: Column, *, tolerance: float = 0.10) -> DataFrame:
    """Positive rate of each part against the rate of all labelled rows."""
    per_part = (
        assigned.filter(F.col("split") != EXCLUDED)
        .groupBy("split")
        .agg(F.count("*").alias("n"), F.sum(y.cast("long")).alias("n_pos"))
    )
    # at most one row per part reaches the outer aggregate
    overall = per_part.agg(ratio(F.sum("n_pos"), F.sum("n")).alias("r")).scalar()
    rate = ratio(F.col("n_pos"), F.col("n"))
    gap = F.abs(rate - overall)
    return per_part.select(
        "split",
        "n",
        F.round(rate, 6).alias("positive_rate"),
        F.round(gap, 6).alias("gap"),
        F.when(gap > tolerance, WARN).otherwise(PASS).alias("status"),
    )


def minimum_sizes(assigned: DataFrame, least: Mapping[str, int] = MIN_SIZES) -> DataFrame:
    """Rows per part against the smallest acceptable size; a part with no row counts as 0."""
    part = F.col("split")
    counts = assigned.agg(*[F.count_if(part == p).alias(p) for p in least])
    lines = F.array(
        *[
            F.struct(
                F.lit(p).alias("split"),
                F.col(p).alias("n"),
                F.lit(m).cast("long").alias("least"),
                F.when(F.col(p) < m, WARN).otherwise(PASS).alias("status"),
            )
            for p, m in least.items()
        ]
    )
    return counts.select(F.explode(lines).alias("_l")).select("_l.*")


def kolmogorov_p(statistic: Column, n1: Column, n2: Column) -> Column:
    """Asymptotic two-sample p-value; the series is cut at 100 terms and 1 for tiny arguments."""
    en = F.sqrt(ratio(n1 * n2, n1 + n2))
    lam = en * statistic
    term = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.exp(F.lit(-2.0) * k * k * lam * lam),
    )
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), term * 2)))


def ks_drift(
    assigned: DataFrame,
    features: Sequence[str],
    *,
    statistic_limit: float = 0.10,
    p_limit: float = 0.05,
    top: int | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Kolmogorov-Smirnov distance of train against val and test per numeric feature.

    The gap is searched by branch and bound (:class:`KsSearch`): counts per cell of values
    rule out most cells, and only the values of the others are shuffled and ordered, at most
    ``rows_per_bucket`` rows of a cell in one task.  Totals become literals.
    """
    rows = assigned.filter(F.col("split").isin(*PARTS))
    numbers = rows.select("split", *[number_of(rows, c).alias(c) for c in features])
    search = KsSearch(numbers, features, rows_per_bucket)

    def total(p: str) -> Column:
        i = PARTS.index(p)
        pairs = [x for c in features for x in (F.lit(c), F.lit(search.totals[c][i]).cast("double"))]
        return F.element_at(F.create_map(*pairs), F.col("feature"))

    wide = search.largest_gaps()
    lines = F.array(
        *[
            F.struct(
                F.lit(f"train_vs_{p}").alias("pair"),
                F.col(f"d_{p}").alias("d"),
                total("train").alias("n1"),
                total(p).alias("n2"),
            )
            for p in ("val", "test")
        ]
    )
    p_value = kolmogorov_p(F.col("d"), F.col("n1"), F.col("n2"))
    result = (
        wide.select("feature", F.explode(lines).alias("_l"))
        .select("feature", "_l.*")
        .withColumn("p", p_value)
        .select(
            "feature",
            "pair",
            F.round("d", 6).alias("statistic"),
            F.round("p", 4).alias("p_value"),
            (F.col("p") < p_limit).alias("p_flagged"),
            F.when(F.col("d") > statistic_limit, WARN).otherwise(PASS).alias("status"),
        )
    )
    if top is None:
        return result
    by_size = Window.partitionBy("pair").orderBy(F.desc("statistic"), "feature")
    return result.withColumn("_r", F.row_number().over(by_size)).filter(F.col("_r") <= top).drop("_r")
