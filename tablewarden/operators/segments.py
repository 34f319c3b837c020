"""Label rates by segment, group means, histograms and bounded example lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.functions.numbers import nan_to_null, number_of, ratio
from tablewarden.functions.text import MISSING_CATEGORY, norm_category, text_of
from tablewarden.session import literal_rows


def _labelled_levels(
    df: DataFrame, label: str, positive: str, segments: Sequence[str]
) -> DataFrame:
    """(segment_col, segment, n, n_positive) over rows whose label is not missing."""
    if label not in df.columns:
        raise ValueError(f"label column {label!r} not found")
    positive = str(positive).strip()
    if not positive:
        raise ValueError("the positive label must not be blank")
    present = [c for c in segments if c in df.columns]
    if not present:
        raise ValueError("none of the segment columns is present")
    y = norm_category(text_of(df, label))
    # labels first: rows without one take no part, and nothing but the used columns is read
    narrow = df.select(y.alias("_y"), *[norm_category(text_of(df, c)).alias(c) for c in present])
    hit = (F.col("_y") == positive).cast("int")
    # label and level travel as one value: a plain unpivot keeps its shuffle reusable in self joins
    pairs = [F.struct(hit.alias("pos"), F.col(f"`{c}`").alias("segment")).alias(c) for c in present]
    return (
        narrow.filter(F.col("_y") != MISSING_CATEGORY)
        .select(*pairs)
        .unpivot([], present, "segment_col", "_v")
        .groupBy("segment_col", F.col("_v.segment").alias("segment"))
        .agg(F.count("*").alias("n"), F.sum("_v.pos").alias("n_positive"))
    )


def _column_totals(levels: DataFrame) -> DataFrame:
    """(segment_col, n_valid), one row per segment column.

    Both sums are kept in use: with the same columns as the level table itself
    Spark reads that table's shuffle a second time instead of the input.
    """
    sums = levels.groupBy("segment_col").agg(F.sum("n").alias("n_valid"), F.sum("n_positive").alias("_pos"))
    return sums.filter(F.col("_pos") >= 0).select("segment_col", "n_valid")


def rate_by_segment(
    df: DataFrame,
    *,
    label: str,
    positive: str,
    segments: Sequence[str],
    min_share: float = 0.01,
) -> DataFrame:
    """Positive rate of every level of every segment column, best rate first.

    Rows without a label take no part.  One unpivot and one shuffle serve all
    segment columns; the totals per column reuse that shuffle.
    """
    levels = _labelled_levels(df, label, positive, segments)
    # one row per segment column, so this side is bounded by the argument list
    totals = _column_totals(levels)
    share = ratio(F.col("n"), F.col("n_valid"))
    return (
        levels.join(F.broadcast(totals), "segment_col")
        .select(
            "segment_col",
            "segment",
            "n",
            F.round(share, 6).alias("share"),
            F.round(ratio(F.col("n_positive"), F.col("n")), 6).alias("positive_rate"),
            (share < F.lit(float(min_share))).alias("small_segment"),
        )
        .orderBy(F.desc("positive_rate"), "segment_col", "segment")
    )


def segment_meta(df: DataFrame, *, label: str, positive: str, segments: Sequence[str]) -> DataFrame:
    """Per segment column: does it exist, its number of levels, and the label counts."""
    levels = _labelled_levels(df, label, positive, segments)
    found = levels.groupBy("segment_col").agg(F.count("*").alias("n_levels"))
    y = norm_category(text_of(df, label))
    counts = df.agg(
        F.count("*").alias("n_rows_total"),
        F.count_if(y != MISSING_CATEGORY).alias("n_rows_used"),
        F.count_if(y == MISSING_CATEGORY).alias("n_labels_missing"),
    )
    asked = F.array(
        *[F.struct(F.lit(c).alias("segment_col"), F.lit(c in df.columns).alias("column_exists")) for c in segments]
    )
    return (
        counts.withColumn("_asked", F.explode(asked))
        .select("_asked.*", "n_rows_total", "n_rows_used", "n_labels_missing")
        .join(F.broadcast(found), "segment_col", "left")
        .withColumn("n_levels", F.coalesce("n_levels", F.lit(0).cast("long")))
    )


def rate_spread(
    df: DataFrame,
    *,
    label: str,
    positive: str,
    columns: Sequence[str],
    min_share: float = 0.01,
    top: int = 3,
) -> DataFrame:
    """Widest gap between level rates per categorical column; tiny levels left out."""
    levels = _labelled_levels(df, label, positive, columns)
    totals = _column_totals(levels)
    rate = ratio(F.col("n_positive"), F.col("n"))
    return (
        levels.join(F.broadcast(totals), "segment_col")
        .filter(ratio(F.col("n"), F.col("n_valid")) >= F.lit(float(min_share)))
        .groupBy(F.col("segment_col").alias("column"))
        .agg(F.count("*").alias("n_levels"), F.round(F.max(rate) - F.min(rate), 6).alias("spread"))
        .orderBy(F.desc("spread"), "column")
        .limit(top)
    )


def group_mean(df: DataFrame, group: str, value: str) -> DataFrame:
    """Mean of ``value`` per level of ``group``, both known, largest first."""
    return (
        df.select(F.col(f"`{group}`").alias("level"), number_of(df, value).alias("v"))
        .dropna()
        .groupBy("level")
        .agg(F.count("*").alias("n"), F.round(F.avg("v"), 6).alias("mean_value"))
        .orderBy(F.desc("mean_value"), "level")
    )


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Counts in equal-width bins; the last bin takes its right edge, empty bins stay."""
    x = df.select(number_of(df, column).alias("x")).filter(F.col("x").isNotNull())
    lo, hi = x.agg(F.min("x"), F.max("x")).first()
    spark = df.sparkSession
    if lo is None:
        return literal_rows(spark, [], "bin int, bin_left double, bin_right double, n long")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    at = F.least(F.floor((F.col("x") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = x.groupBy(at.alias("bin")).agg(F.count("*").alias("n"))
    every_bin = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every_bin.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        F.round(F.lit(lo) + F.col("bin") * F.lit(width), 6).alias("bin_left"),
        F.round(F.lit(lo) + (F.col("bin") + 1) * F.lit(width), 6).alias("bin_right"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n"),
    )


def top_pairs(df: DataFrame, label: str, value: str, *, top: int = 10, descending: bool = True) -> DataFrame:
    """The ``top`` (label, value) pairs by value, labels breaking ties."""
    pairs = df.select(text_of(df, label).alias("label"), nan_to_null(number_of(df, value)).alias("value"))
    order = F.desc("value") if descending else F.asc("value")
    return pairs.filter(F.col("value").isNotNull()).orderBy(order, "label").limit(top)


def examples(df: DataFrame, group: str, order: Sequence[Column | str], k: int = 10) -> DataFrame:
    """At most ``k`` rows per group, numbered in the given order.

    The rank filter lets Spark keep k rows per group and task before the
    shuffle, so a large group costs no more than a small one.
    """
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("example_no", F.row_number().over(w)).filter(F.col("example_no") <= k)
