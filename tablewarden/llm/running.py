"""Running sums in a given order without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sum(
    df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[Column | str], value: str, out: str
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all earlier rows of the group.

    Rows are ordered by ``bucket`` and then ``order``. Only the rows of one bucket of
    one group meet in a task; what lies before a bucket comes from the bucket totals.
    Group columns and bucket must not be null. ``df`` is read twice: hand in a written table.
    """
    group = list(group)
    totals = df.groupBy(*group, bucket).agg(F.sum(value).alias("_total"))
    ahead = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*group, bucket, F.coalesce(F.sum("_total").over(ahead), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(before, [*group, bucket])
        .withColumn(out, F.col("_before") + F.col("_inside"))
        .drop("_before", "_inside")
    )
