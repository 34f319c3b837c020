"""Key, time and label checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.functions.numbers import ratio
from tablewarden.functions.text import MISSING_CATEGORY, norm_category, row_id, text_of
from tablewarden.operators.findings import FAIL, PASS, SKIPPED, WARN
from tablewarden.operators.order_stats import bucket_count, check_orderable, order_rank, ordered_buckets
from tablewarden.session import literal_rows

# Parts of a column name that point at the label (label alignment check).
LABEL_NAME_PARTS = ["label", "target", "churn", "default", "fraud", "converted"]

# Up to this many rows one task may order; longer sequences are cut into pieces.
ROWS_PER_PIECE = 1_000_000


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def _known(names: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in _cols(names):
        out = out & c.isNotNull()
    return out


def key_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every key that occurs more than once, with its number of rows."""
    return (
        df.filter(_known(keys)).groupBy(*_cols(keys)).agg(F.count("*").alias("n"))
        .filter(F.col("n") > 1)
    )


def key_duplicate_examples(df: DataFrame, keys: Sequence[str], k: int = 20) -> DataFrame:
    """The ``k`` most repeated keys."""
    return key_duplicates(df, keys).orderBy(F.desc("n"), *_cols(keys)).limit(k)


def label_conflicts(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Entities whose rows carry different labels; missing labels do not disagree."""
    y = norm_category(text_of(df, label))
    return (
        df.select(*_cols(keys), F.when(y != MISSING_CATEGORY, y).alias("_y"))
        .filter(_known(keys))
        .groupBy(*_cols(keys))
        .agg(F.min("_y").alias("label_min"), F.max("_y").alias("label_max"), F.count("*").alias("n"))
        .filter(F.col("label_min") != F.col("label_max"))
    )


def key_summary(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Numbers of repeated keys and of keys with conflicting labels, from one grouped pass."""
    y = norm_category(text_of(df, label))
    per_key = (
        df.select(*_cols(keys), F.when(y != MISSING_CATEGORY, y).alias("_y"))
        .filter(_known(keys))
        .groupBy(*_cols(keys))
        .agg(F.count("*").alias("_n"), F.min("_y").alias("_lo"), F.max("_y").alias("_hi"))
    )
    return per_key.agg(
        F.count_if(F.col("_n") > 1).alias("n_duplicate_keys"),
        F.count_if(F.col("_lo") != F.col("_hi")).alias("n_label_conflicts"),
    )


# --- time ----------------------------------------------------------------------------------


def as_time(df: DataFrame, column: str) -> Column:
    c, kind = F.col(f"`{column}`"), df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return c
    if isinstance(kind, T.DateType):
        return c.cast("timestamp_ntz")
    return F.try_to_timestamp(c.cast("string"))


def time_counts(df: DataFrame, column: str, *, earliest: str | None, latest: str | None) -> dict[str, Column]:
    """The aggregates of ``time_bounds``."""
    t = as_time(df, column)
    kind = df.select(t.alias("t")).schema["t"].dataType
    never = F.lit(False)
    return {
        "n_rows": F.count("*"),
        "n_missing": F.count_if(t.isNull()),
        "n_too_early": F.count_if(t < F.lit(earliest).cast(kind) if earliest else never),
        "n_too_late": F.count_if(t > F.lit(latest).cast(kind) if latest else never),
    }


def time_bounds(
    df: DataFrame,
    column: str | None,
    *,
    earliest: str | None = None,
    latest: str | None = None,
    allow_missing: bool = False,
) -> DataFrame:
    """Missing or unreadable times, and times outside the allowed range."""
    if column is None:
        return literal_rows(
            df.sparkSession,
            [(None, None, None, None, SKIPPED)],
            "n_rows long, n_missing long, n_too_early long, n_too_late long, status string",
        )
    out = df.agg(*[c.alias(n) for n, c in time_counts(df, column, earliest=earliest, latest=latest).items()])
    missing_bad = (F.col("n_missing") > 0) & F.lit(not allow_missing)
    bad = missing_bad | (F.col("n_too_early") > 0) | (F.col("n_too_late") > 0)
    return out.withColumn("status", F.when(bad, FAIL).otherwise(PASS))


def duplicate_snapshots(df: DataFrame, entity: Sequence[str], column: str) -> DataFrame:
    """(entity, time) pairs that occur more than once."""
    return key_duplicates(df.withColumn("_t", as_time(df, column)), [*entity, "_t"]).withColumnRenamed(
        "_t", "snapshot_time"
    )


def out_of_order(
    df: DataFrame,
    entity: Sequence[str],
    column: str,
    order: str,
    *,
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """Rows whose time lies before the previous row's time of the same entity.

    "Previous" is by the ``order`` column, whose values should be unique per
    entity.  Rows without a time or order take no part.  Where the table is
    large, each entity's sequence is cut at shared points of the order column,
    so that an entity with a third of all rows spreads over many tasks; the
    last time of a piece is handed on to the next piece of the entity.
    Numbers, truth values, dates, times, text and bytes can give the order,
    whatever the size; any other type is a TypeError.
    """
    narrow = (
        df.select(
            *[F.col(f"`{e}`") for e in entity],
            F.col(f"`{order}`").alias("_o"),
            as_time(df, column).alias("_t"),
        )
        .filter(F.col("_t").isNotNull() & F.col("_o").isNotNull())
    )
    check_orderable(narrow, "_o")
    pieces = bucket_count(df.count(), rows_per_piece)
    keys = list(entity)
    names = [*keys, F.col("_o").alias("order_value"), F.col("_t").alias("event_time"), "previous_time"]
    in_entity = Window.partitionBy(*keys)
    if pieces == 1:
        seq = narrow.withColumn("previous_time", F.lag("_t").over(in_entity.orderBy("_o")))
        return seq.filter(F.col("_t") < F.col("previous_time")).select(*names)

    placed = narrow.withColumn("_at", order_rank(narrow, "_o"))
    buckets = ordered_buckets(placed, ["_at"], pieces)["_at"]
    cut = placed.withColumn("_piece", buckets.of(F.col("_at")))
    seq = cut.withColumn("_prev", F.lag("_t").over(Window.partitionBy(*keys, "_piece").orderBy("_o")))
    inside = seq.filter(F.col("_t") < F.col("_prev")).select(
        *keys, F.col("_o").alias("order_value"), F.col("_t").alias("event_time"),
        F.col("_prev").alias("previous_time"),
    )
    # one row per entity and piece, so at most `pieces` rows of an entity meet in a window
    ends = cut.groupBy(*keys, "_piece").agg(
        F.min("_o").alias("order_value"),
        F.min_by("_t", "_o").alias("event_time"),
        F.max_by("_t", "_o").alias("_last"),
    )
    across = (
        ends.withColumn("previous_time", F.lag("_last").over(in_entity.orderBy("_piece")))
        .filter(F.col("event_time") < F.col("previous_time"))
        .select(*keys, "order_value", "event_time", "previous_time")
    )
    return inside.unionByName(across)


# --- label alignment -------------------------------------------------------------------------


def label_counts(df: DataFrame, label: str, positive: str) -> dict[str, Column]:
    """The aggregates of ``label_degenerate``."""
    y = norm_category(text_of(df, label))
    return {"n_labelled": F.count_if(y != MISSING_CATEGORY), "n_positive": F.count_if(y == F.lit(str(positive).strip()))}


def label_degenerate(
    df: DataFrame, label: str, positive: str, *, low: float = 0.01, high: float = 0.99
) -> DataFrame:
    """Share of positives among known labels; outside [low, high] fails."""
    row = df.agg(*[c.alias(n) for n, c in label_counts(df, label, positive).items()])
    share = ratio(F.col("n_positive"), F.col("n_labelled"))
    good = F.coalesce(share.between(low, high), F.lit(False))
    return row.select(
        "n_labelled",
        "n_positive",
        F.round(share, 6).alias("positive_share"),
        F.when(good, PASS).otherwise(FAIL).alias("status"),
    )


def risky_names(
    df: DataFrame, parts: Sequence[str] = tuple(LABEL_NAME_PARTS), *, exclude: Sequence[str] = ()
) -> list[str]:
    """Columns whose name holds one of ``parts``; the label itself is excluded first."""
    skip = set(exclude)
    return [c for c in df.columns if c not in skip and any(p in c.lower() for p in parts)]


def alias_counts(df: DataFrame, label: str, columns: Sequence[str]) -> dict[str, tuple[Column, Column]]:
    """The aggregates of ``label_aliases``: pairs of known values, and equal ones, per column."""
    y, out = norm_category(text_of(df, label)), {}
    for c in columns:
        x = norm_category(text_of(df, c))
        known = (y != MISSING_CATEGORY) & (x != MISSING_CATEGORY)
        out[c] = F.count_if(known), F.count_if(known & (y == x))
    return out


def label_aliases(
    df: DataFrame,
    label: str,
    columns: Sequence[str],
    *,
    min_pairs: int = 50,
) -> DataFrame:
    """Is a feature the label under another name: equal on every pair of known values of the table."""
    counts = alias_counts(df, label, columns)

    def of(c: str) -> Column:
        known, equal = counts[c]
        return F.struct(F.lit(c).alias("column"), known.alias("n_pairs"), equal.alias("n_equal"))

    # one row of counts over one scan, then a row per column
    pairs = df.agg(F.array(*[of(c) for c in columns]).alias("_p")).select(F.inline("_p"))
    alias = (F.col("n_pairs") >= min_pairs) & (F.col("n_pairs") == F.col("n_equal"))
    return pairs.withColumn("is_alias", alias).withColumn("status", F.when(alias, WARN).otherwise(PASS))
