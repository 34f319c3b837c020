"""Column profiles, contract checks, rules, readiness, balance and effect sizes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.functions.numbers import number_of, ratio
from tablewarden.functions.text import MISSING_CATEGORY, norm_category, text_of
from tablewarden.operators.findings import FAIL, PASS, WARN
from tablewarden.operators.order_stats import exact_quantiles
from tablewarden.operators.segments import examples
from tablewarden.session import literal_rows


def _long(one_row: DataFrame, subjects: Sequence[str], metrics: Mapping[str, str], key: str = "column") -> DataFrame:
    """A one-row aggregate with columns ``<i>_<metric>`` as one row per subject."""
    structs = [
        F.struct(
            F.lit(s).alias(key),
            *[F.col(f"{i}_{m}").cast(kind).alias(m) for m, kind in metrics.items()],
        )
        for i, s in enumerate(subjects)
    ]
    return one_row.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


# --- contract ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Contract:
    required: Sequence[str]
    numeric: Sequence[str] = ()
    categorical: Sequence[str] = ()
    primary_key: Sequence[str] = ()
    allow_extra: bool = True
    enforce_required: bool = True
    enforce_dtypes: bool = False


def contract_columns(df: DataFrame, contract: Contract) -> DataFrame:
    """Missing and extra columns, one row each, from the schema alone."""
    rows = [
        (c, "missing_column", FAIL if contract.enforce_required else WARN)
        for c in contract.required
        if c not in df.columns
    ]
    known = {*contract.required, *contract.numeric, *contract.categorical}
    rows += [
        (c, "extra_column", PASS if contract.allow_extra else WARN) for c in df.columns if c not in known
    ]
    return literal_rows(df.sparkSession, rows, "column string, issue string, status string")


def known_value(df: DataFrame, column: str) -> Column:
    """True where the column holds more than a kind of missing value."""
    x = F.col(f"`{column}`")
    return x.isNotNull() & (norm_category(text_of(df, column)) != MISSING_CATEGORY)


def unreadable_number(df: DataFrame, column: str) -> Column:
    """True where a known value is no number."""
    return known_value(df, column) & number_of(df, column).isNull()


def contract_dtypes(df: DataFrame, contract: Contract) -> DataFrame:
    """Values of numeric-listed columns that cannot be read as numbers, in one scan."""
    cols = [c for c in contract.numeric if c in df.columns]
    asks = []
    for i, c in enumerate(cols):
        asks.append(F.count_if(known_value(df, c)).alias(f"{i}_n_known"))
        asks.append(F.count_if(unreadable_number(df, c)).alias(f"{i}_n_unreadable"))
    worse = FAIL if contract.enforce_dtypes else WARN
    return _long(df.agg(*asks), cols, {"n_known": "long", "n_unreadable": "long"}).withColumn(
        "status", F.when(F.col("n_unreadable") > 0, worse).otherwise(PASS)
    )


def contract_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Primary-key check: rows, NULL keys, repeated keys and the rows they hold."""
    some_null = F.lit(False)
    for k in keys:
        some_null = some_null | F.col(f"`{k}`").isNull()
    groups = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count("*").alias("_n"))
    # null parts make a key null as a whole; such rows are counted apart
    per_key = groups.select("_n", some_null.alias("_null"))
    dup = (F.col("_n") > 1) & ~F.col("_null")
    none = F.lit(0).cast("long")
    return per_key.agg(
        F.coalesce(F.sum("_n"), none).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("_null"), F.col("_n"))), none).alias("n_null_keys"),
        F.count_if(dup).alias("n_duplicate_keys"),
        F.coalesce(F.sum(F.when(dup, F.col("_n"))), none).alias("n_rows_in_duplicates"),
    ).withColumn(
        "status",
        F.when((F.col("n_null_keys") > 0) | (F.col("n_duplicate_keys") > 0), FAIL).otherwise(PASS),
    )


# --- health --------------------------------------------------------------------------------


def _level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    texts = df.select(*[text_of(df, c).alias(c) for c in columns])
    return (
        texts.unpivot([], list(columns), "column", "value")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )


def health_columns(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    high_missing: float = 0.20,
    high_cardinality: float = 0.50,
    approximate: bool = False,
) -> DataFrame:
    """Missing rate, distinct values and tags per column.

    Exact distinct counts go through (column, value) groups, which combine on
    the map side and spread one column over all tasks.  ``approximate`` takes
    one mergeable sketch per column instead and needs no wide shuffle.
    """
    cols = list(columns or df.columns)
    if approximate:
        asks = []
        for i, c in enumerate(cols):
            x = text_of(df, c)
            asks += [
                F.count("*").alias(f"{i}_n_rows"),
                F.count_if(x.isNull()).alias(f"{i}_n_missing"),
                F.approx_count_distinct(x).alias(f"{i}_n_unique"),
            ]
        base = _long(df.agg(*asks), cols, {"n_rows": "long", "n_missing": "long", "n_unique": "long"})
    else:
        missing = F.col("value").isNull()
        base = (
            _level_counts(df, cols)
            .groupBy("column")
            .agg(
                F.sum("n").alias("n_rows"),
                F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("n_missing"),
                F.count_if(~missing).alias("n_unique"),
            )
        )
    missing_rate = ratio(F.col("n_missing"), F.col("n_rows"))
    unique_ratio = ratio(F.col("n_unique"), F.col("n_rows"))
    tags = F.array_compact(
        F.array(
            F.when(F.col("n_missing") == F.col("n_rows"), "all_missing"),
            F.when(missing_rate > high_missing, "high_missing"),
            F.when(unique_ratio > high_cardinality, "high_cardinality"),
            F.when(F.col("n_unique") == 1, "constant"),
        )
    )
    return base.select(
        "column",
        "n_rows",
        "n_missing",
        F.round(missing_rate, 6).alias("missing_rate"),
        "n_unique",
        F.round(unique_ratio, 6).alias("unique_ratio"),
        F.array_join(tags, ",").alias("tags"),
    )


def health_numeric(df: DataFrame, columns: Sequence[str], *, approximate_median: bool = False) -> DataFrame:
    """n, min, max, mean, sample deviation and median of numeric columns."""
    numbers = df.select(*[number_of(df, c).alias(c) for c in columns])
    asks = []
    for i, c in enumerate(columns):
        x = F.col(f"`{c}`")
        asks += [
            F.count(x).alias(f"{i}_n"),
            F.min(x).alias(f"{i}_min_value"),
            F.max(x).alias(f"{i}_max_value"),
            F.round(F.avg(x), 4).alias(f"{i}_mean_value"),
            F.round(F.stddev_samp(x), 4).alias(f"{i}_std_value"),
        ]
        if approximate_median:
            asks.append(F.percentile_approx(x, 0.5).alias(f"{i}_median_value"))
    if not approximate_median:
        medians = exact_quantiles(numbers, columns, [0.5])
        asks += [F.lit(medians[c][0]).cast("double").alias(f"{i}_median_value") for i, c in enumerate(columns)]
    kinds = {"n": "long"} | {
        f"{m}_value": "double" for m in ("min", "max", "mean", "std", "median")
    }
    return _long(numbers.agg(*asks), list(columns), kinds)


def top_levels(df: DataFrame, columns: Sequence[str], k: int = 3) -> DataFrame:
    """The ``k`` most frequent known values per column with their share of all rows."""
    counts = _level_counts(df, columns)
    totals = counts.groupBy("column").agg(F.sum("n").alias("_rows"))  # one row per column
    # NULLs are ranked last and dropped after ranking, so both readers share one shuffle
    unknown = F.col("value").isNull()
    best = examples(counts, "column", [unknown, F.desc("n"), F.asc("value")], k).filter(~unknown)
    return best.join(F.broadcast(totals), "column").select(
        "column",
        F.col("example_no").alias("level_rank"),
        "value",
        "n",
        F.round(ratio(F.col("n"), F.col("_rows")), 6).alias("share"),
    )


def numeric_sanity(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """n, missing, negative, zero, min and max per numeric column, in one scan."""
    asks = []
    for i, c in enumerate(columns):
        x = number_of(df, c)
        asks += [
            F.count("*").alias(f"{i}_n"),
            F.count_if(x.isNull()).alias(f"{i}_n_missing"),
            F.count_if(x < 0).alias(f"{i}_n_negative"),
            F.count_if(x == 0).alias(f"{i}_n_zero"),
            F.min(x).alias(f"{i}_min_value"),
            F.max(x).alias(f"{i}_max_value"),
        ]
    kinds = {m: "long" for m in ("n", "n_missing", "n_negative", "n_zero")}
    return _long(df.agg(*asks), list(columns), kinds | {"min_value": "double", "max_value": "double"})


# --- semantic rules ------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A named test of a table's rows; ``broken(df)`` is true where a row breaks the rule."""

    name: str
    column: str
    broken: Callable[[DataFrame], Column]


def in_range(column: str, low: float | None = None, high: float | None = None) -> Rule:
    def broken(df: DataFrame) -> Column:
        x, out = number_of(df, column), F.lit(False)
        if low is not None:
            out = out | (x < F.lit(low))
        if high is not None:
            out = out | (x > F.lit(high))
        return out

    return Rule(f"{column}_in_range", column, broken)


def not_negative(column: str) -> Rule:
    return Rule(f"{column}_not_negative", column, lambda df: number_of(df, column) < 0)


def one_of(column: str, allowed: Sequence[str]) -> Rule:
    def broken(df: DataFrame) -> Column:
        x = norm_category(text_of(df, column))
        return (x != MISSING_CATEGORY) & ~x.isin(list(allowed))

    return Rule(f"{column}_one_of", column, broken)


def zero_with_positive(zero: str, positive: str) -> Rule:
    """An anomaly: ``zero`` is 0 although ``positive`` is above 0."""
    return Rule(
        f"{zero}_zero_with_positive_{positive}",
        zero,
        lambda df: (number_of(df, zero) == 0) & (number_of(df, positive) > 0),
    )


def less_than_part(whole: str, part: str) -> Rule:
    """An anomaly: the whole is smaller than one of its parts."""
    return Rule(
        f"{whole}_less_than_{part}", whole, lambda df: number_of(df, whole) < number_of(df, part)
    )


def check_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Violations per rule over all rows, in one scan; no row is dropped."""
    asks = [F.count("*").alias("_n")]
    asks += [F.count_if(r.broken(df)).alias(f"v{i}") for i, r in enumerate(rules)]
    structs = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.column).alias("column"),
            F.col("_n").alias("n_rows"),
            F.col(f"v{i}").alias("n_violations"),
            F.when(F.col(f"v{i}") > 0, WARN).otherwise(PASS).alias("status"),
        )
        for i, r in enumerate(rules)
    ]
    return df.agg(*asks).select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def rule_examples(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str], k: int = 5) -> DataFrame:
    """At most ``k`` violating rows per rule, smallest keys first."""
    hits = F.array_compact(
        F.array(
            *[
                F.when(
                    r.broken(df),
                    F.struct(F.lit(r.name).alias("rule"), text_of(df, r.column).alias("found")),
                )
                for r in rules
            ]
        )
    )
    rows = df.select(*[f"`{c}`" for c in keys], F.explode(hits).alias("_h")).select(*keys, "_h.*")
    return examples(rows, "rule", [*keys, "found"], k)


# --- readiness and balance -----------------------------------------------------------------


@dataclass(frozen=True)
class Readiness:
    """What a table needs for a classification task."""

    min_rows: int = 1000
    max_label_missing: float = 0.30
    min_positive: float = 0.05
    max_positive: float = 0.95

    def counts(self, df: DataFrame, label: str, positive: str) -> dict[str, Column]:
        """The aggregates that ``lines`` reads."""
        y = norm_category(text_of(df, label))
        return {
            "n": F.count("*"),
            "n_labelled": F.count_if(y != MISSING_CATEGORY),
            "n_pos": F.count_if(y == F.lit(str(positive).strip())),
        }

    def lines(self, value: Callable[[str], Column] = F.col) -> list[tuple[str, Column, Column]]:
        """(metric, value, good) over the aggregates."""
        n, labelled = value("n"), value("n_labelled")
        missing = F.lit(1.0) - ratio(labelled, n)
        share = ratio(value("n_pos"), labelled)
        return [
            ("n_rows", n, n >= self.min_rows),
            ("label_missing_share", F.round(missing, 6), missing <= self.max_label_missing),
            ("positive_share", F.round(share, 6), share.between(self.min_positive, self.max_positive)),
        ]


def readiness(df: DataFrame, *, label: str, positive: str, needs: Readiness = Readiness()) -> DataFrame:
    """Is the table fit for a classification task: rows, missing labels, class balance."""
    lines = [
        F.struct(
            F.lit(name).alias("metric"),
            value.cast("double").alias("value"),
            F.when(F.coalesce(good, F.lit(False)), PASS).otherwise(FAIL).alias("status"),
        )
        for name, value, good in needs.lines()
    ]
    row = df.agg(*[c.alias(n) for n, c in needs.counts(df, label, positive).items()])
    return row.select(F.explode(F.array(*lines)).alias("_l")).select("_l.*")


def label_balance(df: DataFrame, label: str, *, max_majority: float = 0.80) -> DataFrame:
    """Rows and share per class; the majority class is flagged when too large."""
    y = norm_category(text_of(df, label))
    classes = (
        df.select(y.alias("class")).filter(F.col("class") != MISSING_CATEGORY)
        .groupBy("class").agg(F.count("*").alias("n"))
    )
    total = classes.agg(F.sum("n").alias("n")).scalar()
    share = ratio(F.col("n"), total)
    return classes.select(
        "class", "n", F.round(share, 6).alias("share"), (share > F.lit(max_majority)).alias("dominant")
    )


# --- relations to the label ------------------------------------------------------------------


def guarded_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over complete pairs, NULL for a constant side."""
    px, py = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(px, py), F.stddev_pop(px) * F.stddev_pop(py))


def correlation_asks(x: Column, y: Column) -> tuple[Column, Column]:
    """Aggregates: complete pairs, and their correlation."""
    return F.count_if(x.isNotNull() & y.isNotNull()), guarded_corr(x, y)


def label_correlation(
    df: DataFrame,
    columns: Sequence[str],
    y: Column,
    *,
    threshold: float = 0.90,
    min_pairs: int = 10,
) -> DataFrame:
    """Correlation of each candidate with the 0/1 label, all in one scan."""
    narrow = df.select(y.cast("double").alias("_y"), *[number_of(df, c).alias(c) for c in columns])
    asks = []
    for i, c in enumerate(columns):
        x = F.col(f"`{c}`")
        asks.append(F.count_if(x.isNotNull() & F.col("_y").isNotNull()).alias(f"{i}_n_pairs"))
        asks.append(guarded_corr(x, F.col("_y")).alias(f"{i}_r"))
    table = _long(narrow.agg(*asks), list(columns), {"n_pairs": "long", "r": "double"})
    r = F.when(F.col("n_pairs") >= min_pairs, F.col("r"))
    return table.select(
        "column",
        "n_pairs",
        F.round(r, 6).alias("correlation"),
        F.coalesce(F.abs(r) >= threshold, F.lit(False)).alias("flagged"),
    )


def cohens_d(df: DataFrame, columns: Sequence[str], y: Column, *, top: int = 5) -> DataFrame:
    """Standardised mean difference between the classes, largest effects first."""
    narrow = df.select(y.alias("_y"), *[number_of(df, c).alias(c) for c in columns])
    asks = []
    for i, c in enumerate(columns):
        for tag, k in (("a", 1), ("b", 0)):
            v = F.when(F.col("_y") == k, F.col(f"`{c}`"))
            asks += [
                F.count(v).alias(f"{i}_n{tag}"),
                F.avg(v).alias(f"{i}_m{tag}"),
                F.var_samp(v).alias(f"{i}_v{tag}"),
            ]
    kinds = {f"{m}{t}": ("long" if m == "n" else "double") for t in "ab" for m in "nmv"}
    t = _long(narrow.agg(*asks), list(columns), kinds)
    pooled = F.sqrt(
        F.try_divide(
            (F.col("na") - 1) * F.col("va") + (F.col("nb") - 1) * F.col("vb"),
            (F.col("na") + F.col("nb") - 2).cast("double"),
        )
    )
    d = F.round(F.try_divide(F.col("ma") - F.col("mb"), pooled), 6)
    return (
        t.select("column", F.col("na").alias("n_positive"), F.col("nb").alias("n_negative"), d.alias("effect"))
        .orderBy(F.desc(F.abs(F.coalesce("effect", F.lit(0.0)))), "column")
        .limit(top)
    )
