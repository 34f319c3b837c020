"""Configurable cleaning: strip, drop unlabelled rows, hooks, cast and fill, rare levels, mappings.

The order of the steps is part of the meaning: rare levels are counted on
values that are not mapped yet, and fills see what the hooks left missing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.functions.numbers import NUMBER_PATTERN, number_of, nulls_for_nan
from tablewarden.functions.text import strip
from tablewarden.operators.order_stats import exact_quantiles
from tablewarden.session import literal_rows

Hook = Callable[[DataFrame], DataFrame]

# Up to this many frequent levels travel to the driver and become literals.
LITERAL_LEVELS = 5_000

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("step_no", T.IntegerType()),
        T.StructField("step", T.StringType()),
        T.StructField("part", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("note", T.StringType()),
    ]
)


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


# --- the single steps -----------------------------------------------------------------------


def strip_strings(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Strip blanks from the listed (or all) text columns in one projection."""
    names = strippable(df, columns)
    return df.withColumns({n: strip(F.col(f"`{n}`")) for n in names}) if names else df


def strippable(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    asked = df.columns if columns is None else columns
    return [n for n in asked if n in df.columns and is_text(df, n)]


def drop_missing_label(df: DataFrame, label: str) -> DataFrame:
    """Drop rows without a label; the empty text is a label here."""
    return df.dropna(subset=[label]) if label in df.columns else df


def impute_product(target: str, factors: Sequence[str]) -> Hook:
    """A hook that fills a missing ``target`` with the product of ``factors``."""

    def hook(df: DataFrame) -> DataFrame:
        product = number_of(df, factors[0])
        for f in factors[1:]:
            product = product * number_of(df, f)
        return df.withColumn(target, F.coalesce(number_of(df, target), product))

    hook.__name__ = f"impute_{target}"
    return hook


@dataclass(frozen=True)
class Cast:
    """How one column becomes a number; ``fill`` is median, mean, zero, None or a number."""

    to: str = "float"
    errors: str = "coerce"
    fill: str | float | None = "median"

    @classmethod
    def from_config(cls, cfg: Mapping) -> Cast:
        return cls(
            to=str(cfg.get("type", "float")).strip().lower(),
            errors=str(cfg.get("errors", "coerce")).strip().lower(),
            fill=cfg.get("fill_strategy", "median"),
        )

    @property
    def error_mode(self) -> str:
        return self.errors if self.errors in ("raise", "coerce", "ignore") else "coerce"

    @property
    def fixed_fill(self) -> float | None:
        if self.fill == "zero":
            return 0.0
        if self.fill in (None, "median", "mean"):
            return None
        try:
            return float(self.fill)
        except (TypeError, ValueError):
            return None


@dataclass
class CastOutcome:
    cast: Cast
    missing_before: int = 0
    fill_value: float | None = None
    kept_as_is: bool = False

    @property
    def missing_after(self) -> int:
        return 0 if self.fill_value is not None else self.missing_before

    @property
    def final_type(self) -> str:
        # an integer column cannot hold what is still missing
        return "long" if self.cast.to == "int" and self.missing_after == 0 else "double"


def _unreadable(df: DataFrame, name: str) -> Column:
    """Text that is neither empty nor a number."""
    if not is_text(df, name):
        return F.lit(False)
    c = F.col(f"`{name}`")
    return c.isNotNull() & (c != "") & ~c.rlike(NUMBER_PATTERN)


def fit_casts(df: DataFrame, casts: Mapping[str, Cast]) -> dict[str, CastOutcome]:
    """Missing counts and fill values of all columns; results are one row in size."""
    present = [c for c in casts if c in df.columns]
    if not present:
        return {}
    asks = []
    for i, c in enumerate(present):
        x = number_of(df, c)
        asks += [F.count_if(x.isNull()).alias(f"missing{i}"), F.avg(x).alias(f"mean{i}")]
        if casts[c].error_mode == "ignore":
            asks.append(F.count_if(_unreadable(df, c)).alias(f"bad{i}"))
    row = df.agg(*asks).first()
    out = {}
    for i, c in enumerate(present):
        o = CastOutcome(casts[c], missing_before=row[f"missing{i}"])
        o.kept_as_is = casts[c].error_mode == "ignore" and row[f"bad{i}"] > 0
        o.fill_value = row[f"mean{i}"] if casts[c].fill == "mean" else casts[c].fixed_fill
        out[c] = o
    medians = [c for c in present if casts[c].fill == "median" and not out[c].kept_as_is]
    if medians:
        numbers = df.select(*[number_of(df, c).alias(c) for c in medians])
        for c, (m,) in exact_quantiles(numbers, medians, [0.5]).items():
            out[c].fill_value = m
    return out


def apply_casts(df: DataFrame, fitted: Mapping[str, CastOutcome]) -> DataFrame:
    new = {}
    for c, o in fitted.items():
        if o.kept_as_is:
            continue
        x = number_of(df, c)
        if o.cast.error_mode == "raise":
            message = F.concat(F.lit(f"column {c} holds no number: "), F.col(f"`{c}`").cast("string"))
            x = F.when(_unreadable(df, c), F.raise_error(message).cast("double")).otherwise(x)
        if o.fill_value is not None:
            x = F.coalesce(x, F.lit(float(o.fill_value)))
        new[c] = x.cast(o.final_type)
    return df.withColumns(new) if new else df


def cast_numbers(df: DataFrame, casts: Mapping[str, Cast]) -> DataFrame:
    return apply_casts(df, fit_casts(df, casts))


# --- rare levels ---------------------------------------------------------------------------


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for every level, NULL being a level, in one pass and one shuffle."""
    texts = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    return (
        texts.unpivot([], list(columns), "column", "value")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )


def bucket_rare(
    df: DataFrame,
    columns: Sequence[str],
    *,
    min_freq: int = 50,
    other: str = "Other",
    literal_levels: int = LITERAL_LEVELS,
) -> DataFrame:
    """Replace levels seen fewer than ``min_freq`` times, rare NULLs included.

    The columns become text.  The frequent levels become literals where they
    are few, which needs no join.  Otherwise they are joined, see
    ``_join_frequent``.
    """
    return fit_rare(df, columns, min_freq=min_freq, other=other, literal_levels=literal_levels)(df)


def fit_rare(
    df: DataFrame,
    columns: Sequence[str],
    *,
    min_freq: int = 50,
    other: str = "Other",
    literal_levels: int = LITERAL_LEVELS,
) -> Callable[[DataFrame], DataFrame]:
    """``bucket_rare`` with the levels of ``df``, as a step for this table however it is carried on."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return lambda d: d
    frequent = level_counts(df, present).filter(F.col("n") >= int(min_freq))
    # the limit makes one action both the size check and the fetch
    fetched = frequent.limit(literal_levels + 1).collect()

    def join(d: DataFrame) -> DataFrame:
        for c in present:
            d = _join_frequent(d, c, frequent, other)
        return d

    if len(fetched) > literal_levels:
        return join
    new = {}
    for c in present:
        levels = [r["value"] for r in fetched if r["column"] == c]
        text = F.col(f"`{c}`").cast("string")
        keep = text.isin([v for v in levels if v is not None])
        if None in levels:
            keep = keep | text.isNull()
        new[c] = F.when(keep, text).otherwise(F.lit(other))
    return lambda d: d.withColumns(new)


def _join_frequent(df: DataFrame, column: str, frequent: DataFrame, other: str) -> DataFrame:
    """Rare bucketing where the frequent levels are too many for literals.

    Hot levels (at most 1,000 can hold a thousandth of the rows each) are
    literals; their rows stay out of the join, so no join partition collects
    a hot level.
    """
    mine = frequent.filter(F.col("column") == column)
    text = F.col(f"`{column}`").cast("string")
    share = df.count() / 1000
    hot = [r["value"] for r in mine.filter(F.col("n") > share).select("value").collect()]
    is_hot = F.coalesce(text.isin([v for v in hot if v is not None]), F.lit(False))
    if None in hot:
        is_hot = is_hot | text.isNull()

    def key(c: Column) -> Column:
        return F.coalesce(F.concat(F.lit("v"), c), F.lit("null"))

    names = df.columns
    hot_rows = df.filter(is_hot).select(*[text.alias(n) if n == column else F.col(f"`{n}`") for n in names])
    keyed = df.filter(~is_hot).withColumn("_key", key(text))
    lookup = mine.select(key(F.col("value")).alias("_key"), F.lit(True).alias("_frequent"))
    keep = F.col("_frequent").isNotNull()
    joined = keyed.join(lookup, "_key", "left").select(
        *[F.when(keep, text).otherwise(F.lit(other)).alias(n) if n == column else F.col(f"`{n}`") for n in names]
    )
    return joined.union(hot_rows)


def rare_report(
    df: DataFrame, columns: Sequence[str], *, min_freq: int = 50, other: str = "Other"
) -> DataFrame:
    """Per column: rows replaced and number of levels before and after."""
    present = [c for c in columns if c in df.columns]
    rare = F.col("n") < int(min_freq)
    kept_other = F.max((~rare & F.col("value").eqNullSafe(F.lit(other))).cast("int"))
    return (
        level_counts(df, present)
        .groupBy("column")
        .agg(
            F.coalesce(F.sum(F.when(rare, F.col("n"))), F.lit(0)).alias("n_replaced"),
            F.count("*").alias("n_levels_before"),
            (
                F.count_if(~rare)
                + F.when(F.count_if(rare) > 0, F.lit(1) - kept_other).otherwise(F.lit(0))
            ).alias("n_levels_after"),
        )
    )


# --- mappings ------------------------------------------------------------------------------


def map_values(df: DataFrame, columns: Sequence[str], mapping: Mapping) -> DataFrame:
    """Replace values by ``mapping``, all at once: a->b and b->c do not chain."""
    present = [c for c in columns if c in df.columns]
    return df.replace(dict(mapping), subset=present) if present and mapping else df


def _takes(df: DataFrame, name: str, mapping: Mapping) -> bool:
    """Whether the mapping's keys are of the column's kind; it leaves other columns as they are."""
    if all(isinstance(k, bool) for k in mapping):
        kind = T.BooleanType
    else:
        kind = T.StringType if any(isinstance(k, str) for k in mapping) else T.NumericType
    return isinstance(df.schema[name].dataType, kind)


def map_hits(df: DataFrame, columns: Sequence[str], mapping: Mapping) -> dict[str, Column]:
    """Per column: 1 where the mapping changes or confirms a value."""
    return {
        c: F.col(f"`{c}`").isin(list(mapping)).cast("int") if _takes(df, c, mapping) else F.lit(0) for c in columns
    }


def map_report(df: DataFrame, columns: Sequence[str], mapping: Mapping) -> DataFrame:
    """Per column: how many values the mapping will change or confirm."""
    present = [c for c in columns if c in df.columns]
    hits = df.select(*[hit.alias(c) for c, hit in map_hits(df, present, mapping).items()])
    sums = hits.agg(*[F.coalesce(F.sum(f"`{c}`"), F.lit(0)).alias(c) for c in present])
    return sums.unpivot([], present, "column", "n_affected")


# --- the whole run -------------------------------------------------------------------------


# A report row's place: step number, step, part, column, metric.
Place = tuple[int, str, str | None, str | None, str]


@dataclass
class CleaningResult:
    """The clean table, a report of every step, and the passes that lead there."""

    data: DataFrame
    report: DataFrame
    steps_run: list[str]
    used_config: Mapping = field(default_factory=dict)
    raw: DataFrame | None = None
    passes: list[Callable[[DataFrame], DataFrame] | dict[Place, Column]] = field(default_factory=list)
    settled: DataFrame | None = None

    def save(self, write: Callable[[DataFrame], object]) -> DataFrame:
        """Write the clean table and return the report of that same pass.

        Row counts and the counts of every step are observed while ``write`` (one action on the
        table it is given) runs, so the report costs no further scan but that of the rare levels.
        Spark counts an observed partition once however often its task is retried, as long as
        the task ends the job; below a shuffle a lost executor may have map tasks run, and
        counted, twice. So where a step needs a shuffle the counts come from ``report`` instead.
        """
        df, seen = self.raw, []
        for step in self.passes:
            if isinstance(step, dict):
                seen.append((Observation(), step))
                df = df.observe(seen[-1][0], *[c.alias(f"m{i}") for i, c in enumerate(step.values())])
            else:
                df = step(df)
        plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
        last = max(i for i, line in enumerate(plan) if "CollectMetrics" in line)
        if any("Exchange" in line for line in plan[:last]):
            write(self.data)
            return self.report
        write(df)
        rows = []
        for observation, step in seen:
            values = observation.get
            if len(values) < len(step):  # the optimizer saw that no row comes this far
                return self.report
            rows += [(*place, float(values[f"m{i}"]), None) for i, place in enumerate(step)]
        return self.settled.unionByName(literal_rows(self.raw.sparkSession, rows, REPORT_SCHEMA))


def run_cleaning(df: DataFrame, config: Mapping, hooks: Sequence[Hook] = ()) -> CleaningResult:
    """Run all configured steps; returns the clean table and a long report of every step.

    Config keys: ``enable_normalize_strings``, ``string_columns``, ``label_col``,
    ``numeric_cast_columns``, ``rare_category``, ``value_mappings`` and
    ``include_mapping_in_report``.
    """
    if not isinstance(config, Mapping):
        raise TypeError("the cleaning config must be a mapping")
    spark = df.sparkSession
    raw = nulls_for_nan(df)
    cur = raw
    steps: list[str] = []
    fixed: list[tuple] = []  # report rows known on the driver
    lazy: list[DataFrame] = []  # report rows that Spark computes
    grouped: list[DataFrame] = []  # those of them that no row-by-row pass can count
    passes: list = []  # what is done to the table, and what is counted in between

    def counted(step: str, counts: Mapping[tuple[str | None, str], Column], part=None, step_no=None):
        no = len(steps) if step_no is None else step_no
        passes.append({(no, step, part, column, metric): c for (column, metric), c in counts.items()})

    def row(step, metric, value=None, *, part=None, column=None, note=None):
        v = None if value is None else float(value)
        fixed.append((len(steps), step, part, column, metric, v, note))

    def computed(frame: DataFrame, step: str, metrics: Sequence[str], part=None):
        lazy.append(
            frame.select("column", *[F.col(m).cast("double").alias(m) for m in metrics])
            .unpivot(["column"], list(metrics), "metric", "value")
            .select(
                F.lit(len(steps)).alias("step_no"),
                F.lit(step).alias("step"),
                F.lit(part).cast("string").alias("part"),
                "column",
                "metric",
                "value",
                F.lit(None).cast("string").alias("note"),
            )
        )

    def absent(step: str, columns: Sequence[str], part=None):
        for c in columns:
            if c not in cur.columns:
                row(step, "column_not_found", column=c, part=part, note="column_not_found")

    def do(step: Callable[[DataFrame], DataFrame]) -> None:
        nonlocal cur
        cur = step(cur)
        passes.append(step)

    counted("high_level", {(None, "rows_before"): F.count("*")}, step_no=0)
    if config.get("enable_normalize_strings", True):
        steps.append("normalize_strings")
        for c in strippable(cur, config.get("string_columns")):
            row(steps[-1], "stripped", 1, column=c)
        do(lambda d: strip_strings(d, config.get("string_columns")))

    label = str(config.get("label_col") or "").strip()
    if label:
        steps.append("drop_missing_label")
        if label in cur.columns:
            asks = {
                "rows_before": F.count("*"),
                "rows_after": F.count(f"`{label}`"),
                "rows_dropped": F.count_if(F.col(f"`{label}`").isNull()),
            }
            counts = cur.agg(*[c.alias(m) for m, c in asks.items()]).withColumn("column", F.lit(label))
            computed(counts, steps[-1], list(asks))
            counted(steps[-1], {(label, m): c for m, c in asks.items()})
        else:
            row(steps[-1], "rows_dropped", 0, column=label, note="label column not found")
        do(lambda d: drop_missing_label(d, label))

    for hook in hooks:
        steps.append(getattr(hook, "__name__", "hook"))
        try:
            after = hook(cur)
            after.schema  # analysis errors surface here, the input then stays as it was
            cur = after
            passes.append(hook)
            row(steps[-1], "hook", 1)
        except Exception as e:  # noqa: BLE001 - a failing hook is reported, the run goes on
            row(steps[-1], "hook", 0, note=f"{type(e).__name__}: {e}")

    casts = {c: Cast.from_config(v or {}) for c, v in (config.get("numeric_cast_columns") or {}).items()}
    if casts:
        steps.append("cast_numbers")
        absent(steps[-1], list(casts))
        fitted = fit_casts(cur, casts)
        for c, o in fitted.items():
            if o.cast.errors != o.cast.error_mode:
                row(steps[-1], "errors_mode", column=c, note="invalid_errors_value_fallback_to_coerce")
            if o.kept_as_is:
                row(steps[-1], "kept_as_is", 1, column=c)
                continue
            row(steps[-1], "missing_before", o.missing_before, column=c, note=str(o.cast.fill))
            row(steps[-1], "missing_after", o.missing_after, column=c, note=o.final_type)
            row(steps[-1], "fill_value", o.fill_value, column=c, note=str(o.cast.fill))
        do(lambda d: apply_casts(d, fitted))

    rare = config.get("rare_category") or {}
    rare_columns = [c.strip() for c in rare.get("columns") or [] if isinstance(c, str) and c.strip()]
    if rare_columns:
        steps.append("bucket_rare")
        absent(steps[-1], rare_columns)
        options = {"min_freq": int(rare.get("min_freq", 50)), "other": str(rare.get("other_label", "Other"))}
        present = [c for c in rare_columns if c in cur.columns]
        if present:
            computed(
                rare_report(cur, present, **options),
                steps[-1],
                ["n_replaced", "n_levels_before", "n_levels_after"],
            )
            grouped.append(lazy[-1])
            fitted_rare = fit_rare(cur, present, **options)
            do(fitted_rare)

    for part, group in (config.get("value_mappings") or {}).items():
        group = group or {}
        columns = [c.strip() for c in group.get("columns") or [] if isinstance(c, str) and c.strip()]
        mapping = group.get("mapping") or {}
        if not columns or not mapping:
            continue
        steps.append("map_values")
        absent(steps[-1], columns, part=part)
        present = [c for c in columns if c in cur.columns]
        if config.get("include_mapping_in_report", False):
            row(steps[-1], "mapping", len(mapping), part=part, note=str(dict(mapping)))
        if present:
            computed(map_report(cur, present, mapping), steps[-1], ["n_affected"], part=part)
            hits = map_hits(cur, present, mapping)
            counted(steps[-1], {(c, "n_affected"): F.coalesce(F.sum(hit), F.lit(0)) for c, hit in hits.items()}, part=part)
            do(lambda d, present=present, mapping=mapping: map_values(d, present, mapping))

    counted("high_level", {(None, "rows_after"): F.count("*")}, step_no=0)
    steps_seen = list(steps)
    whole = raw.agg(F.count("*").alias("rows_before"))
    whole_after = cur.agg(F.count("*").alias("rows_after"))
    steps.clear()  # the high-level rows carry step number 0
    for frame, metric in ((whole, "rows_before"), (whole_after, "rows_after")):
        computed(frame.withColumn("column", F.lit(None).cast("string")), "high_level", [metric])
    row("high_level", "cols_before", len(df.columns))
    row("high_level", "cols_after", len(cur.columns))

    report = settled = literal_rows(spark, fixed, REPORT_SCHEMA)
    for frame in lazy:
        report = report.unionByName(frame)
    for frame in grouped:
        settled = settled.unionByName(frame)
    return CleaningResult(cur, report, steps_seen, dict(config), raw, passes, settled)
