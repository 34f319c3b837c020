"""Exact, repeatable train/val/test splits and folds.

A split is fitted and then assigned.  Fitting finds, with a few scans whose
results are a handful of rows, the hash (or time) value at which each part
ends.  Assigning compares every row with those cut-offs: a plain projection
without shuffle or sort, identical for any partitioning of the data.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.functions.numbers import binary_label, ratio
from tablewarden.functions.text import row_id, text_of
from tablewarden.operators.class_cuts import class_counts, cuts, join_classes, quotas
from tablewarden.operators.order_stats import (
    DIRECT_LIMIT,
    hash_token,
    tokens_at_ranks,
    values_at_ranks,
)
from tablewarden.session import written

PARTS = ["train", "val", "test"]
# Up to so many classes have cut-offs in the plan; those of more classes are a table.
LITERAL_CLASSES = 1_000
EXCLUDED = "excluded"


class SplitError(ValueError):
    pass


class _NoStrata(Exception):
    """Stratification is impossible with these class counts."""


def part_sizes(n: int, test: float, val: float) -> tuple[int, int, int]:
    """(train, val, test) sizes: test first, then val from the rest, both rounded up."""
    n_test = math.ceil(test * n)
    n_val = math.ceil(val / (1.0 - test) * (n - n_test))
    return n - n_test - n_val, n_val, n_test


def _check_fractions(test: float, val: float) -> None:
    if not 0 < test < 1 or not 0 < val < 1 or test + val >= 1.0:
        raise SplitError(f"test ({test}) and val ({val}) must lie in (0, 1) and add up to less than 1")


def stratum_quotas(counts: Mapping[int, int], drawn: int) -> dict[int, int]:
    """How many of ``drawn`` rows each class gives.

    The classes' shares of the part that stays are rounded down and topped up
    by largest remainder, ties by class order; the rest is drawn.
    """
    n = sum(counts.values())
    stays = n - drawn
    _check_strata(len(counts), min(counts.values()), n, drawn)
    # integer arithmetic: floor and remainder of count * stays / n
    kept = {s: c * stays // n for s, c in counts.items()}
    remainder = {s: c * stays % n for s, c in counts.items()}
    spare = stays - sum(kept.values())
    for s in sorted(counts, key=lambda s: (-remainder[s], s))[:spare]:
        kept[s] += 1
    return {s: counts[s] - kept[s] for s in counts}


def _check_strata(classes: int, least: int, n: int, drawn: int) -> None:
    if least < 2:
        raise _NoStrata("a class has fewer than 2 rows")
    if drawn < classes or n - drawn < classes:
        raise _NoStrata("a part is smaller than the number of classes")


def _class_counts(rows: DataFrame, drawn: int, most: int) -> dict[int, int] | None:
    """Rows per class ``_y``, fetched only once one aggregate has shown that they can be stratified, and
    only up to ``most`` classes (None: there are more)."""
    counts = rows.groupBy("_y").agg(F.count("*").alias("n"))
    seen = counts.agg(F.count("*").alias("k"), F.min("n").alias("least"), F.sum("n").alias("n")).first()
    _check_strata(seen["k"], seen["least"], seen["n"], drawn)
    return {r["_y"]: r["n"] for r in counts.collect()} if seen["k"] <= most else None


@dataclass
class HoldoutPlan:
    """Cut-offs of a fitted holdout split; ``assign`` applies them to any table with the keys."""

    label: str
    positive: str | None
    keys: list[str]
    seed: int
    strategy_requested: str
    strategy_used: str
    fallback_reason: str | None
    test_size: float
    val_size: float
    n_total: int
    n_valid: int
    test_by_class: bool
    val_by_class: bool
    test_cut: dict[int, str] = field(default_factory=dict)
    val_cut: dict[int, str] = field(default_factory=dict)

    def part(self, df: DataFrame) -> Column:
        rid, y = row_id(df, self.keys), binary_label(df, self.label, self.positive)
        in_test = _upto(hash_token(rid, self.seed), y if self.test_by_class else F.lit(0), self.test_cut)
        in_val = _upto(hash_token(rid, self.seed + 1), y if self.val_by_class else F.lit(0), self.val_cut)
        known = known_label(df, self.label)
        return (
            F.when(~known, EXCLUDED).when(in_test, "test").when(in_val, "val").otherwise("train")
        )

    def assign(self, df: DataFrame) -> DataFrame:
        return df.withColumn("split", self.part(df))


def known_label(df: DataFrame, label: str) -> Column:
    return text_of(df, label).isNotNull()


def _cut_of(stratum: Column, cuts: Mapping[int, str]) -> Column:
    # branches side by side: nested ones, up to a thousand deep, overflow the stack
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for s, cut in cuts.items():
        out = out.when(stratum == s, F.lit(cut))
    return out


def _upto(token: Column, stratum: Column, cuts: Mapping[int, str]) -> Column:
    """Does the token lie within its stratum's cut; the token is hashed once per row."""
    return F.coalesce(token <= _cut_of(stratum, cuts), F.lit(False))


def fit_holdout(
    df: DataFrame,
    *,
    label: str,
    keys: Sequence[str],
    positive: str | None = None,
    strategy: str = "stratified",
    test_size: float = 0.20,
    val_size: float = 0.20,
    seed: int = 42,
    direct_limit: int = DIRECT_LIMIT,
    literal_classes: int = LITERAL_CLASSES,
) -> HoldoutPlan:
    """Fit a random or stratified split.  ``keys`` must identify a row.

    The cut-offs of more than ``literal_classes`` classes are a table (see ``ClassPlan``).
    """
    if label not in df.columns:
        raise SplitError(f"label column {label!r} not found")
    _check_fractions(test_size, val_size)
    how = str(strategy).strip().lower()
    if how not in ("stratified", "random"):
        raise SplitError(f"strategy must be stratified or random, got {strategy!r}")

    base = df.select(
        row_id(df, keys).alias("_id"),
        binary_label(df, label, positive).alias("_y"),
        known_label(df, label).alias("_known"),
    )
    n_total, n_valid = base.agg(F.count("*"), F.count_if("_known")).first()
    if n_valid < 3:
        raise SplitError(f"at least 3 labelled rows are needed, got {n_valid}")
    n_train, n_val, n_test = part_sizes(n_valid, test_size, val_size)
    if min(n_train, n_val, n_test) < 1:
        raise SplitError(f"a part would be empty: train={n_train} val={n_val} test={n_test}")

    used, reason = how, None
    valid = base.filter("_known").withColumn("_all", F.lit(0))

    test_by_class = how == "stratified"
    quota = {0: n_test}
    if test_by_class:
        try:
            classes = _class_counts(valid, n_test, literal_classes)
            if classes is None:
                settings = (label, positive, list(keys), seed, strategy)
                return _fit_classes(valid, settings, (test_size, val_size), (n_total, n_valid, n_val, n_test), direct_limit)
            quota = stratum_quotas(classes, n_test)
        except _NoStrata as e:
            used, reason, test_by_class, quota = "random_fallback", str(e), False, {0: n_test}
    t1 = valid.withColumn("_t", hash_token(F.col("_id"), seed))
    stratum = "_y" if test_by_class else "_all"
    test_cut = _cuts(t1, stratum, quota, n_valid, direct_limit)

    rest = t1.filter(~_upto(F.col("_t"), F.col(stratum), test_cut)).withColumn(
        "_t", hash_token(F.col("_id"), seed + 1)
    )
    val_by_class = how == "stratified"
    val_quotas = {0: n_val}
    if val_by_class:
        try:
            left = {s: classes[s] - quota[s] for s in classes} if test_by_class else _class_counts(rest, n_val, n_valid)
            val_quotas = stratum_quotas({s: c for s, c in left.items() if c}, n_val)
        except _NoStrata:
            val_by_class, val_quotas = False, {0: n_val}
            if used != "random_fallback":
                used, reason = "random_fallback_val", "the rows left after the test part allow no strata"
    stratum = "_y" if val_by_class else "_all"
    val_cut = _cuts(rest, stratum, val_quotas, n_valid - n_test, direct_limit)

    return HoldoutPlan(
        label, positive, list(keys), seed, strategy, used, reason, test_size, val_size,
        n_total, n_valid, test_by_class, val_by_class, test_cut, val_cut,
    )


@dataclass
class ClassPlan(HoldoutPlan):
    """Cut-offs of very many classes: ``cuts`` has (_y, test_cut, val_cut), so ``assign`` is a join with it, broadcast
    where the classes are few enough, and the plan is of one size whatever their number."""

    cuts: DataFrame | None = None
    counts: DataFrame | None = None

    def part(self, df: DataFrame) -> Column:
        raise SplitError("the cut-offs of very many classes are a table; use assign")

    def assign(self, df: DataFrame) -> DataFrame:
        rid = row_id(df, self.keys)
        whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
        rows = df.select(
            whole.alias("_row"), binary_label(df, self.label, self.positive).alias("_y"),
            known_label(df, self.label).alias("_known"), rid.alias("_id"),
        )
        rows = join_classes(rows, self.cuts, self.counts, F.col("_id"), "left")
        in_test = F.coalesce(hash_token(F.col("_id"), self.seed) <= F.col("test_cut"), F.lit(False))
        val_token = hash_token(F.col("_id"), self.seed + 1)
        cut = F.col("val_cut") if self.val_by_class else F.lit(self.val_cut.get(0)).cast("string")
        in_val = F.coalesce(val_token <= cut, F.lit(False))
        part = F.when(~F.col("_known"), EXCLUDED).when(in_test, "test").when(in_val, "val").otherwise("train")
        return rows.select("_row.*", part.alias("split"))


def _fit_classes(valid: DataFrame, settings: tuple, fractions: tuple, sizes: tuple, limit: int) -> ClassPlan:
    """A stratified split by tables: quotas, cut-offs and the rows left are never fetched."""
    seed, (n_total, n_valid, n_val, n_test) = settings[3], sizes
    tokens = written(valid.select("_y", "_id"), "tokens")
    counts = class_counts(tokens)

    def cut_table(rows: DataFrame, quota: DataFrame, seed: int, name: str) -> DataFrame:
        asked = quota.select("_y", "c", F.array("quota").alias("ranks"))
        found = cuts(rows.select("_y", hash_token(F.col("_id"), seed).alias("_t")), asked, counts, limit)
        return written(found.select("_y", F.get("cuts", F.lit(0)).alias(name)), name)

    quota = written(quotas(counts, n_valid, n_test), "quotas")
    table = cut_table(tokens, quota, seed, "test_cut")
    out = join_classes(tokens, table, counts, F.col("_id"), "left")
    rest = written(out.filter(~F.coalesce(hash_token(F.col("_id"), seed) <= F.col("test_cut"), F.lit(False))).select("_y", "_id"), "rest")
    left = written(quota.select("_y", (F.col("c") - F.col("quota")).alias("c")).filter("c > 0"), "left")
    seen = left.agg(F.count("*").alias("k"), F.min("c").alias("least"), F.sum("c").alias("n")).first()
    used, reason, val_cut, by_class = "stratified", None, {}, True
    try:
        _check_strata(seen["k"], seen["least"], seen["n"], n_val)
        table = table.join(cut_table(rest, quotas(left, seen["n"], n_val), seed + 1, "val_cut"), "_y", "full")
    except _NoStrata:
        used, reason, by_class = "random_fallback_val", "the rows left after the test part allow no strata", False
        drawn = rest.select(F.lit(0).alias("_all"), hash_token(F.col("_id"), seed + 1).alias("_t"))
        val_cut = _cuts(drawn, "_all", {0: n_val}, n_valid - n_test, limit)
    return ClassPlan(
        *settings, used, reason, *fractions, n_total, n_valid, True, by_class, {}, val_cut,
        cuts=written(table, "cuts"), counts=counts,
    )


def _cuts(df: DataFrame, stratum: str, quotas: Mapping[int, int], n: int, limit: int) -> dict[int, str]:
    found = tokens_at_ranks(df, "_t", stratum, {s: [q] for s, q in quotas.items()}, n, direct_limit=limit)
    return {s: t for (s, _), t in found.items()}


def split_report(assigned: DataFrame, plan: HoldoutPlan) -> DataFrame:
    """Counts, shares of all rows and positive rates of every part, with the settings used."""
    y = binary_label(assigned, plan.label, plan.positive)
    part = F.col("split")
    n = F.count("*")

    def share(p: str) -> Column:
        return F.round(F.coalesce(ratio(F.count_if(part == p), n), F.lit(0.0)), 4)

    def rate(keep: Column) -> Column:
        return F.round(F.coalesce(F.avg(F.when(keep, y)), F.lit(0.0)), 4)

    def text(v: str | None) -> Column:
        return F.lit(v).cast("string")

    return assigned.agg(
        n.alias("n_total"),
        F.count_if(part != EXCLUDED).alias("n_valid"),
        F.count_if(part == EXCLUDED).alias("n_excluded"),
        *[F.count_if(part == p).alias(f"n_{p}") for p in PARTS],
        *[share(p).alias(f"pct_{p}") for p in PARTS],
        rate(part != EXCLUDED).alias("positive_rate_overall"),
        *[rate(part == p).alias(f"positive_rate_{p}") for p in PARTS],
    ).withColumns(
        {
            "split_type": F.lit("holdout"),
            "strategy_requested": text(plan.strategy_requested),
            "strategy_used": text(plan.strategy_used),
            "fallback_reason": text(plan.fallback_reason),
            "random_state": F.lit(plan.seed),
            "test_size_requested": F.lit(plan.test_size),
            "val_size_requested": F.lit(plan.val_size),
            "val_size_of_trainval": F.lit(round(plan.val_size / (1.0 - plan.test_size), 6)),
        }
    )


# --- groups ---------------------------------------------------------------------------------


def split_by_group(
    df: DataFrame,
    group: Sequence[str],
    *,
    test_size: float = 0.20,
    val_size: float = 0.20,
    seed: int = 42,
    direct_limit: int = DIRECT_LIMIT,
) -> DataFrame:
    """Keep every group within one part; the part sizes hold for the number of groups.

    The cut-offs are hash values of group keys, so assigning rows needs no
    join with the groups and a very large group costs nothing extra.
    """
    _check_fractions(test_size, val_size)
    ids = df.select(row_id(df, group).alias("_id")).distinct().withColumn("_all", F.lit(0))
    n = ids.count()
    if n < 3:
        raise SplitError(f"at least 3 groups are needed, got {n}")
    _, n_val, n_test = part_sizes(n, test_size, val_size)
    t1 = ids.withColumn("_t", hash_token(F.col("_id"), seed))
    test_cut = _cuts(t1, "_all", {0: n_test}, n, direct_limit)
    rest = t1.filter(~_upto(F.col("_t"), F.lit(0), test_cut)).withColumn(
        "_t", hash_token(F.col("_id"), seed + 1)
    )
    val_cut = _cuts(rest, "_all", {0: n_val}, n - n_test, direct_limit)
    rid = row_id(df, group)
    part = (
        F.when(_upto(hash_token(rid, seed), F.lit(0), test_cut), "test")
        .when(_upto(hash_token(rid, seed + 1), F.lit(0), val_cut), "val")
        .otherwise("train")
    )
    return df.withColumn("split", part)


# --- time -----------------------------------------------------------------------------------


def moment_of(df: DataFrame, column: str) -> Column:
    """The column itself, or its timestamps if it is text."""
    c = F.col(f"`{column}`")
    return F.try_to_timestamp(c) if isinstance(df.schema[column].dataType, T.StringType) else c


def split_by_time(
    df: DataFrame,
    column: str,
    *,
    test_size: float = 0.20,
    val_size: float = 0.20,
    direct_limit: int = DIRECT_LIMIT,
) -> DataFrame:
    """Oldest rows train, then val, newest test; rows of equal time stay together.

    Each part ends at the first time that fills its quota.  Times in text are
    read as timestamps; rows without a readable time are excluded.
    """
    _check_fractions(test_size, val_size)
    out, df = df, df.withColumn(column, moment_of(df, column))
    kind = df.schema[column].dataType
    n = df.agg(F.count(f"`{column}`")).first()[0]
    if n < 3:
        raise SplitError(f"at least 3 rows with a time are needed, got {n}")
    n_train, n_val, _ = part_sizes(n, test_size, val_size)
    if n_train < 1:
        raise SplitError("the train part would be empty")
    at = values_at_ranks(
        df, {column: [n_train, n_train + n_val]}, counts={column: n}, direct_limit=direct_limit
    )
    t = moment_of(out, column)
    train_end, val_end = (F.lit(at[(column, r)]).cast(kind) for r in (n_train, n_train + n_val))
    part = (
        F.when(t.isNull(), EXCLUDED).when(t <= train_end, "train").when(t <= val_end, "val").otherwise("test")
    )
    return out.withColumn("split", part)


# --- folds ----------------------------------------------------------------------------------


def assign_folds(
    df: DataFrame,
    *,
    label: str,
    keys: Sequence[str],
    positive: str | None = None,
    folds: int = 5,
    stratified: bool = True,
    seed: int = 42,
    direct_limit: int = DIRECT_LIMIT,
    literal_classes: int = LITERAL_CLASSES,
) -> DataFrame:
    """Column ``fold`` in 0..folds-1, sizes per class differing by at most one; NULL without label.

    Folds are consecutive ranges of the hash order, so folds-1 cut-offs per
    class decide every row without ranking the table.
    """
    if folds < 2:
        raise SplitError("at least 2 folds are needed")
    base = df.select(
        row_id(df, keys).alias("_id"),
        (binary_label(df, label, positive) if stratified else F.lit(0)).alias("_y"),
        known_label(df, label).alias("_known"),
    ).filter("_known")
    per_class = base.groupBy("_y").agg(F.count("*").alias("n"))
    # the least class is looked at before any class is fetched
    seen = per_class.agg(F.count("*").alias("k"), F.min("n").alias("least")).first()
    if (seen["least"] or 0) < folds:
        raise SplitError(f"every class needs at least {folds} labelled rows")
    if seen["k"] > literal_classes:
        return _folds_by_table(df, base, label, positive, keys, folds, seed, direct_limit)
    counts = {r["_y"]: r["n"] for r in per_class.collect()}
    ends = {s: [c * (f + 1) // folds for f in range(folds - 1)] for s, c in counts.items()}
    tokens = base.withColumn("_t", hash_token(F.col("_id"), seed))
    at = tokens_at_ranks(tokens, "_t", "_y", ends, sum(counts.values()), direct_limit=direct_limit)
    y = binary_label(df, label, positive) if stratified else F.lit(0)
    token = hash_token(row_id(df, keys), seed)
    # the fold is the number of fold ends that lie before the token
    passed = F.lit(0)
    for f in range(folds - 1):
        cut = _cut_of(y, {s: at[(s, ends[s][f])] for s in counts})
        passed = passed + (token > cut).cast("int")
    return df.withColumn("fold", F.when(known_label(df, label), passed))


def _folds_by_table(
    df: DataFrame, base: DataFrame, label: str, positive: str | None, keys: Sequence[str], folds: int, seed: int, limit: int
) -> DataFrame:
    """Folds of very many classes: the fold ends are a table."""
    tokens = written(base.select("_y", hash_token(F.col("_id"), seed).alias("_t")), "tokens")
    counts = class_counts(tokens)
    ends = F.array(*[F.floor(F.col("c") * f / folds).cast("long") for f in range(1, folds)])
    table = written(cuts(tokens, counts.select("_y", "c", ends.alias("ranks")), counts, limit), "folds")
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"),
        binary_label(df, label, positive).alias("_y"),
        F.when(known_label(df, label), hash_token(row_id(df, keys), seed)).alias("_t"),
    )
    rows = join_classes(rows, table, counts, F.col("_t"), "left")
    passed = F.size(F.filter("cuts", lambda c: c < F.col("_t")))
    return rows.select("_row.*", F.when(F.col("_t").isNotNull(), passed).alias("fold"))


# --- advice ---------------------------------------------------------------------------------


def split_advice(
    df: DataFrame, *, time_column: str | None, entity: Sequence[str], risky: DataFrame | None = None,
    max_examples: int | None = None,
) -> DataFrame:
    """Which strategy the data asks for: time_based with times, group with repeating entities.

    ``risky`` is a leakage catalogue; its high-risk features are listed: all, or the
    first ``max_examples`` with their full count beside them.
    """
    has_time = F.count_if(F.col(f"`{time_column}`").isNotNull()) if time_column else F.lit(0).cast("long")
    repeats = (
        df.groupBy(*[f"`{e}`" for e in entity]).agg(F.count("*").alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("n_repeating_entities"))
    )
    times = df.agg(has_time.alias("n_with_time"))
    advice = (
        F.when(F.col("n_with_time") > 0, "time_based")
        .when(F.col("n_repeating_entities") > 0, "group")
        .otherwise("stratified")
    )
    out = times.select(
        "n_with_time", repeats.scalar().alias("n_repeating_entities")
    ).withColumn("recommended", advice)
    if risky is not None:
        # one row per feature
        high = risky.filter(F.col("risk") == "high").select("feature")
        shown = high if max_examples is None else high.orderBy("feature").limit(max_examples)
        names = shown.agg(F.array_join(F.array_sort(F.collect_list("feature")), ",").alias("f"))
        out = out.withColumn("risky_features", names.scalar())
        if max_examples is not None:
            out = out.withColumn("n_risky_features", high.agg(F.count("*")).scalar())
    return out
