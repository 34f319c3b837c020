"""The pre-analysis summary: all quality checks of one table as one findings table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.functions.numbers import nulls_for_nan, ratio
from tablewarden.functions.text import MISSING_CATEGORY, norm_category, text_of
from tablewarden.operators import profile
from tablewarden.operators.findings import FAIL, WARN, fact, union_all
from tablewarden.plans.compiled import Checks


def quality_findings(
    df: DataFrame,
    *,
    contract: profile.Contract,
    label: str,
    positive: str,
    rules: Sequence[profile.Rule] = (),
    segments: Sequence[str] = (),
    high_missing: float = 0.20,
    high_cardinality: float = 0.50,
    small_share: float = 0.01,
    max_majority: float = 0.80,
    needs: profile.Readiness = profile.Readiness(),
) -> DataFrame:
    """Contract, health, rules, readiness, segments and balance as finding rows.

    The table is read once for all aggregates, once for the levels of all columns, segments and
    classes, and once for its key.
    """
    df = nulls_for_nan(df)
    checks = Checks(df)
    value = checks.value
    facts: list[Column] = []
    later: list[Callable[[], list[Column]]] = []  # facts, once the asks are compiled

    severity = "hard" if contract.enforce_required else "risk"
    absent = [c for c in contract.required if c not in df.columns]
    facts += [fact("contract", "missing_column", c, F.lit(1.0), severity, F.lit(True)) for c in absent]
    strict = "hard" if contract.enforce_dtypes else "risk"
    numeric = [c for c in contract.numeric if c in df.columns]
    for i, c in enumerate(numeric):
        checks.ask(f"d{i}", F.count_if(profile.unreadable_number(df, c)))
    for i, r in enumerate(rules):
        checks.ask(f"r{i}", F.count_if(r.broken(df)))
    for name, ask in needs.counts(df, label, positive).items():
        checks.ask(name, ask)
    later.append(
        lambda: [fact("contract", "dtype_issues_detected", c, value(f"d{i}"), strict, value(f"d{i}") > 0) for i, c in enumerate(numeric)]
        + [fact("semantic", "rule_broken", r.name, value(f"r{i}"), "risk", value(f"r{i}") > 0) for i, r in enumerate(rules)]
        + [fact("readiness", name, label, x, "hard", ~F.coalesce(good, F.lit(False))) for name, x, good in needs.lines(value)]
    )
    if contract.primary_key:
        # rows without a key, and rows of keys that occur more than once
        checks.ask_groups(
            [F.col(f"`{k}`") for k in contract.primary_key],
            {"n_of_key": F.count("*")},
            {"broken": lambda g: F.coalesce(F.sum(F.when(g("null_key") | (g("n_of_key") > 1), g("n_of_key"))), F.lit(0))},
        )
        key = ",".join(contract.primary_key)
        later.append(lambda: [fact("contract", "primary_key_broken", key, value("broken"), "hard", value("broken") > 0)])

    y = norm_category(text_of(df, label))
    labelled = y != MISSING_CATEGORY
    present = [c for c in segments if c in df.columns]
    for i, c in enumerate(df.columns):
        checks.ask_levels(f"h{i}", text_of(df, c))
    for i, c in enumerate(present):
        checks.ask_levels(f"s{i}", norm_category(text_of(df, c)), labelled)
    checks.ask_levels("c", y, labelled)
    checks.compile()
    for make in later:
        facts += make()

    # every segment column has a level, known or not, in each labelled row
    level, n = F.col("value"), F.col("n")
    per_name = checks.levels().groupBy("name").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(level.isNull(), n)), F.lit(0)).alias("missing"),
        F.count_if(level.isNotNull()).alias("unique"),
        F.count_if(ratio(n, value("n_labelled")) < F.lit(float(small_share))).alias("small"),
        F.max("n").alias("most"),
    )

    def line(name: str, source: str, code: str, subject: str, x: Column, severity: str, bad: Column) -> Column:
        return F.when(F.col("name") == name, fact(source, code, subject, x, severity, bad))

    missing_rate, unique_ratio = (ratio(F.col(c), F.col("rows")) for c in ("missing", "unique"))
    lines = []
    for i, c in enumerate(df.columns):
        lines.append(line(f"h{i}", "health", "high_missing", c, F.round(missing_rate, 6), "fixable", missing_rate > high_missing))
        high = unique_ratio > high_cardinality
        lines.append(line(f"h{i}", "health", "high_cardinality", c, F.round(unique_ratio, 6), "info", high))
    for i, c in enumerate(present):
        lines.append(line(f"s{i}", "domain", "small_segments", c, F.col("small"), "info", F.col("small") > 0))
    share = ratio(F.col("most"), F.col("rows"))
    lines.append(line("c", "distribution", "dominant_class", label, F.round(share, 6), "risk", share > F.lit(max_majority)))
    of_levels = per_name.select(F.explode(F.array_compact(F.array(*lines))).alias("_f")).select("_f.*")
    return union_all([checks.facts(facts), of_levels])


def severity_summary(found: DataFrame, *, max_examples: int = 20) -> DataFrame:
    """Blockers, critical warnings and suggestions with their number and first examples."""
    category = (
        F.when(F.col("severity") == "hard", "blockers")
        .when(F.col("severity") == "risk", "critical_warnings")
        .otherwise("suggestions")
    )
    named = found.filter(F.col("status").isin(WARN, FAIL)).select(
        category.alias("category"), F.concat_ws(":", "source", "code", "subject").alias("name")
    )
    # ranked first, so that at most max_examples names of a category are collected
    ranked = named.withColumn("_r", F.row_number().over(Window.partitionBy("category").orderBy("name")))
    shown = F.collect_list(F.when(F.col("_r") <= max_examples, F.col("name")))
    return ranked.groupBy("category").agg(
        F.count("*").alias("n_findings"), F.array_join(F.array_sort(shown), " | ").alias("examples")
    )
