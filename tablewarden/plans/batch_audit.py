"""Audit every batch of a table in one job: reports of all runs from one aggregation.

A table that arrives in batches (one per day, say) is checked batch by batch.
The facts of all batches come from a single grouped pass; each batch then
yields the report rows of its checks, ready for the gate and audit operators.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.numbers import number_of, ratio
from tablewarden.functions.text import row_id, text_of
from tablewarden.operators.findings import FAIL, PASS, WARN
from tablewarden.operators.reports import HINTS_DDL, Step, report_payload

STEPS = [
    Step("setup", "config_snapshot"),
    Step("data_quality", "contract", "hard"),
    Step("data_quality", "readiness", "hard"),
    Step("data_quality", "orchestrator"),
    Step("data_integrity", "row_identity", "hard"),
    Step("data_integrity", "orchestrator"),
    Step("governance", "manifest"),
]


@dataclass(frozen=True)
class BatchRules:
    """Thresholds for one batch."""

    label: str
    positive: str
    key: str
    entity: str
    amount: str
    extreme_amount: float  # a larger amount in a batch is a hard finding
    min_rows: int = 5
    max_label_missing: float = 0.30
    min_positive: float = 0.05
    max_positive: float = 0.95


def batch_facts(df: DataFrame, run_id: Column, rules: BatchRules) -> DataFrame:
    """Counts per batch.

    Rows are first combined per (batch, entity), so a large batch spreads over
    its entities and no distinct set is held in one task.
    """
    y = text_of(df, rules.label)
    per_entity = (
        df.select(
            run_id.alias("run_id"),
            row_id(df, [rules.entity]).alias("_entity"),
            F.col(f"`{rules.key}`").alias("_key"),
            y.alias("_y"),
            number_of(df, rules.amount).alias("_amount"),
        )
        .groupBy("run_id", "_entity")
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("_key").isNull()).alias("n_no_key"),
            F.count("_y").alias("n_label"),
            F.count_if(F.col("_y") == rules.positive).alias("n_positive"),
            F.count_if(F.col("_amount") > rules.extreme_amount).alias("n_extreme"),
        )
    )
    sums = ["n", "n_no_key", "n_label", "n_positive", "n_extreme"]
    return per_entity.groupBy("run_id").agg(
        *[F.sum(c).alias(c) for c in sums], F.count("*").alias("n_entities")
    )


def _hint(code: str, severity: str, path: str, shown: Column) -> Column:
    return F.struct(
        F.lit(code).alias("code"),
        F.lit(severity).alias("severity_signal"),
        F.lit(path).alias("evidence_path"),
        F.create_map(F.lit("n"), shown.cast("string")).alias("context"),
        F.create_map(F.lit("action"), F.lit(f"review_{code}")).alias("remediation"),
    )


def batch_reports(df: DataFrame, run_id: Column, rules: BatchRules) -> DataFrame:
    """(run_id, stage, name, payload) for every batch and check.

    A batch with a single row has no readiness report; its stage report says so.
    """
    f = batch_facts(df, run_id, rules)
    n, repeats = F.col("n"), F.col("n") - F.col("n_entities")
    missing = F.lit(1.0) - ratio(F.col("n_label"), n)
    positive = ratio(F.col("n_positive"), F.col("n_label"))
    no_texts = F.array().cast("array<string>")

    def texts(*pairs: tuple[str, Column]) -> Column:
        return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), t) for t, c in pairs]))

    unready = n < 2
    balanced = F.coalesce(positive.between(rules.min_positive, rules.max_positive), F.lit(False))
    facts = f.select(
        "*",
        texts(("null_key", F.col("n_no_key") > 0)).alias("contract_issues"),
        texts(
            ("too_few_rows", ~unready & (n < rules.min_rows)),
            ("label_missing", ~unready & (missing > rules.max_label_missing)),
        ).alias("ready_issues"),
        texts(("class_imbalance", ~unready & ~balanced)).alias("ready_warnings"),
        texts(("missing_module_report", unready)).alias("unready_warnings"),
        texts(("entity_repeats", repeats > 0)).alias("repeat_warnings"),
        F.array_compact(
            F.array(
                F.when(repeats > 0, _hint("row_identity_entity_repeats", "risk", "checks.entities", repeats)),
                F.when(
                    F.col("n_extreme") > 0,
                    _hint("extreme_amount", "hard", "checks.amounts", F.col("n_extreme")),
                ),
            )
        ).cast(HINTS_DDL).alias("hints"),
    )
    no_hints = F.array().cast(HINTS_DDL)

    def line(step: Step, issues: Column = no_texts, warnings: Column = no_texts, hints: Column = no_hints) -> Column:
        return F.struct(
            F.lit(step.stage).alias("stage"), F.lit(step.name).alias("name"),
            issues.alias("issues"), warnings.alias("warnings"), hints.alias("hints"),
        )

    setup, contract, ready, quality, identity, integrity, manifest = STEPS
    own, both = F.col("ready_issues"), F.concat("contract_issues", "ready_issues")
    lines = F.array_compact(
        F.array(
            line(setup),
            line(contract, F.col("contract_issues")),
            F.when(~unready, line(ready, own, F.col("ready_warnings"))),
            line(quality, both, F.concat("ready_warnings", "unready_warnings")),
            line(identity, warnings=F.col("repeat_warnings"), hints=F.col("hints")),
            line(integrity, warnings=F.col("repeat_warnings")),
            line(manifest),
        )
    )
    counts = ("n", "n_label", "n_positive", "n_entities")
    rows = facts.select("run_id", *counts, F.explode(lines).alias("_l")).select("run_id", *counts, "_l.*")
    status = (
        F.when(F.size("issues") > 0, FAIL).when(F.size("warnings") > 0, WARN).otherwise(PASS)
    )
    is_quality = (F.col("stage") == quality.stage) & (F.col("name") == quality.name)
    where = F.when(is_quality, F.struct(F.concat(F.lit("clean/"), "run_id").alias("cleaned_parquet_path")))
    # one JSON expression serves the rows of all checks
    payload = report_payload(
        stage=F.col("stage"), step=F.col("name"), name=F.col("name"), run_id=F.col("run_id"), total_rows=n,
        total_cols=F.lit(len(df.columns)), status=status, issues=F.col("issues"), warnings=F.col("warnings"),
        hints=F.col("hints"), extra_checks={"persistence": where},
        metrics=F.create_map(*[x for c in counts for x in (F.lit(c), F.col(c).cast("string"))]),
    )
    return rows.select("run_id", "stage", "name", payload.alias("payload"))
