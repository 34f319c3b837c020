"""Event hints of many reports as one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.functions.text import strip
from tablewarden.operators.findings import SEVERITIES
from tablewarden.operators.reports import hints_of


def flat_hints(reports: DataFrame, order: Sequence[tuple[str, str]], *, max_hints: int | None = None) -> DataFrame:
    """Hints in the order of their reports, each with its source; all, or the first ``max_hints`` per run.

    ``order`` lists (stage, name); other reports follow by stage and name.
    """
    names = F.array(*[F.lit(f"{s}/{n}") for s, n in order])
    place = F.array_position(names, F.concat_ws("/", "stage", "name"))
    upstream = F.when(place > 0, place).otherwise(F.lit(len(order) + 1)).cast("int")
    rows = reports.select(
        "run_id", "stage", "name", upstream.alias("upstream_no"), F.posexplode(hints_of()).alias("pos", "_h")
    ).select("run_id", "stage", F.col("name").alias("source_module"), "upstream_no", "pos", "_h.*")
    if max_hints is None:
        return rows
    in_run = Window.partitionBy("run_id").orderBy("upstream_no", "stage", "source_module", "pos")
    return rows.withColumn("hint_no", F.row_number().over(in_run)).filter(F.col("hint_no") <= max_hints)


def dedup_hints(hints: DataFrame) -> DataFrame:
    """The first hint of each (run, code, evidence path, stage, source)."""
    keys = ["run_id", "code", "evidence_path", "stage", "source_module"]
    rest = [c for c in hints.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct("upstream_no", "pos"))
    return (
        hints.groupBy(*keys)
        .agg(first.alias("_f"))
        .select(*keys, "_f.*")
    )


def normalised(hints: DataFrame) -> DataFrame:
    """Trimmed texts, lower-case severity, empty maps instead of missing ones."""
    empty = F.create_map().cast("map<string,string>")
    return hints.withColumns(
        {
            "code": F.coalesce(strip(F.col("code")), F.lit("")),
            "evidence_path": F.coalesce(strip(F.col("evidence_path")), F.lit("")),
            "severity_signal": F.lower(strip(F.coalesce("severity_signal", F.lit("info")))),
            "context": F.coalesce("context", empty),
            "remediation": F.coalesce("remediation", empty),
        }
    )


def hint_problems() -> Column:
    """Codes of what is wrong with a normalised hint."""
    return F.array_compact(
        F.array(
            F.when(~F.col("severity_signal").isin(SEVERITIES), "bad_severity"),
            F.when(F.col("code") == "", "no_code"),
        )
    )


def invalid_hints(hints: DataFrame) -> DataFrame:
    checked = normalised(hints).withColumn("problems", hint_problems())
    return checked.filter(F.size("problems") > 0)
