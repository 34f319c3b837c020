"""Module reports as table rows: building, parsing, validating and choosing among runs.

A report row holds ``stage``, ``name`` and ``run_id`` (where it was filed) and
``payload``, the report itself as JSON text.  ``parse`` adds the struct
``report``; everything else reads that struct, also in its older layouts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.functions.text import strip
from tablewarden.operators.findings import FAIL, STATUSES
from tablewarden.session import literal_rows

# The keys that every report must have.
REQUIRED_KEYS = [
    "schema_version", "run_id", "timestamp_utc", "module", "summary", "status",
    "inputs", "thresholds_used", "used_config", "refs", "checks",
]
MODULE_KEYS = ["stage", "step", "name", "tag", "cfg_key", "enabled"]
SUMMARY_KEYS = ["total_rows", "total_cols", "overall_status", "issues", "warnings", "metrics", "notes"]
# The stages a report may be filed under.
STAGES = ["setup", "data_quality", "data_integrity", "split_strategy", "governance"]

_TEXTS, _DICT = "array<string>", "map<string,string>"
# Numbers are read as double, so that 12 and 12.0 both count and "12" does not.
REPORT_DDL = f"""
  schema_version bigint, run_id string, timestamp_utc string,
  module struct<stage: string, step: string, name: string, tag: string, cfg_key: string, enabled: boolean>,
  summary struct<total_rows: double, total_cols: double, overall_status: string, issues: {_TEXTS},
    warnings: {_TEXTS}, metrics: {_DICT}, notes: {_TEXTS},
    total_columns: double, n_cols: double, cols: double, total_features: double>,
  status string, inputs {_DICT}, thresholds_used {_DICT}, used_config {_DICT}, refs {_DICT}, checks {_DICT},
  validation_status string, fatal_issues {_TEXTS}, warnings {_TEXTS}, metrics {_DICT},
  n_rows double, total_rows double, rows double,
  n_cols double, total_cols double, total_columns double, cols double, columns double,
  high_level struct<total_rows: double>, shape_before array<double>
"""
HINT_DDL = f"struct<code: string, severity_signal: string, evidence_path: string, context: {_DICT}, remediation: {_DICT}>"
HINTS_DDL = f"array<{HINT_DDL}>"
HINTS_PATH = "$.checks.event_hints.hints"
# Issue codes that readers of reports look for.
MISSING_REPORT, MISSING_STEP, RAISED = "missing_module_report", "missing_step_implementation", "module_exception"


# --- building -----------------------------------------------------------------------------


def merge_lists(a: Column, b: Column) -> Column:
    """Both lists, trimmed, without blanks and repeats, in first-seen order."""
    both = F.concat(F.coalesce(a, F.array().cast(_TEXTS)), F.coalesce(b, F.array().cast(_TEXTS)))
    return F.array_distinct(F.filter(F.transform(both, strip), lambda x: x.isNotNull() & (x != "")))


def sorted_unique(a: Column) -> Column:
    return F.array_sort(merge_lists(a, F.array().cast(_TEXTS)))


def report_payload(
    *,
    stage: Column,
    step: Column,
    name: Column,
    run_id: Column,
    total_rows: Column,
    total_cols: Column,
    status: Column,
    issues: Column,
    warnings: Column,
    hints: Column,
    metrics: Column | None = None,
    extra_checks: dict[str, Column] | None = None,
    inputs: Column | None = None,
    thresholds: Column | None = None,
    used_config: Column | None = None,
    refs: Column | None = None,
    notes: Column | None = None,
    schema_version: int = 1,
    timestamp: Column | None = None,
) -> Column:
    """A complete report as JSON text: status normalised and mirrored, lists merged, NaN left out.

    ``inputs``, ``thresholds``, ``used_config`` and ``refs`` are maps or structs, ``notes`` is a list of
    texts.  A status outside the known ones stops the job.
    """
    empty = F.create_map().cast(_DICT)
    status = F.lower(strip(status))
    refused = F.raise_error(F.concat(F.lit("no report status: "), F.coalesce(status, F.lit("null")))).cast("string")
    status = F.when(F.coalesce(status.isin(STATUSES), F.lit(False)), status).otherwise(refused)
    none = F.array().cast(_TEXTS)
    checks = F.struct(
        F.struct(F.lit(1).alias("version"), hints.cast(HINTS_DDL).alias("hints")).alias("event_hints"),
        *[c.alias(k) for k, c in (extra_checks or {}).items()],
    )
    when = F.current_timestamp() if timestamp is None else timestamp
    return F.to_json(
        F.struct(
            F.lit(schema_version).alias("schema_version"),
            run_id.alias("run_id"),
            F.date_format(F.to_utc_timestamp(when, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp_utc"),
            F.struct(
                stage.alias("stage"),
                step.alias("step"),
                name.alias("name"),
                F.upper(name).alias("tag"),
                F.concat_ws(".", F.lit("pipeline"), stage, name).alias("cfg_key"),
                F.lit(True).alias("enabled"),
            ).alias("module"),
            F.struct(
                total_rows.cast("long").alias("total_rows"),
                total_cols.cast("long").alias("total_cols"),
                status.alias("overall_status"),
                merge_lists(issues, none).alias("issues"),
                merge_lists(warnings, none).alias("warnings"),
                (empty if metrics is None else metrics.cast(_DICT)).alias("metrics"),
                merge_lists(none if notes is None else notes, none).alias("notes"),
            ).alias("summary"),
            status.alias("status"),
            *[
                (empty if c is None else c).alias(k)
                for k, c in zip(("inputs", "thresholds_used", "used_config", "refs"), (inputs, thresholds, used_config, refs))
            ],
            checks.alias("checks"),
        ),
        {"ignoreNullFields": "false"},
    )


def preview(df: DataFrame, rows: int = 3, columns: int = 5) -> DataFrame:
    """A bounded look at a table for a report."""
    return df.select(*[f"`{c}`" for c in df.columns[:columns]]).limit(rows)


# --- parsing ------------------------------------------------------------------------------


def parse(reports: DataFrame) -> DataFrame:
    """Add ``report``, the parsed payload; NULL where the text is no complete JSON object."""
    return reports.withColumn("report", F.when(is_readable(), F.from_json("payload", REPORT_DDL)))


def is_readable() -> Column:
    """Whether the payload is a complete JSON object."""
    return F.coalesce(F.json_object_keys("payload").isNotNull() & strip(F.col("payload")).startswith("{"), F.lit(False))


def _r(path: str) -> Column:
    return F.col(f"report.{path}")


def hints_of(payload: Column | str = "payload") -> Column:
    """The report's event hints; entries that are no objects are left out.

    Entries are parsed one by one, so that a malformed one costs only itself.
    """
    entries = F.from_json(F.get_json_object(payload, HINTS_PATH), "array<string>")
    objects = F.filter(entries, lambda e: e.startswith("{"))
    return F.transform(objects, lambda e: F.from_json(e, HINT_DDL))


def _absent(required: Sequence[str], keys: Column, prefix: str) -> Column:
    """Codes for the required keys that an object lacks."""
    wanted = F.array(*[F.lit(k) for k in required])
    gone = F.array_except(wanted, F.coalesce(keys, F.array().cast(_TEXTS)))
    return F.transform(gone, lambda k: F.concat(F.lit(f"missing:{prefix}"), k))


def _blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def violations() -> Column:
    """Codes of everything that is wrong with a parsed report; empty for a valid one."""

    def code(text: str, bad: Column) -> Column:
        return F.when(F.coalesce(bad, F.lit(False)), F.lit(text))

    def outside(c: Column) -> Column:
        return c.isNotNull() & ~c.isin(STATUSES)

    top, overall = _r("status"), _r("summary.overall_status")
    broken = F.array(F.lit("not_an_object"))
    named = F.concat(
        _absent(REQUIRED_KEYS, F.json_object_keys("payload"), ""),
        _absent(MODULE_KEYS, F.json_object_keys(F.get_json_object("payload", "$.module")), "module."),
        _absent(SUMMARY_KEYS, F.json_object_keys(F.get_json_object("payload", "$.summary")), "summary."),
    )
    typed = F.array_compact(
        F.array(
            code("type:schema_version", _r("schema_version").isNull()),
            code("type:run_id", _blank(_r("run_id"))),
            code("type:timestamp_utc", _blank(_r("timestamp_utc"))),
            *[code(f"type:module.{k}", _blank(_r(f"module.{k}"))) for k in MODULE_KEYS[:-1]],
            code("type:module.enabled", _r("module.enabled").isNull()),
            *[
                code(f"type:summary.{k}", _r(f"summary.{k}").isNull())
                for k in SUMMARY_KEYS
                if k != "overall_status"
            ],
            code("domain:status", outside(top)),
            code("domain:overall_status", outside(overall)),
            code("not_mirrored", top.isNotNull() & overall.isNotNull() & (top != overall)),
            *[
                code(f"type:{k}", _r(k).isNull())
                for k in ("inputs", "thresholds_used", "used_config", "refs", "checks")
            ],
        )
    )
    return F.when(F.col("report").isNull(), broken).otherwise(F.concat(named, typed))


# --- reading values, older layouts included ---------------------------------------------------


def overall_status() -> Column:
    """Summary first, then two older places; ``missing`` without a report."""
    summary = _r("summary.overall_status")
    keys = F.json_object_keys("payload")
    return (
        F.when(F.col("report").isNull() | (F.size(keys) == 0), "missing")
        .when(summary.isNotNull() & (summary != ""), F.lower(strip(summary)))
        .when(_r("validation_status").isNotNull(), F.lower(strip(_r("validation_status"))))
        .when(_r("status").isNotNull(), F.lower(strip(_r("status"))))
        .otherwise("unknown")
    )


def module_status() -> Column:
    """Status first, then the summary; whatever is not a known status is a fail."""

    def known(c: Column) -> Column:
        c = F.lower(strip(c))
        return F.when(c.isin(STATUSES), c).otherwise(FAIL)

    return (
        F.when(~_blank(_r("status")), known(_r("status")))
        .when(~_blank(_r("summary.overall_status")), known(_r("summary.overall_status")))
        .otherwise(FAIL)
    )


def norm_status(c: Column) -> Column:
    c = F.lower(strip(c.cast("string")))
    return F.when(c.isNull() | (c == ""), "unknown").otherwise(c)


def issues() -> Column:
    return F.coalesce(_r("summary.issues"), _r("fatal_issues"), F.array().cast(_TEXTS))


def warnings() -> Column:
    return F.coalesce(_r("summary.warnings"), _r("warnings"), F.array().cast(_TEXTS))


def metrics() -> Column:
    return F.coalesce(_r("summary.metrics"), _r("metrics"), F.create_map().cast(_DICT))


def _first_count(places: Sequence[Column]) -> Column:
    return F.coalesce(*[F.when(c >= 0, c) for c in places]).cast("long")


def total_rows() -> Column:
    return _first_count(
        [_r("summary.total_rows"), _r("n_rows"), _r("total_rows"), _r("rows"),
         _r("high_level.total_rows"), F.get(_r("shape_before"), F.lit(0))]
    )


def total_cols() -> Column:
    summary = [_r(f"summary.{k}") for k in ("total_cols", "total_columns", "n_cols", "cols", "total_features")]
    top = [_r(k) for k in ("n_cols", "total_cols", "total_columns", "cols", "columns")]
    return _first_count([*summary, *top, F.get(_r("shape_before"), F.lit(1))])


def non_empty(c: Column) -> Column:
    return F.coalesce(F.size(c), F.lit(0)) > 0


def has_missing_module_report() -> Column:
    return F.array_contains(warnings(), MISSING_REPORT)


def upstream_blocks(parsed: DataFrame, requested: str | None = None) -> DataFrame:
    """A compact status line per report, with where it was read and how it was chosen.

    ``source_path`` is the column ``path`` of reports read from files (NULL for others).  ``load_meta`` tells the run
    asked for and the run found, whether these differ (``fell_back``), and whether the report goes by its current or an
    older name (``mode``), as far as ``requested_or_latest`` and ``preferred_name`` have said so.
    """

    def known(name: str, kind: str) -> Column:
        return F.col(name) if name in parsed.columns else F.lit(None).cast(kind)

    meta = F.struct(
        F.lit(requested).cast("string").alias("requested_run"), F.col("run_id").alias("loaded_run"),
        known("fell_back", "boolean").alias("fell_back"), known("mode", "string").alias("mode"),
        is_readable().alias("readable"),
    )
    return parsed.select(
        "run_id",
        "stage",
        "name",
        overall_status().alias("status"),
        F.size(issues()).alias("n_issues"),
        F.size(warnings()).alias("n_warnings"),
        issues().alias("issues"),
        warnings().alias("warnings"),
        metrics().alias("key_metrics"),
        known("path", "string").alias("source_path"),
        meta.alias("load_meta"),
    )


# --- choosing among runs ----------------------------------------------------------------------


def latest_reports(reports: DataFrame) -> DataFrame:
    """The newest readable run of each (stage, name), by run id; names are compared whole.

    A broken report is chosen only where there is no readable one.
    """
    return _best(reports, F.struct(is_readable().alias("readable"), "run_id"))


def requested_or_latest(reports: DataFrame, run_id: str) -> DataFrame:
    """Each (stage, name) of the wanted run, else of its newest run; readable reports go before broken ones."""
    wanted = F.col("run_id") == F.lit(run_id)
    order = F.struct(is_readable().alias("readable"), wanted.alias("wanted"), "run_id")
    return _best(reports, order).withColumn(
        "fell_back", F.col("run_id") != F.lit(run_id)
    )


def _best(reports: DataFrame, order: Column) -> DataFrame:
    """An aggregate instead of a window: it combines before the shuffle, one row per task and group."""
    rest = [c for c in reports.columns if c not in ("stage", "name")]
    return (
        reports.groupBy("stage", "name")
        .agg(F.max_by(F.struct(*rest), order).alias("_best"))
        .select("stage", "name", "_best.*")
    )


def preferred_name(reports: DataFrame, current: str, older: Sequence[str]) -> DataFrame:
    """Per (run, stage) the report filed under ``current``, else under the first older name found.

    Readable reports go before broken ones.
    """
    names = [current, *older]
    place = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("name"))
    rest = [c for c in reports.columns if c not in ("run_id", "stage")]
    return (
        reports.filter(F.col("name").isin(names))
        .groupBy("run_id", "stage")
        .agg(F.min_by(F.struct(*rest), F.struct(~is_readable(), place)).alias("_best"))
        .select("run_id", "stage", "_best.*")
        .withColumn("mode", F.when(F.col("name") == current, "current").otherwise("older"))
    )


# --- steps ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Step:
    stage: str
    name: str
    gate: str | None = None
    enabled: bool = True


def gate_of(steps: Sequence[Step], default_gate: str = "soft") -> Column:
    """The gate of a report's step; a step without its own gate gets the default."""
    pairs = []
    for s in steps:
        gate = (s.gate or default_gate).strip().lower()
        if gate not in ("hard", "soft"):
            raise ValueError(f"gate of {s.stage}.{s.name} must be hard or soft, got {s.gate!r}")
        pairs += [F.lit(f"{s.stage}/{s.name}"), F.lit(gate)]
    if not pairs:
        return F.lit(default_gate)
    own = F.try_element_at(F.create_map(*pairs), F.concat_ws("/", "stage", "name"))
    return F.coalesce(own, F.lit(default_gate))


def expected_reports(runs: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """One row per run and enabled step; the steps ride along as a literal list."""
    asked = F.array(
        *[F.struct(F.lit(s.stage).alias("stage"), F.lit(s.name).alias("name")) for s in steps if s.enabled]
    )
    return runs.select("run_id").distinct().select("run_id", F.explode(asked).alias("_s")).select("run_id", "_s.*")


def missing_step_reports(reports: DataFrame, steps: Sequence[Step], runs: DataFrame | None = None) -> DataFrame:
    """A failing report row for every enabled step of a run that filed none."""
    gone = expected_reports(reports if runs is None else runs, steps).join(
        reports.select("run_id", "stage", "name"), ["run_id", "stage", "name"], "left_anti"
    )
    issue = F.lit(MISSING_STEP)
    payload = failed_payload(issue, "missing_impl", issue, {"infra": F.struct(issue.alias("error"))})
    return gone.select("stage", "name", "run_id", payload.alias("payload"))


def failed_payload(issue: Column, cause: str, note: Column, evidence: dict[str, Column]) -> Column:
    """The failing report of a step that left none: ``cause`` marks the inputs, ``evidence`` goes to the checks."""
    return report_payload(
        stage=F.col("stage"), step=F.col("name"), name=F.col("name"), run_id=F.col("run_id"),
        total_rows=F.lit(0), total_cols=F.lit(0), status=F.lit(FAIL), issues=F.array(issue),
        warnings=F.array().cast(_TEXTS), hints=F.array().cast(HINTS_DDL), notes=F.array(note), extra_checks=evidence,
        inputs=F.struct(F.lit(True).alias("orchestrator"), F.lit(True).alias(cause)),
        used_config=F.struct(F.concat_ws(".", F.lit("pipeline"), "stage", "name").alias("cfg_key")),
    )


def exception_report(spark: SparkSession, *, stage: str, name: str, run_id: str, error: BaseException) -> DataFrame:
    """The failing report of a step that raised."""
    row = literal_rows(
        spark,
        [(stage, name, run_id, type(error).__name__, repr(error))],
        "stage string, name string, run_id string, error_type string, error_repr string",
    )
    evidence = {"exception": F.struct("error_type", "error_repr")}
    payload = failed_payload(F.lit(RAISED), "exception_fallback", F.col("error_repr"), evidence)
    return row.select("stage", "name", "run_id", payload.alias("payload"))


def gate_decisions(
    parsed: DataFrame, steps: Sequence[Step], *, strict: bool = True, default_gate: str = "soft"
) -> DataFrame:
    """Which reports stop their run: strict mode, a hard gate and a failed status together."""
    halt = F.lit(strict) & (F.col("gate") == "hard") & (F.col("status") == FAIL)
    return (
        parsed.select(
            "run_id", "stage", "name", module_status().alias("status"), gate_of(steps, default_gate).alias("gate")
        )
        .withColumn("is_fail", F.col("status") == FAIL)
        .withColumn("halt", halt)
    )
