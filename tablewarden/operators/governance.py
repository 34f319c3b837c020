"""Manifest, fingerprint, lineage audit, inventory and the release gate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewarden.functions.numbers import ratio
from tablewarden.operators.findings import FAIL, PASS, SKIPPED, WARN, union_all
from tablewarden.operators.hints import flat_hints, normalised
from tablewarden.operators.reports import Step, module_status
from tablewarden.operators.segments import examples
from tablewarden.session import numbered
from tablewarden.sources.reports import file_glob, file_name

# --- files --------------------------------------------------------------------------------


def _files(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """Files of one folder, also those Spark wrote into folders ``file=``; content is read only where a query selects it."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", file_glob(suffix))
        .option("recursiveFileLookup", False)
        .load(folder)
        .withColumn("file", file_name())
        .filter(F.col("file").endswith(suffix))
    )


def manifest(
    spark: SparkSession,
    folder: str,
    *,
    run_id: str | None = None,
    suffix: str = ".json",
    max_files: int | None = None,
    by: str = "name",
    hashes: bool = True,
    preview: int = 30,
) -> DataFrame:
    """The run's files with their hash: all of them, or the first ``max_files``, whose names are fixed before they are read."""
    files = _files(spark, folder, suffix)
    if run_id:
        files = files.filter(F.col("file").endswith(f"_{run_id}{suffix}"))
    order = ["file"] if by == "name" else [F.desc("modificationTime"), "file"]
    facts = ["path", "file", "length", "modificationTime"]
    if max_files is None:
        return _previewed(files.select(*facts, *[F.sha2("content", 256).alias("sha256")] * hashes), order, preview)
    listed = files.select(*facts).orderBy(*order).limit(max_files)
    if not hashes:
        return _previewed(listed, order, preview)
    paths = [r["path"] for r in listed.select("path").collect()]  # at most max_files
    if not paths:
        return _previewed(listed.withColumn("sha256", F.lit(None).cast("string")), order, preview)
    read = spark.read.format("binaryFile").load(paths)
    rows = read.select(
        "path",
        file_name().alias("file"),
        "length",
        "modificationTime",
        F.sha2("content", 256).alias("sha256"),
    )
    return _previewed(rows, order, preview)


def _previewed(rows: DataFrame, order: list, preview: int) -> DataFrame:
    """Number the rows and mark those shown in the preview."""
    return numbered(rows, order, "file_no").withColumn("in_preview", F.col("file_no") <= preview)


def inventory(
    spark: SparkSession,
    folder: str,
    *,
    suffix: str = ".json",
    max_files: int | None = None,
    page_size: int = 200,
    max_pages: int | None = None,
    by: str = "mtime",
) -> DataFrame:
    """All files, newest first or by name, in pages; no content is read. A limit the caller sets keeps the first."""
    order = ["file"] if by == "name" else [F.desc("modified_at"), "file"]
    files = (
        _files(spark, folder, suffix)
        .select("file", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at"))
    )
    limits = [max_files, page_size * max_pages if max_pages is not None else None]
    if given := [x for x in limits if x is not None]:
        files = files.orderBy(*order).limit(min(given))
    return numbered(files, order, "file_no").withColumns(
        {
            "page": F.ceil(F.col("file_no") / page_size).cast("int"),
            "step_hint": F.regexp_extract("file", r"^(.+)_[^_]+\.[^.]+$", 1),
        }
    )


def fingerprint(df: DataFrame, *, sample_columns: int = 5, null_rates: bool = False) -> DataFrame:
    """Shape, types, first columns and a hash of the column list; NULL rates on request."""
    asks = [F.count("*").alias("n_rows")]
    if null_rates:
        asks += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"_null_{i}") for i, c in enumerate(df.columns)]
    out = df.agg(*asks).select(
        "*",
        F.lit(len(df.columns)).alias("n_cols"),
        F.sha2(F.lit(",".join(df.columns)), 256).alias("columns_hash"),
        F.lit(",".join(df.columns[:sample_columns])).alias("first_columns"),
        F.lit(",".join(f"{c}:{t}" for c, t in df.dtypes)).alias("dtypes"),
    )
    if not null_rates:
        return out
    rates = [
        F.concat_ws("=", F.lit(c), F.round(ratio(F.col(f"_null_{i}"), F.col("n_rows")), 6).cast("string"))
        for i, c in enumerate(df.columns)
    ]
    return out.withColumn("null_rates", F.concat_ws(",", *rates)).drop(
        *[f"_null_{i}" for i in range(len(df.columns))]
    )


# --- lineage ------------------------------------------------------------------------------

# Reports a run cannot be audited without.
ANCHORS = [("data_quality", "orchestrator"), ("data_integrity", "orchestrator")]
# Where a report may name the clean table.
CLEAN_TABLE_PATHS = ["$.checks.persistence.cleaned_parquet_path", "$.refs.outputs.cleaned_path"]


def lineage_audit(
    parsed: DataFrame,
    *,
    anchors: Sequence[tuple[str, str]] = tuple(ANCHORS),
    runs: DataFrame | None = None,
    existing_paths: DataFrame | None = None,
    clean_table_required: bool = False,
) -> DataFrame:
    """Breaks of lineage per run: (run_id, rule, subject).

    Anchors that are missing, reports whose own run id is another run's,
    several schema versions in one run, and clean tables that are not named or
    not found in ``existing_paths`` (a table with one ``path`` per row).
    """
    readable = parsed.filter(F.col("report").isNotNull())
    place = F.concat_ws(".", "stage", "name")
    version = F.col("report.schema_version")
    path = F.coalesce(*[F.get_json_object("payload", p) for p in CLEAN_TABLE_PATHS])
    known = F.col("report").isNotNull()

    # one row per run: which anchors are there, and the versions seen
    per_run = parsed.groupBy("run_id").agg(
        F.min(F.when(known, version)).alias("lo"),
        F.max(F.when(known, version)).alias("hi"),
        F.count_if(known & path.isNotNull()).alias("n_paths"),
        *[
            F.coalesce(F.bool_or(known & (F.col("stage") == s) & (F.col("name") == n)), F.lit(False)).alias(f"a{i}")
            for i, (s, n) in enumerate(anchors)
        ],
    )
    if runs is not None:
        per_run = runs.select("run_id").distinct().join(per_run, "run_id", "left")

    def broken(rule: str, subject: Column, when: Column) -> Column:
        return F.when(when, F.struct(F.lit(rule).alias("rule"), subject.alias("subject")))

    def absent(i: int) -> Column:
        return ~F.coalesce(F.col(f"a{i}"), F.lit(False))

    rules = [broken("anchor_missing", F.lit(f"{s}.{n}"), absent(i)) for i, (s, n) in enumerate(anchors)]
    span = F.concat_ws("..", F.col("lo").cast("string"), F.col("hi").cast("string"))
    rules.append(broken("schema_version_mixed", span, F.col("lo") != F.col("hi")))
    if clean_table_required:
        rules.append(broken("clean_table_not_named", F.lit(""), F.coalesce("n_paths", F.lit(0)) == 0))
    out = [
        per_run.select("run_id", F.explode(F.array_compact(F.array(*rules))).alias("_b")).select("run_id", "_b.*"),
        readable.filter(F.coalesce(F.col("report.run_id"), F.lit("")) != F.col("run_id")).select(
            "run_id",
            F.lit("run_id_mismatch").alias("rule"),
            F.concat_ws("=", place, F.coalesce("report.run_id", F.lit(""))).alias("subject"),
        ),
    ]
    if existing_paths is not None:
        named = readable.select("run_id", path.alias("path")).filter(F.col("path").isNotNull()).distinct()
        lost = named.join(existing_paths.select("path"), "path", "left_anti")
        out.append(lost.select("run_id", F.lit("clean_table_not_found").alias("rule"), F.col("path").alias("subject")))
    found = union_all(out)
    return found


# --- release gate --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Policy:
    """What a run needs to be released."""

    required: Sequence[tuple[str, str]]
    steps: Sequence[Step] = ()
    required_status: Sequence[str] = ("pass", "warn")
    step_status: Sequence[str] = ("pass", "warn", "skipped")
    allow_warn: bool = True
    allow_skipped: bool = True
    block_on_fail: bool = True
    blocking_severities: Sequence[str] = ("hard",)

    def allowed(self, statuses: Sequence[str]) -> list[str]:
        drop = {s for s, ok in ((WARN, self.allow_warn), (SKIPPED, self.allow_skipped)) if not ok}
        return [s for s in statuses if s not in drop]


REASON = "struct<layer: int, reason: string, remediation: string>"


def _run_reasons(parsed: DataFrame, policy: Policy, runs: DataFrame | None) -> DataFrame:
    """One row per run with all reasons that follow from its statuses, as an array.

    The policy names a fixed list of reports, so their statuses become columns
    of one aggregate and no joins are needed.
    """
    status = F.when(F.col("report").isNotNull(), module_status())
    place = F.concat_ws(".", "stage", "name")
    state = parsed.select("run_id", place.alias("place"), status.alias("status"))
    required = [f"{s}.{n}" for s, n in policy.required]
    steps = [f"{s.stage}.{s.name}" for s in policy.steps if s.enabled and f"{s.stage}.{s.name}" not in required]
    asked = [*required, *steps]
    failed = F.when(F.col("status") == FAIL, F.col("place"))
    # should a place hold several reports, the worst status counts
    badness = F.array_position(F.array(*[F.lit(s) for s in (PASS, SKIPPED, WARN, FAIL)]), F.col("status"))

    def worst(place: str) -> Column:
        return F.max_by("status", F.when(F.col("place") == place, badness))

    per_run = state.groupBy("run_id").agg(
        *[worst(p).alias(f"s{i}") for i, p in enumerate(asked)],
        # a run files one report per place, so this set is as small as the set of steps
        F.collect_set(failed).alias("_failed"),
    )
    if runs is not None:
        per_run = runs.select("run_id").distinct().join(per_run, "run_id", "left")

    def reason(layer: int, kind: str, subject: Column, action: str, when: Column) -> Column:
        text = F.concat_ws(":", F.lit(kind), subject)
        return F.when(when, F.struct(F.lit(layer), text, F.lit(action)).cast(REASON))

    lines = []
    for i, p in enumerate(asked):
        s, must = F.col(f"s{i}"), p in required
        layer, name = (1, "report") if must else (2, "step")
        allowed = policy.allowed(policy.required_status if must else policy.step_status)
        lines.append(reason(layer, f"missing_{name}", F.lit(p), "run_step_and_file_report", s.isNull()))
        wrong = F.concat_ws(":", F.lit(p), s)
        lines.append(reason(layer, f"{name}_status", wrong, "fix_findings_and_rerun", ~s.isin(allowed)))
    none = F.array().cast(f"array<{REASON}>")
    reasons = F.array_compact(F.array(*lines)) if lines else none
    if policy.block_on_fail:
        failures = F.transform(
            F.coalesce("_failed", F.array().cast("array<string>")),
            lambda p: F.struct(F.lit(3), F.concat(F.lit("failed:"), p), F.lit("fix_findings_and_rerun")).cast(REASON),
        )
        reasons = F.concat(reasons, failures)
    return per_run.select("run_id", reasons.alias("reasons"))


def _hint_reasons(parsed: DataFrame, policy: Policy) -> DataFrame:
    """One row per run and distinct blocking hint."""
    hints = normalised(flat_hints(parsed.filter(F.col("report").isNotNull()), [], max_hints=None))
    blocking = hints.filter(F.col("severity_signal").isin(list(policy.blocking_severities)))
    return blocking.select(
        "run_id", F.concat_ws(":", F.lit("hint"), F.concat_ws(".", "stage", "source_module"), "code").alias("reason")
    ).distinct()


def release_reasons(parsed: DataFrame, policy: Policy, runs: DataFrame | None = None) -> DataFrame:
    """Every reason against a release, one row each: required reports, steps, failures, hints."""
    status = _run_reasons(parsed, policy, runs).select("run_id", F.explode("reasons").alias("_r"))
    out = [status.select("run_id", "_r.*")]
    if policy.blocking_severities:
        hints = _hint_reasons(parsed, policy)
        out.append(
            hints.select("run_id", F.lit(3).alias("layer"), "reason", F.lit("resolve_hint").alias("remediation"))
        )
    return union_all(out)


def release_gate(
    parsed: DataFrame, policy: Policy, runs: DataFrame | None = None, *, max_reasons: int | None = None
) -> DataFrame:
    """One row per run: may it be released, and if not, why.

    All reasons are counted and listed, or the first ``max_reasons`` of each run.
    """
    per_run = _run_reasons(parsed, policy, runs)
    texts = F.array().cast("array<string>")
    if policy.blocking_severities:
        hints = _hint_reasons(parsed, policy)
        counts = hints.groupBy("run_id").agg(F.count("*").alias("n_hints"))
        listed = (
            (hints if max_reasons is None else examples(hints, "run_id", ["reason"], max_reasons))
            .groupBy("run_id")
            .agg(F.collect_list("reason").alias("hints"))
        )
        per_run = per_run.join(counts, "run_id", "left").join(listed, "run_id", "left")
    else:
        per_run = per_run.withColumns({"n_hints": F.lit(0), "hints": texts})
    n_hints = F.coalesce("n_hints", F.lit(0))
    n = (F.size("reasons") + n_hints).cast("long")
    actions = F.transform("reasons", lambda r: r["remediation"])
    actions = F.concat(actions, F.when(n_hints > 0, F.array(F.lit("resolve_hint"))).otherwise(texts))
    all_reasons = F.concat(F.transform("reasons", lambda r: r["reason"]), F.coalesce("hints", texts))
    return per_run.select(
        "run_id",
        (n == 0).alias("releasable"),
        n.alias("n_reasons"),
        F.array_sort(all_reasons if max_reasons is None else F.slice(all_reasons, 1, max_reasons)).alias("reasons"),
        F.array_sort(F.array_distinct(actions)).alias("remediation"),
    )
