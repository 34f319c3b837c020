"""Registered queries: reports, hints and release decisions.

The reports come from auditing the orders of every day as one batch.  Faults
are planted by weekday, so that every rule of the audit has runs that break it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.catalog.inputs import table
from tablewarden.catalog.registry import Register
from tablewarden.operators import governance, reports
from tablewarden.operators.hints import dedup_hints, flat_hints, invalid_hints

from tablewarden.plans.batch_audit import STEPS, BatchRules, batch_reports
from tablewarden.session import shared_folder
from tablewarden.sources.reports import FILED, read_reports, write_reports

register = Register()
query = register.query

RULES = BatchRules("label", "F", "o_orderkey", "o_custkey", "o_totalprice", extreme_amount=495_000)
UPSTREAM = [(s.stage, s.name) for s in STEPS]


def daily_reports(spark, sf) -> DataFrame:
    """Reports of all daily batches of the orders, without faults."""
    orders = table(spark, sf, "orders").withColumn(
        "label", F.when(F.col("o_totalprice") >= 20000, F.col("o_orderstatus"))
    )
    return batch_reports(orders, F.date_format("o_orderdate", "yyyyMMdd"), RULES)


def faulty_reports(spark, sf) -> DataFrame:
    """The daily reports with one kind of fault per weekday."""
    day = F.dayofweek(F.to_date("run_id", "yyyyMMdd"))  # 1 = Sunday
    text = F.col("payload")

    def on(weekday: int, name: str) -> Column:
        return (day == weekday) & (F.col("name") == name)

    def swap(old: str, new: str) -> Column:
        return F.regexp_replace("payload", old, new)

    report = F.from_json(text, reports.REPORT_DDL)
    hints = reports.hints_of("payload")
    older = F.to_json(
        F.struct(
            F.concat(F.upper(report["status"]), F.lit(" ")).alias("validation_status"),
            report["summary"]["issues"].alias("fatal_issues"),
            report["summary"]["warnings"].alias("warnings"),
            F.array(report["summary"]["total_rows"].cast("long"), F.lit(7)).alias("shape_before"),
        )
    )
    twice = F.to_json(
        F.struct(
            F.lit(1).alias("schema_version"),
            F.col("run_id"),
            report["status"].alias("status"),
            F.struct(F.struct(F.concat(hints, hints).alias("hints")).alias("event_hints")).alias("checks"),
        )
    )
    planted = (
        F.when(on(1, "contract"), swap('"run_id":"', '"run_id":"other-'))
        .when(on(2, "config_snapshot"), swap('"schema_version":1,', '"schema_version":2,'))
        .when(on(3, "readiness"), swap(r'"status":"(\w+)","inputs"', '"status":" $1 ","inputs"'))
        .when(on(4, "row_identity"), twice)
        .when(on(5, "contract"), F.expr("left(payload, length(payload) - 5)"))
        .when(on(6, "contract"), F.concat(F.lit("["), text, F.lit("]")))
        .when(on(6, "row_identity"), swap('"severity_signal":"risk"', '"severity_signal":"SEVERE"'))
        .when(on(7, "readiness"), older)
        .otherwise(text)
    )
    kept = daily_reports(spark, sf).filter(~on(2, "manifest"))
    return kept.select("run_id", "stage", "name", planted.alias("payload"))


def filed_reports(spark, sf) -> DataFrame:
    """The faulty reports as the audits meet them: written to the reports table and read back."""
    folder = shared_folder(spark, "reports")
    write_reports(faulty_reports(spark, sf), folder)
    return read_reports(spark, folder)


# The same reports in SQL.  ``dow`` is 0 on Sunday; weekday faults as above.
REPORTS = """o as (select strftime(o_orderdate, '%Y%m%d') as run_id, dayofweek(o_orderdate) as dow,
      case when o_totalprice >= 20000 then o_orderstatus end as label, * from orders),
  f as (select run_id, any_value(dow) as dow, count(*) as n, count(label) as k, count(*) filter (label = 'F') as p,
      count(*) - count(distinct o_custkey) as rep, count(*) filter (o_totalprice > 495000) as ext from o group by run_id),
  ready as (select *, [x for x in [if(n < 5, 'too_few_rows', null), if(1 - k / n > 0.3, 'label_missing', null)] if x is not null] as ri,
      [x for x in [if(coalesce(p / nullif(k, 0) between 0.05 and 0.95, false), null, 'class_imbalance')] if x is not null] as rw,
      [x for x in [if(rep > 0, 'entity_repeats', null)] if x is not null] as iw,
      [x for x in [if(rep > 0, {'code': 'row_identity_entity_repeats', 'sev': 'risk', 'path': 'checks.entities', 'shown': rep}, null),
                   if(ext > 0, {'code': 'extreme_amount', 'sev': 'hard', 'path': 'checks.amounts', 'shown': ext}, null)] if x is not null] as h
    from f),
  e as (select cast([] as varchar[]) as none),
  good as (
    select 1 as ord, run_id, dow, n, 'setup' as stage, 'config_snapshot' as name, none as issues, none as warnings, h[1:0] as hints from ready, e
    union all select 2, run_id, dow, n, 'data_quality', 'contract', none, none, h[1:0] from ready, e
    union all select 3, run_id, dow, n, 'data_quality', 'readiness', ri, rw, h[1:0] from ready, e where n >= 2
    union all select 4, run_id, dow, n, 'data_quality', 'orchestrator', if(n < 2, none, ri), if(n < 2, ['missing_module_report'], rw), h[1:0] from ready, e
    union all select 5, run_id, dow, n, 'data_integrity', 'row_identity', none, iw, h from ready, e
    union all select 6, run_id, dow, n, 'data_integrity', 'orchestrator', none, iw, h[1:0] from ready, e
    union all select 7, run_id, dow, n, 'governance', 'manifest', none, none, h[1:0] from ready, e),
  st as (select *, case when len(issues) > 0 then 'fail' when len(warnings) > 0 then 'warn' else 'pass' end as status from good),
  rep as (select ord, run_id, dow, stage, name, hints,
      not (name = 'contract' and dow in (4, 5)) as ok,
      name = 'readiness' and dow = 6 as older, name = 'row_identity' and dow = 3 as twice,
      n, issues, warnings, status as st,
      if(name = 'contract' and dow = 0, 'other-' || run_id, run_id) as inner_run,
      if(name = 'config_snapshot' and dow = 1, 2, 1) as version
    from st where not (name = 'manifest' and dow = 1)),
  r as (select *,
      case when not ok then null when older then null when name = 'readiness' and dow = 2 then ' ' || st || ' ' else st end as top_status,
      case when not ok then 'missing' else st end as overall,
      case when not ok then 'fail' when older then 'fail' else st end as module_status,
      if(not ok or twice, [], issues) as iss, if(not ok or twice, [], warnings) as war,
      case when twice then hints || hints else hints end as hh
    from rep)"""


@query(
    "reports_scan",
    f"""with {REPORTS} select stage, name, run_id, ok as is_report, case when ok and not older then inner_run end as inner_run_id,
    case when ok and not older then version end as schema_version, top_status as status,
    cast(if(ok, len(hh), 0) as integer) as n_hints from r""",
)
def reports_scan(spark, sf):
    r = F.col("report")
    return reports.parse(faulty_reports(spark, sf)).select(
        "stage", "name", "run_id", r.isNotNull().alias("is_report"), r["run_id"].alias("inner_run_id"),
        r["schema_version"].cast("int").alias("schema_version"), r["status"].alias("status"),
        F.coalesce(F.size(F.when(r.isNotNull(), reports.hints_of())), F.lit(0)).alias("n_hints"),
    )


@query(
    "reports_refiled",
    f"""with {REPORTS} select stage, count(*) as n_stored, count(distinct run_id) as n_runs,
    count(*) filter (ok and name <> 'readiness') as n_readable from r group by stage""",
)
def reports_refiled(spark, sf):
    """All reports filed, then those named readiness once more, as lists: these replace the first ones."""
    filed = faulty_reports(spark, sf).select("stage", "name", "run_id", "payload")
    folder = shared_folder(spark, "reports")
    write_reports(filed, folder)
    write_reports(filed.where("name = 'readiness'").withColumn("payload", F.lit("[]")), folder)
    stored = reports.parse(spark.read.schema(FILED).parquet(folder))
    return stored.groupBy("stage").agg(
        F.count("*").alias("n_stored"),
        F.count_distinct("run_id").alias("n_runs"),
        F.count_if(F.col("report").isNotNull()).alias("n_readable"),
    )


TOP = reports.REQUIRED_KEYS
OLDER_PROBLEMS = "|".join(
    [f"missing:{k}" for k in TOP]
    + [f"missing:module.{k}" for k in reports.MODULE_KEYS]
    + [f"missing:summary.{k}" for k in reports.SUMMARY_KEYS]
    + ["type:schema_version", "type:run_id", "type:timestamp_utc"]
    + [f"type:module.{k}" for k in reports.MODULE_KEYS]
    + [f"type:summary.{k}" for k in reports.SUMMARY_KEYS if k != "overall_status"]
    + [f"type:{k}" for k in ("inputs", "thresholds_used", "used_config", "refs", "checks")]
)
TWICE_PROBLEMS = "|".join(
    p
    for p in OLDER_PROBLEMS.split("|")
    if p
    not in (
        "missing:schema_version", "missing:run_id", "missing:status", "missing:checks",
        "type:schema_version", "type:run_id", "type:checks",
    )
)


@query(
    "reports_validate",
    f"""with {REPORTS} select stage, name, run_id, case when not ok then 'not_an_object' when older then '{OLDER_PROBLEMS}'
    when twice then '{TWICE_PROBLEMS}' when name = 'readiness' and dow = 2 then 'domain:status|not_mirrored' else '' end as problems from r""",
)
def reports_validate(spark, sf):
    parsed = reports.parse(faulty_reports(spark, sf))
    return parsed.select("stage", "name", "run_id", F.array_join(reports.violations(), "|").alias("problems"))


@query(
    "reports_status",
    f"with {REPORTS} select stage, name, run_id, overall as overall_status, module_status from r",
)
def reports_status(spark, sf):
    return reports.parse(faulty_reports(spark, sf)).select(
        "stage", "name", "run_id", reports.overall_status().alias("overall_status"),
        reports.module_status().alias("module_status"),
    )


@query(
    "reports_shape",
    f"""with {REPORTS} select stage, name, run_id, case when ok and not twice then n end as total_rows,
    case when ok and not twice then 7::bigint end as total_cols, cast(len(iss) as integer) as n_issues,
    cast(len(war) as integer) as n_warnings from r""",
)
def reports_shape(spark, sf):
    return reports.parse(faulty_reports(spark, sf)).select(
        "stage", "name", "run_id", reports.total_rows().alias("total_rows"), reports.total_cols().alias("total_cols"),
        F.size(reports.issues()).alias("n_issues"), F.size(reports.warnings()).alias("n_warnings"),
    )


@query(
    "reports_upstream",
    f"""with {REPORTS} select run_id, stage, name, overall as status, cast(len(iss) as integer) as n_issues, cast(len(war) as integer) as n_warnings,
    array_to_string(iss, '|') as issues, array_to_string(war, '|') as warnings from r""",
)
def reports_upstream(spark, sf):
    blocks = reports.upstream_blocks(reports.parse(faulty_reports(spark, sf)))
    return blocks.drop("key_metrics", "source_path", "load_meta").withColumns({c: F.array_join(c, "|") for c in ("issues", "warnings")})


@query(
    "reports_merge_lists",
    f"""with {REPORTS} select run_id, stage, name, array_to_string(list_concat(list_concat(iss, [x for x in war if not list_contains(iss, x)]), ['seen']), '|') as merged from r""",
)
def reports_merge_lists(spark, sf):
    parsed = reports.parse(faulty_reports(spark, sf))
    padded = F.transform(reports.issues(), lambda x: F.concat(F.lit(" "), x, F.lit(" ")))
    extra = F.concat(reports.issues(), F.array(F.lit("")), reports.warnings(), F.array(F.lit("seen"), F.lit(" seen")))
    return parsed.select(
        "run_id", "stage", "name", F.array_join(reports.merge_lists(padded, extra), "|").alias("merged")
    )


@query(
    "reports_sorted_issues",
    f"""with {REPORTS} select run_id, stage, name, array_to_string(list_sort(list_distinct(list_concat(war, iss))), '|') as found from r""",
)
def reports_sorted_issues(spark, sf):
    parsed = reports.parse(faulty_reports(spark, sf))
    both = F.concat(reports.warnings(), reports.issues(), reports.warnings())
    return parsed.select("run_id", "stage", "name", F.array_join(reports.sorted_unique(both), "|").alias("found"))


@query(
    "reports_missing_impl",
    f"""with {REPORTS} select run_id, stage, name, len(war) > 0 as any_warning from r where list_contains(war, 'missing_module_report')""",
)
def reports_missing_impl(spark, sf):
    parsed = reports.parse(faulty_reports(spark, sf)).filter(reports.has_missing_module_report())
    return parsed.select("run_id", "stage", "name", reports.non_empty(reports.warnings()).alias("any_warning"))


@query(
    "reports_latest",
    f"""with {REPORTS} select stage, name, run_id, ok as is_report from r
    qualify row_number() over (partition by stage, name order by ok desc, run_id desc) = 1""",
)
def reports_latest(spark, sf):
    latest = reports.latest_reports(faulty_reports(spark, sf))
    return reports.parse(latest).select("stage", "name", "run_id", F.col("report").isNotNull().alias("is_report"))


WANTED = "19950102"  # a Monday, whose manifest is missing


@query(
    "reports_fallback",
    f"""with {REPORTS} select stage, name, run_id, run_id <> '{WANTED}' as fell_back from r
    qualify row_number() over (partition by stage, name order by ok desc, run_id = '{WANTED}' desc, run_id desc) = 1""",
)
def reports_fallback(spark, sf):
    chosen = reports.requested_or_latest(faulty_reports(spark, sf), WANTED)
    return chosen.select("stage", "name", "run_id", "fell_back")


@query(
    "reports_preferred_name",
    f"""with {REPORTS} select run_id, stage, name, if(name = 'readiness', 'current', 'older') as mode from r
    where stage = 'data_quality' and name in ('readiness', 'contract', 'orchestrator')
    qualify row_number() over (partition by run_id order by ok desc, list_position(['readiness', 'contract', 'orchestrator'], name)) = 1""",
)
def reports_preferred_name(spark, sf):
    rows = faulty_reports(spark, sf).filter(F.col("stage") == "data_quality")
    chosen = reports.preferred_name(rows, "readiness", ["contract", "orchestrator"])
    return chosen.select("run_id", "stage", "name", "mode")


MISSING = """gone as (select f.run_id, s.stage, s.name from f, (values ('setup', 'config_snapshot'), ('data_quality', 'contract'),
    ('data_quality', 'readiness'), ('data_quality', 'orchestrator'), ('data_integrity', 'row_identity'), ('data_integrity', 'orchestrator'),
    ('governance', 'manifest')) s(stage, name) anti join r on r.run_id = f.run_id and r.stage = s.stage and r.name = s.name)"""


@query(
    "reports_missing_steps",
    f"with {REPORTS}, {MISSING} select run_id, stage, name, 'fail' as status, 'missing_step_implementation' as issues, '' as problems from gone",
)
def reports_missing_steps(spark, sf):
    parsed = reports.parse(reports.missing_step_reports(faulty_reports(spark, sf), STEPS))
    return parsed.select(
        "run_id", "stage", "name", reports.module_status().alias("status"),
        F.array_join(reports.issues(), "|").alias("issues"), F.array_join(reports.violations(), "|").alias("problems"),
    )


@query(
    "gate_decision",
    f"""with {REPORTS}, g as (select *, if(name in ('contract', 'readiness', 'row_identity'), 'hard', 'soft') as gate from r)
    select run_id, stage, name, module_status as status, gate, module_status = 'fail' as is_fail, gate = 'hard' and module_status = 'fail' as halt from g""",
)
def gate_decision(spark, sf):
    return reports.gate_decisions(reports.parse(faulty_reports(spark, sf)), STEPS, strict=True)


# --- hints ----------------------------------------------------------------------------------------

HINTS = """h0 as (select run_id, stage, name as source_module, cast(5 as integer) as upstream_no,
      unnest(hh) as h, generate_subscripts(hh, 1) - 1 as pos, dow from r where ok),
  h as (select run_id, stage, source_module, upstream_no, cast(pos as integer) as pos, h.code as code,
      if(dow = 5 and h.sev = 'risk', 'SEVERE', h.sev) as severity_signal, h.path as evidence_path, cast(h.shown as varchar) as shown from h0)"""


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumn("shown", F.col("context")["n"]).drop("context", "remediation")


@query(
    "hints_flat",
    f"""with {REPORTS}, {HINTS} select *, cast(row_number() over (partition by run_id order by pos) as integer) as hint_no from h
    qualify row_number() over (partition by run_id order by pos) <= 3""",
)
def hints_flat(spark, sf):
    return _flat(flat_hints(faulty_reports(spark, sf), UPSTREAM, max_hints=3))


@query(
    "hints_dedup",
    f"""with {REPORTS}, {HINTS} select * from h
    qualify row_number() over (partition by run_id, code, evidence_path, stage, source_module order by pos) = 1""",
)
def hints_dedup(spark, sf):
    return _flat(dedup_hints(flat_hints(faulty_reports(spark, sf), UPSTREAM, max_hints=None)))


@query(
    "hints_invalid",
    f"""with {REPORTS}, {HINTS} select run_id, source_module, pos, code, lower(severity_signal) as severity_signal, 'bad_severity' as problems from h where severity_signal = 'SEVERE'""",
)
def hints_invalid(spark, sf):
    bad = invalid_hints(flat_hints(faulty_reports(spark, sf), UPSTREAM, max_hints=None))
    return bad.select(
        "run_id", "source_module", "pos", "code", "severity_signal", F.array_join("problems", "|").alias("problems")
    )


# --- governance -------------------------------------------------------------------------------------

ORDER_COLUMNS = "o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority,priority"


@query(
    "fingerprint",
    f"""select count(*) as n_rows, 7 as n_cols, sha256('{ORDER_COLUMNS}') as columns_hash,
    'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate' as first_columns,
    'o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string,priority:string' as dtypes,
    'o_orderkey=0.0,o_custkey=0.0,o_orderstatus=0.0,o_totalprice=0.0,o_orderdate=0.0,o_orderpriority=0.0,priority='
      || cast(round(count(*) filter (o_orderpriority = '4-NOT SPECIFIED') / count(*), 6) as varchar) as null_rates from orders""",
)
def fingerprint(spark, sf):
    df = table(spark, sf, "orders").withColumn(
        "priority", F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority"))
    )
    return governance.fingerprint(df, null_rates=True)


ANCHORS = [*governance.ANCHORS, ("data_quality", "contract"), ("governance", "manifest")]


@query(
    "lineage_audit",
    f"""with {REPORTS} select run_id, 'anchor_missing' as rule, 'governance.manifest' as subject from f where dow = 1
    union all select run_id, 'anchor_missing', 'data_quality.contract' from f where dow in (4, 5)
    union all select run_id, 'run_id_mismatch', stage || '.' || name || '=' || inner_run from r where ok and inner_run <> run_id
    union all select run_id, 'run_id_mismatch', 'data_quality.readiness=' from r where older
    union all select run_id, 'schema_version_mixed', '1..2' from f where dow = 1
    union all select run_id, 'clean_table_not_found', 'clean/' || run_id from f where n < 3""",
)
def lineage_audit(spark, sf):
    all_reports = filed_reports(spark, sf)
    sizes = table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyyMMdd").alias("run_id")).count()
    written = sizes.filter(F.col("count") >= 3).select(F.concat(F.lit("clean/"), "run_id").alias("path"))
    return governance.lineage_audit(all_reports, anchors=ANCHORS, existing_paths=written)


POLICY = governance.Policy(
    required=[
        ("setup", "config_snapshot"),
        ("data_quality", "orchestrator"),
        ("data_integrity", "orchestrator"),
        ("governance", "manifest"),
    ],
    steps=STEPS,
)

REASONS = """gate as (
    select run_id, 'missing_report:governance.manifest' as reason, 'run_step_and_file_report' as rem from f where dow = 1
    union all select run_id, 'report_status:' || stage || '.' || name || ':' || module_status, 'fix_findings_and_rerun' from r
      where ok and name in ('config_snapshot', 'orchestrator', 'manifest') and module_status not in ('pass', 'warn')
    union all select run_id, 'missing_step:data_quality.readiness', 'run_step_and_file_report' from f where n < 2
    union all select run_id, 'missing_step:data_quality.contract', 'run_step_and_file_report' from f where dow in (4, 5)
    union all select run_id, 'step_status:' || stage || '.' || name || ':' || module_status, 'fix_findings_and_rerun' from r
      where ok and name in ('contract', 'readiness', 'row_identity') and module_status not in ('pass', 'warn', 'skipped')
    union all select run_id, 'failed:' || stage || '.' || name, 'fix_findings_and_rerun' from r where ok and module_status = 'fail'
    union all select run_id, 'hint:data_integrity.row_identity:extreme_amount', 'resolve_hint' from f where ext > 0)"""


@query("release_reasons", f"with {REPORTS}, {REASONS} select run_id, reason, rem as remediation from gate")
def release_reasons(spark, sf):
    found = governance.release_reasons(filed_reports(spark, sf), POLICY)
    return found.select("run_id", "reason", "remediation")


@query(
    "release_gate",
    f"""with {REPORTS}, {REASONS}, c as (select run_id, count(*) as n, list_sort(list(reason)) as reasons, list_sort(list_distinct(list(rem))) as rem from gate group by run_id)
    select f.run_id, c.n is null as releasable, coalesce(c.n, 0) as n_reasons, coalesce(array_to_string(reasons, '|'), '') as reasons,
    coalesce(array_to_string(rem, '|'), '') as remediation from f left join c using (run_id)""",
)
def release_gate(spark, sf):
    decided = governance.release_gate(filed_reports(spark, sf), POLICY)
    return decided.withColumns({c: F.array_join(c, "|") for c in ("reasons", "remediation")})


QUERIES, ORACLE = register.queries, register.sql
