"""Registered queries over files: each writes files from the given tables to the shared folder and reads them back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.catalog.inputs import table
from tablewarden.catalog.registry import Register
from tablewarden.operators import governance, reports
from tablewarden.session import shared_folder
from tablewarden.sources.reports import read_report_files, write_report_files
from tablewarden.sources.tables import read_csv

register = Register()
query = register.query


# --- CSV --------------------------------------------------------------------------------------------

CSV_SCAN = """with o as (select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey,
      o_orderstatus, o_orderpriority || ' "x", ' || o_orderstatus as note from orders)
    select o_orderkey, o_custkey, note, null::varchar as bad from o where o_orderstatus = 'F'
    union all select o_orderkey, null, note, null from o where o_orderstatus = 'O'
    union all select null, null, null, o_orderkey || ',' || o_custkey || ',surplus' from o where o_orderstatus not in ('F', 'O')"""


@query("csv_scan", CSV_SCAN)
def csv_scan(spark, sf):
    """One folder of files under three headers: columns in another order, one missing, and rows with a cell too many."""
    text = [F.col(c).cast("string").alias(c) for c in ("o_orderkey", "o_custkey")]
    note = F.concat("o_orderpriority", F.lit(' "x", '), "o_orderstatus").alias("note")
    rows = table(spark, sf, "orders").select("o_orderstatus", *text, note)
    folder, status = shared_folder(spark, "csv"), F.col("o_orderstatus")

    def add(part: DataFrame, separator: str = ",") -> None:
        part.write.mode("append").option("header", True).option("escape", '"').option("sep", separator).csv(folder)

    add(rows.where(status == "F").select("note", "o_custkey", "o_orderkey"))
    add(rows.where(status == "O").select("o_orderkey", "note"))
    # as one cell between tabs, so that the commas stand without quotes
    wide = F.concat_ws(",", "o_orderkey", "o_custkey", F.lit("surplus")).alias("o_orderkey,o_custkey")
    add(rows.where(~status.isin("F", "O")).select(wide), "\t")
    # of a row of the wrong width only the row itself is taken
    cells = {c: F.when(F.col("bad").isNull(), F.col(c)) for c in ("o_orderkey", "o_custkey", "note")}
    return read_csv(spark, folder, bad_rows="bad").withColumns(cells).select("o_orderkey", "o_custkey", "note", "bad")


# --- report files -----------------------------------------------------------------------------------

MODULES = [("data_quality", "contract"), ("data_integrity", "row_identity"), ("governance", "manifest")]


def month_reports(spark, sf) -> DataFrame:
    """Three reports on the orders of each month; in March, June and September one is cut short, a list, or empty."""
    month = table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyyMM").alias("run_id"))
    facts = month.agg(
        F.count("*").alias("n"), (F.count("*") - F.count_distinct("o_custkey")).alias("again"),
        F.count_if(F.col("o_totalprice") > 450000).alias("dear"),
    )
    module = F.array(*[F.struct(F.lit(s).alias("stage"), F.lit(m).alias("name")) for s, m in MODULES])
    each = facts.select("*", F.explode(module).alias("m")).select("run_id", "n", "again", "dear", "m.*")
    found = F.when(F.col("name") == "contract", F.when(F.col("dear") > 0, "dear_orders"))
    found = found.when(F.col("name") == "row_identity", F.when(F.col("again") > 0, "entity_repeats"))
    warned = F.coalesce(F.concat(F.lit('"'), found, F.lit('"')), F.lit(""))
    status = F.when(warned == "", "pass").otherwise("warn")
    text = F.concat(
        F.lit('{"schema_version":1,"run_id":"'), "run_id", F.lit('","status":"'), status,
        F.lit('","summary":{"total_rows":'), "n", F.lit(',"total_cols":6,"overall_status":"'), status,
        F.lit('","issues":[],"warnings":['), warned, F.lit("]}}"),
    )
    on = lambda month, name: F.col("run_id").endswith(month) & (F.col("name") == name)
    planted = (
        F.when(on("03", "contract"), F.expr("left(payload, length(payload) - 5)"))
        .when(on("06", "row_identity"), F.concat(F.lit("["), F.col("payload"), F.lit("]")))
        .when(on("09", "manifest"), "")
        .otherwise(F.col("payload"))
    )
    return each.select("run_id", "stage", "name", text.alias("payload")).withColumn("payload", planted)


def report_folder(spark, sf) -> str:
    folder = shared_folder(spark, "report-files")
    write_report_files(month_reports(spark, sf), folder)
    return folder


MONTHS = """f as (select strftime(o_orderdate, '%Y%m') as run_id, count(*) as n, count(*) - count(distinct o_custkey) as again,
      count(*) filter (o_totalprice > 450000) as dear from orders group by 1),
  m0 as (select f.*, s.stage, s.name, case when name = 'contract' and dear > 0 then 'dear_orders' when name = 'row_identity' and again > 0
      then 'entity_repeats' end as warned from f, (values ('data_quality', 'contract'), ('data_integrity', 'row_identity'), ('governance', 'manifest')) s(stage, name)),
  m1 as (select *, if(warned is null, 'pass', 'warn') as st, right(run_id, 2) as mm from m0),
  m2 as (select *, '{"schema_version":1,"run_id":"' || run_id || '","status":"' || st || '","summary":{"total_rows":' || n
      || ',"total_cols":6,"overall_status":"' || st || '","issues":[],"warnings":[' || coalesce('"' || warned || '"', '') || ']}}' as good from m1),
  m as (select *, stage || '_' || name || '_' || run_id || '.json' as file,
      not (mm = '03' and name = 'contract' or mm = '06' and name = 'row_identity' or mm = '09' and name = 'manifest') as ok,
      case when mm = '03' and name = 'contract' then left(good, length(good) - 5) when mm = '06' and name = 'row_identity' then '[' || good || ']'
           when mm = '09' and name = 'manifest' then '' else good end || chr(10) as payload from m2)"""


@query(
    "reports_files",
    f"""with {MONTHS} select stage, name, run_id, ok as is_report, case when ok then st end as status, case when ok then n end as total_rows,
    cast(if(ok and warned is not null, 1, 0) as integer) as n_warnings from m""",
)
def reports_files(spark, sf):
    """Report files read back; the broken, the list and the empty one are rows without a report."""
    read = read_report_files(spark, report_folder(spark, sf))
    return read.select(
        "stage", "name", "run_id", F.col("report").isNotNull().alias("is_report"), F.col("report.status").alias("status"),
        reports.total_rows().alias("total_rows"), F.size(reports.warnings()).alias("n_warnings"),
    )


WANTED = "199503"  # its contract is cut short


@query(
    "reports_upstream_files",
    f"""with {MONTHS}, best as (select * from m qualify row_number() over (partition by stage, name order by ok desc, run_id = '{WANTED}' desc, run_id desc) = 1)
    select run_id, stage, name, st as status, coalesce(warned, '') as warnings, file as source, '{WANTED}' as requested_run,
    run_id <> '{WANTED}' as fell_back, ok as readable from best""",
)
def reports_upstream_files(spark, sf):
    """Upstream blocks of one run, or of the newest readable one, with the file each came from."""
    read = read_report_files(spark, report_folder(spark, sf))
    chosen = reports.requested_or_latest(read, WANTED)
    blocks = reports.upstream_blocks(chosen, requested=WANTED)
    return blocks.select(
        "run_id", "stage", "name", "status", F.array_join("warnings", "|").alias("warnings"),
        F.regexp_extract("source_path", "/file=([^/]+)/", 1).alias("source"),
        *[F.col("load_meta")[c].alias(c) for c in ("requested_run", "fell_back", "readable")],
    )


@query(
    "manifest",
    f"""with {MONTHS} select file, cast(length(payload) as bigint) as length, sha256(payload) as sha256,
    row_number() over (order by file) as file_no, row_number() over (order by file) <= 30 as in_preview from m""",
)
def manifest(spark, sf):
    found = governance.manifest(spark, report_folder(spark, sf))
    return found.select("file", "length", "sha256", "file_no", "in_preview")


@query(
    "manifest_run",
    f"""with {MONTHS} select file, sha256(payload) as sha256, row_number() over (order by file) as file_no from m where run_id = '{WANTED}'""",
)
def manifest_run(spark, sf):
    found = governance.manifest(spark, report_folder(spark, sf), run_id=WANTED)
    return found.select("file", "sha256", "file_no")


@query(
    "inventory",
    f"""with {MONTHS} select file, cast(length(payload) as bigint) as size_bytes, stage || '_' || name as step_hint,
    row_number() over (order by file) as file_no, cast(ceil(row_number() over (order by file) / 50) as integer) as page from m""",
)
def inventory(spark, sf):
    found = governance.inventory(spark, report_folder(spark, sf), page_size=50, by="name")
    return found.select("file", "size_bytes", "step_hint", "file_no", "page")


QUERIES, ORACLE = register.queries, register.sql
