"""Registered queries: keys, time, label alignment and leakage."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.catalog.inputs import LINES_WITH_GAPS, lines_with_gaps, table
from tablewarden.catalog.registry import Register
from tablewarden.functions.numbers import binary_label
from tablewarden.operators import integrity, leakage
from tablewarden.plans.integrity import SOURCES, findings_as_hints, findings_summary, integrity_findings

register = Register()
query = register.query


def labelled_events(spark, sf):
    """Events with a label, a copy of it, a planted product and a scrambled arrival order."""
    return table(spark, sf, "events").select(
        "event_id",
        "user_id",
        F.when(F.col("value") >= 0.1, F.col("ts")).alias("ts"),
        F.when(F.col("event_type") == "purchase", "yes").otherwise("no").alias("bought"),
        F.when(F.col("event_type") == "purchase", " yes").otherwise("no ").alias("outcome_text"),
        "value",
        (F.col("value") * 2).alias("double_value"),
        F.lit(2.0).alias("two"),
        "props",
        (F.round(F.col("value") * 100).cast("long") * 1_000_000_000_000 + F.col("event_id")).alias("arrival"),
    )


EVENTS = """ev as (select event_id, user_id, case when value >= 0.1 then ts end as ts,
    case when event_type = 'purchase' then 'yes' else 'no' end as bought,
    case when event_type = 'purchase' then ' yes' else 'no ' end as outcome_text,
    value, value * 2 as double_value, 2.0::double as two, props,
    cast(round(value * 100) as bigint) * 1000000000000 + event_id as arrival from events)"""


@query(
    "pk_duplicates",
    "select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1",
)
def pk_duplicates(spark, sf):
    return integrity.key_duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "pk_duplicate_examples",
    """select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1
    order by n desc, l_orderkey, l_linenumber limit 20""",
)
def pk_duplicate_examples(spark, sf):
    return integrity.key_duplicate_examples(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "label_conflicts",
    """select l_orderkey, l_linenumber, min(l_returnflag) as label_min, max(l_returnflag) as label_max, count(*) as n
    from lineitem group by l_orderkey, l_linenumber having min(l_returnflag) <> max(l_returnflag)""",
)
def label_conflicts(spark, sf):
    return integrity.label_conflicts(
        table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_returnflag"
    )


EARLIEST, LATEST = "2024-01-02 00:00:00", "2024-01-05 00:00:00"
BOUNDS_SQL = f"""with {EVENTS} select count(*) as n_rows, count(*) filter (ts is null) as n_missing,
    count(*) filter (ts < timestamp '{EARLIEST}') as n_too_early, count(*) filter (ts > timestamp '{LATEST}') as n_too_late,
    case when count(*) filter (ts is null or ts < timestamp '{EARLIEST}' or ts > timestamp '{LATEST}') > 0 then 'fail' else 'pass' end as status
    from ev"""


@query("temporal_bounds", BOUNDS_SQL)
def temporal_bounds(spark, sf):
    return integrity.time_bounds(labelled_events(spark, sf), "ts", earliest=EARLIEST, latest=LATEST)


@query("temporal_bounds_text", BOUNDS_SQL)
def temporal_bounds_text(spark, sf):
    """The same check on times that arrive as text, some of them unreadable."""
    df = labelled_events(spark, sf)
    text = F.coalesce(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("not a time"))
    return integrity.time_bounds(df.withColumn("ts", text), "ts", earliest=EARLIEST, latest=LATEST)


@query(
    "temporal_duplicates",
    """select user_id, date_trunc('hour', ts) as snapshot_time, count(*) as n from events group by all having count(*) > 1""",
)
def temporal_duplicates(spark, sf):
    df = table(spark, sf, "events").select("user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))
    return integrity.duplicate_snapshots(df, ["user_id"], "hour")


ORDER_SQL = f"""with {EVENTS}, s as (select user_id, arrival as order_value, ts as event_time,
      lag(ts) over (partition by user_id order by arrival) as previous_time from ev where ts is not null)
    select * from s where event_time < previous_time"""


@query("temporal_out_of_order", ORDER_SQL)
def temporal_out_of_order(spark, sf):
    return integrity.out_of_order(labelled_events(spark, sf), ["user_id"], "ts", "arrival")


@query("temporal_out_of_order_pieces", ORDER_SQL)
def temporal_out_of_order_pieces(spark, sf):
    """The same rows when every sequence is cut into pieces, as on a large table."""
    return integrity.out_of_order(labelled_events(spark, sf), ["user_id"], "ts", "arrival", rows_per_piece=500)


@query(
    "temporal_in_order",
    """with s as (select user_id, event_id as order_value, ts as event_time,
      lag(ts) over (partition by user_id order by event_id) as previous_time from events)
    select * from s where event_time < previous_time""",
)
def temporal_in_order(spark, sf):
    return integrity.out_of_order(table(spark, sf, "events"), ["user_id"], "ts", "event_id")


@query(
    "label_degenerate",
    f"""with {EVENTS} select count(*) as n_labelled, count(*) filter (bought = 'yes') as n_positive,
    round(count(*) filter (bought = 'yes') / count(*), 6) as positive_share,
    case when count(*) filter (bought = 'yes') / count(*) between 0.01 and 0.99 then 'pass' else 'fail' end as status from ev""",
)
def label_degenerate(spark, sf):
    return integrity.label_degenerate(labelled_events(spark, sf), "bought", "yes")


@query(
    "label_alias",
    f"""with {EVENTS}, s as (select * from ev),
    p as (select 'outcome_text' as "column", trim(outcome_text) as v, bought from s union all select 'props', props, bought from s)
    select "column", count(*) as n_pairs, count(*) filter (v = bought) as n_equal,
    count(*) >= 50 and count(*) = count(*) filter (v = bought) as is_alias,
    case when count(*) >= 50 and count(*) = count(*) filter (v = bought) then 'warn' else 'pass' end as status
    from p group by "column" """,
)
def label_alias(spark, sf):
    return integrity.label_aliases(labelled_events(spark, sf), "bought", ["outcome_text", "props"])


FEATURES = ["value", "double_value", "two", "outcome_text", "user_id", "props", "event_id"]
PROXIES = [leakage.ProxyRule("double_value", ["value", "two"])]


def _catalogue_sql() -> str:
    numeric = {"value", "double_value", "two", "user_id", "event_id"}
    parts = []
    for c in FEATURES:
        r = f"(select corr({c}, if(bought = 'yes', 1, 0)) from ev)" if c in numeric else "null"
        parts.append(
            f"""select '{c}' as feature, sum(n) as n_known, count(*) as n_unique, count(*) filter (lo = hi) as n_single, {r} as r
            from (select {c} as v, count(*) as n, min(bought) as lo, max(bought) as hi from ev where {c} is not null group by {c})"""
        )
    return f"""cat0 as ({' union all '.join(parts)}),
    cat1 as (select feature, n_known, n_unique, n_unique / n_known as ratio, case when isnan(r) then null else r end as r,
      feature = 'outcome_text' or coalesce(not isnan(r) and abs(r) >= 0.98, false) as near,
      n_unique = n_single and n_unique / n_known < 0.9 and n_unique > 1 as det,
      feature = 'double_value' and (select count(*) >= 200 from ev where value <> 0) as proxy,
      feature in ('user_id', 'event_id') as idl from cat0),
    cat as (select feature, cast(n_known as bigint) as n_known, n_unique, round(ratio, 6) as unique_ratio, round(r, 6) as correlation,
      concat_ws(',', if(near, 'near_label', null), if(det, 'deterministic_wrt_label', null), if(proxy, 'derived_proxy', null),
        if(idl, 'id_like_name', null), if(ratio >= 0.9, 'high_cardinality', null)) as tags,
      case when near or det then 'high' when proxy or idl then 'medium' else 'low' end as risk from cat1)"""


@query("leakage_catalogue", f"with {EVENTS}, {_catalogue_sql()} select * from cat")
def leakage_catalogue(spark, sf):
    df = labelled_events(spark, sf)
    return leakage.leakage_catalogue(
        df, label="bought", y=binary_label(df, "bought", "yes"), features=FEATURES, proxy_rules=PROXIES
    )


@query(
    "derived_proxy",
    f"""with {LINES_WITH_GAPS}, j as (select l.*, p_retailprice from lines l join part on l_partkey = p_partkey),
    s as (
      select 'net_price' as target, 'net_price~l_extendedprice*keep_rate' as rule, count(*) filter (l_extendedprice * keep_rate <> 0) as n,
        count(*) filter (net_price / (l_extendedprice * keep_rate) between 0.8 and 1.2) as b from j
      union all
      select 'l_extendedprice', 'l_extendedprice~l_quantity*p_retailprice', count(*),
        count(*) filter (l_extendedprice / (l_quantity * p_retailprice) between 0.8 and 1.2) from j)
    select target, rule, n as n_usable, b as n_in_band, round(b / n, 6) as in_band_share, n >= 200 and b / n >= 0.9 as flagged,
      if(n >= 200 and b / n >= 0.9, 'warn', 'pass') as status from s""",
)
def derived_proxy(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    lines = lines_with_gaps(spark, sf)
    df = lines.join(parts, lines.l_partkey == parts.p_partkey)
    return leakage.derived_proxies(
        df,
        [
            leakage.ProxyRule("net_price", ["l_extendedprice", "keep_rate"]),
            leakage.ProxyRule("l_extendedprice", ["l_quantity", "p_retailprice"]),
        ],
    )


@query(
    "proxy_scan",
    f"""with {EVENTS}, r as (select 'double_value' as target, 'double_value~value*two' as rule, corr(double_value, value * two) as r from ev
      union all select 'value', 'value~user_id', corr(value, user_id) from ev)
    select target, rule, round(r, 6) as correlation, abs(r) >= 0.7 as flagged,
      if(abs(r) >= 0.7, 'check_multicollinearity,drop_or_regularize,keep_but_constrain', '') as actions from r""",
)
def proxy_scan(spark, sf):
    rules = [*PROXIES, leakage.ProxyRule("value", ["user_id"])]
    return leakage.proxy_correlations(labelled_events(spark, sf), rules)


@query(
    "proxy_examples",
    """select l_orderkey, l_linenumber, l_partkey, round(l_extendedprice / (l_quantity * l_suppkey), 6) as ratio from lineitem
    where l_suppkey <> 0 and round(l_extendedprice / (l_quantity * l_suppkey), 6) between 0.8 and 1.2 order by 1, 2, 3, 4 limit 10""",
)
def proxy_examples(spark, sf):
    rule = leakage.ProxyRule("l_extendedprice", ["l_quantity", "l_suppkey"])
    return leakage.proxy_examples(
        table(spark, sf, "lineitem"), rule, ["l_orderkey", "l_linenumber", "l_partkey"]
    )


def _integrity_findings(spark, sf):
    return integrity_findings(
        labelled_events(spark, sf),
        keys=["event_id"],
        label="bought",
        positive="yes",
        features=FEATURES,
        entity=["user_id"],
        time_column="ts",
        order_column="arrival",
        earliest=EARLIEST,
        latest=LATEST,
        proxy_rules=PROXIES,
    )


INTEGRITY_FACTS = f"""with {EVENTS}, {_catalogue_sql()},
  b as (select count(*) as n, count(*) filter (ts is null) as m, count(*) filter (ts < timestamp '{EARLIEST}') as e,
    count(*) filter (ts > timestamp '{LATEST}') as l, count(*) filter (bought = 'yes') as p from ev),
  s as (select user_id, ts, lag(ts) over (partition by user_id order by arrival) as prev from ev where ts is not null),
  o as (select count(*) as n from s where ts < prev),
  d as (select count(*) as n from (select user_id, ts from ev where ts is not null group by all having count(*) > 1)),
  smp as (select * from ev),
  al as (select 'outcome_text' as f, count(*) as eq from smp union all select x, 0 from (values ('value'), ('double_value'), ('two'), ('user_id'), ('props'), ('event_id')) v(x)),
  f(source, code, subject, value, severity, bad) as (
    select 'row_identity', 'duplicate_keys', 'event_id', 0, 'hard', false
    union all select 'row_identity', 'label_conflicts', 'event_id', 0, 'hard', false
    union all select 'temporal', 'n_missing', 'ts', m, 'hard', m > 0 from b
    union all select 'temporal', 'n_too_early', 'ts', e, 'hard', e > 0 from b
    union all select 'temporal', 'n_too_late', 'ts', l, 'hard', l > 0 from b
    union all select 'temporal', 'duplicate_snapshots', 'user_id', n, 'risk', n > 0 from d
    union all select 'temporal', 'out_of_order', 'user_id', n, 'risk', n > 0 from o
    union all select 'label_alignment', 'degenerate_label', 'bought', round(p / n, 6), 'hard', not (p / n between 0.01 and 0.99) from b
    union all select 'label_alignment', 'label_alias', f, eq, 'risk', eq >= 50 from al
    union all select 'leakage_scan', 'leakage_risk', feature, case risk when 'high' then 2 when 'medium' then 1 else 0 end, 'risk', risk = 'high' from cat),
  g as (select source, code, subject, value, severity, case when not bad then 'pass' when severity = 'hard' then 'fail' else 'warn' end as status from f)"""


@query(
    "integrity_findings",
    INTEGRITY_FACTS + " select source, code, subject, cast(value as double) as value, severity, status from g",
)
def findings(spark, sf):
    return _integrity_findings(spark, sf)


@query(
    "integrity_hints",
    INTEGRITY_FACTS
    + """ select 'run-1' as run_id, source as module, source || '_' || code as code, severity as severity_signal,
    'checks.' || code || '.' || subject as evidence_path, 'review_' || code as action from g where status <> 'pass'""",
)
def integrity_hints(spark, sf):
    hints = findings_as_hints(_integrity_findings(spark, sf), "run-1")
    return hints.withColumn("action", F.col("remediation")["action"]).drop("context", "remediation")


@query(
    "integrity_summary",
    INTEGRITY_FACTS
    + """, h as (select source, status from g union all select 'contract', 'fail')
    select coalesce(source, 'overall') as source, count(*) as n_checks, count(*) filter (status = 'warn') as n_warn,
    count(*) filter (status = 'fail') as n_fail, case when count(*) filter (status = 'fail') > 0 then 'fail'
      when count(*) filter (status = 'warn') > 0 then 'warn' else 'pass' end as status,
    count(*) filter (status = 'fail') = 0 as ready from h group by rollup (source)""",
)
def integrity_summary(spark, sf):
    return findings_summary(_integrity_findings(spark, sf), [*SOURCES, "contract"])


QUERIES, ORACLE = register.queries, register.sql
