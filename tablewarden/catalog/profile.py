"""Registered queries: segment rates, profiles and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.catalog.inputs import (
    MESSY_ORDERS,
    ORDER_SEGMENTS,
    lines_with_gaps,
    messy_orders,
    order_segments,
    sql_norm,
    table,
)
from tablewarden.catalog.registry import Register
from tablewarden.functions.binning import bin_right_closed
from tablewarden.functions.numbers import binary_label
from tablewarden.operators import profile, segments
from tablewarden.operators.order_stats import exact_quantiles
from tablewarden.plans.quality import quality_findings, severity_summary

register = Register()
query = register.query

# --- segments ---------------------------------------------------------------------------------

SEGMENT_LEVELS = f"""with {ORDER_SEGMENTS}, y as (
    select {sql_norm('label')} as y, {sql_norm('priority')} as priority, {sql_norm('c_mktsegment')} as c_mktsegment from seg),
  v as (select * from y where y <> '<MISSING>'),
  lv as (
    select 'priority' as segment_col, priority as segment, count(*) as n, count(*) filter (y = 'F') as pos from v group by priority
    union all
    select 'c_mktsegment', c_mktsegment, count(*), count(*) filter (y = 'F') from v group by c_mktsegment)"""

SEGMENTS = {"label": "label", "positive": "F", "segments": ["priority", "c_mktsegment"]}


@query(
    "rate_by_segment",
    SEGMENT_LEVELS
    + """ select segment_col, segment, n, round(n / (select count(*) from v), 6) as share,
    round(pos / n, 6) as positive_rate, n / (select count(*) from v) < 0.03 as small_segment from lv""",
)
def rate_by_segment(spark, sf):
    return segments.rate_by_segment(order_segments(spark, sf), **SEGMENTS, min_share=0.03)


@query(
    "segment_meta",
    SEGMENT_LEVELS
    + """ select s.segment_col, s.segment_col <> 'absent' as column_exists,
    (select count(*) from y) as n_rows_total, (select count(*) from v) as n_rows_used,
    (select count(*) from y where y = '<MISSING>') as n_labels_missing,
    (select count(*) from lv where lv.segment_col = s.segment_col) as n_levels
    from (values ('priority'), ('c_mktsegment'), ('absent')) s(segment_col)""",
)
def segment_meta(spark, sf):
    return segments.segment_meta(
        order_segments(spark, sf), label="label", positive="F", segments=["priority", "c_mktsegment", "absent"]
    )


@query(
    "rate_spread",
    SEGMENT_LEVELS
    + """ select segment_col as "column", count(*) as n_levels, round(max(pos / n) - min(pos / n), 6) as spread
    from lv where n / (select count(*) from v) >= 0.01 group by segment_col""",
)
def rate_spread(spark, sf):
    return segments.rate_spread(
        order_segments(spark, sf), label="label", positive="F", columns=["priority", "c_mktsegment"]
    )


DOC_LEVELS = """with d as (select lang, source, cast(quality as varchar) as y from documents join labels using (doc_id)),
  lv as (select 'lang' as segment_col, lang as segment, count(*) as n, count(*) filter (y = '1') as pos from d group by lang
    union all select 'source', source, count(*), count(*) filter (y = '1') from d group by source)"""


@query(
    "rate_by_document_segment",
    DOC_LEVELS
    + """ select segment_col, segment, n, round(n / (select count(*) from d), 6) as share,
    round(pos / n, 6) as positive_rate, n / (select count(*) from d) < 0.01 as small_segment from lv""",
)
def rate_by_document_segment(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    labelled = docs.join(table(spark, sf, "labels"), "doc_id")
    return segments.rate_by_segment(labelled, label="quality", positive="1", segments=["lang", "source"])


@query(
    "rate_by_bin",
    f"""with {MESSY_ORDERS}, q as (select quantile_cont(o_totalprice, 0.33) as q1, quantile_cont(o_totalprice, 0.66) as q2 from messy),
    d as (select label, case when o_totalprice <= q1 then 'low' when o_totalprice <= q2 then 'mid' else 'high' end as price_bin from messy, q where label is not null)
    select 'price_bin' as segment_col, price_bin as segment, count(*) as n, round(count(*) / (select count(*) from d), 6) as share,
    round(count(*) filter (label = 'F') / count(*), 6) as positive_rate, count(*) / (select count(*) from d) < 0.01 as small_segment
    from d group by price_bin""",
)
def rate_by_bin(spark, sf):
    df = messy_orders(spark, sf)
    edges = exact_quantiles(df, ["o_totalprice"], [0.0, 0.33, 0.66, 1.0], direct_limit=1000)["o_totalprice"]
    bins = bin_right_closed(F.col("o_totalprice"), edges, ["low", "mid", "high"])
    return segments.rate_by_segment(
        df.withColumn("price_bin", bins), label="label", positive="F", segments=["price_bin"]
    )


@query(
    "group_mean",
    f"""with {MESSY_ORDERS} select priority as level, count(*) as n, round(avg(o_totalprice), 6) as mean_value
    from messy where priority is not null group by priority""",
)
def group_mean(spark, sf):
    return segments.group_mean(messy_orders(spark, sf), "priority", "o_totalprice")


@query(
    "histogram",
    """with s as (select min(l_extendedprice) as lo, (max(l_extendedprice) - min(l_extendedprice)) / 30 as w from lineitem),
    c as (select cast(least(floor((l_extendedprice - lo) / w), 29) as integer) as bin, count(*) as n from lineitem, s group by 1)
    select cast(b as integer) as bin, round(lo + b * w, 6) as bin_left, round(lo + (b + 1) * w, 6) as bin_right, coalesce(n, 0) as n
    from range(30) r(b) cross join s left join c on c.bin = b""",
)
def histogram(spark, sf):
    return segments.histogram(table(spark, sf, "lineitem"), "l_extendedprice")


@query(
    "top_pairs",
    f"""with {MESSY_ORDERS} select cast(o_orderkey as varchar) as label, cast(price_text as double) as value from messy
    where trim(price_text) not in ('', '12d') order by 2 desc, 1 limit 10""",
)
def top_pairs(spark, sf):
    return segments.top_pairs(messy_orders(spark, sf), "o_orderkey", "price_text", top=10)


@query(
    "examples_topk",
    """select o_orderpriority, o_orderkey, o_totalprice, cast(rn as integer) as example_no from (
      select *, row_number() over (partition by o_orderpriority order by o_totalprice desc, o_orderkey) as rn from orders)
    where rn <= 10""",
)
def examples_topk(spark, sf):
    df = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return segments.examples(df, "o_orderpriority", [F.desc("o_totalprice"), "o_orderkey"], 10)


# --- contract and health ------------------------------------------------------------------------

CONTRACT = profile.Contract(
    required=["o_orderkey", "o_custkey", "label", "priority", "price_text", "discount_code"],
    numeric=["o_orderkey", "o_totalprice", "price_text", "priority"],
    categorical=["label"],
    primary_key=["o_orderkey"],
)


@query(
    "contract_dtypes",
    f"""with {MESSY_ORDERS}, n as (select {sql_norm('price_text')} as price_text, {sql_norm('priority')} as priority from messy)
    select c as "column", known as n_known, bad as n_unreadable, case when bad > 0 then 'warn' else 'pass' end as status from (
      select 'o_orderkey' as c, count(*) as known, 0 as bad from n
      union all select 'o_totalprice', count(*), 0 from n
      union all select 'price_text', count(*) filter (price_text <> '<MISSING>'), count(*) filter (price_text = '12d') from n
      union all select 'priority', count(*) filter (priority <> '<MISSING>'), count(*) filter (priority <> '<MISSING>') from n)""",
)
def contract_dtypes(spark, sf):
    return profile.contract_dtypes(messy_orders(spark, sf), CONTRACT)


def _null_key_lines(spark, sf):
    """Line items whose line number is missing for the largest quantity."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey", F.when(F.col("l_quantity") < 50, F.col("l_linenumber")).alias("l_linenumber")
    )


@query(
    "contract_pk",
    """with k as (select l_orderkey, case when l_quantity < 50 then l_linenumber end as ln from lineitem),
    g as (select l_orderkey, ln, count(*) as n from k where ln is not null group by all)
    select (select count(*) from k) as n_rows, (select count(*) from k where ln is null) as n_null_keys,
    count(*) filter (n > 1) as n_duplicate_keys, cast(sum(n) filter (n > 1) as bigint) as n_rows_in_duplicates,
    'fail' as status from g""",
)
def contract_pk(spark, sf):
    return profile.contract_key(_null_key_lines(spark, sf), ["l_orderkey", "l_linenumber"])


HEALTH_COLUMNS = ["o_orderkey", "o_custkey", "label", "priority", "price_text"]
HEALTH_LEVELS = " union all ".join(
    f"select '{c}' as \"column\", cast({c} as varchar) as value, count(*) as n from messy group by {c}"
    for c in HEALTH_COLUMNS
)


@query(
    "health_columns",
    f"""with {MESSY_ORDERS}, lv as ({HEALTH_LEVELS}),
    s as (select "column", sum(n) as n_rows, coalesce(sum(n) filter (value is null), 0) as n_missing,
      count(*) filter (value is not null) as n_unique from lv group by "column")
    select "column", cast(n_rows as bigint) as n_rows, cast(n_missing as bigint) as n_missing,
      round(n_missing / n_rows, 6) as missing_rate, n_unique, round(n_unique / n_rows, 6) as unique_ratio,
      concat_ws(',', case when n_missing = n_rows then 'all_missing' end, case when n_missing / n_rows > 0.02 then 'high_missing' end,
        case when n_unique / n_rows > 0.5 then 'high_cardinality' end, case when n_unique = 1 then 'constant' end) as tags
    from s""",
)
def health_columns(spark, sf):
    return profile.health_columns(messy_orders(spark, sf), HEALTH_COLUMNS, high_missing=0.02)


NUMERIC = ["l_quantity", "l_extendedprice", "discount", "tax"]


@query(
    "health_numeric",
    "with lines as (select l_quantity, l_extendedprice, case when l_quantity > 5 then l_discount end as discount,"
    " case when l_returnflag <> 'R' then l_tax end as tax from lineitem) "
    + " union all ".join(
        f"select '{c}' as \"column\", count({c}) as n, min({c}) as min_value, max({c}) as max_value, round(avg({c}), 4) as mean_value,"
        f" round(stddev_samp({c}), 4) as std_value, median({c}) as median_value from lines"
        for c in NUMERIC
    ),
)
def health_numeric(spark, sf):
    return profile.health_numeric(lines_with_gaps(spark, sf), NUMERIC)


def _top_sql(columns: list[str], k: int) -> str:
    lv = " union all ".join(
        f"select '{c}' as \"column\", cast({c} as varchar) as value, count(*) as n from messy group by {c}" for c in columns
    )
    return f"""with {MESSY_ORDERS}, lv as ({lv}),
      r as (select *, row_number() over (partition by "column" order by n desc, value) as rk from lv where value is not null)
      select "column", cast(rk as integer) as level_rank, value, n, round(n / (select count(*) from messy), 6) as share
      from r where rk <= {k}"""


@query("health_topk", _top_sql(["o_custkey", "label", "priority"], 3))
def health_topk(spark, sf):
    return profile.top_levels(messy_orders(spark, sf), ["o_custkey", "label", "priority"], 3)


@query("categorical_topk", _top_sql(["label", "priority"], 10))
def categorical_topk(spark, sf):
    return profile.top_levels(messy_orders(spark, sf), ["label", "priority"], 10)


@query(
    "numeric_sanity",
    " union all ".join(
        f"select '{c}' as \"column\", count(*) as n, count(*) filter ({c} is null) as n_missing, count(*) filter ({c} < 0) as n_negative,"
        f" count(*) filter ({c} = 0) as n_zero, min({c}) as min_value, max({c}) as max_value from customer"
        for c in ("c_acctbal", "c_nationkey")
    ).replace("min(c_nationkey)", "cast(min(c_nationkey) as double)").replace("max(c_nationkey)", "cast(max(c_nationkey) as double)"),
)
def numeric_sanity(spark, sf):
    return profile.numeric_sanity(table(spark, sf, "customer"), ["c_acctbal", "c_nationkey"])


# --- rules --------------------------------------------------------------------------------------

RULES = [
    profile.in_range("l_quantity", 1, 45),
    profile.not_negative("l_tax"),
    profile.one_of("l_returnflag", ["A", "N"]),
    profile.zero_with_positive("l_discount", "l_tax"),
    profile.less_than_part("l_extendedprice", "l_suppkey"),
]
RULE_SQL = {
    ("l_quantity_in_range", "l_quantity"): "l_quantity < 1 or l_quantity > 45",
    ("l_tax_not_negative", "l_tax"): "l_tax < 0",
    ("l_returnflag_one_of", "l_returnflag"): "l_returnflag not in ('A', 'N')",
    ("l_discount_zero_with_positive_l_tax", "l_discount"): "l_discount = 0 and l_tax > 0",
    ("l_extendedprice_less_than_l_suppkey", "l_extendedprice"): "l_extendedprice < l_suppkey",
}


@query(
    "semantic_rules",
    'select *, case when n_violations > 0 then \'warn\' else \'pass\' end as status from ('
    + " union all ".join(
        f"select '{r}' as rule, '{c}' as \"column\", count(*) as n_rows, count(*) filter ({p}) as n_violations from lineitem"
        for (r, c), p in RULE_SQL.items()
    )
    + ")",
)
def semantic_rules(spark, sf):
    return profile.check_rules(table(spark, sf, "lineitem"), RULES)


@query(
    "semantic_examples",
    "select * exclude (rn), cast(rn as integer) as example_no from (select *, row_number() over (partition by rule order by l_orderkey, l_linenumber, l_partkey, found) as rn from ("
    + " union all ".join(
        f"select l_orderkey, l_linenumber, l_partkey, '{r}' as rule, cast({c} as varchar) as found from lineitem where {p}"
        for (r, c), p in RULE_SQL.items()
    )
    + ")) where rn <= 5",
)
def semantic_examples(spark, sf):
    return profile.rule_examples(
        table(spark, sf, "lineitem"), RULES, ["l_orderkey", "l_linenumber", "l_partkey"], 5
    )


# --- readiness, balance, label relations --------------------------------------------------------


@query(
    "readiness",
    f"""with {MESSY_ORDERS}, s as (select count(*) as n, count(label) as k, count(*) filter (label = 'F') as p from messy)
    select 'n_rows' as metric, cast(n as double) as value, case when n >= 1000 then 'pass' else 'fail' end as status from s
    union all select 'label_missing_share', round(1 - k / n, 6), case when 1 - k / n <= 0.3 then 'pass' else 'fail' end from s
    union all select 'positive_share', round(p / k, 6), case when p / k between 0.05 and 0.95 then 'pass' else 'fail' end from s""",
)
def readiness(spark, sf):
    return profile.readiness(messy_orders(spark, sf), label="label", positive="F")


@query(
    "readiness_small",
    """select 'n_rows' as metric, cast(count(*) as double) as value, case when count(*) >= 1000 then 'pass' else 'fail' end as status from supplier
    union all select 'label_missing_share', 0.0::double, 'pass'
    union all select 'positive_share', round(count(*) filter (s_nationkey = 3) / count(*), 6),
      case when count(*) filter (s_nationkey = 3) / count(*) between 0.05 and 0.95 then 'pass' else 'fail' end from supplier""",
)
def readiness_small(spark, sf):
    return profile.readiness(table(spark, sf, "supplier"), label="s_nationkey", positive="3")


@query(
    "label_balance",
    """select cast(quality as varchar) as class, count(*) as n, round(count(*) / (select count(*) from labels), 6) as share,
    count(*) / (select count(*) from labels) > 0.8 as dominant from labels group by quality""",
)
def label_balance(spark, sf):
    return profile.label_balance(table(spark, sf, "labels"), "quality")


CORR = ["l_quantity", "l_extendedprice", "discount", "tax", "constant"]


@query(
    "label_corr",
    "with lines as (select *, case when l_quantity > 5 then l_discount end as discount, case when l_returnflag <> 'R' then l_tax end as tax,"
    " 1.0::double as constant, case when l_quantity > 25 then 1.0 else 0.0 end::double as y from lineitem), r as ("
    + " union all ".join(
        f"select '{c}' as \"column\", count({c}) as n_pairs, corr({c}, y) as r from lines" for c in CORR
    )
    + ') select "column", n_pairs, case when isnan(r) then null else round(r, 6) end as correlation,'
    " coalesce(not isnan(r) and abs(r) >= 0.8, false) as flagged from r",
)
def label_corr(spark, sf):
    df = lines_with_gaps(spark, sf).withColumn("constant", F.lit(1.0))
    return profile.label_correlation(df, CORR, (F.col("l_quantity") > 25).cast("int"), threshold=0.8)


def _cohen_sql() -> str:
    parts = " union all ".join(
        f"""select '{c}' as "column", count({c}) filter (y) as na, count({c}) filter (not y) as nb, avg({c}) filter (y) as ma,
        avg({c}) filter (not y) as mb, var_samp({c}) filter (y) as va, var_samp({c}) filter (not y) as vb from lines"""
        for c in NUMERIC
    )
    return f"""with lines as (select *, case when l_quantity > 5 then l_discount end as discount,
      case when l_returnflag <> 'R' then l_tax end as tax, l_linestatus = 'F' as y from lineitem), s as ({parts})
      select "column", na as n_positive, nb as n_negative,
      round((ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2)), 6) as effect from s"""


@query("cohens_d", _cohen_sql())
def cohens_d(spark, sf):
    df = lines_with_gaps(spark, sf)
    return profile.cohens_d(df, NUMERIC, binary_label(df, "l_linestatus", "F"))


def _findings(spark, sf):
    return quality_findings(
        messy_orders(spark, sf),
        contract=CONTRACT,
        label="label",
        positive="F",
        rules=[profile.in_range("o_totalprice", 2000, None), profile.one_of("label", ["F", "O"])],
        segments=["priority"],
        high_missing=0.02,
    )


QUALITY_FACTS = f"""with {MESSY_ORDERS}, p as (
    select *, {sql_norm('priority')} as np, {sql_norm('label')} as nl, {sql_norm('price_text')} as nt from messy),
  a as (select count(*) as n, count(*) filter (np <> '<MISSING>') as known_p, count(*) filter (nt = '12d') as bad_t,
    count(*) filter (priority is null) as m_p, count(*) filter (label is null) as m_l, count(*) filter (nl <> '<MISSING>') as k,
    count(*) filter (nl = 'F') as pos, count(*) filter (o_totalprice < 2000) as low, count(*) filter (nl not in ('F', 'O', '<MISSING>')) as odd,
    count(distinct o_orderkey) as u_k, count(distinct o_custkey) as u_c, count(distinct label) as u_l, count(distinct priority) as u_p,
    count(distinct price_text) as u_t, count(distinct o_totalprice) as u_x from p),
  seg as (select np, count(*) as n from p where nl <> '<MISSING>' group by np),
  cls as (select nl, count(*) as n from p where nl <> '<MISSING>' group by nl),
  f(source, code, subject, value, severity, status) as (
    select 'contract', 'missing_column', 'discount_code', 1.0, 'hard', 'fail'
    union all select 'contract', 'dtype_issues_detected', 'price_text', bad_t, 'risk', if(bad_t > 0, 'warn', 'pass') from a
    union all select 'contract', 'dtype_issues_detected', 'priority', known_p, 'risk', if(known_p > 0, 'warn', 'pass') from a
    union all select 'contract', 'dtype_issues_detected', s, 0, 'risk', 'pass' from (values ('o_orderkey'), ('o_totalprice')) v(s)
    union all select 'contract', 'primary_key_broken', 'o_orderkey', 0, 'hard', 'pass'
    union all select 'health', 'high_missing', s, round(m / n, 6), 'fixable', if(m / n > 0.02, 'warn', 'pass')
      from a, lateral (values ('o_orderkey', 0), ('o_custkey', 0), ('label', m_l), ('priority', m_p), ('price_text', 0), ('o_totalprice', 0)) v(s, m)
    union all select 'health', 'high_cardinality', s, round(u / n, 6), 'info', if(u / n > 0.5, 'warn', 'pass')
      from a, lateral (values ('o_orderkey', u_k), ('o_custkey', u_c), ('label', u_l), ('priority', u_p), ('price_text', u_t), ('o_totalprice', u_x)) v(s, u)
    union all select 'semantic', 'rule_broken', 'o_totalprice_in_range', low, 'risk', if(low > 0, 'warn', 'pass') from a
    union all select 'semantic', 'rule_broken', 'label_one_of', odd, 'risk', if(odd > 0, 'warn', 'pass') from a
    union all select 'readiness', 'n_rows', 'label', n, 'hard', if(n >= 1000, 'pass', 'fail') from a
    union all select 'readiness', 'label_missing_share', 'label', round(1 - k / n, 6), 'hard', if(1 - k / n <= 0.3, 'pass', 'fail') from a
    union all select 'readiness', 'positive_share', 'label', round(pos / k, 6), 'hard', if(pos / k between 0.05 and 0.95, 'pass', 'fail') from a
    union all select 'domain', 'small_segments', 'priority', (select count(*) from seg, a where seg.n / a.k < 0.01), 'info',
      if((select count(*) from seg, a where seg.n / a.k < 0.01) > 0, 'warn', 'pass')
    union all select 'distribution', 'dominant_class', 'label', round((select max(n) from cls) / k, 6), 'risk',
      if((select max(n) from cls) / k > 0.8, 'warn', 'pass') from a)"""


@query(
    "quality_findings",
    QUALITY_FACTS + " select source, code, subject, cast(value as double) as value, severity, status from f",
)
def findings(spark, sf):
    return _findings(spark, sf)


@query(
    "quality_summary",
    QUALITY_FACTS
    + """ select case severity when 'hard' then 'blockers' when 'risk' then 'critical_warnings' else 'suggestions' end as category,
    count(*) as n_findings, array_to_string((list_sort(list(source || ':' || code || ':' || subject)))[1:20], ' | ') as examples
    from f where status in ('warn', 'fail') group by 1""",
)
def quality_summary(spark, sf):
    return severity_summary(_findings(spark, sf))


QUERIES, ORACLE = register.queries, register.sql
