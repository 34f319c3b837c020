"""Registered queries: scalar functions and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.catalog.inputs import (
    LINES_WITH_GAPS,
    MESSY_ORDERS,
    PARTS_WITH_GAPS,
    lines_with_gaps,
    messy_orders,
    parts_with_gaps,
    sql_norm,
    sql_strip,
    table,
)
from tablewarden.catalog.registry import Register
from tablewarden.functions.binning import bin_right_closed, merge_equal_edges
from tablewarden.functions.numbers import binary_label, parse_number, safe_float
from tablewarden.functions.text import norm_category, row_id
from tablewarden.operators import cleaning
from tablewarden.operators.order_stats import exact_quantiles
from tablewarden.session import shared_folder
from tablewarden.sources.tables import read_clean, write_clean

register = Register()
query = register.query


# --- scalar functions ----------------------------------------------------------------------


@query("norm_category", f"with {MESSY_ORDERS} select o_orderkey, {sql_norm('priority')} as category from messy")
def norm_category_(spark, sf):
    return messy_orders(spark, sf).select("o_orderkey", norm_category(F.col("priority")).alias("category"))


@query(
    "safe_numeric",
    f"""with {MESSY_ORDERS} select o_orderkey, price_text,
    case when regexp_full_match(trim(price_text), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)') then try_cast(price_text as double) end as price
    from messy"""
)
def safe_numeric(spark, sf):
    return messy_orders(spark, sf).select(
        "o_orderkey", "price_text", parse_number(F.col("price_text")).alias("price")
    )


@query(
    "label_encode",
    f"""with {MESSY_ORDERS} select o_orderkey, case when label = 'F' then 1 else 0 end as by_value,
    cast(trunc(coalesce(try_cast(nullif(price_text, '12d') as double), 0) / 1000) as bigint) as by_number
    from messy"""
)
def label_encode(spark, sf):
    df = messy_orders(spark, sf).withColumn("thousands", parse_number(F.col("price_text")) / 1000)
    return df.select(
        "o_orderkey",
        binary_label(df, "label", " F ").alias("by_value"),
        binary_label(df, "thousands", None).alias("by_number"),
    )


@query(
    "safe_float_round",
    """select l_orderkey, l_linenumber, l_partkey,
    case when l_discount = 0 then null else round(l_extendedprice / l_discount, 3) end as ratio
    from lineitem"""
)
def safe_float_round(spark, sf):
    df = table(spark, sf, "lineitem")
    inf = F.when(F.col("l_discount") == 0, F.lit(float("inf"))).otherwise(
        F.try_divide(F.col("l_extendedprice"), F.col("l_discount"))
    )
    return df.select("l_orderkey", "l_linenumber", "l_partkey", safe_float(inf).alias("ratio"))


# Bin edges and labels for durations in months.
DURATION_EDGES = [0, 6, 12, 24, 48, 1000]
DURATION_LABELS = ["0-6m", "6-12m", "12-24m", "24-48m", "48m+"]


@query(
    "bin_fixed",
    """select p_partkey, p_size, case when p_size < 0 then null when p_size <= 6 then '0-6m'
    when p_size <= 12 then '6-12m' when p_size <= 24 then '12-24m' when p_size <= 48 then '24-48m'
    when p_size <= 1000 then '48m+' end as size_bin from part"""
)
def bin_fixed(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        "p_size",
        bin_right_closed(F.col("p_size"), DURATION_EDGES, DURATION_LABELS).alias("size_bin"),
    )


@query(
    "bin_quantile",
    """with q as (select quantile_cont(p_retailprice, 0.33) as q1, quantile_cont(p_retailprice, 0.66) as q2 from part)
    select p_partkey, case when p_retailprice <= q1 then 'q1' when p_retailprice <= q2 then 'q2' else 'q3' end as price_bin
    from part, q"""
)
def bin_quantile(spark, sf):
    df = table(spark, sf, "part")
    edges = merge_equal_edges(exact_quantiles(df, ["p_retailprice"], [0.0, 0.33, 0.66, 1.0])["p_retailprice"])
    labels = [f"q{i + 1}" for i in range(len(edges) - 1)]
    return df.select("p_partkey", bin_right_closed(F.col("p_retailprice"), edges, labels).alias("price_bin"))


@query(
    "row_id",
    """select l_orderkey, l_linenumber,
    coalesce(cast(l_orderkey as varchar), '__MISSING__') || '||' ||
    coalesce(case when l_returnflag <> 'R' then l_returnflag end, '__MISSING__') as row_id from lineitem"""
)
def row_id_(spark, sf):
    df = table(spark, sf, "lineitem").withColumn(
        "flag", F.when(F.col("l_returnflag") != "R", F.col("l_returnflag"))
    )
    return df.select("l_orderkey", "l_linenumber", row_id(df, [" l_orderkey", "flag", "flag "]).alias("row_id"))


# --- cleaning steps -------------------------------------------------------------------------


@query("drop_missing_label", f"with {MESSY_ORDERS} select o_orderkey, label, priority from messy where label is not null")
def drop_missing_label(spark, sf):
    df = messy_orders(spark, sf).select("o_orderkey", "label", "priority")
    return cleaning.drop_missing_label(df, "label")


@query(
    "clean_strings",
    f"""with {MESSY_ORDERS} select o_orderkey, o_custkey, label, {sql_strip('priority')} as priority,
    trim(price_text) as price_text, o_totalprice from messy"""
)
def clean_strings(spark, sf):
    return cleaning.strip_strings(messy_orders(spark, sf))


PRICE_SQL = "case when trim(price_text) in ('', '12d') then null else cast(price_text as double) end"


@query(
    "clean_cast",
    f"""with {MESSY_ORDERS} select o_orderkey, {PRICE_SQL} as price_text,
    cast(trunc(o_totalprice) as bigint) as o_totalprice from messy"""
)
def clean_cast(spark, sf):
    df = messy_orders(spark, sf).select("o_orderkey", "price_text", "o_totalprice")
    # the int column is whole, the text column keeps its gaps and so stays double
    casts = {"price_text": cleaning.Cast("int", fill=None), "o_totalprice": cleaning.Cast("int", fill=None)}
    return cleaning.cast_numbers(df, casts)


def _filled(spark, sf, fill) -> DataFrame:
    df = lines_with_gaps(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "discount", "tax")
    out = cleaning.cast_numbers(df, {c: cleaning.Cast(fill=fill) for c in ("discount", "tax")})
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.round("discount", 6).alias("discount"), F.round("tax", 6).alias("tax"))


def _fill_sql(fill: str) -> str:
    return f"""with {LINES_WITH_GAPS}, f as (select {fill.format('discount')} as d, {fill.format('tax')} as t from lines)
    select l_orderkey, l_linenumber, l_partkey, round(coalesce(discount, d), 6) as discount,
    round(coalesce(tax, t), 6) as tax from lines, f"""


@query("clean_fill_median", _fill_sql("median({})"))
def clean_fill_median(spark, sf):
    return _filled(spark, sf, "median")


@query("clean_fill_mean", _fill_sql("avg({})"))
def clean_fill_mean(spark, sf):
    return _filled(spark, sf, "mean")


@query("clean_fill_const", _fill_sql("0.5 + 0 * min({})"))
def clean_fill_const(spark, sf):
    return _filled(spark, sf, "0.5")


@query(
    "clean_impute_product",
    f"""with {LINES_WITH_GAPS} select l_orderkey, l_linenumber, l_partkey,
    round(coalesce(case when l_returnflag <> 'N' then l_extendedprice end, l_quantity * keep_rate), 4) as total from lines"""
)
def clean_impute_product(spark, sf):
    df = lines_with_gaps(spark, sf).withColumn(
        "total", F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice"))
    )
    filled = cleaning.impute_product("total", ["l_quantity", "keep_rate"])(df)
    return filled.select("l_orderkey", "l_linenumber", "l_partkey", F.round("total", 4).alias("total"))


RARE_MIN = 80
RARE_COLUMNS = ["brand", "type", "name"]


def _rare_sql(column: str) -> str:
    return (
        f"case when count(*) over (partition by {column}) < {RARE_MIN} then 'Other' else {column} end as {column}"
    )


@query("clean_rare", f"with {PARTS_WITH_GAPS} select p_partkey, {', '.join(_rare_sql(c) for c in RARE_COLUMNS)} from parts")
def clean_rare(spark, sf):
    df = parts_with_gaps(spark, sf).select("p_partkey", *RARE_COLUMNS)
    return cleaning.bucket_rare(df, RARE_COLUMNS, min_freq=RARE_MIN)


def _rare_report_sql() -> str:
    levels = " union all ".join(
        f"select '{c}' as \"column\", {c} as value, count(*) as n from parts group by {c}" for c in RARE_COLUMNS
    )
    return f"""with {PARTS_WITH_GAPS}, levels as ({levels})
    select "column", cast(coalesce(sum(n) filter (n < {RARE_MIN}), 0) as bigint) as n_replaced,
    count(*) as n_levels_before,
    count(*) filter (n >= {RARE_MIN}) + case when count(*) filter (n < {RARE_MIN}) > 0 then 1 else 0 end as n_levels_after
    from levels group by "column" """


@query("clean_rare_report", _rare_report_sql())
def clean_rare_report(spark, sf):
    return cleaning.rare_report(parts_with_gaps(spark, sf), RARE_COLUMNS, min_freq=RARE_MIN)


MAPPING = {"1-URGENT": "2-HIGH", "2-HIGH": "3-MEDIUM", "4-NOT SPECIFIED": "5-LOW"}
MAPPING_SQL = (
    "case o_orderpriority when '1-URGENT' then '2-HIGH' when '2-HIGH' then '3-MEDIUM' "
    "when '4-NOT SPECIFIED' then '5-LOW' else o_orderpriority end"
)


@query("clean_map", f"select o_orderkey, o_orderstatus, {MAPPING_SQL} as o_orderpriority from orders")
def clean_map(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return cleaning.map_values(df, ["o_orderpriority", "o_orderstatus", "no_such_column"], MAPPING)


@query(
    "clean_map_report",
    """select 'o_orderpriority' as "column", count(*) filter (o_orderpriority in ('1-URGENT', '2-HIGH', '4-NOT SPECIFIED')) as n_affected from orders
    union all select 'o_orderstatus', count(*) filter (o_orderstatus in ('1-URGENT', '2-HIGH', '4-NOT SPECIFIED')) from orders"""
)
def clean_map_report(spark, sf):
    df = table(spark, sf, "orders")
    return cleaning.map_report(df, ["o_orderpriority", "o_orderstatus"], MAPPING)


# --- whole runs ---------------------------------------------------------------------------------

CLEANING = {
    "label_col": "label",
    "numeric_cast_columns": {"price_text": {"type": "float", "errors": "coerce"}},
    "rare_category": {"columns": ["priority"], "min_freq": 30, "other_label": "Other"},
    "value_mappings": {
        "priorities": {"columns": ["priority", "absent"], "mapping": {"5-LOW": "low", "4-NOT SPECIFIED": "low"}}
    },
}


def _halve_urgent(df: DataFrame) -> DataFrame:
    """A hook that uses the untyped text column."""
    return df.withColumn("urgent", F.coalesce(F.col("priority") == "1-URGENT", F.lit(False)))


def _broken_hook(df: DataFrame) -> DataFrame:
    return df.select("no_such_column")


def _run(spark, sf) -> cleaning.CleaningResult:
    return cleaning.run_cleaning(messy_orders(spark, sf), CLEANING, [_halve_urgent, _broken_hook])


CLEAN_SQL = f"""with {MESSY_ORDERS}, stripped as (
    select o_orderkey, o_custkey, label, {sql_strip('priority')} as priority, {PRICE_SQL} as price, o_totalprice
    from messy where label is not null),
  fill as (select median(price) as m from stripped),
  rare as (select *, count(*) over (partition by priority) as n from stripped)
  select o_orderkey, o_custkey, label,
    case when n < 30 then 'Other' when priority in ('5-LOW', '4-NOT SPECIFIED') then 'low' else priority end as priority,
    round(coalesce(price, m), 4) as price_text, o_totalprice,
    coalesce(priority = '1-URGENT', false) as urgent
  from rare, fill"""


@query("clean_run", CLEAN_SQL)
def clean_run(spark, sf):
    return _run(spark, sf).data.withColumn("price_text", F.round("price_text", 4))


@query(
    "clean_report",
    f"""with {MESSY_ORDERS}, stripped as (
      select label, {sql_strip('priority')} as priority, {PRICE_SQL} as price from messy),
    kept as (select * from stripped where label is not null),
    lv as (select priority, count(*) as n from kept group by priority),
    t as (select
      (select count(*) from stripped) as rows_before,
      (select count(*) from kept) as rows_after,
      (select count(*) from kept where price is null) as missing,
      (select median(price) from kept) as med,
      (select coalesce(sum(n), 0) from lv where n < 30) as n_rare,
      (select count(*) from lv) as lv_before,
      (select count(*) from lv where n >= 30) + (select case when count(*) > 0 then 1 else 0 end from lv where n < 30) as lv_after,
      (select coalesce(sum(n), 0) from lv where n >= 30 and priority in ('5-LOW', '4-NOT SPECIFIED')) as mapped)
    select step_no, step, "column", metric, cast(value as double) as value from t, lateral (values
      (0, 'high_level', null, 'rows_before', rows_before), (0, 'high_level', null, 'rows_after', rows_after),
      (0, 'high_level', null, 'cols_before', 6), (0, 'high_level', null, 'cols_after', 7),
      (1, 'normalize_strings', 'label', 'stripped', 1), (1, 'normalize_strings', 'priority', 'stripped', 1),
      (1, 'normalize_strings', 'price_text', 'stripped', 1),
      (2, 'drop_missing_label', 'label', 'rows_before', rows_before),
      (2, 'drop_missing_label', 'label', 'rows_after', rows_after),
      (2, 'drop_missing_label', 'label', 'rows_dropped', rows_before - rows_after),
      (3, '_halve_urgent', null, 'hook', 1), (4, '_broken_hook', null, 'hook', 0),
      (5, 'cast_numbers', 'price_text', 'missing_before', missing), (5, 'cast_numbers', 'price_text', 'missing_after', 0),
      (5, 'cast_numbers', 'price_text', 'fill_value', round(med, 4)),
      (6, 'bucket_rare', 'priority', 'n_replaced', n_rare), (6, 'bucket_rare', 'priority', 'n_levels_before', lv_before),
      (6, 'bucket_rare', 'priority', 'n_levels_after', lv_after),
      (7, 'map_values', 'absent', 'column_not_found', null), (7, 'map_values', 'priority', 'n_affected', mapped)
    ) as v(step_no, step, "column", metric, value)"""
)
def clean_report(spark, sf):
    """The report observed while the clean table is written."""
    path = shared_folder(spark, "clean")
    report = _run(spark, sf).save(lambda clean: write_clean(clean, path, run_id="observed"))
    return report.select("step_no", "step", "column", "metric", F.round("value", 4).alias("value"))


@query("clean_roundtrip", CLEAN_SQL)
def clean_roundtrip(spark, sf):
    """Write the clean table to the shared folder and read it back."""
    path = write_clean(clean_run(spark, sf), shared_folder(spark, "clean"), run_id="roundtrip")
    return read_clean(spark, path)


QUERIES, ORACLE = register.queries, register.sql
