"""Inputs of the registered queries: the given tables, and faults derived from their own values.

The supplied tables hold no missing or malformed values, so those are derived
from other columns of the same row.  Each derived input comes twice: as a
DataFrame and as the same definition in SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def messy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with missing labels, padded and missing categories, and prices as text."""
    price, prio = F.col("o_totalprice"), F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.when(price >= 20000, F.col("o_orderstatus")).alias("label"),
        F.when(price > 450000, F.concat(F.lit("  "), prio, F.lit(" \t")))
        .when(price < 15000, "NaN")
        .when(price < 30000, F.lit(None))
        .when(price < 40000, "   ")
        .otherwise(prio)
        .alias("priority"),
        F.when((prio == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "O"), " ")
        .when((prio == "1-URGENT") & (price > 400000), "12d")
        .otherwise(price.cast("string"))
        .alias("price_text"),
        "o_totalprice",
    )


MESSY_ORDERS = """messy as (
  select o_orderkey, o_custkey,
    case when o_totalprice >= 20000 then o_orderstatus end as label,
    case when o_totalprice > 450000 then '  ' || o_orderpriority || chr(160) || chr(9)
         when o_totalprice < 15000 then 'NaN'
         when o_totalprice < 30000 then null
         when o_totalprice < 40000 then '   '
         else o_orderpriority end as priority,
    case when o_orderpriority = '4-NOT SPECIFIED' and o_orderstatus = 'O' then ' '
         when o_orderpriority = '1-URGENT' and o_totalprice > 400000 then '12d'
         else cast(o_totalprice as varchar) end as price_text,
    o_totalprice
  from orders)"""

# The blanks that occur in the derived inputs.
SQL_BLANKS = "' ' || chr(9) || chr(160)"


def sql_strip(x: str) -> str:
    return f"trim({x}, {SQL_BLANKS})"


def sql_norm(x: str) -> str:
    t = sql_strip(x)
    return (
        f"case when {x} is null or {t} = '' or lower({t}) in ('nan', 'none', 'null') "
        f"then '<MISSING>' else {t} end"
    )


def parts_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose brand is missing for the smallest size."""
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_size") > 1, F.col("p_brand")).alias("brand"),
        F.col("p_type").alias("type"),
        F.col("p_name").alias("name"),
        "p_size",
        "p_retailprice",
    )


PARTS_WITH_GAPS = """parts as (
  select p_partkey, case when p_size > 1 then p_brand end as brand, p_type as type,
         p_name as name, p_size, p_retailprice
  from part)"""


def lines_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with missing discounts and taxes, and the exact net price as a planted proxy."""
    return table(spark, sf_dir, "lineitem").withColumns(
        {
            "discount": F.when(F.col("l_quantity") > 5, F.col("l_discount")),
            "tax": F.when(F.col("l_returnflag") != "R", F.col("l_tax")),
            "net_price": F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 2),
            "keep_rate": 1 - F.col("l_discount"),
        }
    )


LINES_WITH_GAPS = """lines as (
  select *, case when l_quantity > 5 then l_discount end as discount,
         case when l_returnflag <> 'R' then l_tax end as tax,
         round(l_extendedprice * (1 - l_discount), 2) as net_price,
         1 - l_discount as keep_rate
  from lineitem)"""


def order_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messy orders with the market segment of their customer."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    orders = messy_orders(spark, sf_dir).select("o_orderkey", "o_custkey", "label", "priority")
    return orders.join(customers, orders.o_custkey == customers.c_custkey).drop("c_custkey")


ORDER_SEGMENTS = (
    MESSY_ORDERS
    + """, seg as (
  select o_orderkey, label, priority, c_mktsegment
  from messy join customer on o_custkey = c_custkey)"""
)
