"""Registered queries: splits, folds and split diagnostics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.catalog.inputs import table
from tablewarden.catalog.integrity import EVENTS, FEATURES, PROXIES, labelled_events
from tablewarden.catalog.registry import Register
from tablewarden.functions.numbers import binary_label
from tablewarden.operators import drift, splits
from tablewarden.operators.leakage import leakage_catalogue
from tablewarden.plans.integrity import findings_summary
from tablewarden.plans.split_checks import split_findings

register = Register()
query = register.query


def _orders(spark, sf):
    """Orders with their date, the label missing for the cheapest."""
    dates = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
        F.when(F.col("o_totalprice") >= 20000, F.col("o_orderstatus")).alias("label"),
    )
    return dates


def _fit(df, strategy, **more):
    return splits.fit_holdout(df, label="label", positive="F", keys=["o_orderkey"], strategy=strategy, **more)


ORDERS = "ord as (select o_orderkey, o_custkey, o_totalprice, o_orderdate, case when o_totalprice >= 20000 then o_orderstatus end as label from orders)"


def _hash(key: str, seed: int) -> str:
    return f"md5(cast({key} as varchar) || ':{seed}')"


RANDOM = f"""{ORDERS}, v as (select *, row_number() over (order by {_hash('o_orderkey', 42)}) as r1, count(*) over () as n from ord where label is not null),
  v1 as (select *, cast(ceil(0.2::double * n) as bigint) as n_test from v),
  v2 as (select *, row_number() over (order by {_hash('o_orderkey', 43)}) as r2 from v1 where r1 > n_test),
  assigned as (
    select o.*, case when o.label is null then 'excluded' when v2.o_orderkey is null then 'test'
      when r2 <= ceil(0.25::double * (n - n_test)) then 'val' else 'train' end as split
    from ord o left join v2 using (o_orderkey))"""


def _quota(source: str, share: str, out: str) -> str:
    """Largest remainder on the part that stays, ties by class order."""
    return f"""{out}_c as (select y, count(*) as c, sum(count(*)) over () as n from {source} group by y),
    {out}_d as (select *, cast(n - ceil({share} * n) as bigint) as stays from {out}_c),
    {out}_k as (select y, c, stays, c * stays // n as kept, c * stays % n as rem from {out}_d),
    {out} as (select y, c - kept - if(row_number() over (order by rem desc, y) <= stays - sum(kept) over (), 1, 0) as quota from {out}_k)"""


STRATIFIED = f"""{ORDERS}, v as (select *, if(label = 'F', 1, 0) as y from ord where label is not null),
  {_quota('v', '0.2::double', 'q1')},
  v1 as (select v.*, row_number() over (partition by v.y order by {_hash('o_orderkey', 42)}) <= quota as is_test from v join q1 on v.y = q1.y),
  w as (select * from v1 where not is_test),
  {_quota('w', '0.25::double', 'q2')},
  w1 as (select w.*, row_number() over (partition by w.y order by {_hash('o_orderkey', 43)}) <= quota as is_val from w join q2 on w.y = q2.y),
  assigned as (
    select o.*, case when o.label is null then 'excluded' when w1.o_orderkey is null then 'test'
      when is_val then 'val' else 'train' end as split
    from ord o left join w1 using (o_orderkey))"""


@query("split_random", f"with {RANDOM} select o_orderkey, label, split from assigned")
def split_random(spark, sf):
    df = _orders(spark, sf)
    return _fit(df, "random").assign(df).select("o_orderkey", "label", "split")


@query("split_stratified", f"with {STRATIFIED} select o_orderkey, label, split from assigned")
def split_stratified(spark, sf):
    df = _orders(spark, sf)
    return _fit(df, "stratified").assign(df).select("o_orderkey", "label", "split")


@query("split_stratified_buckets", f"with {STRATIFIED} select o_orderkey, label, split from assigned")
def split_stratified_buckets(spark, sf):
    """The same split with the cut-offs found through hash buckets, as on a large table."""
    df = _orders(spark, sf)
    return _fit(df, "stratified", direct_limit=200).assign(df).select("o_orderkey", "label", "split")


@query(
    "split_fallback",
    f"""with {RANDOM} select o_orderkey, split, 'stratified' as strategy_requested, 'random_fallback' as strategy_used,
    'a class has fewer than 2 rows' as fallback_reason from assigned""",
)
def split_fallback(spark, sf):
    """A label with a value of its own in every row allows no strata: the split is drawn at random."""
    df = _orders(spark, sf).withColumn("amount", F.when(F.col("label").isNotNull(), F.col("o_orderkey").cast("double")))
    plan = splits.fit_holdout(df, label="amount", keys=["o_orderkey"], strategy="stratified")
    report = {"strategy_requested": plan.strategy_requested, "strategy_used": plan.strategy_used, "fallback_reason": plan.fallback_reason}
    return plan.assign(df).select("o_orderkey", "split", *[F.lit(v).alias(k) for k, v in report.items()])


MANY = STRATIFIED.replace("as label from orders", "as label, case when o_totalprice >= 20000 then o_custkey % 97 end as bucket from orders").replace(
    "if(label = 'F', 1, 0) as y", "bucket as y"
)


def _bucketed(spark, sf):
    return _orders(spark, sf).withColumn("bucket", F.when(F.col("label").isNotNull(), F.col("o_custkey") % 97))


@query("split_many_classes", f"with {MANY} select o_orderkey, bucket, split from assigned")
def split_many_classes(spark, sf):
    """A label of 97 classes, with cut-offs in a table, as for many thousands; large classes are cut by hash digits."""
    df = _bucketed(spark, sf)
    plan = splits.fit_holdout(df, label="bucket", keys=["o_orderkey"], literal_classes=10, direct_limit=50)
    return plan.assign(df).select("o_orderkey", "bucket", "split")


@query(
    "split_cv_many_classes",
    f"""with {MANY.split(", v as")[0]}, v as (select *, bucket as y from ord where bucket is not null),
    r as (select *, row_number() over (partition by y order by {_hash('o_orderkey', 42)}) as r, count(*) over (partition by y) as c from v)
    select o.o_orderkey, o.bucket, case when r <= c // 3 then 0 when r <= 2 * c // 3 then 1 when r is not null then 2 end as fold
    from ord o left join r using (o_orderkey)""",
)
def split_cv_many_classes(spark, sf):
    df = _bucketed(spark, sf)
    folds = splits.assign_folds(df, label="bucket", keys=["o_orderkey"], folds=3, literal_classes=10, direct_limit=50)
    return folds.select("o_orderkey", "bucket", "fold")


def _share(p: str) -> str:
    return f"round(count(*) filter (split = '{p}') / count(*), 4) as pct_{p}"


def _rate(name: str, cond: str) -> str:
    return f"round(coalesce(avg(if(label = 'F', 1, 0)) filter ({cond}), 0), 4) as positive_rate_{name}"


@query(
    "split_report",
    f"""with {STRATIFIED} select count(*) as n_total, count(*) filter (split <> 'excluded') as n_valid,
    count(*) filter (split = 'excluded') as n_excluded, count(*) filter (split = 'train') as n_train,
    count(*) filter (split = 'val') as n_val, count(*) filter (split = 'test') as n_test,
    {_share('train')}, {_share('val')}, {_share('test')}, {_rate('overall', "split <> 'excluded'")},
    {_rate('train', "split = 'train'")}, {_rate('val', "split = 'val'")}, {_rate('test', "split = 'test'")},
    'holdout' as split_type, 'stratified' as strategy_requested, 'stratified' as strategy_used, null::varchar as fallback_reason,
    42 as random_state, 0.2::double as test_size_requested, 0.2::double as val_size_requested, 0.25::double as val_size_of_trainval
    from assigned""",
)
def split_report(spark, sf):
    df = _orders(spark, sf)
    plan = _fit(df, "stratified")
    return splits.split_report(plan.assign(df), plan)


@query(
    "split_group",
    f"""with g as (select distinct o_custkey as k from orders), g1 as (select k, row_number() over (order by {_hash('k', 42)}) as r1, count(*) over () as n from g),
    g2 as (select *, row_number() over (order by {_hash('k', 43)}) as r2 from g1 where r1 > ceil(0.2::double * n))
    select o_orderkey, o_custkey, case when g2.k is null then 'test' when r2 <= ceil(0.25::double * (n - ceil(0.2::double * n))) then 'val' else 'train' end as split
    from orders left join g2 on o_custkey = k""",
)
def split_group(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return splits.split_by_group(df, ["o_custkey"])


@query(
    "split_group_dialogs",
    f"""with g as (select distinct conv_id as k from conversations), g1 as (select k, row_number() over (order by {_hash('k', 42)}) as r1, count(*) over () as n from g),
    g2 as (select *, row_number() over (order by {_hash('k', 43)}) as r2 from g1 where r1 > ceil(0.2::double * n))
    select conv_id, turn, case when g2.k is null then 'test' when r2 <= ceil(0.25::double * (n - ceil(0.2::double * n))) then 'val' else 'train' end as split
    from conversations left join g2 on conv_id = k""",
)
def split_group_dialogs(spark, sf):
    df = table(spark, sf, "conversations").select("conv_id", "turn")
    return splits.split_by_group(df, ["conv_id"], direct_limit=20)


TIME = """n as (select count(*) as n from lineitem),
  q as (select n - cast(ceil(0.2::double * n) as bigint) - cast(ceil(0.25::double * (n - ceil(0.2::double * n))) as bigint) as n_train,
    n - cast(ceil(0.2::double * n) as bigint) as n_trainval from n),
  c as (select l_shipdate as t, sum(count(*)) over (order by l_shipdate) as upto from lineitem group by 1),
  e as (select min(t) filter (upto >= n_train) as e1, min(t) filter (upto >= n_trainval) as e2 from c, q),
  assigned as (select l.*, case when l_shipdate <= e1 then 'train' when l_shipdate <= e2 then 'val' else 'test' end as split from lineitem l, e)"""


def _by_time(spark, sf, **more):
    return splits.split_by_time(table(spark, sf, "lineitem"), "l_shipdate", **more)


SPLIT_TIME = f"with {TIME} select l_orderkey, l_linenumber, l_partkey, l_shipdate, split from assigned"


def _time_columns(df):
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "split")


@query("split_time", SPLIT_TIME)
def split_time(spark, sf):
    return _time_columns(_by_time(spark, sf))


@query("split_time_buckets", SPLIT_TIME)
def split_time_buckets(spark, sf):
    # a small limit sends the search for the two cut-offs through its narrowing passes
    return _time_columns(_by_time(spark, sf, direct_limit=1000))


SPLIT_CV = f"""with {ORDERS}, v as (select *, if(label = 'F', 1, 0) as y from ord where label is not null),
    r as (select *, row_number() over (partition by y order by {_hash('o_orderkey', 42)}) as r, count(*) over (partition by y) as c from v)
    select o.o_orderkey, o.label, case when r <= c // 5 then 0 when r <= 2 * c // 5 then 1 when r <= 3 * c // 5 then 2
      when r <= 4 * c // 5 then 3 when r is not null then 4 end as fold
    from ord o left join r using (o_orderkey)"""


def _folds(spark, sf, **more):
    folds = splits.assign_folds(_orders(spark, sf), label="label", positive="F", keys=["o_orderkey"], **more)
    return folds.select("o_orderkey", "label", "fold")


@query("split_cv", SPLIT_CV)
def split_cv(spark, sf):
    return _folds(spark, sf)


@query("split_cv_buckets", SPLIT_CV)
def split_cv_buckets(spark, sf):
    return _folds(spark, sf, direct_limit=2000)


@query(
    "split_constraints",
    f"""with {EVENTS} select count(ts) as n_with_time,
    (select count(*) from (select user_id from ev group by 1 having count(*) > 1)) as n_repeating_entities,
    'time_based' as recommended, 'outcome_text' as risky_features from ev""",
)
def split_constraints(spark, sf):
    df = labelled_events(spark, sf)
    risky = leakage_catalogue(
        df, label="bought", y=binary_label(df, "bought", "yes"), features=FEATURES, proxy_rules=PROXIES
    )
    return splits.split_advice(df, time_column="ts", entity=["user_id"], risky=risky)


# --- diagnostics ----------------------------------------------------------------------------------


def _stratified(spark, sf):
    df = _orders(spark, sf)
    return _fit(df, "stratified").assign(df)


OVERLAP = """ov as (select count(*) as n_groups, count(*) filter (lo <> hi) as n_overlapping from (
    select o_custkey, min(split) as lo, max(split) as hi from assigned where split <> 'excluded' group by 1))"""


@query(
    "split_group_overlap",
    f"with {STRATIFIED}, {OVERLAP} select *, if(n_overlapping > 0, 'fail', 'pass') as status from ov",
)
def split_group_overlap(spark, sf):
    return drift.group_overlap(_stratified(spark, sf), ["o_custkey"])


INVERSION = """tops as (select max(o_orderdate) filter (split = 'train') as tr, max(o_orderdate) filter (split = 'val') as va from assigned),
  inv as (select split, count(*) as n, count(*) filter ((split = 'val' and o_orderdate < tr) or (split = 'test' and o_orderdate < greatest(tr, va))) as n_inverted
    from assigned, tops where split in ('val', 'test') group by split)"""


@query(
    "split_time_inversion",
    f"with {STRATIFIED}, {INVERSION} select *, if(n_inverted > 0, 'fail', 'pass') as status from inv",
)
def split_time_inversion(spark, sf):
    return drift.time_inversion(_stratified(spark, sf), "o_orderdate")


@query(
    "split_time_inversion_none",
    f"with {TIME} select split, count(*) as n, 0::bigint as n_inverted, 'pass' as status from assigned where split <> 'train' group by split",
)
def split_time_inversion_none(spark, sf):
    return drift.time_inversion(_by_time(spark, sf), "l_shipdate")


BALANCE = """al as (select avg(if({pos}, 1, 0)) as r from assigned where split <> 'excluded'),
  bal as (select split, count(*) as n, avg(if({pos}, 1, 0)) as rate, abs(avg(if({pos}, 1, 0)) - any_value(r)) as gap
    from assigned, al where split <> 'excluded' group by split)"""


@query(
    "split_label_imbalance",
    f"""with {STRATIFIED}, {BALANCE.format(pos="label = 'F'")}
    select split, n, round(rate, 6) as positive_rate, round(gap, 6) as gap, if(gap > 0.1, 'warn', 'pass') as status from bal""",
)
def split_label_imbalance(spark, sf):
    df = _stratified(spark, sf)
    return drift.label_imbalance(df, binary_label(df, "label", "F"))


SIZES = """sz as (select 'train' as split, count(*) filter (split = 'train') as n, 500::bigint as least from assigned
  union all select 'val', count(*) filter (split = 'val'), 100 from assigned
  union all select 'test', count(*) filter (split = 'test'), 100 from assigned)"""


@query(
    "split_min_sizes",
    f"with {STRATIFIED}, {SIZES} select *, if(n < least, 'warn', 'pass') as status from sz",
)
def split_min_sizes(spark, sf):
    return drift.minimum_sizes(_stratified(spark, sf))


def _ks_sql(features: dict[str, str], source: str = "assigned") -> str:
    """D = max gap of the two distribution functions, p by the cut asymptotic series."""
    long = " union all ".join(
        f"select '{name}' as feature, split, cast({expr} as double) as x from {source} where split <> 'excluded'"
        for name, expr in features.items()
    )
    return f"""x as (select * from ({long}) where x is not null),
  g as (select feature, x, count(*) filter (split = 'train') as a, count(*) filter (split = 'val') as b, count(*) filter (split = 'test') as c from x group by feature, x),
  tot as (select feature, sum(a) as na, sum(b) as nb, sum(c) as nc from g group by feature),
  cum as (select feature, sum(a) over w as a, sum(b) over w as b, sum(c) over w as c from g window w as (partition by feature order by x)),
  ks0 as (select cum.feature, max(abs(a / na - b / nb)) as dv, max(abs(a / na - c / nc)) as dt, any_value(na) as na, any_value(nb) as nb, any_value(nc) as nc
    from cum join tot using (feature) group by cum.feature),
  ks1 as (select feature, 'train_vs_val' as pair, dv as d, sqrt(na * nb / (na + nb)) * dv as lam from ks0
    union all select feature, 'train_vs_test', dt, sqrt(na * nc / (na + nc)) * dt from ks0),
  ks2 as (select *, case when lam < 0.2 then 1.0 else greatest(0.0, least(1.0, 2 * list_sum([if(k % 2 = 1, 1.0, -1.0) * exp(-2.0 * k * k * lam * lam) for k in range(1, 101)]))) end as p from ks1)"""


KS_FEATURES = {c: c for c in ("l_quantity", "l_extendedprice", "l_discount", "l_orderkey")} | {
    "days": "epoch(l_shipdate) / 86400"
}


KS_SQL = f"""with {TIME}, {_ks_sql(KS_FEATURES)} select feature, pair, round(d, 6) as statistic, round(p, 4)::double as p_value, p < 0.05 as p_flagged,
    if(d > 0.1, 'warn', 'pass') as status from ks2"""


def _with_days(spark, sf):
    return _by_time(spark, sf).withColumn("days", F.datediff("l_shipdate", F.lit("1970-01-01")).cast("double"))


@query("ks_drift", KS_SQL)
def ks_drift(spark, sf):
    return drift.ks_drift(_with_days(spark, sf), list(KS_FEATURES))


@query("ks_drift_buckets", KS_SQL)
def ks_drift_buckets(spark, sf):
    # small limits, so that cells are cut again and their values put together from many pieces
    return drift.ks_drift(_with_days(spark, sf), list(KS_FEATURES), rows_per_bucket=50)


SPLIT_FACTS = f"""with {STRATIFIED}, {OVERLAP}, {INVERSION}, {BALANCE.format(pos="label = 'F'")}, {SIZES},
  {_ks_sql({'o_totalprice': 'o_totalprice', 'o_custkey': 'o_custkey'})},
  f(source, code, subject, value, severity, bad) as (
    select 'split', 'minimum_size', split, n, 'risk', n < least from sz
    union all select 'split', 'label_imbalance', split, round(gap, 6), 'risk', gap > 0.1 from bal
    union all select 'split', 'drift', feature || ':' || pair, round(d, 6), 'risk', d > 0.1 from ks2
    union all select 'split', 'group_overlap', 'o_custkey', n_overlapping, 'hard', n_overlapping > 0 from ov
    union all select 'split', 'time_inversion', split, n_inverted, 'hard', n_inverted > 0 from inv),
  g2 as (select source, code, subject, value, severity, case when not bad then 'pass' when severity = 'hard' then 'fail' else 'warn' end as status from f)"""


def _split_findings(spark, sf):
    return split_findings(
        _stratified(spark, sf),
        label="label",
        positive="F",
        features=["o_totalprice", "o_custkey"],
        group=["o_custkey"],
        time_column="o_orderdate",
    )


@query(
    "split_findings",
    SPLIT_FACTS + " select source, code, subject, cast(value as double) as value, severity, status from g2",
)
def findings(spark, sf):
    return _split_findings(spark, sf)


@query(
    "split_summary",
    SPLIT_FACTS
    + """ select coalesce(source, 'overall') as source, count(*) as n_checks, count(*) filter (status = 'warn') as n_warn,
    count(*) filter (status = 'fail') as n_fail, case when count(*) filter (status = 'fail') > 0 then 'fail'
      when count(*) filter (status = 'warn') > 0 then 'warn' else 'pass' end as status,
    count(*) filter (status = 'fail') = 0 as ready from g2 group by rollup (source)""",
)
def split_summary(spark, sf):
    return findings_summary(_split_findings(spark, sf))


QUERIES, ORACLE = register.queries, register.sql
