"""Leakage signals per feature and derived-proxy rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.numbers import number_of
from tablewarden.functions.text import MISSING_CATEGORY, norm_category, text_of
from tablewarden.operators.findings import PASS, WARN
from tablewarden.operators.integrity import risky_names
from tablewarden.operators.profile import guarded_corr, label_correlation, numeric_columns

# Parts of a feature name that hint at knowledge of the outcome.
OUTCOME_NAME_PARTS = [
    "churn", "default", "fraud", "converted", "outcome", "result", "label", "target",
    "response", "next_", "future", "after_", "post_",
]
# Parts of a feature name that hint at an identifier.
ID_NAME_PARTS = ["id", "uuid", "guid", "hash", "account", "customer", "user"]


# What a report advises about a proxy.
ACTIONS = ("check_multicollinearity", "drop_or_regularize", "keep_but_constrain")


@dataclass(frozen=True)
class ProxyRule:
    """``target`` should not be the product of ``factors``."""

    target: str
    factors: Sequence[str]
    low: float = 0.8
    high: float = 1.2
    min_share: float = 0.90
    min_rows: int = 200
    actions: Sequence[str] = ACTIONS

    @property
    def name(self) -> str:
        return f"{self.target}~{'*'.join(self.factors)}"


def _product(df: DataFrame, rule: ProxyRule) -> Column:
    product = number_of(df, rule.factors[0])
    for f in rule.factors[1:]:
        product = product * number_of(df, f)
    return product


def _proxy_ratio(df: DataFrame, rule: ProxyRule) -> Column:
    return F.try_divide(number_of(df, rule.target), _product(df, rule))


def proxy_counts(df: DataFrame, rule: ProxyRule) -> tuple[Column, Column]:
    """Aggregates: rows whose ratio is known, and those of them in the band."""
    q = _proxy_ratio(df, rule)
    return F.count(q), F.count_if(q.between(rule.low, rule.high))


def is_proxy(rule: ProxyRule, n: Column, in_band: Column) -> Column:
    share = F.try_divide(in_band.cast("double"), n.cast("double"))
    return F.coalesce((n >= rule.min_rows) & (share >= rule.min_share), F.lit(False))


def derived_proxies(df: DataFrame, rules: Sequence[ProxyRule]) -> DataFrame:
    """Share of usable rows whose ratio target/product lies in the band, all rules in one scan."""
    ratios = df.select(*[_proxy_ratio(df, r).alias(f"q{i}") for i, r in enumerate(rules)])
    asks = []
    for i, r in enumerate(rules):
        q = F.col(f"q{i}")
        asks += [
            F.count(q).alias(f"n{i}"),
            F.count_if(q.between(r.low, r.high)).alias(f"b{i}"),
        ]
    structs = []
    for i, r in enumerate(rules):
        share = F.try_divide(F.col(f"b{i}").cast("double"), F.col(f"n{i}").cast("double"))
        flagged = (F.col(f"n{i}") >= r.min_rows) & (share >= r.min_share)
        structs.append(
            F.struct(
                F.lit(r.target).alias("target"),
                F.lit(r.name).alias("rule"),
                F.col(f"n{i}").alias("n_usable"),
                F.col(f"b{i}").alias("n_in_band"),
                F.round(share, 6).alias("in_band_share"),
                F.coalesce(flagged, F.lit(False)).alias("flagged"),
            )
        )
    return (
        ratios.agg(*asks)
        .select(F.explode(F.array(*structs)).alias("_r"))
        .select("_r.*")
        .withColumn("status", F.when(F.col("flagged"), WARN).otherwise(PASS))
    )


def proxy_correlations(df: DataFrame, rules: Sequence[ProxyRule], *, threshold: float = 0.70) -> DataFrame:
    """Correlation of each target with its product, and what to do where it is high."""
    pairs = df.select(
        *[number_of(df, r.target).alias(f"t{i}") for i, r in enumerate(rules)],
        *[_product(df, r).alias(f"p{i}") for i, r in enumerate(rules)],
    )
    asks = [guarded_corr(F.col(f"t{i}"), F.col(f"p{i}")).alias(f"r{i}") for i in range(len(rules))]
    lines = []
    for i, r in enumerate(rules):
        high = F.coalesce(F.abs(F.col(f"r{i}")) >= threshold, F.lit(False))
        lines.append(
            F.struct(
                F.lit(r.target).alias("target"),
                F.lit(r.name).alias("rule"),
                F.round(F.col(f"r{i}"), 6).alias("correlation"),
                high.alias("flagged"),
                F.when(high, ",".join(r.actions)).otherwise("").alias("actions"),
            )
        )
    return pairs.agg(*asks).select(F.explode(F.array(*lines)).alias("_l")).select("_l.*")


def proxy_examples(df: DataFrame, rule: ProxyRule, keys: Sequence[str], k: int = 10) -> DataFrame:
    """The first ``k`` rows, by key, whose ratio lies in the band."""
    return (
        df.select(*[f"`{c}`" for c in keys], F.round(_proxy_ratio(df, rule), 6).alias("ratio"))
        .filter(F.col("ratio").between(rule.low, rule.high))
        .orderBy(*keys)
        .limit(k)
    )


def value_determinism(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Per column: distinct known values, and how many of them see a single label only."""
    y = norm_category(text_of(df, label))
    texts = df.select(y.alias("_y"), *[text_of(df, c).alias(c) for c in columns])
    per_value = (
        texts.filter(F.col("_y") != MISSING_CATEGORY)
        .unpivot(["_y"], list(columns), "column", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"), F.min("_y").alias("lo"), F.max("_y").alias("hi"))
    )
    return per_value.groupBy("column").agg(
        F.sum("n").alias("n_known"),
        F.count("*").alias("n_unique"),
        F.count_if(F.col("lo") == F.col("hi")).alias("n_single_label"),
    )


def leakage_catalogue(
    df: DataFrame,
    *,
    label: str,
    y: Column,
    features: Sequence[str],
    proxy_rules: Sequence[ProxyRule] = (),
    corr_threshold: float = 0.98,
    cardinality_threshold: float = 0.90,
    known: Mapping[str, tuple[Column | None, Column]] | None = None,
) -> DataFrame:
    """One row per feature with its tags and risk level.

    Correlations and proxies are one-row aggregates; the determinism test is
    one grouped pass over (column, value).  ``known`` gives a feature's correlation and whether
    it is a proxy target where a caller has them already.
    """
    det = value_determinism(df, features, label)
    unique_ratio = F.try_divide(F.col("n_unique").cast("double"), F.col("n_known").cast("double"))
    facts = det.withColumn("unique_ratio", unique_ratio)
    numeric = [c for c in numeric_columns(df) if c in features]
    # both sides below have at most one row per feature
    if known is not None:
        pick = lambda i, other: F.coalesce(*[F.when(F.col("column") == c, k[i]) for c, k in known.items() if k[i] is not None], other)
        facts = facts.withColumns({"correlation": pick(0, F.lit(None).cast("double")), "_proxy": pick(1, F.lit(False))})
    elif numeric:
        corr = label_correlation(df, numeric, y).select("column", "correlation")
        facts = facts.join(F.broadcast(corr), "column", "left")
    else:
        facts = facts.withColumn("correlation", F.lit(None).cast("double"))
    if known is None and proxy_rules:
        flagged = (
            derived_proxies(df, proxy_rules).filter("flagged").select(F.col("target").alias("column")).distinct()
        ).withColumn("_proxy", F.lit(True))
        facts = facts.join(F.broadcast(flagged), "column", "left")
    elif known is None:
        facts = facts.withColumn("_proxy", F.lit(False))

    outcome = F.col("column").isin(risky_names(df, OUTCOME_NAME_PARTS, exclude=[label]))
    id_like = F.col("column").isin(risky_names(df, ID_NAME_PARTS, exclude=[label]))
    near = outcome | F.coalesce(F.abs("correlation") >= corr_threshold, F.lit(False))
    determined = (
        (F.col("n_unique") == F.col("n_single_label"))
        & (F.col("unique_ratio") < cardinality_threshold)
        & (F.col("n_unique") > 1)
    )
    proxy = F.coalesce("_proxy", F.lit(False))
    tags = F.array_compact(
        F.array(
            F.when(near, "near_label"),
            F.when(determined, "deterministic_wrt_label"),
            F.when(proxy, "derived_proxy"),
            F.when(id_like, "id_like_name"),
            F.when(F.col("unique_ratio") >= cardinality_threshold, "high_cardinality"),
        )
    )
    risk = F.when(near | determined, "high").when(proxy | id_like, "medium").otherwise("low")
    return facts.select(
        F.col("column").alias("feature"),
        "n_known",
        "n_unique",
        F.round("unique_ratio", 6).alias("unique_ratio"),
        "correlation",
        F.array_join(tags, ",").alias("tags"),
        risk.alias("risk"),
    )
