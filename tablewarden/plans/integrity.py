"""The integrity summary: key, time, label and leakage checks of one table as findings."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.numbers import binary_label, nulls_for_nan, number_of, ratio
from tablewarden.functions.text import MISSING_CATEGORY, norm_category, text_of
from tablewarden.operators import integrity, leakage, profile
from tablewarden.operators.findings import FAIL, PASS, SEVERITIES, WARN, fact, findings, union_all, worst_status
from tablewarden.plans.compiled import Checks
from tablewarden.session import literal_rows

SOURCES = ["row_identity", "temporal", "label_alignment", "leakage_scan"]


def integrity_findings(
    df: DataFrame,
    *,
    keys: Sequence[str],
    label: str,
    positive: str,
    features: Sequence[str],
    entity: Sequence[str] = (),
    time_column: str | None = None,
    order_column: str | None = None,
    earliest: str | None = None,
    latest: str | None = None,
    proxy_rules: Sequence[leakage.ProxyRule] = (),
) -> DataFrame:
    """All integrity checks that the given columns allow, as finding rows.

    The table is read once for all aggregates, once for keys and snapshots, once for values
    against the label and once for the order of events (and for their number, beforehand).
    """
    df = nulls_for_nan(df)
    checks, facts, out = Checks(df), [], []
    value = checks.value
    later: list[Callable[[], list[Column]]] = []  # facts, once the asks are compiled

    id_ = ",".join(keys)
    y = norm_category(text_of(df, label))
    known_label = F.when(y != MISSING_CATEGORY, y)
    checks.ask_groups(
        [F.col(f"`{k}`") for k in keys],
        {"n": F.count("*"), "lo": F.min(known_label), "hi": F.max(known_label)},
        {
            "dup": lambda g: F.count_if(~g("null_key") & (g("n") > 1)),
            "split": lambda g: F.count_if(~g("null_key") & (g("lo") != g("hi"))),
        },
    )
    later.append(
        lambda: [
            fact("row_identity", "duplicate_keys", id_, value("dup"), "hard", value("dup") > 0),
            fact("row_identity", "label_conflicts", id_, value("split"), "hard", value("split") > 0),
        ]
    )

    if time_column:
        for name, ask in integrity.time_counts(df, time_column, earliest=earliest, latest=latest).items():
            checks.ask(f"t_{name}", ask)
        codes = ("n_missing", "n_too_early", "n_too_late")
        later.append(
            lambda: [fact("temporal", c, time_column, value(f"t_{c}"), "hard", value(f"t_{c}") > 0) for c in codes]
        )
        who = ",".join(entity)
        if entity:
            key = [*[F.col(f"`{e}`") for e in entity], integrity.as_time(df, time_column)]
            checks.ask_groups(key, {"n": F.count("*")}, {"twice": lambda g: F.count_if(~g("null_key") & (g("n") > 1))})
            later.append(lambda: [fact("temporal", "duplicate_snapshots", who, value("twice"), "risk", value("twice") > 0)])
        if entity and order_column:
            wrong = integrity.out_of_order(df, entity, time_column, order_column).agg(F.count("*").alias("n"))
            out.append(
                findings(wrong, source="temporal", code="out_of_order", subject=F.lit(who), value=F.col("n"),
                         severity="risk", bad=F.col("n") > 0)
            )

    for name, ask in integrity.label_counts(df, label, positive).items():
        checks.ask(f"l_{name}", ask)

    def degenerate() -> list[Column]:
        share = ratio(value("l_n_positive"), value("l_n_labelled"))
        bad = ~F.coalesce(share.between(0.01, 0.99), F.lit(False))
        return [fact("label_alignment", "degenerate_label", label, F.round(share, 6), "hard", bad)]

    later.append(degenerate)
    risky = [c for c in integrity.risky_names(df, exclude=[label]) if c in features]
    later.append(lambda: [fact("label_alignment", "forbidden_name", c, F.lit(1.0), "risk", F.lit(True)) for c in risky])
    for i, (pairs, equal) in enumerate(integrity.alias_counts(df, label, features).values()):
        checks.ask(f"a{i}_pairs", pairs)
        checks.ask(f"a{i}_equal", equal)

    def aliases() -> list[Column]:
        is_alias = lambda i: (value(f"a{i}_pairs") >= 50) & (value(f"a{i}_pairs") == value(f"a{i}_equal"))
        return [fact("label_alignment", "label_alias", c, value(f"a{i}_equal"), "risk", is_alias(i)) for i, c in enumerate(features)]

    later.append(aliases)

    numeric = [c for c in profile.numeric_columns(df) if c in features]
    target = binary_label(df, label, positive).cast("double")
    for i, c in enumerate(numeric):
        n_pairs, r = profile.correlation_asks(number_of(df, c), target)
        checks.ask(f"c{i}_pairs", n_pairs)
        checks.ask(f"c{i}_r", r)
    for i, rule in enumerate(proxy_rules):
        n, in_band = leakage.proxy_counts(df, rule)
        checks.ask(f"p{i}_n", n)
        checks.ask(f"p{i}_band", in_band)
    checks.compile()
    for make in later:
        facts += make()
    out.append(checks.facts(facts))

    known = {}
    for c in features:
        r = None
        if c in numeric:
            i = numeric.index(c)
            r = F.round(F.when(value(f"c{i}_pairs") >= 10, value(f"c{i}_r")), 6)
        flagged = F.lit(False)
        for i, rule in enumerate(proxy_rules):
            if rule.target == c:
                flagged = flagged | leakage.is_proxy(rule, value(f"p{i}_n"), value(f"p{i}_band"))
        known[c] = (r, flagged)
    catalogue = leakage.leakage_catalogue(df, label=label, y=target, features=features, known=known)
    out.append(
        findings(catalogue, source="leakage_scan", code="leakage_risk", subject=F.col("feature"),
                 value=F.when(F.col("risk") == "high", 2).when(F.col("risk") == "medium", 1).otherwise(0),
                 severity="risk", bad=F.col("risk") == "high")
    )
    return union_all(out)


def _missing_status(*, warn: bool = True, fail: bool = True) -> str:
    return FAIL if fail else WARN if warn else PASS


def missing_sources(
    found: DataFrame, expected: Sequence[str] = SOURCES, *, warn: bool = True, fail: bool = True
) -> DataFrame:
    """A finding for every expected source without any row."""
    status = _missing_status(warn=warn, fail=fail)
    asked = literal_rows(found.sparkSession, [(s,) for s in expected], "source string")
    return asked.join(found.select("source").distinct(), "source", "left_anti").select(
        "source",
        F.lit("missing_report").alias("code"),
        F.lit("").alias("subject"),
        F.lit(1.0).alias("value"),
        F.lit("hard" if fail else "risk").alias("severity"),
        F.lit(status).alias("status"),
    )


def findings_summary(found: DataFrame, expected: Sequence[str] = (), **missing: bool) -> DataFrame:
    """Counts and worst status per source and overall; ``ready`` where nothing failed.

    An expected source without findings counts as one finding (see ``missing_sources``). The
    findings are evaluated once: expected sources join them as rows without a status.
    """
    status = F.col("status")
    rows = found.select("source", "status")
    if expected:
        asked = literal_rows(found.sparkSession, [(s, None) for s in expected], "source string, status string")
        rows = rows.unionByName(asked)
    per_source = rows.groupBy("source").agg(
        F.count("status").alias("n_checks"),
        F.count_if(status == WARN).alias("n_warn"),
        F.count_if(status == FAIL).alias("n_fail"),
        worst_status(status).alias("status"),
    )
    if expected:
        absent, worst = F.col("n_checks") == 0, _missing_status(**missing)
        per_source = per_source.select(
            "source",
            F.when(absent, 1).otherwise(F.col("n_checks")).alias("n_checks"),
            *[F.when(absent, int(worst == s)).otherwise(F.col(c)).alias(c) for c, s in (("n_warn", WARN), ("n_fail", FAIL))],
            F.when(absent, worst).otherwise(status).alias("status"),
        )
    sums = [F.sum(c).alias(c) for c in ("n_checks", "n_warn", "n_fail")]
    return (
        per_source.rollup("source")
        .agg(*sums, worst_status(status).alias("status"))
        .select(
            F.coalesce("source", F.lit("overall")).alias("source"),
            *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_checks", "n_warn", "n_fail")],
            "status",
            (F.coalesce("n_fail", F.lit(0)) == 0).alias("ready"),
        )
    )


def findings_as_hints(found: DataFrame, run_id: str, *, max_hints: int | None = None) -> DataFrame:
    """Bad findings as event hints of a run, all of them, or the ``max_hints`` most severe."""
    order = F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("severity"))
    bad = found.filter(F.col("status").isin(WARN, FAIL))
    if max_hints is not None:
        bad = bad.orderBy(order, "source", "code", "subject").limit(max_hints)
    return (
        bad.select(
            F.lit(run_id).alias("run_id"),
            F.col("source").alias("module"),
            F.concat_ws("_", "source", "code").alias("code"),
            F.col("severity").alias("severity_signal"),
            F.concat_ws(".", F.lit("checks"), "code", "subject").alias("evidence_path"),
            F.create_map(F.lit("value"), F.col("value").cast("string")).alias("context"),
            F.create_map(F.lit("action"), F.concat(F.lit("review_"), F.col("code"))).alias("remediation"),
        )
    )
