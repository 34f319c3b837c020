"""All diagnostics of an assigned split as one findings table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.numbers import binary_label, ratio
from tablewarden.functions.text import MISSING_KEY_PART
from tablewarden.operators import drift
from tablewarden.operators.findings import FAIL, WARN, fact, findings, union_all
from tablewarden.operators.splits import EXCLUDED
from tablewarden.plans.compiled import Checks


def split_findings(
    assigned: DataFrame,
    *,
    label: str,
    positive: str | None,
    features: Sequence[str],
    group: Sequence[str] = (),
    time_column: str | None = None,
) -> DataFrame:
    """Sizes, balance, drift and, where columns are named, group overlap and time order.

    Sizes, balance and late rows are one aggregate over one read of the table (the newest times are
    fetched before it); groups and drift take one read each.
    """
    checks = Checks(assigned)
    value = checks.value
    part = F.col("split")
    y = binary_label(assigned, label, positive)
    parts = list(dict.fromkeys([*drift.MIN_SIZES, "train", "val", "test"]))
    for p in parts:
        checks.ask(f"n_{p}", F.count_if(part == p))
        checks.ask(f"pos_{p}", F.sum(F.when(part == p, y.cast("long"))))
    if time_column:
        for p, late in drift.late_rows(assigned, time_column).items():
            checks.ask(f"late_{p}", F.count_if(late))
    if group:
        low, high = F.min(F.when(part != EXCLUDED, part)), F.max(F.when(part != EXCLUDED, part))
        key = [F.coalesce(F.col(f"`{g}`").cast("string"), F.lit(MISSING_KEY_PART)) for g in group]
        checks.ask_groups(key, {"lo": low, "hi": high}, {"overlaps": lambda g: F.count_if(g("lo") != g("hi"))})
    checks.compile()

    facts = []
    for p, least in drift.MIN_SIZES.items():
        facts.append(fact("split", "minimum_size", p, value(f"n_{p}"), "risk", value(f"n_{p}") < least))
    total = lambda what: sum((F.coalesce(value(f"{what}_{p}"), F.lit(0)) for p in parts), F.lit(0))
    overall = ratio(total("pos"), total("n"))
    for p in parts:
        gap = F.abs(ratio(value(f"pos_{p}"), value(f"n_{p}")) - overall)
        # a part without rows has no rate and makes no finding
        facts.append(F.when(value(f"n_{p}") > 0, fact("split", "label_imbalance", p, F.round(gap, 6), "risk", gap > 0.10)))
    if group:
        facts.append(fact("split", "group_overlap", ",".join(group), value("overlaps"), "hard", value("overlaps") > 0))
    if time_column:
        for p in ("val", "test"):
            late = fact("split", "time_inversion", p, value(f"late_{p}"), "hard", value(f"late_{p}") > 0)
            facts.append(F.when(value(f"n_{p}") > 0, late))
    out = [checks.facts(facts)]
    if features:
        moved = drift.ks_drift(assigned, features, top=None)
        bad = F.col("status").isin(WARN, FAIL)
        subject = F.concat_ws(":", "feature", "pair")
        out.append(findings(moved, source="split", code="drift", subject=subject, value=F.col("statistic"), severity="risk", bad=bad))
    return union_all(out)
