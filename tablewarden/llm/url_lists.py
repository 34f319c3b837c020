"""URL filters whose lists change over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import hot_keys, salted_join
from .store import materialise


def host_of(url: Column) -> Column:
    """Lower-case host of a URL without user, port and trailing dots; empty if there is none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return F.regexp_replace(F.lower(F.coalesce(host, F.lit(""))), r"\.+$", "")


def domains_of(host: Column) -> Column:
    """The host and its parent domains of two labels or more (one label: the host itself)."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    starts = F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1)))
    return F.when(host != "", F.transform(starts, lambda i: F.array_join(F.slice(labels, i, n), "."))).otherwise(
        F.array().cast("array<string>")
    )


def validity(entries: DataFrame) -> DataFrame:
    """Dated entries (list, domain, action, at) to intervals (list, domain, since, until).

    An ``add`` opens an interval, which the next entry of the same list and domain ends
    (``until`` is null for none: still active). Of entries at one time a ``remove`` counts last, and
    repeats change nothing. Entries with a null, or another action, say nothing. Domains
    match without regard to case or trailing dots.
    """
    clean = entries.where(F.col("action").isin("add", "remove") & F.col("list").isNotNull() & F.col("at").isNotNull())
    name = F.regexp_replace(F.lower("domain"), r"\.+$", "")
    clean = clean.select("list", name.alias("domain"), "at", (F.col("action") == "remove").alias("removes")).where("domain <> ''")
    # one row per time: whether that time ends with the entry removed
    states = clean.groupBy("list", "domain", "at").agg(F.max("removes").alias("removes"))
    following = F.lead("at").over(Window.partitionBy("list", "domain").orderBy("at"))
    return states.withColumn("until", following).where("not removes").select("list", "domain", F.col("at").alias("since"), "until")


def filter_urls(captures: DataFrame, entries: DataFrame, url: str = "url", at: str = "fetched_at") -> DataFrame:
    """Judge every capture by the list entries active when it was fetched; its columns are kept.

    Adds host, n_active (entries that match), lists (their lists, sorted, comma-joined;
    empty if none) and blocked. An entry for a domain matches its subdomains.

    * null or unreadable URL, or null fetch time: nothing matches;
    * an entry is active from its own time on, and no more at the time it is removed;
    * repeated captures are judged one by one; columns named like those added are replaced;
    * empty captures: no rows; no entries: nothing is blocked.

    The join is on domain, with the time inside the interval. A domain of very many
    captures is dealt to many tasks; the intervals of such domains are repeated.
    """
    captures = captures.drop("host", "n_active", "lists", "blocked")
    rows = captures.withColumn("host", host_of(F.col(url))).withColumn("_row", F.monotonically_increasing_id())
    rows = materialise(rows, "captures")
    asked = rows.select("_row", F.col(at).alias("_at"), F.explode(domains_of(F.col("host"))).alias("domain"))
    asked = asked.where("_at is not null")
    hot = hot_keys(asked.groupBy("domain").agg(F.count("*").alias("n")), ["domain"])
    spans = materialise(validity(entries), "intervals")
    met = salted_join(asked, spans, ["domain"], hot, "_row")
    met = met.where("since <= _at and (until is null or _at < until)")
    of = met.groupBy("_row").agg(
        F.count("*").alias("n_active"), F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists")
    )
    n = F.coalesce("n_active", F.lit(0).cast("long"))
    return rows.join(of, "_row", "left").select(
        *captures.columns, "host", n.alias("n_active"), F.coalesce("lists", F.lit("")).alias("lists"), (n > 0).alias("blocked")
    )
