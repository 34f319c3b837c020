"""Quotas and cut-offs of a label with very many classes, as tables.

Nothing per class reaches the driver or the plan: quotas come from the classes' counts, the
rank of a cut-off is looked for among counts of hash prefixes, and only the rows of the bucket that
holds it are ordered. A class that holds more than a thousandth of the rows (there are
fewer than a thousand) is dealt over many tasks in every join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.session import numbered, written

HOT_SHARE = 1000
SALTS = 64
# A table of so many classes, of a few numbers or hashes each, may be broadcast: some 20 MB.
BROADCAST_CLASSES = 100_000


def class_counts(rows: DataFrame) -> DataFrame:
    """(_y, c), written once."""
    return written(rows.groupBy("_y").agg(F.count("*").alias("c")), "classes")


def quotas(counts: DataFrame, n: int, drawn: int) -> DataFrame:
    """(_y, c, quota): how many of ``drawn`` rows each class gives, by largest remainder of what stays, ties by class order."""
    wide = lambda c: c.cast("decimal(38,0)")
    whole = wide(F.col("c")) * F.lit(n - drawn)
    rem = whole % F.lit(n)
    # without the remainder the quotient is whole
    shares = counts.select("_y", "c", rem.alias("rem"), ((whole - rem) / F.lit(n)).cast("long").alias("kept"))
    spare = (n - drawn) - (shares.agg(F.sum("kept")).first()[0] or 0)
    placed = numbered(shares, [F.desc("rem"), "_y"], "place")
    return placed.select("_y", "c", (F.col("c") - F.col("kept") - (F.col("place") <= spare).cast("long")).alias("quota"))


def join_classes(rows: DataFrame, classes: DataFrame, counts: DataFrame, spread: Column, how: str = "inner") -> DataFrame:
    """``rows`` with what ``classes`` (unique in _y) say: broadcast where the number of classes is small, else by shuffle,
    rows of large classes being dealt by ``spread``."""
    seen = counts.agg(F.count("*").alias("k"), F.sum("c").alias("n")).first()
    if seen["k"] <= BROADCAST_CLASSES:
        return rows.join(F.broadcast(classes), "_y", how)
    hot = [r["_y"] for r in counts.filter(F.col("c") * HOT_SHARE > F.lit(seen["n"])).select("_y").collect()]
    salt = F.when(F.col("_y").isin(hot), F.pmod(F.xxhash64(spread), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    copies = F.when(F.col("_y").isin(hot), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    classes = classes.withColumn("_salt", F.explode(copies))
    return rows.withColumn("_salt", salt).join(classes, ["_y", "_salt"], how).drop("_salt")


def cuts(tokens: DataFrame, asked: DataFrame, counts: DataFrame, limit: int) -> DataFrame:
    """(_y, cuts): the tokens at the 1-based ``ranks`` of each class, in order.

    ``tokens``: (_y, _t) of all rows; ``asked``: (_y, c, ranks), c the rows of the class. A class of more than
    ``limit`` rows is cut by as many leading hash digits as that takes, others stay whole.
    """
    digits = F.when(F.col("c") > limit, F.ceil(F.log(16.0, F.col("c") / F.lit(float(limit))))).otherwise(0).cast("int")
    wanted = asked.filter(F.exists("ranks", lambda r: r > 0)).select("_y", "ranks", digits.alias("_d"))
    placed = join_classes(tokens, wanted, counts, F.col("_t")).withColumn("_p", F.expr("substring(_t, 1, _d)"))
    buckets = placed.groupBy("_y", "_p").agg(F.count("*").alias("n"), F.first("ranks").alias("ranks"))
    # at most 16 * c / limit buckets of a class meet here
    upto = F.sum("n").over(Window.partitionBy("_y").orderBy("_p").rowsBetween(Window.unboundedPreceding, 0))
    buckets = buckets.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("n"))
    inside = F.filter("ranks", lambda r: (r > F.col("before")) & (r <= F.col("upto")))
    buckets = buckets.select("_y", "_p", "before", inside.alias("here")).filter(F.size("here") > 0)
    found = placed.select("_y", "_p", "_t").join(buckets, ["_y", "_p"])
    # about ``limit`` rows of a bucket at most
    place = F.row_number().over(Window.partitionBy("_y", "_p").orderBy("_t")) + F.col("before")
    found = found.withColumn("_r", place).filter(F.array_contains("here", F.col("_r")))
    return found.groupBy("_y").agg(F.sort_array(F.collect_list("_t")).alias("cuts"))
