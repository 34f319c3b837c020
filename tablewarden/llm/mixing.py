"""Mixing sources to target weights by a low-discrepancy schedule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .running import running_sum
from .skew import hot_keys, salted_join
from .store import materialise

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK = 1024
SLOTS_PER_BUCKET = 4096
WORD = "[^\\x20\\x09-\\x0D]+"
# the golden ratio's fraction times 2^31, made odd: slot t has the point t * STEP mod 2^31
PERIOD, STEP = 1 << 31, 1327217885


def targets(sources: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """(src, source_size) to (..., weight, target): ``share`` of all sizes dealt by weight.

    Sources stand in code point order, null last, and take the weights in turn. A
    source gets at most ``most`` times its size; what it leaves is dealt again among
    the others by weight until none is above. With sources in order of size / weight,
    the capped ones come first: the table has a row for each source, and its window
    is over sources, not over documents.
    """
    if most < share:
        raise ValueError("sources can't fill the share under this cap")
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("src"))) - 1, F.lit(len(weights)))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), turn)
    table = sources.withColumn("weight", weight).withColumn("_cap", F.col("source_size") * float(most))
    order = Window.orderBy(F.col("_cap") / F.col("weight"), F.col("src"))
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    # the price of a unit of weight if all earlier sources are capped and this and later ones are not
    left = F.sum("source_size").over(everything) * float(share) - F.coalesce(F.sum("_cap").over(upto), F.lit(0.0))
    table = table.withColumn("_price", left / F.sum("weight").over(onward))
    # it rises while the sources so far are rightly capped and falls after: the greatest is the level
    table = table.withColumn("_level", F.max("_price").over(everything))
    target = F.least(F.col("_cap"), F.col("_level") * F.col("weight"))
    return table.select("src", "source_size", "weight", target.alias("target"))


def schedule(plan: DataFrame) -> DataFrame:
    """(src_no, rank, slot): which slot is a source's first, second, ... in the mix.

    ``plan`` holds src_no and need (slots wanted) of every source. Slot t goes to the
    source whose part of the unit interval, as wide as its share of all needs, holds
    the golden-ratio point of t, so every run of slots holds each source near its
    share. Gaps between the first n points are below 2 / n, so three times the slots
    needed fill every part; a source whose need is met lets its later slots pass.

    The interval is cut into cells, at least as many as sources; points meet the parts
    of their own cell only. Ranks are running counts over blocks of slots.
    """
    spark = plan.sparkSession
    plan = plan.where("need > 0")
    ahead = Window.orderBy("src_no").rowsBetween(Window.unboundedPreceding, -1)
    plan = materialise(plan.select("src_no", "need", F.coalesce(F.sum("need").over(ahead), F.lit(0)).alias("from")), "plan")
    total, sources = plan.agg(F.coalesce(F.sum("need"), F.lit(0)), F.count("*")).first()
    cells = max(1024, 4 * sources)
    lap, at = F.floor(F.col("slot") / PERIOD), F.col("slot") % PERIOD * STEP % PERIOD
    # later sweeps of the period fall between the points of the first
    point = (at + lap * (STEP / PERIOD) % 1.0) / float(PERIOD)
    points = (
        spark.range(3 * total)
        .select(F.col("id").alias("slot"))
        .withColumn("at", point * float(total))
        .withColumn("cell", F.floor(point * cells))
    )
    cell_of = lambda c: F.floor(c / float(total) * cells)
    parts = plan.withColumn("to", F.col("from") + F.col("need")).withColumn(
        "cell", F.explode(F.sequence(cell_of(F.col("from")) - 1, cell_of(F.col("to")) + 1))
    )
    filled = points.join(parts, "cell").where("at >= from and at < to").select("src_no", "slot", "need")
    filled = filled.withColumn("_bucket", F.floor(F.col("slot") / SLOTS_PER_BUCKET)).withColumn("one", F.lit(1))
    ranked = running_sum(materialise(filled, "slots"), ["src_no"], "_bucket", ["slot"], "one", "rank")
    return ranked.where("rank < need").select("src_no", "rank", "slot")


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    block: int = BLOCK,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """How many words of every document the mix takes.

    Returns key, size, source_size, target, taken, and copies (how often the document
    is begun), first_slot (of the schedule; null if not taken), text_hash.

    Each source's documents are put in hash order, laid end to end and cut into blocks
    of ``block`` words; the source's r-th slot takes its r-th block, starting over
    after the last, until the target's whole words are taken. So taken words of a source
    are its target without the fraction, and no word is taken more than ``most`` times.

    * null text: size 0, taken 0; a source of such texts has target 0;
    * null source: a source like any other, last in order; null and repeated keys: rows
      alike in key, source and text are counted first, then laid out one after the other;
    * a document longer than a block lies in many blocks, which are dealt one by one;
    * empty table: no rows. Other columns are not read.
    """
    rows = docs.select(
        F.col(key).alias("_key"),
        F.coalesce(F.concat(F.lit("0"), F.col(source)), F.lit("1")).alias("src"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(text).alias("text_hash"),
    )
    order = F.md5(F.concat(F.lit("mix|"), F.coalesce(F.col("_key").cast("string"), F.lit(""))))
    rows = rows.groupBy("_key", "src", "size", "text_hash").agg(F.count("*").alias("n"))
    rows = rows.withColumn("order", order).withColumn("words", F.col("n") * F.col("size"))
    rows = materialise(rows.withColumn("_bucket", F.conv(F.substring("order", 1, 3), 16, 10).cast("int")), "sizes")
    sources = rows.groupBy("src").agg(F.sum("words").alias("source_size"), F.count("*").alias("n"))
    plan = targets(sources.select("src", "source_size"), weights, share, float(most))
    whole = F.floor(F.col("target") + 1e-6)
    blocks = F.ceil(F.col("source_size") / block)
    laps = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0)
    plan = (
        plan.withColumn("src_no", F.row_number().over(Window.orderBy("src")))
        .withColumn("whole", whole)
        .withColumn("blocks", blocks)
        .withColumn("need", (laps * blocks + F.ceil((whole - laps * F.col("source_size")) / block)).cast("long"))
    )
    plan = materialise(plan, "targets")
    hot = hot_keys(sources, ["src"])
    laid = running_sum(rows, ["src"], "_bucket", ["order", "_key", "size", "text_hash"], "words", "start")
    laid = salted_join(laid, plan.drop("weight", "need"), ["src"], hot, "order")
    laid = laid.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    laid = laid.withColumn("start", F.col("start") + F.col("copy") * F.col("size"))
    begin, end = F.col("start"), F.col("start") + F.col("size")
    in_blocks = F.when(F.col("size") > 0, F.sequence(F.floor(begin / block), F.floor((end - 1) / block)))
    pieces = laid.withColumn("blk", F.explode_outer(in_blocks))
    slots = schedule(plan.select("src_no", "need"))
    # a block's slots are at most ``most`` laps of its source, so the join key (source, lap, block) is unique
    laps_of = F.explode(F.sequence(F.lit(0), F.lit(int(most) - 1)))
    pieces = pieces.withColumn("lap", laps_of).withColumn("rank", F.col("lap") * F.col("blocks") + F.col("blk"))
    met = pieces.join(slots, ["src_no", "rank"], "left")
    # the last slot of a source ends where the target does
    stop = F.least(end, (F.col("blk") + 1) * block, F.col("whole") - F.col("lap") * F.col("source_size"))
    got = F.when(F.col("slot").isNotNull(), F.greatest(F.lit(0), stop - F.greatest(begin, F.col("blk") * block)))
    starts = F.col("slot").isNotNull() & (F.col("blk") == F.floor(begin / block)) & (got > 0)
    keys = ["_key", "src_no", "size", "text_hash", "start", "copy", "source_size", "target"]
    return (
        met.groupBy(*keys)
        .agg(
            F.coalesce(F.sum(got), F.lit(0)).cast("long").alias("taken"),
            F.count_if(starts).alias("copies"),
            F.min(F.when(starts, F.col("slot"))).alias("first_slot"),
        )
        .select(F.col("_key").alias(key), "size", "source_size", "target", "taken", "copies", "first_slot", "text_hash")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix: every row as often as the mix begins it, columns unchanged.

    Rows alike in key, text and source share what the mix takes of them evenly.
    """
    key, text = options.get("key", "doc_id"), options.get("text", "text")
    took = mix(docs, **options)
    took = took.groupBy(F.col(key).alias("_k"), F.col("text_hash").alias("_h")).agg(
        F.sum("copies").alias("_copies"), F.count("*").alias("_rows")
    )
    took = took.where("_copies > 0")
    rows = docs.withColumn("_hash", F.xxhash64(text))
    met = rows.join(took, (rows["_hash"] == took["_h"]) & rows[key].eqNullSafe(took["_k"]))
    place = F.row_number().over(Window.partitionBy("_h", "_k").orderBy(F.lit(1)))
    times = F.floor(F.col("_copies") / F.col("_rows")) + (place <= F.col("_copies") % F.col("_rows")).cast("long")
    met = met.withColumn("_times", F.when(F.col("_rows") == 1, F.col("_copies")).otherwise(times)).where("_times > 0")
    return met.withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times")))).select(*docs.columns)
