"""Sharding by a hierarchical weighted hash tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .running import running_sum
from .store import materialise

# region -> rack -> shard -> weight
Tree = dict[int, dict[int, dict[int, float]]]

SHARDS = 40
BUCKETS = 1024
ROW_BYTES = 16


def tree_of(shards: int, base: int = SHARDS, per_rack: int = 5, racks: int = 2, weight: float = 1.0) -> Tree:
    """Regions of ``racks`` racks of ``per_rack`` shards for the first ``base`` shards; every
    further shard comes as a region of its own."""
    tree: Tree = {}
    for s in range(min(shards, base)):
        region, rack = s // (per_rack * racks), s // per_rack % racks
        tree.setdefault(region, {}).setdefault(rack, {})[s] = weight
    for s in range(base, shards):
        tree[len(tree)] = {0: {s: weight}}
    return tree


def _draw(key: Column, path: list[Column], weight: Column) -> Column:
    """ln(u) / weight with u from the hash of key and node: of siblings, the greatest wins with
    odds in proportion to weight, and a changed weight changes no sibling's draw."""
    u = (F.shiftrightunsigned(F.xxhash64(key, *path), 11).cast("double") + 0.5) / float(1 << 53)
    return F.when(weight > 0, F.ln(u) / weight)


def _nested(values) -> Column:
    return F.array(*[_nested(v) for v in values]) if isinstance(values, list) else F.lit(values)


def _winner(draws: list[Column]) -> Column:
    """Position of the greatest draw."""
    best = F.array_max(F.array(*[F.struct(d.alias("draw"), F.lit(i).alias("at")) for i, d in enumerate(draws)]))
    return best["at"]


def descend(df: DataFrame, tree: Tree, key: str, prefix: str = "") -> DataFrame:
    """Add ``region``, ``rack`` and ``shard``: at each level the child with the best weighted draw.

    The key and the nodes' numbers and weights decide alone. When a shard's weight
    changes, keys move only into or out of the regions and racks whose weight changed
    with it; a shard added as a region of its own takes keys only into itself. A null
    key is one key like any other.
    """
    regions = sorted(tree)
    names = [[f"{r}/{k}" for k in sorted(tree[r])] for r in regions]
    ids = [[sorted(tree[r][k]) for k in sorted(tree[r])] for r in regions]
    leaf = [[[float(tree[r][k][s]) for s in sorted(tree[r][k])] for k in sorted(tree[r])] for r in regions]
    wide, deep = max(map(len, names)), max(len(k) for r in ids for k in r)
    pad = lambda xs, n, fill: xs + [fill] * (n - len(xs))
    rack_w = [pad([sum(k) for k in r], wide, 0.0) for r in leaf]
    leaf_w = [pad([pad(k, deep, 0.0) for k in r], wide, [0.0] * deep) for r in leaf]
    leaf_id = [pad([pad(k, deep, -1) for k in r], wide, [-1] * deep) for r in ids]
    k, at = F.col(key), {n: f"{prefix}_{n}" for n in ("region", "rack", "shard")}
    region = _winner([_draw(k, [F.lit("region"), F.lit(r)], F.lit(sum(rack_w[i]))) for i, r in enumerate(regions)])
    df = df.withColumn(at["region"], region)
    own = F.get(_nested(rack_w), F.col(at["region"]))
    rack_key = [F.lit("rack"), F.col(at["region"])]
    df = df.withColumn(at["rack"], _winner([_draw(k, [*rack_key, F.lit(i)], F.get(own, F.lit(i))) for i in range(wide)]))
    inner = lambda table: F.get(F.get(_nested(table), F.col(at["region"])), F.col(at["rack"]))
    weights, shards = inner(leaf_w), inner(leaf_id)
    draws = [_draw(k, [F.lit("shard"), F.get(shards, F.lit(i))], F.get(weights, F.lit(i))) for i in range(deep)]
    return df.withColumn(at["shard"], F.get(shards, _winner(draws)))


def shard_rows(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Deal rows into ``shards`` shards by their key, and number the rows of each shard.

    Returns key, size, text_crc32, law (always ``key``), shard, slot, grown_shard, region,
    rack. A slot is the row's place in its shard: gapless from 0, the same in every run.

    * null text: size 16 (no bytes), checksum 0, as for the empty text;
    * null key: all such rows share one shard; repeated keys too. Rows alike in key,
      size and checksum are counted before they are numbered, so they may be very many;
    * empty table: no rows. Other columns are not read.

    Slots come from running counts over BUCKETS hash buckets of every shard, so no task
    holds a whole shard.
    """
    grown = tree_of(shards + 1, base=shards)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("_key"),
        (F.octet_length(body).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    same = rows.groupBy("_key", "size", "text_crc32").agg(F.count("*").alias("n"))
    placed = descend(descend(same, tree_of(shards, base=shards), "_key", "now"), grown, "_key", "later")
    bucket = F.pmod(F.xxhash64("_key", "size", "text_crc32", F.lit("slot")), F.lit(BUCKETS))
    placed = materialise(placed.withColumn("_bucket", bucket), "shards")
    numbered = running_sum(placed, ["now_shard"], "_bucket", ["_key", "size", "text_crc32"], "n", "_first")
    return numbered.select(
        F.col("_key").alias(key),
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        F.col("now_shard").alias("shard"),
        F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("n") - 1)).alias("slot"),
        F.col("later_shard").alias("grown_shard"),
        F.col("now_region").alias("region"),
        F.col("now_rack").alias("rack"),
    )
