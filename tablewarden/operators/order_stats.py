"""Exact order statistics without a global sort.

A value at a given rank is found by narrowing: a mergeable sketch brackets the
rank, exact counts confirm the bracket, and the next pass looks only inside it.
Each pass is one scan with a one-row result.  Only when a bracket is known to
hold at most ``direct_limit`` rows are its values ordered in one window.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.functions.numbers import nan_to_null

DIRECT_LIMIT = 2_000_000
SKETCH_ACCURACY = 10_000
SKETCHED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


@dataclass
class _Bracket:
    """Rows of ``column`` strictly between ``low`` and ``high`` (None: no bound)."""

    column: str
    rank: int  # 1-based
    inside: int
    below: int = 0
    low: object = None
    high: object = None


def _ordered_kind(df: DataFrame, column: str) -> T.DataType:
    """The column's type; a type that cannot be sketched is refused at any size, not only for large tables."""
    kind = df.schema[column].dataType
    if not isinstance(kind, SKETCHED):
        raise TypeError(f"column {column!r} is of type {kind.simpleString()}; convert it to a number or a time first")
    return kind


def _portable(c: Column, kind: T.DataType) -> Column:
    """Numbers travel to the driver as they are, everything else as text."""
    return c if isinstance(kind, T.NumericType) else c.cast("string")


def _literal(value, kind: T.DataType) -> Column:
    return F.lit(value).cast(kind)


def _in_bracket(b: _Bracket, c: Column, kind: T.DataType) -> Column:
    inside = c.isNotNull()
    if b.low is not None:
        inside = inside & (c > _literal(b.low, kind))
    if b.high is not None:
        inside = inside & (c < _literal(b.high, kind))
    return inside


def values_at_ranks(
    df: DataFrame,
    ranks: Mapping[str, Sequence[int]],
    *,
    counts: Mapping[str, int] | None = None,
    direct_limit: int = DIRECT_LIMIT,
) -> dict[tuple[str, int], object]:
    """Value at each 1-based rank of each column, NULLs left out.

    Numbers come back as numbers, other types as text that casts back to them.
    """
    wanted = {c: sorted(set(rs)) for c, rs in ranks.items() if rs}
    if not wanted:
        return {}
    kinds = {c: _ordered_kind(df, c) for c in wanted}
    df = df.select(*[f"`{c}`" for c in wanted])
    if counts is None:
        row = df.agg(*[F.count(f"`{c}`").alias(c) for c in wanted]).first()
        counts = row.asDict()
    brackets = []
    for c, rs in wanted.items():
        for r in rs:
            if not 1 <= r <= counts[c]:
                raise ValueError(f"rank {r} is outside 1..{counts[c]} of column {c}")
            brackets.append(_Bracket(c, r, counts[c]))

    done: dict[tuple[str, int], object] = {}
    while wide := [b for b in brackets if b.inside > direct_limit]:
        done.update(_narrow(df, wide, kinds))
        brackets = [b for b in brackets if (b.column, b.rank) not in done]
    if brackets:
        done.update(_read_off(df, brackets, kinds))
    return done


def _narrow(df: DataFrame, wide: list[_Bracket], kinds: Mapping[str, T.DataType]) -> dict:
    """Shrink every bracket around its rank; returns the ranks that were hit exactly.

    Both end values leave the bracket in each pass, so a value that fills a
    large part of the column cannot keep it wide.
    """
    slack = 2.0 / SKETCH_ACCURACY
    aims = []
    for i, b in enumerate(wide):
        c, kind = F.col(f"`{b.column}`"), kinds[b.column]
        share = (b.rank - b.below) / b.inside
        ends = [max(0.0, share - slack), min(1.0, share + slack)]
        sketch = F.percentile_approx(F.when(_in_bracket(b, c, kind), c), ends, SKETCH_ACCURACY)
        aims.append(_portable(sketch[0], kind).alias(f"lo{i}"))
        aims.append(_portable(sketch[1], kind).alias(f"hi{i}"))
    end = df.agg(*aims).first()

    counts = []
    for i, b in enumerate(wide):
        c, kind = F.col(f"`{b.column}`"), kinds[b.column]
        lo, hi = _literal(end[f"lo{i}"], kind), _literal(end[f"hi{i}"], kind)
        counts.append(F.count_if(c < lo).alias(f"under{i}"))
        counts.append(F.count_if(c <= lo).alias(f"to_lo{i}"))
        counts.append(F.count_if(c < hi).alias(f"before_hi{i}"))
        counts.append(F.count_if(c <= hi).alias(f"to_hi{i}"))
    n = df.agg(*counts).first()

    hit = {}
    for i, b in enumerate(wide):
        lo, hi, top = end[f"lo{i}"], end[f"hi{i}"], b.below + b.inside
        if b.rank <= n[f"under{i}"]:
            b.high, b.inside = lo, n[f"under{i}"] - b.below
        elif b.rank <= n[f"to_lo{i}"]:
            hit[(b.column, b.rank)] = lo
        elif b.rank <= n[f"before_hi{i}"]:
            b.low, b.high = lo, hi
            b.below, b.inside = n[f"to_lo{i}"], n[f"before_hi{i}"] - n[f"to_lo{i}"]
        elif b.rank <= n[f"to_hi{i}"]:
            hit[(b.column, b.rank)] = hi
        else:
            b.low, b.below, b.inside = hi, n[f"to_hi{i}"], top - n[f"to_hi{i}"]
    return hit


def _read_off(df: DataFrame, brackets: list[_Bracket], kinds: Mapping[str, T.DataType]) -> dict:
    """Order the values of brackets whose size has been checked; one job per column type."""
    done: dict = {}
    by_kind: dict[str, list[_Bracket]] = {}
    for b in brackets:
        by_kind.setdefault(kinds[b.column].simpleString(), []).append(b)
    for same_kind in by_kind.values():
        kind = kinds[same_kind[0].column]
        # brackets of one column that share their bounds share their values
        spans: dict[tuple, list[_Bracket]] = {}
        for b in same_kind:
            spans.setdefault((b.column, b.low, b.high, b.below), []).append(b)
        tagged, below = [], []
        for g, (span, group) in enumerate(spans.items()):
            c = F.col(f"`{span[0]}`")
            tagged.append(F.when(_in_bracket(group[0], c, kind), F.struct(F.lit(g).alias("g"), c.alias("v"))))
            below += [F.lit(g), F.lit(span[3]).cast("long")]
        counts = (
            df.select(F.explode(F.array_compact(F.array(*tagged))).alias("_x"))
            .groupBy("_x.g", "_x.v")
            .agg(F.count("*").alias("n"))
        )
        # at most direct_limit rows per group reach this window, see values_at_ranks
        run = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
        upto = F.sum("n").over(run) + F.element_at(F.create_map(*below), F.col("g"))
        ranked = counts.withColumn("upto", upto)
        picks, places = [], []
        for g, group in enumerate(spans.values()):
            for b in group:
                reached = (F.col("g") == g) & (F.col("upto") >= b.rank)
                picks.append(_portable(F.min(F.when(reached, F.col("v"))), kind).alias(str(len(places))))
                places.append((b.column, b.rank))
        row = ranked.agg(*picks).first()
        done.update({place: row[i] for i, place in enumerate(places)})
    return done


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    *,
    direct_limit: int = DIRECT_LIMIT,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of numeric columns, NULL and NaN left out."""
    df = df.select(*[nan_to_null(F.col(f"`{c}`").cast("double")).alias(c) for c in columns])
    counts = df.agg(*[F.count(f"`{c}`").alias(c) for c in columns]).first().asDict()
    ranks: dict[str, list[int]] = {}
    for c in columns:
        if counts[c]:
            at = [(counts[c] - 1) * p for p in probabilities]
            ranks[c] = [math.floor(a) + 1 for a in at] + [math.ceil(a) + 1 for a in at]
    found = values_at_ranks(df, ranks, counts=counts, direct_limit=direct_limit)
    out: dict[str, list[float | None]] = {}
    for c in columns:
        if not counts[c]:
            out[c] = [None] * len(probabilities)
            continue
        out[c] = []
        for p in probabilities:
            at = (counts[c] - 1) * p
            lo, hi = math.floor(at), math.ceil(at)
            v0, v1 = found[(c, lo + 1)], found[(c, hi + 1)]
            out[c].append(v0 if lo == hi else (hi - at) * v0 + (at - lo) * v1)
    return out


# --- ordered buckets: split a long ordered series into parts of similar size -------------


@dataclass(frozen=True)
class OrderedBuckets:
    """Edges that cut a column into ordered buckets, looked up in two short steps."""

    edges: tuple
    kind: T.DataType

    @property
    def count(self) -> int:
        return len(self.edges) + 1

    def of(self, c: Column) -> Column:
        """Bucket number: how many edges are <= c."""
        if not self.edges:
            return F.lit(0)
        step = max(1, math.isqrt(len(self.edges)))
        groups = [self.edges[i : i + step] for i in range(0, len(self.edges), step)]

        def arr(values):
            # one text literal, cast to an array: folded to a constant by the optimizer
            text = ",".join(str(v) for v in values)
            return F.split(F.lit(text), ",").cast(T.ArrayType(self.kind))

        heads = arr([g[0] for g in groups])
        tails = F.array(*[arr(g) for g in groups])
        group = F.size(F.filter(heads, lambda e: e <= c))
        inside = F.size(F.filter(F.element_at(tails, F.greatest(group, F.lit(1))), lambda e: e <= c))
        return F.when(group == 0, F.lit(0)).otherwise((group - 1) * F.lit(step) + inside)


def ordered_buckets(df: DataFrame, columns: Sequence[str], n_buckets: int) -> dict[str, OrderedBuckets]:
    """Bucket edges of all columns from one sketching pass.

    The edges only balance the work; results computed with them stay exact.
    """
    kinds = {c: _ordered_kind(df, c) for c in columns}
    if n_buckets <= 1:
        return {c: OrderedBuckets((), kinds[c]) for c in columns}
    text = ",".join(str(i / n_buckets) for i in range(1, n_buckets))
    shares = F.split(F.lit(text), ",").cast("array<double>")
    asks = []
    for i, c in enumerate(columns):
        sketch = F.percentile_approx(F.col(f"`{c}`"), shares, SKETCH_ACCURACY)
        if not isinstance(kinds[c], T.NumericType):
            sketch = sketch.cast("array<string>")
        asks.append(sketch.alias(str(i)))
    row = df.agg(*asks).first()
    return {c: OrderedBuckets(tuple(dict.fromkeys(row[i] or [])), kinds[c]) for i, c in enumerate(columns)}


def text_rank(df: DataFrame, column: str) -> Column:
    """A number that never falls where the text rises: six bytes after what all values begin with alike.

    Lets text and bytes be cut into ordered buckets; equal numbers only mean one bucket.
    """
    c = F.col(f"`{column}`").cast("binary")
    low, high = (bytes(x or b"") for x in df.agg(F.min(c), F.max(c)).first())
    alike = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
    digits = F.substring(F.hex(c), 2 * alike + 1, 12)
    return F.conv(F.rpad(digits, 12, "0"), 16, 10).cast("long")


def check_orderable(df: DataFrame, column: str) -> None:
    """Refuse, at any size, a column by which rows can't be put in order in pieces."""
    kind = df.schema[column].dataType
    if not isinstance(kind, (*SKETCHED, T.StringType, T.BinaryType, T.BooleanType)):
        raise TypeError(f"rows can't be put in order by a column of type {kind.simpleString()}")


def order_rank(df: DataFrame, column: str) -> Column:
    """What stands for an orderable column when it is cut into ordered buckets."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return text_rank(df, column)
    return F.col(f"`{column}`").cast("int") if isinstance(kind, T.BooleanType) else F.col(f"`{column}`")


def bucket_count(n_rows: int, rows_per_bucket: int, most: int = 4096) -> int:
    return max(1, min(most, math.ceil(n_rows / max(1, rows_per_bucket))))


# --- ranks of hashed keys -----------------------------------------------------------------


def hash_token(key_id: Column, seed: int) -> Column:
    """A repeatable random order: md5 of key and seed, the key itself breaking ties."""
    return F.concat(F.md5(F.concat(key_id, F.lit(f":{seed}"))), F.lit(":"), key_id)


# Hex digits of a token's hash, and how many of them one counting pass takes at most (65,536 counts a stratum and rank).
HASH_DIGITS, STEP_DIGITS = 32, 4


def tokens_at_ranks(
    df: DataFrame,
    token: str,
    stratum: str,
    ranks: Mapping[int, Sequence[int]],
    n_rows: int,
    *,
    direct_limit: int = DIRECT_LIMIT,
    step_digits: int = STEP_DIGITS,
) -> dict[tuple[int, int], str]:
    """The token at each 1-based rank within each stratum.

    Hash tokens are uniform, so leading hex digits cut them into even, ordered
    buckets.  Bucket counts (few rows) show which bucket holds a rank; a bucket
    of more than ``direct_limit`` tokens is cut again on its next digits, until
    it fits.  Only what is then left, about n / 16**digits, is ordered.  A key
    so frequent that its whole hash is one large bucket is counted, not ordered.
    """
    wanted = {s: sorted({r for r in rs if r > 0}) for s, rs in ranks.items()}
    wanted = {s: rs for s, rs in wanted.items() if rs}
    if not wanted:
        return {}
    df = df.select(F.col(token).alias("t"), F.col(stratum).alias("s")).filter(F.col("s").isin(list(wanted)))
    targets = F.create_map(
        *[x for s, rs in wanted.items() for x in (F.lit(s), F.array(*[F.lit(r).cast("long") for r in rs]))]
    )
    target = F.element_at(targets, F.col("s"))
    # buckets that hold a wanted rank, with the number of the stratum's tokens before each
    depth, spots, largest = 0, {(s, ""): 0 for s in wanted}, n_rows
    inside, before = df, F.lit(0).cast("long")
    while largest > direct_limit and depth < HASH_DIGITS:
        step = 1
        while largest / 16**step > direct_limit and step < min(step_digits, HASH_DIGITS - depth):
            step += 1
        bucket, finer = F.substring("t", 1, depth), F.substring("t", 1, depth + step)
        counts = inside.groupBy("s", bucket.alias("b"), before.alias("ahead"), finer.alias("p")).agg(F.count("*").alias("n"))
        # at most 16**step rows per bucket
        upto = Window.partitionBy("s", "b").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
        located = (
            counts.withColumn("upto", F.col("ahead") + F.sum("n").over(upto))
            .withColumn("r", F.explode(target))
            .filter((F.col("r") <= F.col("upto")) & (F.col("r") > F.col("upto") - F.col("n")))
            .select("s", "p", "n", (F.col("upto") - F.col("n")).alias("before"))
            .collect()
        )
        spots = {(x["s"], x["p"]): x["before"] for x in located}
        if not spots:
            return {}
        largest, depth = max(x["n"] for x in located), depth + step
        spot = F.concat_ws("/", F.col("s").cast("string"), finer)
        names = F.create_map(*[x for (s, p), b in sorted(spots.items()) for x in (F.lit(f"{s}/{p}"), F.lit(b).cast("long"))])
        inside, before = df.filter(spot.isin([f"{s}/{p}" for s, p in sorted(spots)])), F.element_at(names, spot)

    in_bucket = Window.partitionBy("s", "b").orderBy("t")
    if largest > direct_limit:
        inside = inside.groupBy("s", "t").agg(F.count("*").alias("n"))
        last = before + F.sum("n").over(in_bucket.rowsBetween(Window.unboundedPreceding, 0))
    else:
        inside = inside.withColumn("n", F.lit(1).cast("long"))
        last = before + F.row_number().over(in_bucket)
    hits = (
        inside.withColumn("b", F.substring("t", 1, depth))
        .withColumn("last", last)
        .withColumn("r", F.explode(F.filter(target, lambda r: (r <= F.col("last")) & (r > F.col("last") - F.col("n")))))
        .select("s", "r", "t")
        .collect()
    )
    return {(h["s"], int(h["r"])): h["t"] for h in hits}
