"""The largest gap between distribution functions, by branch and bound.

Values are cut into ordered cells and only counted.  At the cells' ends the gap is
known; within a cell it cannot exceed what all rows of one part falling before all
rows of the other would give.  Only cells whose bound beats the best gap found so far
are opened: large ones are cut again, and of the rest the values are ordered.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.functions.numbers import ratio
from tablewarden.session import literal_rows, written

CELLS = 1024
PIECES = 16
# cells that the driver holds at most: beyond, cells of more than ``rows_per_cell`` rows are ordered
MOST_CELLS = 1 << 16
PARTS = ("train", "val", "test")
# keeps differences and products of doubles finite; a power of two, so that no order changes
SCALE = 2.0**-14


@dataclass
class _Cell:
    """Neighbouring values of a feature: least, greatest, rows per part before them and among them."""

    lo: float
    hi: float
    before: tuple[int, ...]
    n: tuple[int, ...]
    stubborn: bool = False
    edges: tuple[float, ...] = ()

    @property
    def rows(self) -> int:
        return sum(self.n)


def _array(values: Sequence, kind: str) -> Column:
    # one text literal, folded to a constant; empty stands for NULL
    text = ",".join("" if v is None else repr(v) for v in values)
    return F.split(F.lit(text), ",").try_cast(f"array<{kind}>")


def _by_part() -> list[Column]:
    return [F.count_if(F.col("part") == j).alias(p) for j, p in enumerate(PARTS)]


def _cell_of(v: Column, lo: Column, hi: Column, n: Column) -> Column:
    """Number 0 to n + 1 of the cell of ``v`` between ``lo`` and ``hi``; never falls where v rises."""
    inside = F.coalesce(F.width_bucket(v * SCALE, lo * SCALE, hi * SCALE, n.cast("long")), F.lit(1).cast("long"))
    return F.when(v < lo, 0).when(v >= hi, n + 1).otherwise(F.greatest(F.lit(1), F.least(inside, n))).cast("int")


class KsSearch:
    """Search over ``numbers``: a column ``split`` with the three parts, and doubles without NaN.

    ``totals``: rows per feature and part.  ``best``: the largest gap of train to val and to test at
    cell ends.  ``opened`` of ``rows`` values are left, in cells of at most ``rows_per_cell``
    rows (or of one in MOST_CELLS of all rows, if that is more), which ``largest_gaps`` orders.

    A value is a row (part, v, slot): slot is the number of the cell to cut next, or -1 - id of a cell to order.
    Every round counts values per cell, with about ``cells`` rows a feature as its result (four per cell cut, where
    these are many), and drops the values of closed cells. It cuts a cell into
    parts of one width or, if that left more than three quarters of the rows together before, at
    quantiles from a sketch (one more scan), so that the rounds grow with the logarithm of the rows only.
    Once at most half of the values are left, they are written to the shared folder and later rounds read those
    alone, so that all rounds together read little more than the first.
    """

    def __init__(self, numbers: DataFrame, features: Sequence[str], rows_per_cell: int, cells: int = CELLS):
        self.names, self.cells = list(features), cells
        code = F.when(F.col("split") == PARTS[0], 0).when(F.col("split") == PARTS[1], 1).when(F.col("split") == PARTS[2], 2)
        self.numbers = numbers.select(code.alias("part"), *[F.col(f"`{f}`").alias(f"v{i}") for i, f in enumerate(features)])
        asks = []
        for i in range(len(self.names)):
            c = F.col(f"v{i}")
            finite = F.when(F.abs(c) < F.lit(math.inf), c)
            asks += [F.count_if((F.col("part") == j) & c.isNotNull()).alias(f"{p}{i}") for j, p in enumerate(PARTS)]
            asks += [F.min(finite).alias(f"lo{i}"), F.max(finite).alias(f"hi{i}")]
        row = self.numbers.agg(*asks).first()
        self.totals = {f: tuple(row[f"{p}{i}"] for p in PARTS) for i, f in enumerate(features)}
        self.features = [f for f in features if sum(self.totals[f])]
        self.best = {f: [0.0 if t and n else None for n in rest] for f in self.features for t, *rest in [self.totals[f]]}
        self.rows = sum(sum(self.totals[f]) for f in self.features)
        # the cells to cut next, with their features, and those left to order, by id
        cut: list[tuple[str, _Cell]] = []
        self._left: list[tuple[str, _Cell]] = []
        wide = []
        for i, f in enumerate(features):
            if f in self.best:
                lo, hi = row[f"lo{i}"], row[f"hi{i}"]
                v = F.col(f"v{i}")
                wide.append(F.when(v.isNotNull(), F.struct("part", v.alias("v"), F.lit(len(cut)).alias("slot"))).alias(str(i)))
                cut.append((f, _Cell(0.0 if lo is None else lo, 0.0 if hi is None else hi, (0, 0, 0), self.totals[f])))
        # values still to tell apart, and how many rows a scan of them reads
        self._values, self._read = self._long(self.numbers.select(*wide)) if wide else None, self.rows
        # so fewer than MOST_CELLS cells are cut in a round, however many rows there are
        limit = max(rows_per_cell, self.rows // MOST_CELLS)
        while cut:
            cut = self._round(cut, limit)
        self._open = [c if self._may_beat(f, c) else None for f, c in self._left]
        self.opened = sum(c.rows for c in self._open if c)

    def _fans(self, cut: Sequence[tuple[str, _Cell]]) -> list[int]:
        n = Counter(f for f, _ in cut)
        return [max(2, self.cells // n[f] - 2) for f, _ in cut]

    def _long(self, wide: DataFrame) -> DataFrame:
        """A row per struct that is not NULL. No filter is pushed below it: each round's expressions stay their own."""
        return wide.unpivot([], wide.columns, "_f", "_c").filter(F.col("_c").isNotNull()).select("_c.*")

    def _numbered(self, cut: Sequence[tuple[str, _Cell]], fans: Sequence[int], starts: Sequence[int]) -> DataFrame:
        """The values with ``k``: the number, through all cells cut, of the piece they lie in; NULL if they wait to be ordered."""
        v, slot = F.col("v"), F.col("slot")
        lo, hi = (F.get(_array(x, "double"), slot) for x in ([c.lo for _, c in cut], [c.hi for _, c in cut]))
        cell = _cell_of(v, lo, hi, F.get(_array(fans, "int"), slot))
        sketched = [i for i, (_, c) in enumerate(cut) if c.edges]
        if sketched:
            numbers, edges = dict(zip(sketched, range(len(sketched)))), []
            for i in sketched:
                own = cut[i][1].edges
                edges += [*own, *[None] * (PIECES - len(own))]
            flat, at = _array(edges, "double"), F.get(_array([numbers.get(i) for i in range(len(cut))], "int"), slot)
            passed = [F.when(F.get(flat, at * PIECES + j) <= v, 1).otherwise(0) for j in range(PIECES)]
            cell = F.when(at.isNotNull(), reduce(add, passed)).otherwise(cell)
        return self._values.select("part", "v", "slot", (F.get(_array(starts, "int"), slot) + cell).alias("k"))

    def _may_beat(self, f: str, c: _Cell) -> bool:
        t0, t1, total = c.before[0], c.before[0] + c.n[0], self.totals[f]
        for i, best in enumerate(self.best[f]):
            if best is None:
                continue
            p0, p1 = c.before[i + 1], c.before[i + 1] + c.n[i + 1]
            if max(t1 / total[0] - p0 / total[i + 1], p1 / total[i + 1] - t0 / total[0]) > best:
                return c.lo < c.hi
        return False

    def _sketch(self, cut: Sequence[tuple[str, _Cell]], fans: Sequence[int]) -> None:
        """Quantiles of the cells that cutting by width has not made smaller."""
        if not any(c.stubborn for _, c in cut):
            return
        asked = F.get(_array([1 if c.stubborn else None for _, c in cut], "int"), F.col("slot"))
        asked = self._long(self._values.select(F.when(asked.isNotNull(), F.struct("slot", "v")).alias("0")))
        shares = [j / PIECES for j in range(1, PIECES)]
        for r in asked.groupBy("slot").agg(F.percentile_approx("v", shares, 1000).alias("edges")).collect():
            step = -(-PIECES // min(PIECES, fans[r["slot"]] + 2))
            cut[r["slot"]][1].edges = tuple(dict.fromkeys(r["edges"][step - 1 :: step]))

    def _round(self, cut: list[tuple[str, _Cell]], rows_per_cell: int) -> list[tuple[str, _Cell]]:
        """Cuts ``cut``; the cells to cut next."""
        fans = self._fans(cut)
        self._sketch(cut, fans)
        starts = list(accumulate((n + 2 for n in fans), initial=0))
        numbered = self._numbered(cut, fans, starts)
        counted = numbered.groupBy("k").agg(*_by_part(), F.min("v").alias("lo"), F.max("v").alias("hi"))
        found = {r["k"]: r for r in counted.collect()}
        fresh: list[tuple[int, str, _Cell]] = []
        for slot, (f, parent) in enumerate(cut):
            before = parent.before
            for k in range(starts[slot], starts[slot + 1]):
                if (r := found.get(k)) is None:
                    continue
                cell = _Cell(r["lo"], r["hi"], before, tuple(r[p] for p in PARTS))
                cell.stubborn = not parent.edges and 4 * cell.rows > 3 * parent.rows
                before = tuple(a + b for a, b in zip(before, cell.n))
                fresh.append((k, f, cell))
                for i, best in enumerate(self.best[f]):
                    if best is not None:
                        gap = abs(before[0] / self.totals[f][0] - before[i + 1] / self.totals[f][i + 1])
                        self.best[f][i] = max(best, gap)
        following: list[int | None] = [None] * starts[-1]
        large = []
        for k, f, cell in fresh:
            if not self._may_beat(f, cell):
                continue
            if cell.rows <= rows_per_cell:
                self._left.append((f, cell))
                following[k] = -len(self._left)
            else:
                following[k] = len(large)
                large.append((f, cell))
        waits = [i if self._may_beat(f, c) else None for i, (f, c) in enumerate(self._left)]
        slot = F.coalesce(F.get(_array(following, "int"), F.col("k")), -1 - F.get(_array(waits, "int"), -1 - F.col("slot")))
        on = numbered.select("part", "v", slot.alias("slot"))
        self._values = self._long(on.select(F.when(F.col("slot").isNotNull(), F.struct("part", "v", "slot")).alias("0")))
        still = sum(c.rows for _, c in large) + sum(self._left[i][1].rows for i in waits if i is not None)
        if large and 2 * still <= self._read:
            self._values, self._read = written(self._values, "ks-search"), still
        return large

    def largest_gaps(self) -> DataFrame:
        """(feature, d_val, d_test); a gap to a part without rows is NULL."""
        known = literal_rows(
            self.numbers.sparkSession, [(f, *self.best[f]) for f in self.features], "feature string, b_val double, b_test double"
        )
        if not self.opened:
            return known.select("feature", F.col("b_val").alias("d_val"), F.col("b_test").alias("d_test"))
        numbers: list[int | None] = []
        owner, offsets = [], []
        for (f, _), cell in zip(self._left, self._open):
            numbers.append(len(owner) if cell else None)
            if cell:
                owner.append(self.names.index(f))
                offsets.append(cell.before)
        slot = F.get(_array(numbers, "int"), -1 - F.col("slot"))
        located = self._values.select("part", "v", slot.alias("slot"))
        located = located.select(F.when(F.col("slot").isNotNull(), F.struct("part", "v", "slot")).alias("0"))
        values = self._long(located).groupBy("slot", "v").agg(*_by_part())
        run = Window.partitionBy("slot").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
        feature = F.get(_array(owner, "int"), F.col("slot"))
        share = {}
        for j, p in enumerate(PARTS):
            total = F.get(_array([self.totals[f][j] if f in self.totals else None for f in self.names], "double"), feature)
            share[p] = ratio(F.sum(p).over(run) + F.get(_array([o[j] for o in offsets], "long"), F.col("slot")), total)
        upto = values.select(feature.alias("i"), *[c.alias(p) for p, c in share.items()])
        gap = lambda p: F.max(F.abs(F.col("train") - F.col(p)))
        inside = upto.groupBy("i").agg(gap("val").alias("i_val"), gap("test").alias("i_test"))
        inside = inside.withColumn("feature", F.get(F.array(*[F.lit(f) for f in self.names]), F.col("i")))
        # one row per feature on both sides; a part without rows has no best gap and no gap inside
        return known.join(F.broadcast(inside), "feature", "left").select(
            "feature", F.greatest("b_val", "i_val").alias("d_val"), F.greatest("b_test", "i_test").alias("d_test")
        )
