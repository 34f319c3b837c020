"""Near duplicates by n-gram Jaccard similarity: group counts as points of an R-tree."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bitmaps import bitmap, listed, only_listed, scoped
from .components import components
from .running import running_sum
from .skew import hot_keys, salted_join
from .store import materialise
from .words import Hasher, mix, mix_one, slices, space_words

SHINGLE = 3
SIMILAR = (90, 100)
COORDINATES = 256
COARSE = 32
MOST_COUNT = 32767
FINE_FROM, FINE_MOST = 2048, 1 << 16
LEAF = 1024
FIRST_PAIRS = 4
LOW_MARKS = 32
NO_MARK = (1 << 63) - 1
NO_ID = (1 << 63) - 1
SECOND = 0x3C79AC492BA7B653


class Parts:
    """How sets are cut so that similar ones agree in a part.

    Sets of at most ``limits[c]`` shingles make class c. Two similar sets, the larger in class c, differ
    in at most tau shingles; cut by hash range into tau + 1 + slack parts they agree in
    at least slack + 1. Parts of one shingle or none are weak: they agree too easily. If
    a set has at most slack weak parts, one of the agreeing parts is not weak, and weak parts
    get no mark. Sets with more weak parts mark those too, and those with more than slack
    empty parts (very rare) their class as well: two sets that agree in weak, or in empty
    parts only, are both of that kind. Slack allows for the weak parts expected.
    """

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.limits = [0]
        mean = 0.85 * (den + num) / (2 * (den - num)) if den > num else 50.0
        self.weak = 1.5 * math.exp(-mean) * (1 + mean)

    def of(self, n: int) -> list[tuple[int, int, int]]:
        """(class, parts, slack) for the classes in which a set of n shingles looks for partners."""
        while self.limits[-1] < n or len(self.limits) < 3:
            low = self.limits[-1] + 1
            self.limits.append(max(low, low * 3 // 2 - 1))
        c = int(np.searchsorted(self.limits, n))
        out = [self._class(c)]
        # the least set of the next class may still be a partner
        if self.den * n >= self.num * (self.limits[c] + 1):
            if c + 1 == len(self.limits):
                low = self.limits[-1] + 1
                self.limits.append(max(low, low * 3 // 2 - 1))
            out.append(self._class(c + 1))
        return out

    def _class(self, c: int) -> tuple[int, int, int]:
        tau = 2 * self.limits[c] * (self.den - self.num) // (self.den + self.num)
        slack = 2 + int(self.weak * tau) if tau else 0
        return c, tau + 1 + slack, slack


def shingle_sets(hasher: Hasher, data: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingle hashes; fewer than k words are one shingle."""
    starts, ends, first = hasher.bounds(data, offsets)
    spans = hasher.spans(hasher.words(data, starts, ends))
    every = spans.every(k)
    for i in range(len(offsets) - 1):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= k:
            yield np.unique(every[a : b - k + 1])
        elif b > a:
            yield spans.hash(np.array([a]), np.array([b]))
        else:
            yield np.zeros(0, np.uint64)


def similar(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """Whether two sorted sets reach the similarity num / den."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if den * len(small) < num * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    inter = int(np.count_nonzero(large[at] == small))
    return den * inter >= num * (len(a) + len(b) - inter)


def _fine_counts(s: np.ndarray) -> bytes:
    """Counts of a large set in about one group for eight shingles (a power of two)."""
    groups = min(FINE_MOST, 1 << (len(s) // 8).bit_length())
    return np.bincount((s & np.uint64(groups - 1)).astype(np.int64), minlength=groups).astype(np.int32).tobytes()


def _fine_fit(num: int, den: int):
    """Pairs whose finer counts allow the overlap needed; pairs without such counts pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            passes = []
            for x, y in zip(batch["fine"], batch["fine_"]):
                if not (x.is_valid and y.is_valid):
                    passes.append(True)
                    continue
                x, y = (np.frombuffer(c.as_buffer(), np.int32) for c in (x, y))
                groups = min(len(x), len(y))
                # the finer counts are summed to the coarser
                x, y = (c.reshape(-1, groups).sum(0, dtype=np.int64) for c in (x, y))
                passes.append(int(np.minimum(x, y).sum()) * (num + den) >= num * int(x.sum() + y.sum()))
            yield batch.drop_columns(["fine", "fine_"]).filter(pa.array(passes, pa.bool_()))

    return run


def _features(k: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, parts = Hasher(space_words(), lower=True), Parts(num, den)
        mark = 0x9E3779B97F4A7C15
        for batch in batches:
            for row, data, offsets in slices(batch["text"]):
                sizes, v, v2, points, fine, marks, counts = [], [], [], [], [], [], []
                for s in shingle_sets(hasher, data, offsets, k):
                    n = len(s)
                    spread = mix(s ^ np.uint64(SECOND))
                    sizes.append(n)
                    v.append(spread.sum(dtype=np.uint64))
                    v2.append(mix(spread ^ np.uint64(mark)).sum(dtype=np.uint64))
                    count = np.bincount((s & np.uint64(COORDINATES - 1)).astype(np.int64), minlength=COORDINATES)
                    points.append(np.minimum(count, MOST_COUNT).astype(np.int16))
                    fine.append(_fine_counts(s) if n > FINE_FROM else None)
                    own = []
                    for c, p, slack in parts.of(n) if n else ():
                        part = (s >> np.uint64(32)) * np.uint64(p) >> np.uint64(32)
                        begin = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
                        total = np.add.reduceat(spread, begin)
                        made = mix(total + part[begin] * np.uint64(mark) + np.uint64(mix_one(c + 1)))
                        strong = np.diff(np.append(begin, n)) > 1
                        own.append(made[strong] if p - int(strong.sum()) <= slack else made)
                        if p - len(begin) > slack:
                            own.append(np.array([mix_one(mix_one(c + 1) ^ mark)], np.uint64))
                    counts.append(sum(map(len, own)))
                    marks.extend(own)
                n = len(sizes)
                flat = np.concatenate(marks).view(np.int64) if marks else np.zeros(0, np.int64)
                cuts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                here = batch.slice(row, n)
                yield pa.RecordBatch.from_pydict(
                    {c: here[c] for c in ("id", "d", "k")}
                    | {
                        "n": np.array(sizes, np.int64),
                        "v": np.array(v, np.uint64).view(np.int64),
                        "v2": np.array(v2, np.uint64).view(np.int64),
                        "point": pa.ListArray.from_arrays(
                            np.arange(n + 1, dtype=np.int32) * COORDINATES, np.concatenate(points)
                        ),
                        "fine": pa.array(fine, pa.binary()),
                        "marks": pa.ListArray.from_arrays(cuts, flat),
                    }
                )

    return run


def _listed_marks(groups: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits_of = np.frombuffer(groups.value, np.uint8)
        for batch in batches:
            flat = batch["marks"].flatten().to_numpy(zero_copy_only=False)
            v = np.repeat(batch["v"].to_numpy(), batch["marks"].value_lengths().to_numpy(zero_copy_only=False))
            passes = listed(bits_of, flat.view(np.uint64))
            yield pa.RecordBatch.from_pydict({"v": v[passes], "mark": flat[passes]})

    return run


def _set_of(hasher: Hasher, text: pa.Scalar, k: int) -> np.ndarray:
    data = np.frombuffer(text.as_buffer() if text.is_valid else b"", np.uint8)
    return next(shingle_sets(hasher, data, np.array([0, len(data)]), k))


def _verify(k: int, num: int, den: int):
    """Pairs (v, hub) with both texts, in runs of one hub, to pairs and whether they are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(space_words(), lower=True)
        last, own = None, None
        for batch in batches:
            linked = []
            hubs = batch["hub"].to_pylist()
            texts, others = (batch[c].cast(pa.large_binary()) for c in ("text", "hub_text"))
            for i, hub in enumerate(hubs):
                if hub != last:
                    last, own = hub, _set_of(hasher, others[i], k)
                linked.append(similar(_set_of(hasher, texts[i], k), own, num, den))
            yield pa.RecordBatch.from_pydict({"v": batch["v"], "hub": batch["hub"], "linked": pa.array(linked, pa.bool_())})

    return run


def _fit(both: tuple[np.ndarray, np.ndarray], n: np.ndarray, i: np.ndarray, j: np.ndarray, num: int, den: int) -> np.ndarray:
    """Summed coordinate minima of points i and j, -1 where they are below the overlap needed.

    ``both`` has sums of neighbouring coordinates, compared first, and the points. Sets so large that a coordinate
    may not hold its count pass.
    """
    out = np.full(len(i), -1)
    need, free = num * (n[i] + n[j]), np.minimum(n[i], n[j]) > MOST_COUNT
    at = np.arange(len(i))
    for p in both:
        most = np.minimum(p[i[at]], p[j[at]]).sum(1, dtype=np.int64)
        out[at] = np.where((most * (num + den) >= need[at]) | free[at], most, -1)
        at = np.flatnonzero(out >= 0)
    return out


def _met_before(low: np.ndarray, mark: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs are known to share a mark less than this one: there they are listed already."""
    out = np.zeros(len(i), bool)
    for c in range(0, len(i), 4096):
        a, b = low[i[c : c + 4096]], low[j[c : c + 4096]]
        # lists end in NO_MARK, which is less than no mark
        both = (a[:, :, None] == b[:, None, :]) & (a < mark[i[c : c + 4096], None])[:, :, None]
        out[c : c + 4096] = both.any((1, 2))
    return out


def _columns(batch) -> tuple:
    mark, v, label, n = (batch[c].to_numpy(zero_copy_only=False) for c in ("mark", "v", "label", "n"))

    def matrix(name: str, width: int) -> np.ndarray:
        lists = batch[name]
        flat = (lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists).flatten()
        return flat.to_numpy(zero_copy_only=False).reshape(-1, width)

    points = matrix("point", COORDINATES)
    return mark, v, label, n, matrix("low", LOW_MARKS), (points.reshape(-1, COARSE, COORDINATES // COARSE).sum(2, dtype=np.int32), points)


def _small_groups(num: int, den: int):
    """Rows sorted by mark to pairs of one mark, of different labels, that pass the bound.

    Each row is compared with the next of its mark, then the next but one, all rows at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
            marks = table["mark"].to_numpy()
            # the last mark may go on in the next batch
            whole = int(np.searchsorted(marks, marks[-1])) if len(marks) else 0
            rest = table.slice(whole)
            if whole:
                yield _pairs_of(table.slice(0, whole), num, den)
        if rest is not None:
            yield _pairs_of(rest, num, den)

    return run


def _pairs_of(table: pa.Table, num: int, den: int) -> pa.RecordBatch:
    mark, v, label, n, low, points = _columns(table)
    at, step, found = np.arange(len(mark)), 1, []
    while True:
        at = at[at + step < len(mark)]
        at = at[mark[at] == mark[at + step]]
        if not len(at):
            break
        i = at[label[at] != label[at + step]]
        for c in range(0, len(i), 8192):
            k = i[c : c + 8192]
            most = _fit(points, n, k, k + step, num, den)
            k, most = k[most >= 0], most[most >= 0]
            new = ~_met_before(low, mark, k, k + step)
            found.append((k[new], k[new] + step, most[new]))
        step += 1
    return _pair_rows(v, label, found)


def _pair_rows(v: np.ndarray, label: np.ndarray, found: list) -> pa.RecordBatch:
    none = np.zeros(0, np.int64)
    i, j, most = (np.concatenate(c) for c in zip(*found)) if found else (none, none, none)
    # by the order of the sets' ids, so that a pair found twice is one row
    swap = v[i] > v[j]
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    return pa.RecordBatch.from_pydict({"a": v[i], "b": v[j], "la": label[i], "lb": label[j], "most": most})


def _leaf_pair(num: int, den: int):
    """Points of two leaves, or of one, to pairs of different labels that pass the bound."""

    def run(table: pa.Table) -> pa.Table:
        leaf = table["leaf"].to_numpy()
        mark, v, label, n, low, points = _columns(table)
        first, second = np.flatnonzero(leaf == leaf.min()), np.flatnonzero(leaf == leaf.max())
        found = []
        for i in first:
            others = second[second > i] if leaf.min() == leaf.max() else second
            others = others[label[others] != label[i]]
            most = _fit(points, n, np.full(len(others), i), others, num, den)
            others, most = others[most >= 0], most[most >= 0]
            new = ~_met_before(low, mark, np.full(len(others), i), others)
            found.append((np.full(int(new.sum()), i), others[new], most[new]))
        return pa.Table.from_batches([_pair_rows(v, label, found)])

    return run


PAIR = "a long, b long, la long, lb long, most long"


def _box(table: pa.Table) -> pa.Table:
    """The box of a leaf (LEAF points at most): sizes, greatest counts, labels."""
    points = table["point"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, COORDINATES)
    ends = {f"{name}": [fn(table[c]).as_py()] for name, fn, c in (
        ("lo", pa.compute.min, "n"), ("hi", pa.compute.max, "n"), ("l0", pa.compute.min, "label"), ("l1", pa.compute.max, "label"))}
    box = pa.array([points.max(0)], pa.list_(pa.int16()))
    one = {"mark": table["mark"][:1], "leaf": table["leaf"][:1], "lo": ends["lo"], "hi": ends["hi"], "box": box, "l0": ends["l0"], "l1": ends["l1"]}
    return pa.table(one)


def _tree_pairs(members: DataFrame, points: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of different labels that the R-trees let pass: (mark, v, label) and (v, n, point) to
    (a, b, la, lb, most).

    One tree per mark. Its points are packed by size into leaves of LEAF points; a
    leaf's box has the greatest count of every coordinate and the range of sizes. Pairs of
    leaves go on only if the summed minima of their boxes allow the overlap that the
    least sizes need; then points are compared in the same way. A tree of one leaf
    (most are) needs no boxes. Two sets share many marks: every set carries its
    LOW_MARKS least ones, and a pair is listed only where these show no lesser one in common,
    so about once.
    """
    low = F.sort_array(F.collect_list("mark"))
    low = F.slice(F.concat(low, F.array_repeat(F.lit(NO_MARK), LOW_MARKS)), 1, LOW_MARKS)
    members = materialise(members.join(points.join(members.groupBy("v").agg(low.alias("low")), "v"), "v"), "members")
    sizes = materialise(members.groupBy("mark").agg(F.count("*").alias("_n")).where(F.col("_n") > LEAF), "large")
    small = members.join(sizes, "mark", "left_anti").select("mark", "v", "label", "n", "point", "low")
    found = small.repartition("mark").sortWithinPartitions("mark").mapInArrow(_small_groups(num, den), PAIR)
    once = [F.first(c).alias(c) for c in ("la", "lb", "most")]
    if sizes.isEmpty():
        return found.groupBy("a", "b").agg(*once)

    large = materialise(members.join(sizes.select("mark"), "mark").withColumn("one", F.lit(1)), "large-members")
    packed = running_sum(large, ["mark"], "n", ["v"], "one", "_at")
    packed = materialise(packed.withColumn("leaf", F.floor(F.col("_at") / LEAF)), "leaves")
    boxes = packed.select("mark", "leaf", "n", "label", "point").groupBy("mark", "leaf").applyInArrow(
        _box, "mark long, leaf long, lo long, hi long, box array<smallint>, l0 long, l1 long"
    )
    boxes = materialise(boxes, "boxes")
    other = boxes.select("mark", *[F.col(c).alias(f"{c}_") for c in ("leaf", "lo", "hi", "box", "l0", "l1")])
    pairs = boxes.join(other, "mark").where(
        (F.col("leaf") <= F.col("leaf_"))
        & (F.col("hi") * den >= F.col("lo_") * num)
        & (F.col("hi_") * den >= F.col("lo") * num)
        & (F.least("l0", "l0_") != F.greatest("l1", "l1_"))
        & (
            (_bound("box", "box_") * (num + den) >= (F.col("lo") + F.col("lo_")) * num)
            | (F.least("hi", "hi_") > MOST_COUNT)
        )
    )
    pairs = pairs.select("mark", F.col("leaf").alias("p"), F.col("leaf_").alias("q"))
    sides = pairs.withColumn("leaf", F.explode(F.array_distinct(F.array("p", "q"))))
    met = sides.join(packed.select("mark", "leaf", "v", "label", "n", "point", "low"), ["mark", "leaf"])
    found = found.union(met.groupBy("mark", "p", "q").applyInArrow(_leaf_pair(num, den), PAIR))
    return found.groupBy("a", "b").agg(*once)


def _bound(a: str, b: str):
    """The sum of coordinate minima of two count vectors."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.least(x, y)), F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))


def _verified(pairs: DataFrame, own: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Pairs (v, hub) with linked, judged on the whole sets of the texts in ``own`` (v, text)."""
    hubs = own.select(F.col("v").alias("hub"), F.col("text").alias("hub_text"))
    hot = hot_keys(pairs.groupBy("hub").agg(F.count("*").alias("n")), ["hub"])
    both = salted_join(pairs.join(own, "v"), hubs, ["hub"], hot, "v")
    schema = "v long, hub long, linked boolean"
    return both.select("v", "hub", "text", "hub_text").mapInArrow(_verify(k, num, den), schema)


def labelled_classes(docs: DataFrame, shingle: int, similar_at: tuple[int, int], key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(documents, classes): id, d, k, set size n and class v of every document; label (the
    component) and least id of every class. See ``near_duplicates``."""
    num, den = similar_at
    rows = docs.select(
        F.col(key).alias("id"),
        F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("d"),
        F.xxhash64(text).alias("k"),
        F.col(text).alias("text"),
    )
    kind = dict(rows.dtypes)["id"]
    schema = f"id {kind}, d long, k long, n long, v long, v2 long, point array<smallint>, fine binary, marks array<long>"
    found = materialise(rows.mapInArrow(_features(shingle, num, den), schema), "sets")
    some = found.where("n > 0")
    classes = some.groupBy("v").agg(F.min("d").alias("least"), F.min(F.struct("d", "k", "n", "point", "fine")).alias("one"))
    classes = materialise(classes.select("v", "least", "one.*"), "classes")

    marks = some.select("v", F.explode("marks").alias("mark"))
    groups = marks.groupBy("mark").agg(F.min("v").alias("hub"), F.max("v").alias("_last"), F.count("*").alias("n"))
    groups = materialise(groups.where("hub <> _last").drop("_last"), "groups")
    # few marks are shared: a bitmap keeps most of the others out of the second shuffle
    with scoped():
        shared = some.select("v", "marks").mapInArrow(_listed_marks(bitmap(groups, "mark")), "v long, mark long")
        met = salted_join(shared, groups.select("mark", "hub"), ["mark"], hot_keys(groups, ["mark"]), "v")
        met = materialise(met.where("v <> hub").distinct(), "met")

    points = classes.select("v", "n", "point")
    pairs = met.select("v", "hub").distinct().join(points, "v").join(
        points.select(*[F.col(c).alias(x) for c, x in (("v", "hub"), ("n", "_n"), ("point", "_point"))]), "hub"
    )
    likely = (
        (F.col("n") * den >= F.col("_n") * num)
        & (F.col("_n") * den >= F.col("n") * num)
        & (
            (_bound("point", "_point") * (num + den) >= (F.col("n") + F.col("_n")) * num)
            | (F.least("n", "_n") > MOST_COUNT)
        )
    )
    fines = classes.where("fine is not null").select("v", "fine")
    any_fine = not fines.isEmpty()

    def finer(pairs: DataFrame, a: str, b: str) -> DataFrame:
        if not any_fine:
            return pairs
        for side, name in ((a, "fine"), (b, "fine_")):
            pairs = pairs.join(fines.select(F.col("v").alias(side), F.col("fine").alias(name)), side, "left")
        schema = T.StructType([f for f in pairs.schema.fields if f.name not in ("fine", "fine_")])
        return pairs.mapInArrow(_fine_fit(num, den), schema)

    pairs = materialise(finer(pairs.where(likely).select("v", "hub"), "v", "hub"), "pairs")
    needed = classes.select("v", "d", "k")

    def texts_of(pairs: DataFrame, a: str, b: str) -> DataFrame:
        wanted = pairs.select(F.col(a).alias("v")).union(pairs.select(F.col(b).alias("v"))).distinct().join(needed, "v")
        wanted = materialise(wanted, "wanted")
        # both sides of a pair read the texts: written once, the documents are searched once, and the plans stay short
        with scoped():
            texts = only_listed(rows, "k", bitmap(wanted, "k")).select("d", "k", "text").dropDuplicates(["d", "k"])
            return materialise(wanted.join(texts, ["d", "k"]).select("v", "text"), "texts")

    def linked(pairs: DataFrame) -> DataFrame:
        checked = _verified(pairs, texts_of(pairs, "v", "hub"), shingle, num, den)
        return materialise(checked.where("linked").select(F.col("v").alias("a"), F.col("hub").alias("b")), "links")

    links = linked(pairs)
    labels = components(links)

    # every group's members are decided against its hub; what is left are pairs among the others
    label = F.coalesce("label", "v")
    labelled = materialise(met.select("mark", "v").join(labels, "v", "left").withColumn("label", label), "labelled")
    mixed = labelled.groupBy("mark").agg(F.min("label").alias("_l0"), F.max("label").alias("_l1"), F.count("*").alias("n"))
    mixed = materialise(mixed.where("_l0 <> _l1").select("mark", "n"), "mixed")
    left = not mixed.isEmpty()
    if left:
        members = salted_join(labelled, mixed.select("mark"), ["mark"], hot_keys(mixed, ["mark"]), "v")
        waiting = materialise(finer(_tree_pairs(members, points, num, den), "a", "b"), "waiting")
    most = FIRST_PAIRS
    while left and not waiting.isEmpty():
        # the likeliest pairs of any two components first: most of the others then need no check
        place = F.row_number().over(Window.partitionBy("la", "lb").orderBy(F.desc("most"), "a", "b"))
        ranked = materialise(waiting.withColumn("_at", place), "ranked")
        now = ranked.where(F.col("_at") <= most).select(F.col("a").alias("v"), F.col("b").alias("hub"))
        more = linked(now)
        waiting = ranked.where(F.col("_at") > most).drop("_at", "la", "lb")
        if not more.isEmpty():
            links = materialise(links.union(more), "links")
            labels = components(links)
        for side, name in (("a", "la"), ("b", "lb")):
            of = labels.select(F.col("v").alias(side), F.col("label").alias(name))
            waiting = waiting.join(of, side, "left").withColumn(name, F.coalesce(name, side))
        waiting = materialise(waiting.where("la <> lb").select("a", "b", "la", "lb", "most"), "waiting")
        most *= 8

    named = classes.join(labels, "v", "left").withColumn("label", F.coalesce("label", "v"))
    return found.drop("marks", "point", "fine"), named.select("v", "label", "least")


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    similar_at: tuple[int, int] = SIMILAR,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """key, n_shingles, component_id of every document, and class_id (equal for equal sets).

    A document's set holds the distinct ``shingle``-word runs of its A-Z lower-cased words; two
    documents link if their sets' Jaccard similarity is at least num/den of ``similar_at``.
    component_id is the least key reachable by links.

    Equal sets become one class. Classes meet where a part of their sets agrees (see
    ``Parts``: no link can be missed); in each such group the least class is the hub, and
    components are formed from the links to hubs. Groups that still hold different
    components go through an R-tree of count vectors (shingles hashed into COORDINATES
    groups), which lists no pairs within a component. A pair is verified on its whole
    sets only if the summed minima of its two vectors reach the overlap needed, and the
    likeliest pairs of any two components first, so that most others need no check.

    * null text and texts without words: empty set, linked with nothing, not even each
      other; component_id is the row's own key; fewer words than ``shingle``: one shingle;
    * null keys: kept; a component's id is its least key that is not null, or null;
    * repeated rows and copies are one class, which is not expanded into pairs;
    * empty table: no rows. Other columns are not read.
    """
    found, named = labelled_classes(docs, shingle, similar_at, key, text)
    some = found.where("n > 0")
    least = named.groupBy("label").agg(F.min("least").alias("component"))
    of_class = named.join(least, "label").select("v", "component")
    hot = hot_keys(some.groupBy("v").agg(F.count("*").alias("n")), ["v"])
    full = salted_join(some.select("id", "n", "v", "k"), of_class, ["v"], hot, "k")
    component = F.when(F.col("component") < NO_ID, F.col("component"))
    full = full.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("v").alias("class_id"))
    none = found.where("n = 0").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.col("id").cast("long").alias("component_id"),
        F.lit(None).cast("long").alias("class_id"),
    )
    return full.union(none)


def keep_one(
    docs: DataFrame, shingle: int, similar_at: tuple[int, int], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One document of each component, the one with the least key (then text hash); columns unchanged.

    Of equal rows one stays. Documents without words are alike to nothing and all stay.
    """
    found, named = labelled_classes(docs, shingle, similar_at, key, text)
    some = found.where("n > 0")
    hot = hot_keys(some.groupBy("v").agg(F.count("*").alias("n")), ["v"])
    of = salted_join(some.select("v", "d", "k"), named.select("v", "label"), ["v"], hot, "k")
    first = of.groupBy("label").agg(F.min(F.struct("d", "k")).alias("one")).select(F.col("one.d").alias("_d"), F.col("one.k").alias("_k"))
    chosen = first.withColumn("_words", F.lit(True)).union(
        found.where("n = 0").select("d", "k").distinct().withColumn("_words", F.lit(False))
    )
    own = docs.withColumn("_d", F.coalesce(F.col(key).cast("long"), F.lit(NO_ID))).withColumn("_k", F.xxhash64(text))
    met = own.join(chosen, ["_d", "_k"])
    place = F.row_number().over(Window.partitionBy("_d", "_k").orderBy(F.lit(1)))
    return met.withColumn("_at", place).where("_at = 1 or not _words").select(*docs.columns)
