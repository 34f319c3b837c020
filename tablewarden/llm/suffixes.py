"""Suffix-array dedup: repeated strings of bytes from the interval tree of common prefixes.

An equal window of ``window`` bytes has the same anchor wherever it starts: the place of
its least gram hash. So only suffixes that begin at anchors are sorted, those of one gram
together, and each carries the bytes before it (as far as windows of this anchor reach).
A stack scan over the sorted suffixes' common prefixes yields the intervals of the tree;
within an interval of depth R the bytes before the anchors tell apart the maximal
repeats: members that share L bytes to the left with L + R >= window are occurrences of
one repeat of L + R bytes or more. All members of an interval meet there, not just
neighbours in the array.

Suffixes with equal bytes on both sides are counted first and sorted once. A gram with
more than GROUP different suffixes is cut by the place of the window at its anchor:
windows of a rung of places share all bytes but RUNG, so that only suffixes which share
those meet. Groups that are still too large are cut to single windows, whose members
are all alike: a count decides them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitmaps import bitmap, only_listed
from .skew import hot_keys, salted_join
from .store import materialise
from .words import Hasher, cut_rows, least_in_window, list_of, mix, slices

WINDOW = 400
GRAM = 128
GROUP = 4096
RUNG = 16
MARKS_PER_ROW = 4096
SECOND = 0x2545F4914F6CDD1D


def _anchors(window: int, gram: int):
    """Per text: bytes, digest, and its anchors: gram hash ``h``, hash ``e`` of all bytes that windows of this
    anchor cover and of its place in them, first and last window ``a`` and ``b``, place ``p``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(np.ones(256, bool))
        for batch in batches:
            for row, data, offsets in slices(batch["text"]):
                spans = hasher.spans(hasher.byte[data])
                least, place = least_in_window(spans.every(gram), window - gram + 1)
                at = np.arange(len(least))
                text = np.searchsorted(offsets, at, "right") - 1
                at = at[at + window <= offsets[text + 1]]
                new = np.ones(len(at), bool)
                new[1:] = (np.diff(at) != 1) | (np.diff(place[at]) != 0)
                a = at[new]
                b = at[np.append(new[1:], True)] if len(at) else a
                p = place[a]
                edge = mix(spans.hash(a, b + window) + (p - a).astype(np.uint64) * np.uint64(SECOND))
                owner, part, cuts = cut_rows(np.searchsorted(a, offsets), MARKS_PER_ROW)
                base = offsets[np.searchsorted(offsets, a, "right") - 1]
                small = lambda x: (x - base).astype(np.int32)
                walk = list_of(cuts, h=least[a].view(np.int64), e=edge.view(np.int64), a=small(a), b=small(b), p=small(p))
                whole = [hashlib.sha256(data[offsets[i] : offsets[i + 1]]).hexdigest() for i in range(len(offsets) - 1)]
                take = pa.array(owner + row)
                yield pa.RecordBatch.from_pydict(
                    {n: batch[n].take(take) for n in ("k1", "k2")}
                    | {
                        "part": part.astype(np.int32),
                        "n_bytes": np.diff(offsets)[owner],
                        "whole": pa.array(whole, pa.string()).take(pa.array(owner)),
                        "walk": walk,
                    }
                )

    return run


ITEM = "g long, k1 long, k2 long, p int, n long, left binary, right binary"


def _suffixes(window: int, group: int, rung: int):
    """Texts with kinds of anchors -> suffixes to sort: group, bytes before the anchor (reversed) and from it on.

    An anchor whose gram has more than ``group`` kinds comes once per rung of window places,
    in the group of those that share the bytes common to all windows of the rung.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch["text"][i].as_py() or b""
                k1, k2 = batch["k1"][i].as_py(), batch["k2"][i].as_py()
                out = []
                for x in batch["kinds"][i].as_py():
                    a, b, p, h = x["a"], x["b"], x["p"], x["h"]
                    left, right = text[a:p][::-1], text[p : b + window]
                    if x["size"] <= group:
                        out.append((h, k1, k2, p, x["n"], left, right))
                        continue
                    low, high = p - b, p - a  # places of the anchor in its windows
                    for r in range(low // rung * rung, high + 1, rung):
                        top = r + rung - 1
                        shared = hashlib.blake2b(left[:r] + right[: window - top], digest_size=8, key=h.to_bytes(8, "big", signed=True) + r.to_bytes(4, "big"))
                        g = int.from_bytes(shared.digest(), "big", signed=True)
                        out.append((g, k1, k2, p, x["n"], left[: min(top, high)], right[: window - max(r, low)]))
                for at in range(0, len(out), 1024):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, t) for v, t in zip(zip(*out[at : at + 1024]), SUFFIX_TYPES)], SUFFIX_NAMES
                    )

    return run


SUFFIX_NAMES = ["g", "k1", "k2", "p", "n", "left", "right"]
SUFFIX_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]


def _windows(window: int):
    """Suffixes of groups too large to sort -> each of their windows, with two hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.to_pylist():
                left, right = x["left"], x["right"]
                for o in range(max(0, window - len(right)), len(left) + 1):
                    d = hashlib.blake2b(left[:o][::-1] + right[: window - o], digest_size=16, salt=o.to_bytes(4, "big")).digest()
                    w1, w2 = (int.from_bytes(d[i : i + 8], "big", signed=True) for i in (0, 8))
                    out.append((w1, w2, x["k1"], x["k2"], x["n"], x["p"] - o))
            types = [pa.int64()] * 5 + [pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types], ["w1", "w2", "k1", "k2", "n", "at"])

    return run


def _common(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid)
    return low


def _sorted(groups: np.ndarray, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The array of suffixes by group and bytes, and each one's common prefix with the one before (-1: another group)."""
    order = sorted(range(len(strings)), key=lambda i: (groups[i], strings[i]))
    shared = [-1] * len(order)
    for r in range(1, len(order)):
        i, j = order[r - 1], order[r]
        if groups[i] == groups[j]:
            shared[r] = _common(strings[i], strings[j])
    return np.array(order, np.int64), np.array(shared, np.int64)


class _Least:
    """Least of any range of values."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while (step := 1 << len(self.rows) - 1) * 2 <= len(values):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-step], last[step:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of values a to b, both included."""
        level = np.log2(b - a + 1).astype(np.int64)
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            s = level == k
            out[s] = np.minimum(self.rows[k][a[s]], self.rows[k][b[s] - (1 << int(k)) + 1])
        return out


def _intervals(shared: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of the common-prefix intervals of depth ``least`` or more, inner ones first: a scan with a stack."""
    stack: list[tuple[int, int]] = []  # depth, first
    for r, depth in enumerate([*shared.tolist(), -1]):
        first = r - 1
        while stack and stack[-1][0] > depth:
            deep, first = stack.pop()
            yield deep, first, r - 1
        if depth >= least and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def _reach(window: int, order: np.ndarray, shared: np.ndarray, other: np.ndarray, other_shared: np.ndarray, longest: int) -> np.ndarray:
    """For every suffix, the deepest interval in which some other member agrees on the other side as far as the window needs (-1: none).

    ``other`` and ``other_shared`` sort the other side; left-extension diversity shows as
    common lengths below what is needed between members that are neighbours there.
    """
    rank = np.empty(len(order), np.int64)
    rank[other] = np.arange(len(other))
    least = _Least(other_shared)
    reach = np.full(len(order), -1, np.int64)
    for depth, first, last in _intervals(shared, max(0, window - longest)):
        members = order[first : last + 1]
        if (reach[members] >= 0).all():
            continue
        ranks = np.sort(rank[members])
        same = least(ranks[:-1] + 1, ranks[1:]) >= window - depth
        found = np.zeros(len(ranks), bool)
        found[1:] |= same
        found[:-1] |= same
        hit = other[ranks[found]]
        reach[hit] = np.where(reach[hit] < 0, depth, reach[hit])
    return reach


def _groups_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of whole groups from batches sorted by g; a group has a bounded number of suffixes."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        if held is not None:
            rows = pa.concat_tables([held, rows]).combine_chunks()
        last = rows["g"][len(rows) - 1]
        mine = pa.compute.equal(rows["g"], last)
        done, held = rows.filter(pa.compute.invert(mine)), rows.filter(mine)
        if len(done):
            yield done
    if held is not None:
        yield held


def _tree(window: int):
    """Sorted groups of suffixes -> for those that occur once, the bytes ``lo`` to ``hi`` that some repeat covers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups_of(batches):
            g = rows["g"].to_numpy()
            g = g - g.min() if len(g) and g.max() - g.min() > 0 else g
            left, right = rows["left"].to_pylist(), rows["right"].to_pylist()
            by_right, shared_right = _sorted(g.tolist(), right)
            by_left, shared_left = _sorted(g.tolist(), left)
            far = _reach(window, by_right, shared_right, by_left, shared_left, max(map(len, left)))
            back = _reach(window, by_left, shared_left, by_right, shared_right, max(map(len, right)))
            lone = pa.compute.equal(rows["n"], 1).to_numpy()
            hit = np.flatnonzero((far >= 0) & lone)
            rows, p = rows.take(pa.array(hit)), rows["p"].to_numpy()[hit]
            # each repeat holds the anchor, so together they cover one run of bytes
            lo, hi = (p - back[hit]).astype(np.int32), (p + far[hit]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([rows["k1"].combine_chunks(), rows["k2"].combine_chunks(), pa.array(lo), pa.array(hi)], ["k1", "k2", "lo", "hi"])

    return run


def _repeats(window: int):
    """Sorted groups of suffixes -> all maximal repeats with all their occurrences.

    A repeat is those members of an interval that agree on the left as far as the window needs
    and no further (left-extension diversity), if they come from more than one child of the
    interval (else the child has it, longer).
    """

    def named(body: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(body, digest_size=8).digest(), "big", signed=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups_of(batches):
            g = rows["g"].to_pylist()
            left, right = rows["left"].to_pylist(), rows["right"].to_pylist()
            order, shared = _sorted(g, right)
            other, other_shared = _sorted(g, left)
            rank = np.empty(len(order), np.int64)
            rank[other] = np.arange(len(other))
            least, place, out = _Least(other_shared), np.argsort(order), []
            p, n = rows["p"].to_pylist(), rows["n"].to_pylist()
            k1, k2 = rows["k1"].to_pylist(), rows["k2"].to_pylist()
            for depth, first, last in _intervals(shared, max(0, window - max(map(len, left)))):
                child = np.cumsum(np.append(0, shared[first + 1 : last + 1] == depth))
                ranks = np.sort(rank[order[first : last + 1]])
                between = least(ranks[:-1] + 1, ranks[1:])
                # members in the order of their bytes on the left: the same scan gives the repeats' left ends
                for back, i, j in _intervals(np.append(-1, between), max(0, window - depth)):
                    members = other[ranks[i : j + 1]]
                    if len(set(child[place[members] - first].tolist())) < 2:
                        continue
                    name = named(left[members[0]][:back][::-1] + right[members[0]][:depth])
                    out += [(name, back + depth, k1[m], k2[m], p[m], back) for m in members.tolist()]
            # a kind with several places is a repeat as it stands
            for m in np.flatnonzero(np.array(n) > 1).tolist():
                back = len(left[m])
                out.append((named(left[m][::-1] + right[m]), back + len(right[m]), k1[m], k2[m], p[m], back))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            names = ["repeat", "length", "k1", "k2", "p", "back"]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types], names)

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with spans -> what goes and what stays."""
    for batch in batches:
        removed, runs, kept, bodies = [], [], [], []
        for text, spans in zip(batch["text"], batch["spans"]):
            data = np.frombuffer(text.as_py() or b"", np.uint8)
            flat = spans.values
            turn = np.zeros(len(data) + 1, np.int32)
            np.add.at(turn, flat.field(0).to_numpy(zero_copy_only=False), 1)
            np.add.at(turn, flat.field(1).to_numpy(zero_copy_only=False), -1)
            gone = np.cumsum(turn[:-1]) > 0
            body = data[~gone].tobytes()
            removed.append(int(gone.sum()))
            runs.append(int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum()))
            kept.append(hashlib.sha256(body).hexdigest())
            bodies.append(body)
        yield pa.RecordBatch.from_arrays(
            [batch["k1"], batch["k2"], pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept), pa.array(bodies, pa.binary())],
            ["k1", "k2", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


class RepeatedBytes:
    """Strings of ``window`` bytes that start more than once in the texts of ``docs``.

    Equal texts are one text with a count. ``texts``: (k1, k2: hashes of a text, part, n_bytes,
    whole, walk, m), ``ids``: (id, k1, k2). Null texts are empty; other columns are not read.
    """

    def __init__(self, docs: DataFrame, window: int = WINDOW, gram: int = GRAM, key: str = "doc_id", text: str = "text"):
        self.window, self.docs, self.spark = window, docs, docs.sparkSession
        body = F.coalesce(F.col(text), F.lit("")).cast("binary")
        rows = docs.select(F.col(key).alias("id"), body.alias("text"))
        self.rows = rows.select("id", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit("again"), "text").alias("k2"), "text")
        schema = "k1 long, k2 long, part int, n_bytes long, whole string, walk array<struct<h: long, e: long, a: int, b: int, p: int>>"
        walks = self.rows.select("k1", "k2", "text").mapInArrow(_anchors(window, gram), schema)
        first = [F.first(c).alias(c) for c in ("n_bytes", "whole", "walk")]
        self.texts = materialise(walks.groupBy("k1", "k2", "part").agg(*first, F.count("*").alias("m")), "walks")
        edges = self.texts.select("k1", "k2", "m", F.inline("walk"))
        nodes = edges.groupBy("h").agg(F.sum("m").alias("n"), F.min("e").alias("e0"), F.max("e").alias("e1"))
        nodes = materialise(nodes.where("n > 1").select("h", "n", (F.col("e0") != F.col("e1")).alias("branches")), "nodes")
        self.met = materialise(salted_join(edges, nodes.select("h", "branches"), ["h"], hot_keys(nodes, ["h"]), "k1"), "edges")
        one = F.min(F.struct("k1", "k2", "a", "b", "p")).alias("one")
        self.kinds = materialise(self.met.where("branches").groupBy("h", "e").agg(F.sum("m").alias("n"), one), "kinds")

    def _texts_of(self, keys: DataFrame) -> DataFrame:
        """(k1, k2, text), each text once, of at least the texts in ``keys``."""
        passes = bitmap(keys, "k1")
        return only_listed(self.rows.select("k1", "k2", "text"), "k1", passes).groupBy("k1", "k2").agg(F.first("text").alias("text"))

    def suffixes(self) -> DataFrame:
        """A row per kind of branching anchor (rows, where it is cut by rungs)."""
        sizes = materialise(self.kinds.groupBy("h").agg(F.count("*").alias("size")), "sizes")
        sized = salted_join(self.kinds, sizes, ["h"], hot_keys(sizes, ["h"], "size"), "e")
        sources = sized.groupBy("one.k1", "one.k2").agg(F.collect_list(F.struct("h", "one.a", "one.b", "one.p", "n", "size")).alias("kinds"))
        sources = materialise(sources, "sources")
        texts = self._texts_of(sources).join(sources, ["k1", "k2"])
        return materialise(texts.mapInArrow(_suffixes(self.window, GROUP, RUNG), ITEM), "suffixes")

    def _grouped(self, suffixes: DataFrame) -> DataFrame:
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return suffixes.repartition(tasks, "g").sortWithinPartitions("g")

    def spans(self) -> DataFrame:
        """(k1, k2, lo, hi): bytes that repeats cover."""
        alike = ["k1", "k2", F.col("a").alias("lo"), (F.col("b") + self.window).alias("hi")]
        straight = self.met.where("not branches").select(*alike)
        often = self.kinds.where("n > 1").select("h", "e")
        same = salted_join(self.met.where("branches"), often, ["h", "e"], hot_keys(self.kinds, ["h", "e"]), "k1").select(*alike)
        suffixes = self.suffixes()
        large = materialise(suffixes.groupBy("g").agg(F.count("*").alias("size")).where(F.col("size") > GROUP), "large")
        out = straight.union(same)
        if not large.isEmpty():
            marked = salted_join(suffixes, large, ["g"], hot_keys(large, ["g"], "size"), "k1", "left")
            windows = marked.where("size is not null").select(*SUFFIX_NAMES)
            windows = windows.mapInArrow(_windows(self.window), "w1 long, w2 long, k1 long, k2 long, n long, at int")
            windows = materialise(windows, "windows")
            counts = materialise(windows.groupBy("w1", "w2").agg(F.sum("n").alias("n")).where("n > 1"), "counts")
            hits = salted_join(windows.where("n = 1").drop("n"), counts.select("w1", "w2"), ["w1", "w2"], hot_keys(counts, ["w1", "w2"]), "k1")
            out = out.union(hits.select("k1", "k2", F.col("at").alias("lo"), (F.col("at") + self.window).alias("hi")))
            suffixes = marked.where("size is null").select(*SUFFIX_NAMES)
        return out.union(self._grouped(suffixes).mapInArrow(_tree(self.window), "k1 long, k2 long, lo int, hi int"))

    def groups(self) -> DataFrame:
        """Maximal repeats with all occurrences: (repeat, length, k1, k2, start, n), n the copies of the text.

        A repeat reaches as far as the windows of one anchor do; a longer one is a chain of groups
        that overlap. A group that is listed has every occurrence, so rows grow with nested
        repeats; ``spans`` does not need this list. Suffixes are not cut by rungs here.
        """
        size = (F.col("b") - F.col("a") + self.window).cast("int")
        straight = self.met.where("not branches").select(F.xxhash64("h", "e").alias("repeat"), size.alias("length"), "k1", "k2", F.col("a").alias("start"), F.col("m").alias("n"))
        found = self._grouped(self.suffixes()).mapInArrow(_repeats(self.window), "repeat long, length int, k1 long, k2 long, p int, back int")
        found = found.distinct().join(self.kinds.select("h", "e", "one.k1", "one.k2", "one.p"), ["k1", "k2", "p"])
        places = self.met.select("h", "e", "k1", "k2", "p", "m")
        hot = hot_keys(self.kinds, ["h", "e"])
        found = salted_join(places, found.select("h", "e", "repeat", "length", "back"), ["h", "e"], hot, "k1")
        found = found.select("repeat", "length", "k1", "k2", (F.col("p") - F.col("back")).alias("start"), F.col("m").alias("n"))
        return straight.union(found.distinct())

    def cut(self) -> DataFrame:
        """(k1, k2, n_removed, n_spans, kept_sha256, kept) of the texts that lose bytes."""
        spans = materialise(self.spans().groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "hi")).alias("spans")), "spans")
        texts = self._texts_of(spans).join(spans, ["k1", "k2"])
        return texts.mapInArrow(_cut, "k1 long, k2 long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def drop_repeated_bytes(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, key: str = "doc_id", text: str = "text", with_text: bool = False
) -> DataFrame:
    """Remove every byte (UTF-8) inside a string of ``window`` bytes that also starts anywhere else.

    Returns key, n_bytes, n_removed, n_spans, kept_sha256 and, if asked, the kept bytes (``kept``,
    binary, as cuts may fall inside a character; null where nothing went).

    * null, empty and texts shorter than ``window``: nothing goes;
    * a string may repeat within one text and overlap itself; copies go whole, all of them;
    * repeated rows are copies of each other; null keys are kept as they are;
    * empty table: no rows. Columns other than key and text are not read.
    """
    found = RepeatedBytes(docs, window, gram, key, text)
    columns = ["k1", "k2", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_text else [])]
    changed = materialise(found.cut().select(*columns), "cut")
    texts = found.texts.where("part = 0").select("k1", "k2", "n_bytes", "whole", "m").join(changed, ["k1", "k2"], "left")
    texts = texts.select(
        "k1", "k2", "n_bytes", "m",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_removed", "n_spans")],
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
        *columns[5:],
    )
    ids = found.rows.select("id", "k1", "k2")
    hot = hot_keys(found.texts.where("part = 0"), ["k1", "k2"], "m")
    ids = ids.withColumn("spread", F.monotonically_increasing_id())
    out = salted_join(ids, texts, ["k1", "k2"], hot, "spread")
    return out.select(F.col("id").alias(key), "n_bytes", "n_removed", "n_spans", "kept_sha256", *columns[5:])
