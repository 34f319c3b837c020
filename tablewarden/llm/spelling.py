"""Spelling variants: words within one edit of each other, found in a trie of frequency vectors.

A word's vector counts its code points by group (code point modulo GROUPS). The trie
arranges words by one count a level. One inserted code point adds one to a count, a
deleted one takes one away, a replaced one does both or neither: a search goes down the
trie with a budget of one surplus and one deficit, and words at the leaves it reaches
are compared. Counts that vary most between the words come first. To meet every pair once, a search spends its surplus first: it looks for
words that are longer by one, or that have more of the first letter group that differs.

The upper levels are walked by Spark, a few levels a round, branches without words being
cut off; a subtree that is small enough (SHARD_WORDS, and one in SHARES of all words) is
searched in one task, all its searches level by level. Subtrees that stay too large down to the leaves are cut into
parts by a hash of the word, and the searches go through every part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialise

LEAST = 7
EVERY = 31
GROUPS = 16
STEP = 2
SHARD_WORDS = 65_536
SHARES = 20
ROWS = 1 << 17
WIDE = 64
PAIRS = 1 << 16
LOWER = {c: c + 32 for c in range(65, 91)}


def _damaged_words(least: int, every: int):
    """Texts -> (word, n), summed per batch: runs of letters of which a hash of document and run may delete a letter."""
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{least},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: Counter[str] = Counter()
            for doc, text in zip(batch["doc"].to_pylist(), batch["text"]):
                text = text.as_py()
                if not text:
                    continue
                known = zlib.crc32(f"{doc}:".encode())
                own: Counter[str] = Counter()
                for word, n in Counter(runs.findall(text)).items():
                    own[word.translate(LOWER)] += n
                for word, n in own.items():
                    h = zlib.crc32(word.encode(), known)
                    if h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least:
                            continue
                    total[word] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    return run


def damaged_words(docs: DataFrame, least: int = LEAST, every: int = EVERY, often: int = 2) -> DataFrame:
    """(word, n): words of ``docs`` (doc_id, text) that occur ``often`` times, after planted deletions.

    Words are maximal runs of ``[A-Za-zÀ-ÿ]``, A-Z lower-cased. Null texts have none; a null
    doc_id is written as the empty text before the hash.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), "text")
    words = rows.mapInArrow(_damaged_words(least, every), "word string, n bigint")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= often)


def _letters(words: list[str]) -> np.ndarray:
    """Code points of words of at most WIDE, padded by 0 (no word holds it)."""
    return np.array(words, f"U{WIDE}").view(np.uint32).reshape(len(words), WIDE)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``vec``: the counts of a word's letter groups."""
    for batch in batches:
        words = batch["word"].to_pylist()
        vec = np.zeros((len(words), GROUPS), np.int32)
        short = [i for i, w in enumerate(words) if len(w) <= WIDE]
        for at in range(0, len(short), PAIRS // 4):
            some = short[at : at + PAIRS // 4]
            letters = _letters([words[i] for i in some])
            group = np.where(letters > 0, letters % GROUPS, GROUPS)
            vec[some] = np.stack([(group == g).sum(1) for g in range(GROUPS)], 1)
        for i, w in enumerate(words):
            if len(w) > WIDE:
                vec[i] = np.bincount(np.frombuffer(w.encode("utf-32-le"), np.uint32) % GROUPS, minlength=GROUPS)
        flat = pa.array(vec.ravel(), pa.int32())
        vec = pa.ListArray.from_arrays(pa.array(np.arange(len(words) + 1) * GROUPS, pa.int32()), flat)
        yield pa.RecordBatch.from_arrays([*batch.columns, vec], [*batch.schema.names, "vec"])


def _choices(state: int) -> list[tuple[list[int], int]]:
    """What a search may do in STEP levels: (differences, state after). States: 0 nothing spent, 1 the surplus, 2 both."""
    out = [([0] * STEP, state)]
    places = range(STEP)
    one = lambda *at: [next((d for p, d in at if p == i), 0) for i in places]
    if state == 0:
        out += [(one((i, 1)), 1) for i in places]
        out += [(one((i, 1), (j, -1)), 2) for i, j in combinations(places, 2)]
    if state == 1:
        out += [(one((j, -1)), 2) for j in places]
    return out


def _step(searches: DataFrame, depth: int) -> DataFrame:
    """Searches STEP levels further down; ``path`` holds the counts of the branch taken."""

    def literal(state: int):
        return F.array(*[F.struct(F.array(*[F.lit(x) for x in d]).alias("by"), F.lit(after).alias("after")) for d, after in _choices(state)])

    choice = F.when(F.col("state") == 0, literal(0)).when(F.col("state") == 1, literal(1)).otherwise(literal(2))
    counts = F.zip_with(F.slice("vec", depth + 1, STEP), F.col("go.by"), lambda a, b: a + b)
    moved = searches.withColumn("go", F.explode(choice)).withColumn("more", counts)
    moved = moved.where(~F.exists("more", lambda c: c < 0))
    return moved.select("word", "n", "vec", F.concat("path", "more").alias("path"), F.col("go.after").alias("state"))


def _one_edit(a: str, b: str) -> bool:
    """Whether b is a with one code point replaced or inserted."""
    if len(b) - len(a) not in (0, 1) or a == b:
        return False
    low, high = 0, len(a)
    while low < high:  # longest common prefix, by halves
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return a[low + (len(a) == len(b)) :] == b[low + 1 :]


def _verified(qs: pa.Array, ws: pa.Array, qi: np.ndarray, wi: np.ndarray, state: np.ndarray) -> np.ndarray:
    """Which pairs (query, word) are one edit apart; those of one vector are met from both their words and count once."""
    qs, ws = np.array(qs.to_pylist(), object), np.array(ws.to_pylist(), object)
    nq, nw = np.array([len(x) for x in qs]), np.array([len(x) for x in ws])
    more = nw[wi] - nq[qi]
    ok = ((more == 0) & (state != 1)) | ((more == 1) & (state == 1))
    short = (nq[qi] <= WIDE) & (nw[wi] <= WIDE)
    fast = np.flatnonzero(ok & short)
    a_of, b_of = (_letters([x if len(x) <= WIDE else "" for x in v]) for v in (qs, ws))
    for at in range(0, len(fast), PAIRS // 4):
        some = fast[at : at + PAIRS // 4]
        width = int(max(nq[qi[some]].max(), nw[wi[some]].max()))
        a, b = a_of[qi[some], :width], b_of[wi[some], :width]
        differ = a != b
        first = np.where(differ.any(1), differ.argmax(1), width)
        # behind the first difference b runs one place ahead of a, if it is longer
        ahead = a[:, :-1] != b[:, 1:]
        tail = (ahead & (np.arange(width - 1) >= first[:, None])).any(1)
        ok[some] = np.where(more[some] == 1, ~tail, differ.sum(1) == 1)
    for p in np.flatnonzero(ok & ~short):
        ok[p] = _one_edit(qs[qi[p]], ws[wi[p]])
    for p in np.flatnonzero(ok & (state == 0)):
        ok[p] = qs[qi[p]] < ws[wi[p]]
    return np.flatnonzero(ok)


def _matrix(rows: pa.Table) -> np.ndarray:
    return rows["vec"].combine_chunks().flatten().to_numpy().reshape(len(rows), GROUPS)


class _Trie:
    """The levels from ``depth`` on of the subtrees of some words."""

    def __init__(self, words: pa.Table, depth: int):
        self.words, self.depth, vec = words, depth, _matrix(words)
        shard = words["shard"].to_numpy()
        # subtrees by number; nodes below are numbered by parent and count
        self.top, node = np.unique(shard, return_inverse=True)
        self.levels = []
        for g in range(depth, GROUPS):
            keys, node = np.unique(node * (1 << 31) + vec[:, g], return_inverse=True)
            self.levels.append(keys)
        self.order = np.argsort(node, kind="stable")
        self.begin = np.searchsorted(node[self.order], np.arange(len(self.levels[-1]) + 1 if self.levels else len(self.top) + 1))

    def search(self, searches: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Blocks of (search, word, state) whose vectors are within the budget."""
        want, shard = _matrix(searches), searches["shard"].to_numpy()
        at = np.minimum(np.searchsorted(self.top, shard), len(self.top) - 1)
        q = np.flatnonzero(self.top[at] == shard)
        at, state = at[q], searches["state"].to_numpy()[q]
        for g, keys in zip(range(self.depth, GROUPS), self.levels):
            base, found = at * (1 << 31) + want[q, g], []
            for spent, by, then in ((0, 0, 0), (0, 1, 1), (1, 0, 1), (1, -1, 2), (2, 0, 2)):
                mine = np.flatnonzero(state == spent if by >= 0 else (state == spent) & (want[q, g] > 0))
                key = base[mine] + by
                place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[place] == key
                found.append((q[mine[hit]], place[hit], np.full(hit.sum(), then)))
            q, at, state = (np.concatenate(x) for x in zip(*found))
        size = self.begin[at + 1] - self.begin[at]
        done, total = 0, np.append(0, np.cumsum(size))
        while done < len(q):  # leaves in blocks of bounded size
            upto = max(done + 1, int(np.searchsorted(total, total[done] + PAIRS, "right")) - 1)
            n = size[done:upto]
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(q[done:upto], n), self.order[np.repeat(self.begin[at[done:upto]], n) + inner], np.repeat(state[done:upto], n)
            done = upto


def _search(depth: int):
    """Sorted subtrees, each with its words (kind 0) before its searches (kind 1) -> pairs (word, near, near_n), both ways."""

    def buffered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        some, n = [], 0
        for batch in batches:
            some.append(batch)
            n += batch.num_rows
            if n >= ROWS:
                yield pa.Table.from_batches(some).combine_chunks()
                some, n = [], 0
        if n:
            yield pa.Table.from_batches(some).combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, trie = None, None  # words of the subtree that the last rows ended in
        for rows in buffered(batches):
            words, searches = (rows.filter(pa.compute.equal(rows["kind"], k)) for k in (0, 1))
            if held is None or len(words):
                words = words if held is None else pa.concat_tables([held, words])
                trie = _Trie(words.combine_chunks(), depth) if len(words) else None
                held = words.filter(pa.compute.equal(words["shard"], rows["shard"][len(rows) - 1])).combine_chunks()
            if trie is None or not len(searches):
                continue
            ws, qs = trie.words["word"].combine_chunks(), searches["word"].combine_chunks()
            wn, qn = trie.words["n"].to_numpy(), searches["n"].to_numpy()
            for qi, wi, state in trie.search(searches):
                # only what meets is looked at letter by letter
                q_of, qi = np.unique(qi, return_inverse=True)
                w_of, wi = np.unique(wi, return_inverse=True)
                good = _verified(qs.take(pa.array(q_of)), ws.take(pa.array(w_of)), qi, wi, state)
                a, b = q_of[qi[good]], w_of[wi[good]]
                left, right = qs.take(pa.array(a)), ws.take(pa.array(b))
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([left, right]), pa.concat_arrays([right, left]), pa.array(np.concatenate([wn[b], qn[a]]))],
                    ["word", "near", "near_n"],
                )

    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, near_n) for all pairs of ``words`` (word, n; written tables) that are one edit apart, both ways."""
    spark = words.sparkSession
    vectors = materialise(words.mapInArrow(_vectors, "word string, n bigint, vec array<int>"), "vectors")
    counts = [F.col("vec")[g].cast("double") for g in range(GROUPS)]
    spread = vectors.agg(F.count("*").alias("n"), *[F.var_pop(c).alias(str(g)) for g, c in enumerate(counts)]).first()
    order = sorted(range(GROUPS), key=lambda g: (-(spread[str(g)] or 0.0), g))
    vectors = vectors.withColumn("vec", F.array(*[F.col("vec")[g] for g in order]))
    limit = min(SHARD_WORDS, max(1024, spread["n"] // SHARES))
    searches = vectors.select("word", "n", "vec", F.array().cast("array<int>").alias("path"), F.lit(0).alias("state"))
    for depth in range(STEP, GROUPS + 1, STEP):
        nodes = vectors.groupBy(F.slice("vec", 1, depth).alias("path")).agg(F.count("*").alias("size"))
        nodes = materialise(nodes, "nodes")
        searches = _step(searches, depth - STEP).join(nodes.select("path"), "path", "left_semi")
        largest = nodes.agg(F.max("size")).first()[0] or 0
        if largest <= limit or depth == GROUPS:
            break
        searches = materialise(searches, "searches")
    parts = F.ceil(F.col("size") / limit).cast("int")
    mine = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    nodes = nodes.select("path", parts.alias("parts"))
    index = vectors.withColumn("path", F.slice("vec", 1, depth))
    fields = ["word", "n", "vec", "state", "kind"]
    # only subtrees of several parts need a look at their number; they are few, and none at most depths
    many = nodes.where("parts > 1")
    if largest <= limit:
        index, searches = (x.withColumn("part", F.lit(0)) for x in (index, searches))
    else:
        index = index.join(many, "path", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("part", mine)
        searches = searches.join(many, "path", "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
    key = F.struct("path", "part")
    index = index.select(key.alias("key"), "word", "n", "vec", F.lit(0).alias("state"), F.lit(0).alias("kind"))
    searches = searches.select(key.alias("key"), "word", "n", "vec", "state", F.lit(1).alias("kind"))
    # a subtree goes by the hash of its path and part; paths of one hash would share a shard, and their words just fail the comparison
    both = index.union(searches).select(F.xxhash64("key").alias("shard"), *fields)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = both.repartition(tasks, "shard").sortWithinPartitions("shard", "kind")
    return both.mapInArrow(_search(depth), "word string, near string, near_n bigint")


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """Per word of ``words`` (word, n): form, root, n, n_near, form_n.

    The form is the near word that occurs most (ties: the smallest in code-point order), if it
    occurs ``ratio`` times as often; the root ends the chain of forms (the word itself, if it
    has no form). Words without neighbours have n_near 0. A null word is dropped; equal words are
    added up. An empty table gives no rows.
    """
    words = materialise(words.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")), "words")
    pairs = near_pairs(words)
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near")))
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    own = words.join(best, "word", "left")
    has = -F.col("best.m") >= ratio * F.col("n")
    own = own.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has, F.col("best.near")).alias("form"),
        F.when(has, -F.col("best.m")).alias("form_n"),
    )
    own = materialise(own, "forms")
    # chains at least double their reach a round; each form occurs ratio times as often, so they are short
    roots = own.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ends = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = materialise(roots.join(ends, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if roots.where("moved").isEmpty():
            break
        roots = roots.drop("moved")
    out = own.join(roots.select("word", "root"), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
