"""Substring dedup on a sparse De Bruijn graph of word grams."""

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
from .words import Hasher, cut_rows, least_in_window, list_of, mix, slices, space_words

WINDOW = 35
GRAM = 8
MARKS_PER_ROW = 4096
NO_ID = (1 << 63) - 1
SECOND = 0x2545F4914F6CDD1D


def _graph(window: int, gram: int):
    """Per text: its word count, the digest of all its words, and its walk through the graph.

    Each window of words has one node: the least hash of its grams, the leftmost on ties. A
    run of windows with the same node at the same place is an edge: ``h`` the node, ``e``
    the hash of all words that the run covers and the node's place in it, ``a`` and ``b``
    the run's first and last window.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(space_words())
        for batch in batches:
            for row, data, offsets in slices(batch["text"]):
                starts, ends, first = hasher.bounds(data, offsets)
                spans = hasher.spans(hasher.words(data, starts, ends))
                node, place = least_in_window(spans.every(gram), window - gram + 1)
                at = np.arange(len(node))
                text = np.searchsorted(first, at, "right") - 1
                at = at[at + window <= first[text + 1]]
                new = np.ones(len(at), bool)
                new[1:] = (np.diff(at) != 1) | (np.diff(place[at]) != 0)
                # a text's last window and the next text's first are never neighbours
                a = at[new]
                b = at[np.append(new[1:], True)] if len(at) else a
                depth = (place[a] - a).astype(np.uint64) * np.uint64(SECOND)
                edge = mix(spans.hash(a, b + window) + depth)
                per_text = np.searchsorted(a, first)
                owner, part, cuts = cut_rows(per_text, MARKS_PER_ROW)
                base = first[np.searchsorted(first, a, "right") - 1]
                walk = list_of(cuts, h=node[a].view(np.int64), e=edge.view(np.int64), a=a - base, b=b - base)
                body = data.tobytes()
                whole = [
                    hashlib.sha256(b" ".join(body[offsets[i] : offsets[i + 1]].split())).hexdigest()
                    for i in range(len(offsets) - 1)
                ]
                take = pa.array(owner + row)
                yield pa.RecordBatch.from_pydict(
                    {n: batch[n].take(take) for n in ("id", "d", "k")}
                    | {
                        "part": part.astype(np.int32),
                        "n_words": np.diff(first)[owner],
                        "whole": pa.array(whole, pa.string()).take(pa.array(owner)),
                        "walk": walk,
                    }
                )

    return run


def _unroll(window: int):
    """The windows of edges, each with two hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(space_words())
        for batch in batches:
            for row, data, offsets in slices(batch["text"]):
                starts, ends, first = hasher.bounds(data, offsets)
                words = hasher.words(data, starts, ends)
                one, two = hasher.spans(words), hasher.spans(mix(words ^ np.uint64(SECOND)))
                cut = batch["edges"][row : row + len(offsets) - 1]
                flat = cut.flatten()
                owner = np.repeat(np.arange(len(cut)), cut.value_lengths().to_numpy(zero_copy_only=False))
                a, b, n = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                size = b - a + 1
                edge = np.repeat(np.arange(len(a)), size)
                at = a[edge] + np.arange(len(edge)) - np.repeat(np.cumsum(size) - size, size)
                word = first[owner[edge]] + at
                take = pa.array(owner[edge] + row)
                yield pa.RecordBatch.from_pydict(
                    {"d": batch["d"].take(take), "k": batch["k"].take(take)}
                    | {
                        "at": at,
                        "lone": n[edge] == 1,
                        "w1": one.hash(word, word + window).view(np.int64),
                        "w2": two.hash(word, word + window).view(np.int64),
                    }
                )

    return run


def _cut(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept, texts = [], [], []
            for text, spans in zip(batch["text"].cast(pa.large_binary()), batch["spans"]):
                words = (text.as_py() or b"").split()
                flat = spans.values
                turn = np.zeros(len(words) + 1, np.int64)
                np.add.at(turn, flat.field(0).to_numpy(zero_copy_only=False), 1)
                np.add.at(turn, flat.field(1).to_numpy(zero_copy_only=False) + window, -1)
                stays = np.cumsum(turn[:-1]) == 0
                body = b" ".join([w for w, s in zip(words, stays.tolist()) if s])
                removed.append(len(words) - int(stays.sum()))
                kept.append(hashlib.sha256(body).hexdigest())
                texts.append(body.decode("utf-8") if with_text else None)
            out = {"n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(kept, pa.string())}
            out |= {"d": batch["d"], "k": batch["k"], "kept": pa.array(texts, pa.string())}
            yield pa.RecordBatch.from_pydict(out)

    return run


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(
        F.col(key).alias("id"),
        F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("d"),
        F.xxhash64(text).alias("k"),
        F.col(text).alias("text"),
    )


def repeated_spans(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(texts, spans, involved): n_words and word digest of every text; the runs of windows (first
    a, last b, by word) that start anywhere else too; the rows that may hold such runs.

    Texts are walks through a De Bruijn graph over word grams, of which only nodes that are
    the least of some window are kept, so that any two equal windows pass the same node.
    Nodes that occur once are dropped. Where all walks through a node agree in all the
    words around it the path does not branch: its windows are repeated as they stand.
    Edges that follow one another are not merged to longer paths; their windows meet by
    coordinates when the text is cut. At a branching node, equal edges are joined and
    compacted to one each; the windows of these are then unrolled from the source text at
    their coordinates, and counted.
    """
    rows = _rows(docs, key, text)
    kind = dict(rows.dtypes)["id"]
    schema = (
        f"id {kind}, d long, k long, part int, n_words long, whole string, "
        "walk array<struct<h: long, e: long, a: long, b: long>>"
    )
    texts = materialise(rows.mapInArrow(_graph(window, gram), schema), "walks")
    edges = texts.select("d", "k", F.inline("walk"))
    nodes = edges.groupBy("h").agg(F.count("*").alias("n"), F.min("e").alias("_e0"), F.max("e").alias("_e1"))
    nodes = materialise(nodes.where("n > 1").select("h", "n", (F.col("_e0") != F.col("_e1")).alias("branches")), "nodes")
    met = salted_join(edges, nodes.select("h", "branches"), ["h"], hot_keys(nodes, ["h"]), "k")
    met = materialise(met, "edges")
    straight, forks = met.where("not branches").select("d", "k", "a", "b"), met.where("branches")
    one = F.min(F.struct("d", "k", "a", "b"))
    kinds = materialise(forks.groupBy("h", "e").agg(F.count("*").alias("n"), one.alias("one")), "kinds")
    same = salted_join(forks, kinds.where("n > 1").select("h", "e"), ["h", "e"], hot_keys(kinds, ["h", "e"]), "k")
    involved = only_listed(rows, "k", bitmap(met, "k"))
    sources = kinds.groupBy("one.d", "one.k").agg(F.collect_list(F.struct("one.a", "one.b", "n")).alias("edges"))
    unrolled = involved.join(sources, ["d", "k"]).select("d", "k", "text", "edges")
    windows = materialise(
        unrolled.mapInArrow(_unroll(window), "d long, k long, at long, lone boolean, w1 long, w2 long"), "windows"
    )
    often = materialise(windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1"), "often")
    lone = windows.where("lone").drop("lone")
    again = salted_join(lone, often.select("w1", "w2"), ["w1", "w2"], hot_keys(often, ["w1", "w2"]), "k")
    spans = straight.union(same.select("d", "k", "a", "b")).union(again.select("d", "k", F.col("at"), F.col("at")))
    return texts.where("part = 0").select("id", "d", "k", "n_words", "whole"), spans, involved


def drop_repeated_spans(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    key: str = "doc_id",
    text: str = "text",
    with_text: bool = False,
) -> DataFrame:
    """Remove every word inside a run of ``window`` words that also starts anywhere else.

    Returns key, n_words, n_removed, kept_sha256 and, if asked, the kept words (``kept``: null
    where nothing went). Runs are judged on the input, so all of their places go.

    * null or empty text, or fewer than ``window`` words: nothing goes;
    * a run may repeat within one text, and overlap itself; copies of a text go whole;
    * repeated rows are copies of each other; null keys are kept as they are;
    * empty table: no rows. Other columns are not read.
    """
    texts, spans, involved = repeated_spans(docs, window, gram, key, text)
    spans = spans.groupBy("d", "k").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    changed = involved.join(spans, ["d", "k"]).select("d", "k", "text", "spans")
    changed = changed.mapInArrow(_cut(window, with_text), "n_removed long, kept_sha256 string, d long, k long, kept string")
    changed = changed.dropDuplicates(["d", "k"])
    out = texts.join(changed, ["d", "k"], "left").select(
        F.col("id").alias(key),
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
        "kept",
    )
    return out if with_text else out.drop("kept")
