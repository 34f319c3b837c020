"""Benchmark decontamination by winnowed fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bitmaps import bitmap, listed
from .skew import hot_keys, salted_join
from .store import materialise
from .words import Hasher, cut_rows, least_in_window, letter_words, list_of, mix, slices

WINDOW = 13
GRAM = 5
HITS_PER_ROW = 4096
SECOND = 0x51ED270B9F1C2D35


def _item_windows(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(letter_words(), lower=True)
        for batch in batches:
            for row, data, offsets in slices(batch["text"]):
                starts, ends, first = hasher.bounds(data, offsets)
                words = hasher.words(data, starts, ends)
                one, two = hasher.spans(words), hasher.spans(mix(words ^ np.uint64(SECOND)))
                least, _ = least_in_window(one.every(gram), window - gram + 1)
                wins = two.every(window)
                for i in range(len(offsets) - 1):
                    a, n = int(first[i]), int(first[i + 1] - first[i])
                    if n >= window:
                        at = np.arange(a, a + n - window + 1)
                        fp, win, length = least[at], wins[at], window
                    elif n:
                        at = np.array([a])
                        fp, win, length = one.hash(at, at + n), two.hash(at, at + n), n
                    else:
                        continue
                    yield pa.RecordBatch.from_pydict(
                        {
                            "item": pa.repeat(batch["item"][row + i], len(fp)),
                            "fp": fp.view(np.int64),
                            "win": win.view(np.int64),
                            "len": np.full(len(fp), length, np.int32),
                        }
                    )

    return run


def _document_windows(window: int, gram: int, short: list[int], items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(letter_words(), lower=True)
        bits_of = np.frombuffer(items.value, np.uint8)
        for batch in batches:
            for row, data, offsets in slices(batch["text"]):
                starts, ends, first = hasher.bounds(data, offsets)
                words = hasher.words(data, starts, ends)
                one, two = hasher.spans(words), hasher.spans(mix(words ^ np.uint64(SECOND)))
                found = []
                for length in [window, *short]:
                    fp = least_in_window(one.every(gram), window - gram + 1)[0] if length == window else one.every(length)
                    at = np.flatnonzero(listed(bits_of, fp))
                    text = np.searchsorted(first, at, "right") - 1
                    fits = at + length <= first[text + 1]
                    at, text = at[fits], text[fits]
                    found.append((text, at, fp[at], two.hash(at, at + length), np.full(len(at), length, np.int32)))
                text, at, fp, win, length = (np.concatenate(x) for x in zip(*found))
                order = np.argsort(text, kind="stable")
                text, at, fp, win, length = (x[order] for x in (text, at, fp, win, length))
                per_text = np.searchsorted(text, np.arange(len(offsets)))
                owner, part, cuts = cut_rows(per_text, HITS_PER_ROW)
                hits = list_of(
                    cuts,
                    fp=fp.view(np.int64),
                    win=win.view(np.int64),
                    start=(at - first[text]).astype(np.int64),
                    len=length,
                )
                take = pa.array(owner + row)
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": batch["row"].take(take),
                        "id": batch["id"].take(take),
                        "k": batch["k"].take(take),
                        "part": part.astype(np.int32),
                        "n_words": np.diff(first)[owner],
                        "hits": hits,
                    }
                )

    return run


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, hits, items): row, id, text hash k and n_words of every document; row, start, len of every
    window of a benchmark item found in it; row and item_id of every item so found.

    Winnowing keeps, for each run of ``window`` words, the least hash of its ``gram``-word
    grams; two texts that share such a run keep the same one. Documents' fingerprints
    pass a bitmap of the items' and are then joined with them, together with a second
    hash of the whole window, which extends the hit from the gram to the window. Items
    of fewer words are one window, fingerprinted whole.
    """
    source = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
    windows = source.mapInArrow(_item_windows(window, gram), "item string, fp long, win long, len int")
    windows = materialise(windows.select(F.coalesce("item", F.lit("null")).alias("item"), "fp", "win", "len"), "items")
    short = sorted(r["len"] for r in windows.select("len").distinct().collect() if r["len"] < window)
    found = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("id"), F.xxhash64(text).alias("k"), F.col(text).alias("text"))
    kind = dict(found.dtypes)["id"]
    schema = f"row long, id {kind}, k long, part int, n_words long, hits array<struct<fp: long, win: long, start: long, len: int>>"
    run = _document_windows(window, gram, short, bitmap(windows, "fp"))
    found = materialise(found.mapInArrow(run, schema), "documents")
    keys = ["fp", "win", "len"]
    seen = found.select("row", F.inline("hits"))
    hot = hot_keys(seen.groupBy(*keys).agg(F.count("*").alias("n")), keys)
    hits = materialise(salted_join(seen, windows.select(*keys).distinct(), keys, hot, "row"), "hits")
    items = salted_join(hits.select("row", *keys).distinct(), windows.distinct(), keys, hot, "row").select("row", "item").distinct()
    return found.where("part = 0").select("row", "id", "k", "n_words"), hits.select("row", "start", "len"), items


def contamination(
    docs: DataFrame, benchmark: DataFrame, share: int = 20, key: str = "doc_id", with_hash: bool = False, **options
) -> DataFrame:
    """key, n_words, n_hit, n_items, items_sha256, contaminated of every document (and text_hash, if asked).

    n_hit counts the words inside any window of an item. A document is contaminated if
    it has such words and they are at least one in ``share`` of its words.

    * null or empty text: no words, no hits, not contaminated; null key: kept as it is;
    * repeated rows are judged one by one; items with equal ids count once; a null
      item_id is named ``null``; items without words have no window;
    * an empty benchmark leaves every document without hits; other columns are not read.
    """
    found, hits, items = overlaps(docs, benchmark, key=key, **options)
    end = F.col("start") + F.col("len")
    before = Window.partitionBy("row").orderBy("start", "len").rowsBetween(Window.unboundedPreceding, -1)
    hits = hits.distinct().withColumn("_from", F.greatest("start", F.coalesce(F.max(end).over(before), F.lit(0).cast("long"))))
    covered = hits.groupBy("row").agg(F.sum(F.greatest(end - F.col("_from"), F.lit(0))).alias("n_hit"))
    named = items.groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    both = covered.join(named, "row")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    listed = F.coalesce("items", F.array().cast("array<string>"))
    hash_of = [F.col("k").alias("text_hash")] if with_hash else []
    return found.join(both, "row", "left").select(
        F.col("id").alias(key),
        *hash_of,
        "n_words",
        n_hit.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", listed), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, columns unchanged; rows alike in key and text fare alike."""
    judged = contamination(docs, benchmark, key=key, text=text, with_hash=True, **options)
    bad = judged.where("contaminated").select(F.col(key).alias("_k"), F.col("text_hash").alias("_h")).distinct()
    rows = docs.withColumn("_hash", F.xxhash64(text))
    kept = rows.join(bad, (rows["_hash"] == bad["_h"]) & rows[key].eqNullSafe(bad["_k"]), "left_anti")
    return kept.select(*docs.columns)
