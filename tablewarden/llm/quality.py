"""Quality scores by voting of the nearest labelled documents in a latent space of their words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import SLICE_BYTES, Hasher, letter_words, slices, space_words, text_of_word

SAMPLE = 6000
LATENT = 48
NEIGHBOURS = 25
WORDS = 8192
GRAMS = 4096
TERMS = WORDS + GRAMS
SHAPES = 8
BLOCK = 512
# rows of axes that are added up at once
NONZERO = 1 << 16


@dataclass
class Terms:
    """Of a run of texts: the terms of text i are ids[first[i]:first[i + 1]], with their counts."""

    first: np.ndarray
    ids: np.ndarray
    counts: np.ndarray
    shapes: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1

    def part(self, a: int, b: int) -> Terms:
        lo, hi = self.first[a], self.first[b]
        return Terms(self.first[a : b + 1] - lo, self.ids[lo:hi], self.counts[lo:hi], self.shapes[a:b])


def hashers() -> tuple[Hasher, Hasher]:
    """For words between white space as they are, and for letters regardless of A-Z case."""
    return Hasher(space_words()), Hasher(letter_words(), lower=True)


def term_counts(hashers: tuple[Hasher, Hasher], data: np.ndarray, offsets: np.ndarray) -> Terms:
    """Counts of the words (hashed to WORDS terms) and of the runs of three characters (to
    GRAMS further terms) of every text, case of A-Z not regarded, and word shares beside them.

    The shares: words equal to the one before, and to the one before that; repeats of any
    word seen in the text; the commonest word; capitals, other characters, digits per byte;
    and 1, so that no vector is zero.
    """
    n = len(offsets) - 1
    shapes = np.zeros((n, SHAPES), np.float32)
    shapes[:, -1] = 1
    if not len(data):
        return Terms(np.zeros(n + 1, np.int64), np.zeros(0, np.uint16), np.zeros(0, np.float32), shapes)
    plain, lower = hashers
    starts, ends, first = lower.bounds(data, offsets)
    found = [text_of_word(first) * TERMS + (lower.words(data, starts, ends) % np.uint64(WORDS)).astype(np.int64)]
    # a character begins at every byte that continues none
    at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    text = np.repeat(np.arange(n), np.diff(offsets))
    starts, ends = at[:-3], at[3:]
    same = text[starts] == text[ends - 1]
    starts, ends = starts[same], ends[same]
    gram = (lower.words(data, starts, ends) % np.uint64(GRAMS)).astype(np.int64)
    found.append(text[starts] * TERMS + WORDS + gram)
    term, counts = np.unique(np.concatenate(found), return_counts=True)
    terms = Terms(
        np.searchsorted(term, np.arange(n + 1) * TERMS), (term % TERMS).astype(np.uint16), counts.astype(np.float32), shapes
    )
    size = np.diff(offsets)
    starts, ends, first = plain.bounds(data, offsets)
    words = plain.words(data, starts, ends)
    of, many = text_of_word(first), np.maximum(np.diff(first), 1)
    for column, lag in ((0, 1), (1, 2)):
        equal = (words[lag:] == words[:-lag]) & (of[lag:] == of[:-lag])
        shapes[:, column] = np.bincount(of[lag:][equal], minlength=n) / many
    for i in range(n):
        own = words[first[i] : first[i + 1]]
        if len(own):
            c = np.unique(own, return_counts=True)[1]
            shapes[i, 2], shapes[i, 3] = 1 - len(c) / len(own), c.max() / len(own)
    capital, digit = (data > 64) & (data < 91), (data > 47) & (data < 58)
    other = (data < 128) & ~capital & ~digit & ~((data > 96) & (data < 123)) & (data != 32) & (data != 10)
    for column, which in ((4, capital), (5, other), (6, digit)):
        shapes[:, column] = np.bincount(text[which], minlength=n) / np.maximum(size, 1)
    return terms


def summed(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of rows first[i] to first[i + 1]."""
    out = np.zeros((len(first) - 1, *rows.shape[1:]), rows.dtype)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        out[some] = np.add.reduceat(rows, first[some], axis=0)
    return out


def weighted(terms: Terms, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log counts times idf, words and runs of characters at length 1 each; and the word shares."""
    w = np.log1p(terms.counts) * idf[terms.ids]
    # each text's words come before its runs
    kind = text_of_word(terms.first) * 2 + (terms.ids >= WORDS)
    norm = np.sqrt(np.bincount(kind, w.astype(np.float64) ** 2, 2 * len(terms)))
    shapes = terms.shapes.copy()
    shapes[:, :-1] = np.sqrt(shapes[:, :-1])
    shapes[:, -1] *= 0.1
    return (w / np.maximum(norm, 1e-12)[kind]).astype(np.float32), shapes


@dataclass
class Model:
    """Latent vectors of the labelled sample, and how to get there."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int

    def latent(self, terms: Terms) -> np.ndarray:
        w, shapes = weighted(terms, self.idf)
        z = shapes @ self.axes[TERMS:]
        a = 0
        while a < len(terms):
            b = max(a + 1, int(np.searchsorted(terms.first, terms.first[a] + NONZERO, "right")) - 1)
            lo, hi = terms.first[a], terms.first[b]
            z[a:b] += summed(self.axes[terms.ids[lo:hi]] * w[lo:hi, None], terms.first[a : b + 1] - lo)
            a = b
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    def scores(self, terms: Terms) -> np.ndarray:
        """The share of label 1 among the nearest labelled vectors, weighted by similarity."""
        out = np.empty(len(terms))
        for a in range(0, len(terms), BLOCK):
            near = self.latent(terms.part(a, min(a + BLOCK, len(terms)))) @ self.vectors.T
            k = min(self.neighbours, near.shape[1])
            best = np.argpartition(near, -k, axis=1)[:, -k:]
            # similarity counted from the farthest voter on, sharpened; never zero
            sim = np.take_along_axis(near, best, 1).astype(np.float64)
            weight = np.exp((sim - sim.max(1, keepdims=True)) * 20)
            out[a : a + BLOCK] = (weight * self.labels[best]).sum(1) / weight.sum(1)
        return np.clip(out, 0.0, 1.0)


def leading_axes(terms: Terms, idf: np.ndarray, latent: int, rounds: int = 8) -> np.ndarray:
    """The leading right singular vectors of the weighted counts, by subspace iteration.

    The matrix of all texts and terms is only ever held for a block of texts.
    """
    w, shapes = weighted(terms, idf)
    q = np.random.default_rng(11).normal(size=(TERMS + SHAPES, min(latent + 16, TERMS))).astype(np.float32)
    for _ in range(rounds):
        q = np.linalg.qr(q)[0]
        y = np.zeros_like(q)
        for a in range(0, len(terms), BLOCK):
            b = min(a + BLOCK, len(terms))
            lo, hi = terms.first[a], terms.first[b]
            x = np.zeros((b - a, TERMS + SHAPES), np.float32)
            x[text_of_word(terms.first[a : b + 1]), terms.ids[lo:hi]] = w[lo:hi]
            x[:, TERMS:] = shapes[a:b]
            y += x.T @ (x @ q)
        q = y
    return np.ascontiguousarray(np.linalg.svd(q, full_matrices=False)[0][:, :latent])


def train(terms: Terms, labels: np.ndarray, latent: int, neighbours: int) -> Model:
    """Truncated singular value decomposition of the sample's weighted counts."""
    if not len(terms):
        empty = hashers()
        terms, labels = term_counts(empty, np.zeros(0, np.uint8), np.zeros(2, np.int64)), np.array([0.5])
    seen = np.bincount(terms.ids, minlength=TERMS)
    idf = (np.log((1 + len(terms)) / (1 + seen)) + 1).astype(np.float32)
    model = Model(idf, leading_axes(terms, idf, latent), np.zeros((0, 0)), labels.astype(np.float64), neighbours)
    model.vectors = model.latent(terms)
    return model


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = hashers()
    for batch in batches:
        for row, data, offsets in slices(batch["text"]):
            t = term_counts(own, data, offsets)
            here, bounds = batch.slice(row, len(t)), list(zip(t.first[:-1], t.first[1:]))
            columns = {c: here[c] for c in ("o", "h", "quality")}
            columns["ids"] = pa.array([t.ids[a:b].tobytes() for a, b in bounds], pa.binary())
            columns["counts"] = pa.array([t.counts[a:b].tobytes() for a, b in bounds], pa.binary())
            columns["shapes"] = pa.array([x.tobytes() for x in t.shapes], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)


def _train(latent: int, neighbours: int):
    """All rows of the sample, in order, to the parts of the model fitted on them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, counts, shapes, labels = [], [], [], []
        for batch in batches:
            ids += batch["ids"].to_pylist()
            counts += batch["counts"].to_pylist()
            shapes += batch["shapes"].to_pylist()
            labels += batch["quality"].to_pylist()
        ends = np.cumsum([0, *(len(x) // 2 for x in ids)])
        joined = [np.frombuffer(b"".join(x), kind) for x, kind in ((ids, np.uint16), (counts, np.float32), (shapes, np.float32))]
        ids = counts = shapes = None
        model = train(Terms(ends, joined[0], joined[1], joined[2].reshape(-1, SHAPES)), np.array(labels), latent, neighbours)
        parts = {n: getattr(model, n).tobytes() for n in ("idf", "axes", "vectors", "labels")} | {"kind": model.vectors.dtype.str.encode()}
        rows = [(n, i, x[a : a + SLICE_BYTES]) for n, x in parts.items() for i, a in enumerate(range(0, len(x), SLICE_BYTES))]
        types = [pa.string(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], ["name", "part", "body"])

    return run


def held_out(key: str = "doc_id"):
    """crc32 of the key as text, mod 3, is 1; a null key counts as the empty text."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 3 == 1


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    latent: int = LATENT,
    neighbours: int = NEIGHBOURS,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> Model:
    """Fit on at most ``sample`` labelled rows that are not held out, the first in order of a hash
    of the key. Their terms (6 bytes for each different one, at most 74 KB a row) meet in one task,
    which sends the driver the axes and vectors, about 3 MB; labels other than 0 and 1 and keys
    without a document teach nothing."""
    known = labels.where(F.col(label).isin(0, 1) & ~held_out(key)).groupBy(key).agg(F.min(label).alias("quality"))
    known = known.withColumn("o", F.xxhash64(key))
    # the bound is taken among keys that have a document; only their texts are read
    chosen = known.join(docs.select(key).distinct(), key, "left_semi").orderBy("o", key).limit(sample)
    rows = docs.select(key, text).join(F.broadcast(chosen), key).select("o", F.col(text).alias("text"), "quality")
    rows = rows.withColumn("h", F.xxhash64("text"))
    kind = dict(rows.dtypes)["quality"]
    counted = rows.mapInArrow(_terms, f"o long, h long, quality {kind}, ids binary, counts binary, shapes binary")
    bounded = counted.orderBy("o", "h").limit(sample).drop("o", "h")
    first = bounded.coalesce(1).mapInArrow(_train(latent, neighbours), "name string, part int, body binary").orderBy("name", "part")
    bodies: dict[str, bytes] = {}
    for r in first.collect():
        bodies[r["name"]] = bodies.get(r["name"], b"") + r["body"]
    if not bodies:
        return train(Terms(np.zeros(1, np.int64), np.zeros(0, np.uint16), np.zeros(0, np.float32), np.zeros((0, SHAPES), np.float32)), np.zeros(0), latent, neighbours)
    idf, axes = (np.frombuffer(bodies[n], np.float32) for n in ("idf", "axes"))
    taught = np.frombuffer(bodies["labels"], np.float64)
    vectors = np.frombuffer(bodies["vectors"], bodies["kind"].decode()).reshape(len(taught), -1)
    return Model(idf, axes.reshape(TERMS + SHAPES, -1), vectors, taught, neighbours)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Add ``out`` (0 to 1, higher: label 1 likelier) to every document, columns kept.

    The sample's vectors (``SAMPLE`` x ``LATENT`` floats, about 1 MB) and the axes (``LATENT``
    floats for each term, about 2 MB) are broadcast;
    every document is compared with all of them, in blocks.

    * null text counts as empty; an empty text has the vector of no terms, whose nearest
      are the shortest texts of the sample;
    * ties: equal similarities weigh alike; repeated rows get equal scores;
    * no labels at all: every score is 0.5; empty table: no rows; a column named as
      ``out`` is replaced, all others are kept.
    """
    of = docs.sparkSession.sparkContext.broadcast((model.idf, model.axes, model.vectors, model.labels, model.neighbours))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, model = hashers(), Model(*of.value)
        for batch in batches:
            got = [model.scores(term_counts(own, data, at)) for _, data, at in slices(batch[text])]
            s = pa.array(np.concatenate(got) if got else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, s], names=[*batch.schema.names, out])

    docs = docs.drop(out)
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """key, held_out, score, predicted of every document (see ``fit`` and ``score``)."""
    scored = score(docs.select(key, text), fit(docs, labels, key=key, text=text, **options), text)
    return scored.select(key, held_out(key).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
