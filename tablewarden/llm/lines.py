"""Line dedup through sharded minimal perfect hashes over repeated lines."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialise
from .words import mix

LEAST_CHARS = 10
SHARD_KEYS = 4096
SALTS = 8
NO_ID = (1 << 63) - 1
KEYS_PER_ROW = 4096


def line_key(line: bytes, least: int) -> bytes | None:
    """128-bit hash of the stripped line in lower-case ASCII; None if it is too short to count."""
    line = line.strip(b" \t\n\r\x0b\x0c").lower()
    if len(line) < least or (len(line) < 4 * least and len(line.decode("utf-8", "replace")) < least):
        return None
    return xxhash.xxh3_128_digest(line)


def _keys(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys = [], []
            for i, text in enumerate(batch["text"].cast(pa.large_binary())):
                lines = (text.as_py() or b"").split(b"\n")
                own = {k for line in lines if (k := line_key(line, least)) is not None}
                rows.append(np.full(len(own), i))
                keys.extend(own)
                if len(keys) > 50_000:
                    yield _key_rows(batch, rows, keys)
                    rows, keys = [], []
            yield _key_rows(batch, rows, keys)

    return run


def _key_rows(batch: pa.RecordBatch, rows: list, keys: list[bytes]) -> pa.RecordBatch:
    at = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64))
    both = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
    out = {"d": batch["d"].take(at), "k": batch["k"].take(at)}
    return pa.RecordBatch.from_pydict(out | {"h1": both[:, 0].copy(), "h2": both[:, 1].copy()})


def _place(h: np.ndarray, level: int, size: int) -> np.ndarray:
    return mix(h ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(size)


def build_index(h1: np.ndarray, h2: np.ndarray, owner: np.ndarray, count: np.ndarray) -> dict[str, bytes]:
    """A minimal perfect hash of the keys and the arrays that it indexes.

    Level by level, keys alone in their slot of a bit array settle there and the others go
    on; a key's index is the number of set bits before its own. ``sizes`` holds the
    levels' slots, ``bits`` all levels' bits; ``prints``, ``counts`` and ``owners`` have
    one entry per key. Keys must be distinct in (h1, h2); those that agree in h1 and so
    never part are kept in the arrays after all others.
    """
    left = np.arange(len(h1))
    sizes, bits, order = [], [], []
    while len(left) and len(sizes) < 64:
        size = 2 * len(left) + 1
        at = _place(h1[left].view(np.uint64), len(sizes), size).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        stays = alone[at]
        order.append(left[stays][np.argsort(at[stays])])
        sizes.append(size)
        bits.append(alone)
        left = left[~stays]
    order = np.concatenate([*order, left]) if len(h1) else left
    packed = np.packbits(np.concatenate(bits), bitorder="little").tobytes() if bits else b""
    return {
        "sizes": np.array(sizes, np.int64).tobytes(),
        "bits": packed,
        "prints": h2[order].tobytes(),
        "counts": count[order].astype(np.int64).tobytes(),
        "owners": owner[order].tobytes(),
    }


class Index:
    """Reads what ``build_index`` wrote."""

    def __init__(self, sizes: bytes, bits: bytes, prints: bytes, counts: bytes, owners: bytes):
        self.sizes = np.frombuffer(sizes, np.int64)
        self.bits = np.unpackbits(np.frombuffer(bits, np.uint8), count=int(self.sizes.sum()), bitorder="little")
        self.before = np.concatenate([[0], np.cumsum(self.bits, dtype=np.int64)])
        self.prints, self.owners = np.frombuffer(prints, np.int64), np.frombuffer(owners, np.int64)
        self.counts = np.frombuffer(counts, np.int64)

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Index of each key, -1 for keys that are not in."""
        out = np.full(len(h1), -1)
        left, start = np.arange(len(h1)), 0
        for level, size in enumerate(self.sizes):
            at = start + _place(h1[left].view(np.uint64), level, int(size)).astype(np.int64)
            here = self.bits[at] == 1
            out[left[here]] = self.before[at[here]]
            left, start = left[~here], start + int(size)
        for i in range(int(self.before[-1]), len(self.prints)):
            out[left[h2[left] == self.prints[i]]] = i
        out[out >= 0] = np.where(self.prints[out[out >= 0]] == h2[out >= 0], out[out >= 0], -1)
        return out


def _index_shard(table: pa.Table) -> pa.Table:
    cols = {n: table[n].to_numpy() for n in ("h1", "h2", "owner", "n")}
    blob = build_index(cols["h1"], cols["h2"], cols["owner"], cols["n"])
    return pa.table({"shard": [table["shard"][0].as_py()], **{k: [v] for k, v in blob.items()}})


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shard and salt, the shard's index before its probes."""
    index, of = None, None
    for batch in batches:
        is_index = batch["probe"].to_numpy(zero_copy_only=False) == 0
        d, k, h1, h2, shard = (batch[n].to_numpy(zero_copy_only=False) for n in ("d", "k", "h1", "h2", "shard"))
        marks = np.flatnonzero(is_index)
        edges = np.unique(np.concatenate([[0], marks, marks + 1, [len(batch)]]))
        hit = np.zeros(len(batch), bool)
        for a, b in zip(edges[:-1], edges[1:]):
            if is_index[a]:
                index = Index(*(batch[n][a].as_py() for n in ("sizes", "bits", "prints", "counts", "owners")))
                of = shard[a]
                continue
            mine = np.flatnonzero(shard[a:b] == of) + a if index else np.zeros(0, np.int64)
            at = index.find(h1[mine], h2[mine]) if len(mine) else mine
            hit[mine[(at >= 0) & (index.owners[at] != d[mine])]] = True if len(mine) else False
        both = np.stack([h1[hit], h2[hit]], 1).tobytes()
        line = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), int(hit.sum()), [None, pa.py_buffer(both)])
        yield pa.RecordBatch.from_pydict({"d": d[hit], "k": k[hit], "line": line.cast(pa.binary())})


def _keep(least: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, dropped, kept, texts = [], [], [], []
            drops = batch["drops"]
            for i, text in enumerate(batch["text"].cast(pa.large_binary())):
                body = text.as_py() or b""
                n = body.count(b"\n") + 1
                gone = set(drops[i].as_py() or ())
                if gone:
                    stay = [x for x in body.split(b"\n") if line_key(x, least) not in gone]
                    body = b"\n".join(stay)
                    dropped.append(n - len(stay))
                else:
                    dropped.append(0)
                lines.append(n)
                kept.append(hashlib.sha256(body).hexdigest())
                if with_text:
                    texts.append(body.decode("utf-8"))
            out = {"id": batch["id"], "n_lines": pa.array(lines, pa.int64()), "n_dropped": pa.array(dropped, pa.int64())}
            out |= {"kept_sha256": pa.array(kept, pa.string())}
            yield pa.RecordBatch.from_pydict(out | ({"kept": pa.array(texts, pa.string())} if with_text else {}))

    return run


def line_index(docs: DataFrame, least: int = LEAST_CHARS, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, DataFrame, int]:
    """(keys, index, shards): every document's line keys, and the shards' indexes of the keys that
    more than one document holds, with their counts and first owners."""
    keys = materialise(docs.mapInArrow(_keys(least), "d long, k long, h1 long, h2 long"), "line-keys")
    lines = keys.groupBy("h1", "h2").agg(F.min("d").alias("owner"), F.max("d").alias("_last"), F.count("*").alias("n"))
    lines = materialise(lines.where("owner <> _last").drop("_last"), "lines")
    shards = max(1, -(-lines.count() // shard_keys))
    schema = "shard long, sizes binary, bits binary, prints binary, counts binary, owners binary"
    index = lines.withColumn("shard", F.pmod(F.xxhash64("h1"), F.lit(shards))).groupBy("shard").applyInArrow(_index_shard, schema)
    return keys, materialise(index, "line-index"), shards


def drop_repeated_lines(
    docs: DataFrame, least: int = LEAST_CHARS, key: str = "doc_id", text: str = "text", with_text: bool = False
) -> DataFrame:
    """Drop lines that another document holds, except from the document with the least id.

    A line's key is the line without ASCII white space at its ends, A-Z in lower case;
    keys of fewer than ``least`` code points never go. Returns key, n_lines, n_dropped,
    kept_sha256 and, if asked, the kept text.

    * null or empty text: one empty line; a text of line breaks only: empty lines;
    * rows of one id are one document, whatever their texts, so repeats under one id
      drop nothing from each other; rows with null id are one document, last in order;
    * a line repeated within one document only stays, each time;
    * empty table: no rows. Other columns are not read.

    Documents meet an index shard (bounded keys) by probing it; a line that very many
    documents hold is probed from SALTS tasks. Rows are known by id and text hash.
    """
    rows = docs.select(
        F.col(key).alias("id"),
        F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("d"),
        F.xxhash64(text).alias("k"),
        F.col(text).alias("text"),
    )
    kind = dict(rows.dtypes)["id"]
    keys, index, shards = line_index(rows.select("d", "k", "text"), least)
    blobs = ["sizes", "bits", "prints", "counts", "owners"]
    none = [F.lit(None).cast("binary").alias(n) for n in blobs]
    zero = F.lit(0).cast("long")
    shard = F.pmod(F.xxhash64("h1"), F.lit(shards)).cast("long")
    salt = F.pmod(F.xxhash64("d"), F.lit(SALTS)).cast("int")
    probes = keys.select(shard.alias("shard"), salt.alias("salt"), F.lit(1).alias("probe"), "d", "k", "h1", "h2", *none)
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    arrays = index.select(
        "shard", every_salt.alias("salt"), F.lit(0).alias("probe"), *[zero.alias(n) for n in ("d", "k", "h1", "h2")], *blobs
    )
    dealt = arrays.union(probes).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "probe")
    hits = dealt.mapInArrow(_probe, "d long, k long, line binary")
    drops = hits.groupBy("d", "k").agg(F.collect_set("line").alias("drops"))
    joined = rows.join(drops, ["d", "k"], "left").select("id", "text", "drops")
    out = f"id {kind}, n_lines long, n_dropped long, kept_sha256 string" + ", kept string" * with_text
    return joined.mapInArrow(_keep(least, with_text), out).withColumnRenamed("id", key)
