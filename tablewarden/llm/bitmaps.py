"""Bitmaps of fixed size over hashed keys: a filter before a shuffle.

A bitmap of 2^bits bits is built by Spark's own bitmap aggregates and broadcast (8 MB at
26 bits, whatever the rows). It lets every listed key pass, and some others; whoever
uses it joins afterwards, so that its size decides speed alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 26
MAP_BYTES = 4096
_OPEN: list[list[Broadcast]] = []


@contextmanager
def scoped() -> Iterator[None]:
    """Bitmaps made inside are freed at the end; what used them must be written by then."""
    _OPEN.append([])
    try:
        yield
    finally:
        for made in _OPEN.pop():
            made.destroy()


def bitmap(df: DataFrame, column: str, bits: int = BITS) -> Broadcast:
    """Of the leading bits of ``column`` (a long that holds a hash)."""
    at = F.shiftrightunsigned(column, 64 - bits) + 1
    maps = df.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("map")
    )
    whole = bytearray(1 << bits - 3)
    # one job for all of them: an iterator would start one for every partition
    for r in maps.collect():
        whole[(r["bucket"] - 1) * MAP_BYTES : r["bucket"] * MAP_BYTES] = r["map"]
    made = df.sparkSession.sparkContext.broadcast(bytes(whole))
    if _OPEN:
        _OPEN[-1].append(made)
    return made


def listed(bits_of: np.ndarray, keys: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Which keys (uint64) have their bit set."""
    at = keys >> np.uint64(64 - bits)
    return (bits_of[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def only_listed(df: DataFrame, column: str, of: Broadcast, bits: int = BITS) -> DataFrame:
    """Rows whose ``column`` passes the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits_of = np.frombuffer(of.value, np.uint8)
        for batch in batches:
            keys = batch[column].to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.filter(pa.array(listed(bits_of, keys, bits)))

    return df.mapInArrow(run, df.schema)
