"""Right-closed bins over given edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bin_right_closed(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the bin ``(edge, next edge]`` that holds ``c``.

    The first bin also takes its left edge; outside the edges the label is NULL.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per pair of neighbouring edges is needed")
    if any(a >= b for a, b in zip(edges, edges[1:])):
        raise ValueError("edges must rise strictly")
    out = F.when(c < F.lit(edges[0]), F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels):
        out = out.when(c <= F.lit(upper), F.lit(label))
    return out


def merge_equal_edges(edges: Sequence[float]) -> list[float]:
    return sorted(set(edges))
