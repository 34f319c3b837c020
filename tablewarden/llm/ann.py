"""Approximate nearest neighbours: a robust-pruned directed graph in every shard."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import materialise

SHARD_ROWS = 4096
QUERY_BLOCK = 2048
DEGREE = 32
BEAM = 64
RELAX = 1.2
ASKED_RELAX = 2.0
ROUNDS = 2
STARTS = 16
AT_ONCE = 4
BATCH = 256


def unit_scaled(x: np.ndarray, axis: int | None = None) -> np.ndarray:
    """Times a power of two (one for all, or one along ``axis``), so that the largest component lies in [0.5, 1): no
    product ranks otherwise, and no finite double leaves the range of float32."""
    top = np.max(np.abs(x), axis=axis, keepdims=axis is not None, initial=0.0)
    return np.ldexp(x, -np.frexp(top)[1])


def lifted(x: np.ndarray) -> np.ndarray:
    """Vectors with one more component, so that all have one length: the largest inner product
    with a query is then the least distance to it."""
    sq = (x.astype(np.float64) ** 2).sum(1)
    return np.hstack([x, np.sqrt(np.maximum(sq.max() - sq, 0))[:, None]]).astype(np.float32)


def beam_search(
    x: np.ndarray, sq: np.ndarray, graph: np.ndarray, starts: np.ndarray, q: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """For every row of ``q`` the ``beam`` nearest points met on the way from ``starts`` (at most ``beam``, all
    different): ids (-1: none), distances.

    All queries advance together: each step opens the AT_ONCE nearest points that are not
    open yet and merges their neighbours into the beam.
    """
    n, rows = len(q), np.arange(len(q))[:, None]
    ids = np.full((n, beam), -1)
    dist = np.full((n, beam), np.inf, np.float32)
    opened = np.zeros((n, beam), bool)
    seen = np.zeros((n, len(x)), bool)
    ids[:, : len(starts)] = starts
    dist[:, : len(starts)] = sq[starts] - 2 * (q @ x[starts].T)
    seen[:, starts] = True
    live = np.arange(n)
    while len(live):
        r = rows[: len(live)]
        own = np.where(opened[live] | (ids[live] < 0), np.inf, dist[live])
        pick = np.argpartition(own, min(AT_ONCE, beam) - 1, axis=1)[:, :AT_ONCE]
        fit = np.isfinite(own[r, pick])
        more = fit.any(1)
        live, pick, fit = live[more], pick[more], fit[more]
        if not len(live):
            break
        r = rows[: len(live)]
        opened[live[:, None], pick] |= fit
        near = np.where(fit[:, :, None], graph[ids[live[:, None], pick]], -1).reshape(len(live), -1)
        near = np.sort(near, axis=1)
        new = (near >= 0) & ~seen[live[:, None], near]
        new[:, 1:] &= near[:, 1:] != near[:, :-1]
        near = np.where(new, near, 0)
        d = sq[near] - 2 * np.einsum("brd,bd->br", x[near], q[live])
        d[~new] = np.inf
        # marking id 0 for masked places must not hide it: only new ids are marked
        at = np.nonzero(new)
        seen[live[at[0]], near[at]] = True
        all_d = np.hstack([dist[live], d])
        keep = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
        all_i = np.hstack([ids[live], np.where(new, near, -1)])
        all_o = np.hstack([opened[live], np.zeros_like(new)])
        dist[live], ids[live], opened[live] = all_d[r, keep], all_i[r, keep], all_o[r, keep]
    order = np.argsort(dist, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)


def robust_prune(
    x: np.ndarray, points: np.ndarray, cand: np.ndarray, degree: int, relax: float, seen_from: np.ndarray | None = None
) -> np.ndarray:
    """Out-edges of each point from its candidates (-1: none): take the nearest, drop every candidate
    that lies ``relax`` times nearer to it than to the point (or the place given for it), and so on."""
    b, c = cand.shape
    vec = x[np.maximum(cand, 0)]
    diff = vec - (x[points] if seen_from is None else seen_from)[:, None, :]
    d = np.einsum("bcd,bcd->bc", diff, diff)
    bad = (cand < 0) | (cand == points[:, None])
    d[bad] = np.inf
    sq = np.einsum("bcd,bcd->bc", vec, vec)
    between = np.maximum(sq[:, :, None] + sq[:, None, :] - 2 * np.matmul(vec, vec.transpose(0, 2, 1)), 0)
    out = np.full((b, degree), -1)
    left, rows = d.copy(), np.arange(b)
    for i in range(min(degree, c)):
        pick = np.argmin(left, axis=1)
        fit = np.isfinite(left[rows, pick])
        if not fit.any():
            break
        out[fit, i] = cand[fit, pick[fit]]
        near = between[rows, pick] * (relax * relax) <= d
        left[near] = np.inf
        left[rows, pick] = np.inf
    return out


def starts_of(x: np.ndarray, entry: int, most: int = STARTS) -> np.ndarray:
    """Where searches begin: the entry point and the longest vectors (those with the least lift)."""
    longest = np.argsort(x[:, -1], kind="stable")[:most]
    return np.concatenate([[entry], longest[longest != entry][: most - 1]])


def build_graph(vectors: np.ndarray, degree: int = DEGREE, beam: int = BEAM, relax: float = RELAX) -> tuple[np.ndarray, int]:
    """(neighbours, entry point) of the graph over all vectors, which should be distinct.

    Points come in batches: a greedy search over the graph so far proposes neighbours,
    which are pruned; edges are added both ways, and full lists pruned again.

    Queries carry no lift, so they lie off the points' sphere, and what they look for is seldom near to what they meet on
    it. So every point then asks like a query, in ROUNDS rounds over the graph so far: the pruned answers (with
    ASKED_RELAX, as all of them are far from who asks) are further edges.
    """
    x = lifted(vectors)
    n = len(x)
    sq = np.einsum("nd,nd->n", x, x)
    graph, entry = _sphere_graph(x, sq, degree, beam, relax)
    asker = x.copy()
    asker[:, -1] = 0
    starts, asked = starts_of(x, entry, min(STARTS, beam)), np.full((n, 0), -1)
    for _ in range(ROUNDS):
        edges, over = np.full((n, degree), -1), np.hstack([graph, asked])
        for a in range(0, n, BATCH):
            own = np.arange(a, min(n, a + BATCH))
            cand, _ = beam_search(x, sq, over, starts, asker[own], beam)
            edges[own] = robust_prune(x, own, cand, degree, ASKED_RELAX, asker[own])
        asked = edges
    return np.hstack([graph, asked]).astype(np.int32), entry


def _sphere_graph(x: np.ndarray, sq: np.ndarray, degree: int, beam: int, relax: float) -> tuple[np.ndarray, int]:
    n = len(x)
    centre = x.mean(0)
    entry = int(np.argmin(sq - 2 * (x @ centre)))
    order = np.random.default_rng(n).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    wide = 2 * degree
    graph, fill = np.full((n, wide), -1), np.zeros(n, np.int64)
    done, size = 1, 16
    while done < n:
        batch = order[done : done + size]
        cand, _ = beam_search(x, sq, graph, order[:1], x[batch], beam)
        # points of one batch may be each other's nearest too
        mates = np.repeat(batch[None, :], len(batch), 0)
        near = sq[mates] - 2 * (x[batch] @ x[batch].T)
        np.fill_diagonal(near, np.inf)
        k = min(degree, len(batch) - 1)
        if k > 0:
            cand = np.hstack([cand, np.take_along_axis(mates, np.argpartition(near, k - 1, axis=1)[:, :k], 1)])
        edges = robust_prune(x, batch, cand, degree, relax)
        graph[batch, :degree], fill[batch] = edges, (edges >= 0).sum(1)
        source, to = np.repeat(batch, degree)[edges.ravel() >= 0], edges.ravel()[edges.ravel() >= 0]
        by = np.argsort(to, kind="stable")
        source, to = source[by], to[by]
        while len(to):
            place = fill[to] + np.arange(len(to)) - np.searchsorted(to, to)
            fits = place < wide
            graph[to[fits], place[fits]] = source[fits]
            fill[:] = np.maximum(fill, np.bincount(to[fits], minlength=n) + fill)
            source, to = source[~fits], to[~fits]
            full = np.flatnonzero(fill >= wide)
            if len(full):
                for a in range(0, len(full), BATCH):
                    own = full[a : a + BATCH]
                    pruned = robust_prune(x, own, graph[own], degree, relax)
                    graph[own] = np.hstack([pruned, np.full((len(own), wide - degree), -1)])
                    fill[own] = (pruned >= 0).sum(1)
        done += len(batch)
        size = min(2 * size, BATCH)
    return graph, entry


def _index(degree: int, beam: int, relax: float):
    def run(table: pa.Table) -> pa.Table:
        ids = table["vec_id"].to_numpy()
        order = np.argsort(ids)
        dim = table["dim"][0].as_py()
        flat = table["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        x = flat.reshape(len(ids), dim)[order]
        graph, entry = build_graph(unit_scaled(x).astype(np.float32), degree, beam, relax)
        cells = {"ids": ids[order].tobytes(), "vectors": x.tobytes(), "graph": graph.tobytes()}
        return pa.table(
            {"dim": pa.array([dim], pa.int32()), "shard": [table["shard"][0].as_py()], "entry": [entry]} | {k: [v] for k, v in cells.items()}
        )

    return run


def _search(k: int, beam: int):
    def run(shard: pa.Table, queries: pa.Table) -> pa.Table:
        none = np.zeros(0, np.int64)
        found = [(none, none, np.zeros(0))]
        for at in range(shard.num_rows if queries.num_rows else 0):
            dim = shard["dim"][at].as_py()
            ids = np.frombuffer(shard["ids"][at].as_py(), np.int64)
            vectors = np.frombuffer(shard["vectors"][at].as_py(), np.float64).reshape(-1, dim)
            graph = np.frombuffer(shard["graph"][at].as_py(), np.int32).reshape(len(ids), -1)
            entry = shard["entry"][at].as_py()
            x = lifted(unit_scaled(vectors).astype(np.float32))
            sq = np.einsum("nd,nd->n", x, x)
            starts = starts_of(x, entry, min(STARTS, beam))
            qid = queries["query_id"].to_numpy()
            q = queries["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            for a in range(0, len(q), BATCH):
                own = q[a : a + BATCH]
                flat = np.hstack([unit_scaled(own, 1), np.zeros((len(own), 1))]).astype(np.float32)
                near, _ = beam_search(x, sq, graph, starts, flat, beam)
                score = np.einsum("bcd,bd->bc", vectors[np.maximum(near, 0)], own)
                score[near < 0] = -np.inf
                # nearest first, ties to the smaller id
                best = np.lexsort((ids[np.maximum(near, 0)], -score), axis=1)[:, :k]
                score, near = np.take_along_axis(score, best, 1), np.take_along_axis(near, best, 1)
                ok = near >= 0
                found.append((np.repeat(qid[a : a + BATCH], ok.sum(1)), ids[near[ok]], score[ok]))
        query, vec, score = (np.concatenate(c) for c in zip(*found))
        return pa.table({"query_id": query, "vec_id": vec, "score": score})

    return run


def usable(column: str = "embedding"):
    """Not null, not empty, all components finite, one of them not zero."""
    c = F.col(column).cast("array<double>")
    finite = F.forall(c, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return F.coalesce(finite & F.exists(c, lambda x: x != 0), F.lit(False))


def build_index(
    vectors: DataFrame,
    shard_rows: int = SHARD_ROWS,
    degree: int = DEGREE,
    beam: int = BEAM,
    relax: float = RELAX,
    keep: int = 21,
    key: str = "vec_id",
    column: str = "embedding",
) -> tuple[DataFrame, DataFrame]:
    """(index, copies): one graph per shard of about ``shard_rows`` different vectors, and each
    vector's ids, the least ``keep`` of those that share it."""
    rows = vectors.where(usable(column) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("vec_id"), F.transform(column, lambda x: x.cast("double") + F.lit(0.0)).alias("embedding")
    )
    rows = rows.groupBy("vec_id", "embedding").agg(F.lit(1).alias("_one")).drop("_one")
    # the rank limit is applied before the shuffle too, so a vector of very many rows stays small
    rank = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    rows = rows.withColumn("_rank", rank).where(F.col("_rank") <= keep)
    of = rows.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    of = materialise(of.select(F.col("ids")[0].alias("vec_id"), "ids", "embedding", F.size("embedding").alias("dim")), "vectors")
    shards = max(1, -(-of.count() // shard_rows))
    dealt = of.select("vec_id", "embedding", "dim", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"))
    schema = "dim int, shard long, entry long, ids binary, vectors binary, graph binary"
    index = dealt.groupBy("dim", "shard").applyInArrow(_index(degree, beam, relax), schema)
    return materialise(index, "graphs"), of.select("vec_id", "ids")


def search(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    beam: int = BEAM,
    key: str = "vec_id",
    column: str = "embedding",
    **options,
) -> DataFrame:
    """query_id, rank, vec_id, score: for every row whose id is divisible by ``every``, the ``k`` rows of
    largest inner product (double precision) that the beam searches find.

    Each block of queries goes to each shard's graph; the shards' best are merged. Equal
    vectors are one point of a graph and are listed by id afterwards.

    * vectors null, empty, zero, or with null or non-finite components take no part,
      nor do rows with null id; queries meet vectors of their own dimension only;
    * rows are known by id: a query's own id is not listed, a row that repeats id and
      vector is one; ties go to the smaller id; fewer candidates: all of them;
    * empty table: no rows. Other columns are not read.
    """
    index, copies = build_index(vectors, beam=beam, keep=k + 1, key=key, column=column, **options)
    queries = vectors.where(usable(column) & (F.col(key) % every == 0)).select(
        F.col(key).cast("long").alias("query_id"), F.col(column).cast("array<double>").alias("embedding")
    )
    queries = materialise(queries.distinct().withColumn("dim", F.size("embedding")), "queries")
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    places = index.select(*[F.col(c).alias(c) for c in ("dim", "shard")]).distinct()
    asked = queries.join(places, "dim")
    graphs = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    on = ["dim", "shard", "block"]
    found = graphs.groupBy(*on).cogroup(asked.groupBy(*on)).applyInArrow(_search(k + 1, beam), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k + 1).drop("_rank")
    rows = best.join(copies, "vec_id").select("query_id", F.explode("ids").alias("vec_id"), "score")
    rows = rows.where("vec_id <> query_id").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return rows.select("query_id", "rank", "vec_id", "score")
