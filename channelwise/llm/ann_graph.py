"""Approximate nearest neighbours by a robust-pruned directed graph per shard.

*Space.* The measure is the largest inner product. A shard's vectors get one more coordinate that
fills them up to the shard's largest norm; the Euclidean neighbours in that space are those of the
largest inner product, so the graph and its pruning work with true distances.

*Build.* The vectors of a shard go in by batches of growing size. A greedy beam search over the graph
so far proposes neighbours for each; relaxed pruning walks them from near to far and drops whatever
is ``ALPHA`` times nearer to an edge already kept than to the vector itself, which leaves at most
``DEGREE`` edges in diverse directions. Edges are entered backwards as well, and a vector with too
many is pruned in the same way.

*Search.* Each query runs a beam of ``BEAM`` through every shard's graph; the beam is then scored
exactly on the original vectors in double precision, and the best of all shards are kept. Equal
vectors are one node: the nodes' members (the smallest ids, as many as a result can hold) are put back
afterwards, so a vector with a million copies costs one node.

*Scale.* The number of shards follows the rows (``SHARD_ROWS`` at most expected in each, and at least
``SHARDS``); the index is a table of (shard, node, vector, edges) in the shared folder. Queries are
dealt in blocks of about ``QUERY_BLOCK``, so a task holds one shard and one block of queries.

Cases: null or empty vectors, zero vectors and vectors with null or non-finite components take no
part, as row or as query; vectors only meet those of their own length; a null vec_id takes no part;
rows that agree in vec_id and vector count once; fewer than ``k`` others give fewer results; extra
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, table

DEGREE, BEAM_BUILD, BEAM, ALPHA, WIDTH = 32, 64, 96, 1.2, 4
SHARDS, SHARD_ROWS, QUERY_BLOCK = 6, 50_000, 20_000
BATCH = 512
TOP = 20
EVERY = 20


def with_norm(x: np.ndarray, largest: float) -> np.ndarray:
    """The vectors with one more coordinate that brings all to the norm ``largest``."""
    rest = np.sqrt(np.maximum(0.0, largest**2 - (x.astype(np.float64) ** 2).sum(axis=1)))
    return np.ascontiguousarray(np.column_stack([x, rest]), dtype=np.float32)


def beam_search(x: np.ndarray, norms: np.ndarray, edges: np.ndarray, entry: int, q: np.ndarray, beam: int
                ) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, squared distance less the query's norm) of the ``beam`` best found, near to far, for each
    row of ``q``; -1 and infinity where fewer were found."""
    rows, n = len(q), len(x)
    nodes = np.full((rows, beam), -1, np.int64)
    dist = np.full((rows, beam), np.inf, np.float32)
    open_ = np.zeros((rows, beam), bool)
    seen = np.zeros((rows, n), bool)
    nodes[:, 0], open_[:, 0], seen[:, entry] = entry, True, True
    dist[:, 0] = norms[entry] - 2 * (q @ x[entry])
    active = np.arange(rows)
    while len(active):
        o = open_[active]
        pick = np.argsort(~o, axis=1, kind="stable")[:, :WIDTH]  # the nearest open ones
        chosen = np.take_along_axis(o, pick, axis=1)
        near = edges[np.where(chosen, np.take_along_axis(nodes[active], pick, axis=1), -1)]
        near = np.where(chosen[:, :, None], near, -1).reshape(len(active), -1)
        np.put_along_axis(o, pick, False, axis=1)
        open_[active] = o
        ok = near >= 0
        ok &= ~seen[active[:, None], near]
        # a node proposed twice at once counts once
        order = np.argsort(near, axis=1, kind="stable")
        ordered = np.take_along_axis(near, order, axis=1)
        again = np.zeros_like(ok)
        np.put_along_axis(again, order[:, 1:], ordered[:, 1:] == ordered[:, :-1], axis=1)
        ok &= ~again
        r, c = np.nonzero(ok)
        found = near[r, c]
        seen[active[r], found] = True
        d = np.full(near.shape, np.inf, np.float32)
        d[r, c] = norms[found] - 2 * np.einsum("ij,ij->i", x[found], q[active[r]])
        all_d = np.concatenate([dist[active], d], axis=1)
        best = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
        dist[active] = np.take_along_axis(all_d, best, axis=1)
        nodes[active] = np.take_along_axis(np.concatenate([nodes[active], near], axis=1), best, axis=1)
        open_[active] = np.take_along_axis(np.concatenate([o, ok], axis=1), best, axis=1)
        active = active[open_[active].any(axis=1)]
    nodes[~np.isfinite(dist)] = -1
    return nodes, dist


def robust_prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int = DEGREE,
                 alpha: float = ALPHA) -> np.ndarray:
    """Edges (rows of at most ``degree`` nodes, -1 behind them) of ``points`` out of ``candidates``
    (rows of nodes, -1 for none, without repeats)."""
    valid = (candidates >= 0) & (candidates != points[:, None])
    c = x[np.where(valid, candidates, 0)]
    square = np.einsum("ijk,ijk->ij", c, c)
    own = x[points]
    d = square - 2 * np.einsum("ijk,ik->ij", c, own) + np.einsum("ij,ij->i", own, own)[:, None]
    d = np.where(valid, d, np.inf)
    order = np.argsort(d, axis=1, kind="stable")
    d, c = np.take_along_axis(d, order, axis=1), np.take_along_axis(c, order[:, :, None], axis=1)
    square, names = np.take_along_axis(square, order, axis=1), np.take_along_axis(candidates, order, axis=1)
    between = square[:, :, None] + square[:, None, :] - 2 * np.matmul(c, c.transpose(0, 2, 1))
    alive = np.isfinite(d)
    out = np.full((len(points), degree), -1, np.int64)
    rows = np.arange(len(points))
    for k in range(degree):
        some = alive.any(axis=1)
        if not some.any():
            break
        first = alive.argmax(axis=1)
        out[some, k] = names[rows[some], first[some]]
        alive[rows, first] = False
        alive &= ~(some[:, None] & (alpha**2 * between[rows, first] <= d))
    return out


def build_graph(x: np.ndarray, seed: int = 11) -> tuple[np.ndarray, int]:
    """(edges, entry) of the graph over the rows of ``x``."""
    n = len(x)
    edges = np.full((n + 1, DEGREE), -1, np.int64)  # the last row is what index -1 names
    norms = np.einsum("ij,ij->i", x, x)
    entry = int((norms - 2 * (x @ x.mean(axis=0))).argmin())
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    at = 1
    while at < n:
        new = order[at:at + max(1, min(BATCH, at))]
        at += len(new)
        found, _ = beam_search(x, norms, edges, entry, x[new], BEAM_BUILD)
        kept = robust_prune(x, new, found)
        edges[new] = kept
        # backward edges, by the node that gets them
        to, by = kept.ravel(), np.repeat(new, DEGREE)
        by, to = by[to >= 0], to[to >= 0]
        order_to = np.argsort(to, kind="stable")
        to, by = to[order_to], by[order_to]
        nodes, start, counts = np.unique(to, return_index=True, return_counts=True)
        have = (edges[nodes] >= 0).sum(axis=1)
        for fits in (True, False):
            chosen = np.flatnonzero((have + counts <= DEGREE) == fits)
            for part in np.array_split(chosen, max(1, math.ceil(len(chosen) / BATCH))) if len(chosen) else ():
                width = DEGREE + int(counts[part].max())
                rows = np.full((len(part), width), -1, np.int64)
                rows[:, :DEGREE] = edges[nodes[part]]
                k = np.repeat(np.arange(len(part)), counts[part])
                inside = np.concatenate([np.arange(m) for m in counts[part]])
                rows[k, np.repeat(have[part] if fits else np.full(len(part), DEGREE), counts[part]) + inside] = \
                    by[np.concatenate([np.arange(s, s + m) for s, m in zip(start[part], counts[part])])]
                edges[nodes[part]] = rows[:, :DEGREE] if fits else robust_prune(x, nodes[part], rows)
    return edges[:n], entry


def search_graph(original: np.ndarray, edges: np.ndarray, entry: int, q: np.ndarray, k: int, beam: int = BEAM
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, node, inner product in double precision) of the best ``k`` nodes found for each row."""
    x = with_norm(original, math.sqrt(float((original.astype(np.float64) ** 2).sum(axis=1).max())))
    norms = np.einsum("ij,ij->i", x, x)
    edges = np.concatenate([edges, np.full((1, edges.shape[1]), -1, edges.dtype)])
    exact, out = original.astype(np.float64), []
    for at in range(0, len(q), BATCH):
        block = q[at:at + BATCH]
        wide = np.ascontiguousarray(np.column_stack([block, np.zeros(len(block))]), dtype=np.float32)
        nodes, _ = beam_search(x, norms, edges, entry, wide, max(beam, k))
        r, c = np.nonzero(nodes >= 0)
        found = nodes[r, c]
        score = np.einsum("ij,ij->i", exact[found], block[r].astype(np.float64))
        order = np.lexsort((found, -score, r))
        r, found, score = r[order], found[order], score[order]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        keep = place < k
        out.append((r[keep] + at, found[keep], score[keep]))
    return tuple(np.concatenate(x) for x in zip(*out))


def valid_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, v array<float>) of the rows that take part."""
    v = F.col("v")
    finite = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return (rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("v"))
            .filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite
                    & F.exists(v, lambda e: e != 0)).distinct())


INDEX = "shard int, pos int, entry int, node long, v array<float>, edges array<int>"


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), dtype=np.float32).reshape(len(flat), -1)


def build_index(nodes: DataFrame) -> DataFrame:
    """INDEX rows for (shard, node, v): one graph per shard."""

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        v = _matrix(group.column("v"))
        x = with_norm(v, math.sqrt(float((v.astype(np.float64) ** 2).sum(axis=1).max())))
        edges, entry = build_graph(x)
        n = len(v)
        return pa.table({
            "shard": group.column("shard"), "pos": pa.array(np.arange(n, dtype=np.int32)),
            "entry": pa.array(np.full(n, entry, np.int32)), "node": group.column("node"), "v": group.column("v"),
            "edges": pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * DEGREE, DEGREE, dtype=np.int32)),
                                              pa.array(edges.astype(np.int32).ravel()))})

    return nodes.select("shard", "node", "v").groupBy("shard").applyInArrow(build, INDEX)


def search_index(index: DataFrame, queries: DataFrame, k: int, beam: int = BEAM) -> DataFrame:
    """(query, node, score): the best ``k`` nodes of every shard for (shard, block, query, v) rows."""

    def search(graph: pa.Table, asked: pa.Table) -> pa.Table:
        names = ["query", "node", "score"]
        if not graph.num_rows or not asked.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=names)
        graph = graph.sort_by("pos")
        edges = np.asarray(graph.column("edges").combine_chunks().flatten()).reshape(-1, DEGREE).astype(np.int64)
        r, found, score = search_graph(_matrix(graph.column("v")), edges, graph.column("entry")[0].as_py(),
                                       _matrix(asked.column("v")), k, beam)
        return pa.table([asked.column("query").take(pa.array(r)), graph.column("node").take(pa.array(found)),
                         pa.array(score)], names=names)

    return (index.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block"))
            .applyInArrow(search, "query long, node long, score double"))


def nearest(rows: DataFrame, k: int = TOP, every: int = EVERY, beam: int = BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row whose vec_id is divisible by ``every``, the ``k``
    nearest others found."""
    vectors = materialize(valid_vectors(rows), "vectors")
    nodes = vectors.groupBy("v").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    nodes = materialize(nodes.select("node", "v", "copies", F.size("v").alias("dim")), "nodes")
    sizes = {r.dim: r.n for r in nodes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    # shards are numbered through the vector lengths: first shard and number of shards of each
    first, plan = 0, []
    for dim, n in sorted(sizes.items()):
        count = min(n, max(SHARDS, math.ceil(n / SHARD_ROWS)))
        plan.append((dim, first, count))
        first += count
    plan = rows.sparkSession.createDataFrame(plan, "dim int, first int, shards int")
    dealt = nodes.join(F.broadcast(plan), "dim")  # a row for each vector length
    index = materialize(build_index(dealt.withColumn(
        "shard", (F.col("first") + F.pmod(F.xxhash64("node"), F.col("shards"))).cast("int"))), "graph")

    # the node of every row and of every query
    of_node = materialize(vectors.join(nodes.select("v", "node", "copies"), "v").select("vec_id", "node", "copies"),
                          "members")
    asked = of_node.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "node")
    asked_nodes = materialize(asked.select("node").distinct(), "asked")
    blocks = max(1, math.ceil(asked_nodes.count() / QUERY_BLOCK))
    in_block = F.pmod(F.xxhash64(F.lit("block"), "node"), F.lit(blocks)).cast("int")
    queries = (dealt.join(asked_nodes, "node", "left_semi")
               .select(F.explode(F.sequence("first", F.col("first") + F.col("shards") - 1)).alias("shard"),
                       in_block.alias("block"), F.col("node").alias("query"), "v"))
    every_block = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    hits = materialize(search_index(every_block, queries, k + 1, beam), "hits")

    # back to rows: the k + 1 smallest ids of a node are all that a result can hold
    salted = Window.partitionBy("node", F.pmod(F.xxhash64("vec_id"), F.lit(64))).orderBy("vec_id")
    few = Window.partitionBy("node").orderBy("vec_id")
    members = (of_node.withColumn("r", F.row_number().over(salted)).filter(F.col("r") <= k + 1)
               .withColumn("r", F.row_number().over(few)).filter(F.col("r") <= k + 1).select("node", "vec_id"))
    of_query = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    best = (hits.join(members, "node").withColumn("r", F.row_number().over(of_query)).filter(F.col("r") <= k + 1)
            .groupBy("query").agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("found")))
    others = F.slice(F.filter("found", lambda h: h["vec_id"] != F.col("query_id")), 1, k)
    return (asked.join(best, asked["node"] == best["query"]).select("query_id", F.posexplode(others).alias("p", "h"))
            .select("query_id", (F.col("p") + 1).cast("int").alias("rank"), "h.vec_id", "h.score"))


def op3_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest others of every twentieth row of ``embeddings``."""
    return nearest(table(spark, sf_dir, "embeddings"))
