"""Approximate nearest neighbours: a navigable small-world graph per shard.

Equal vectors become one node that remembers its smallest ids, so a vector
occurring any number of times costs one node and loses no neighbour.  Nodes are
dealt to bands of nearly equal length and, inside a band, to shards by hash; each shard builds a hierarchical navigable small-world
graph, kept as flat arrays (vectors, ids, one neighbour table per layer), and
the graphs are stored.  Queries visit all shards in blocks, a whole block
walking a graph in step: every round expands the best unexpanded candidate of
every query with a few array operations.  The nearest of each shard are merged,
scored exactly in double precision.

Largest inner product is made a nearest-neighbour problem for the graph by one
more coordinate that brings all vectors of a shard to the same length.  It stays
small beside the others because lengths differ by at most ``ratio`` in a band; with
one length for the whole table a few long vectors would hide all directions.

Defined cases: vectors that are null, empty, zero or hold null, NaN or infinite
components take no part, neither do vectors of another length than the most
common one (the smaller of two equally common); of rows with one id and
different vectors each stands for itself, and a query's own id is never its
neighbour; null ids take no part; an empty table gives an empty result; with
fewer candidates than asked for, all are returned.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelloop.llm.common import stored


@dataclass
class Graph:
    """One shard: augmented vectors, originals, ids of equal vectors, and neighbour tables (-1: none) from the ground up."""

    vectors: np.ndarray
    layers: list[np.ndarray]
    top: np.ndarray
    entry: int


def _near(graph_vectors: np.ndarray, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner product of each query with its row of nodes; -inf where the node is -1."""
    out = np.einsum("qkd,qd->qk", graph_vectors[rows], queries)
    out[rows < 0] = -np.inf
    return out


def beam(vectors: np.ndarray, table: np.ndarray, queries: np.ndarray, start: np.ndarray, width: int, at_once: int = 2):
    """(nodes, nearness), best first, of a best-first walk of all queries in step; -1 pads.

    ``start`` holds first nodes (queries x some).  A query ends when its ``width``
    best are all expanded.
    """
    q, n = len(queries), len(vectors)
    seen = np.zeros((q, n + 1), bool)  # the last column is for padding
    width = min(width, n)
    nodes = np.full((q, width), -1, np.int64)
    score = np.full((q, width), -np.inf, np.float32)
    done = np.zeros((q, width), bool)
    k = min(start.shape[1], width)
    nodes[:, :k] = start[:, :k]
    score[:, :k] = _near(vectors, queries, nodes[:, :k])
    rows = np.arange(q)
    seen[rows[:, None], nodes] = True
    live = rows
    while len(live):
        open_score = np.where(done[live] | (nodes[live] < 0), -np.inf, score[live])
        pick = np.argpartition(-open_score, min(at_once, width) - 1, 1)[:, :at_once] if width > at_once else \
            np.tile(np.arange(width), (len(live), 1))
        value = np.take_along_axis(open_score, pick, 1)
        go = value[:, :].max(1) > -np.inf
        live, pick, value = live[go], pick[go], value[go]
        if not len(live):
            break
        chosen = np.where(value > -np.inf, np.take_along_axis(nodes[live], pick, 1), -1)
        done[live[:, None], pick] = True
        new = np.where(chosen[:, :, None] >= 0, table[chosen], -1).reshape(len(live), -1)
        new[seen[live[:, None], new]] = -1
        if new.shape[1] > table.shape[1]:  # nodes met twice in one round
            order = np.sort(new, 1)
            order[:, 1:][order[:, 1:] == order[:, :-1]] = -1
            new = order
        seen[live[:, None], new] = True
        seen[:, -1] = True
        near = np.full(new.shape, -np.inf, np.float32)
        a, b = np.nonzero(new >= 0)
        near[a, b] = np.einsum("nd,nd->n", vectors[new[a, b]], queries[live[a]])
        every = np.concatenate([score[live], near], 1)
        best = np.argpartition(-every, width - 1, 1)[:, :width]
        nodes[live] = np.take_along_axis(np.concatenate([nodes[live], new], 1), best, 1)
        done[live] = np.take_along_axis(np.concatenate([done[live], np.zeros(new.shape, bool)], 1), best, 1)
        score[live] = np.take_along_axis(every, best, 1)
    order = np.argsort(-score, 1, kind="stable")
    return np.take_along_axis(nodes, order, 1), np.take_along_axis(score, order, 1)


def spread(vectors: np.ndarray, own: np.ndarray, nodes: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates (best first), up to ``most`` that are nearer to the row's own
    vector than to any one chosen before; free places go to the nearest of the others."""
    n, k = nodes.shape
    between = np.einsum("qid,qjd->qij", vectors[nodes], vectors[nodes])
    chosen, count = np.zeros((n, k), bool), np.zeros(n, int)
    for i in range(k):
        closer = np.where(chosen, between[:, i, :], -np.inf).max(1) > near[:, i]
        take = (nodes[:, i] >= 0) & ~closer & (count < most)
        chosen[:, i] = take
        count += take
    rank = np.where(chosen, 0, np.where(nodes >= 0, 1, 2)) * (k + 1) + np.arange(k)
    return np.where(np.sort(rank, 1)[:, :most] < 2 * (k + 1),
                    np.take_along_axis(nodes, np.argsort(rank, 1, kind="stable")[:, :most], 1), -1)


def build(vectors: np.ndarray, links: int = 16, width: int = 64, batch: int = 512, seed: int = 1) -> Graph:
    """The graph of one shard.  Vectors have equal length, so the largest inner product is the nearest.

    Nodes come in batches: a batch walks the graph of those before it, its members
    also see each other, and links are made both ways.
    """
    n = len(vectors)
    rng = np.random.default_rng(seed)
    level = np.minimum((-np.log(1 - rng.random(n)) / math.log(links)).astype(int), 6)
    order = np.argsort(-level, kind="stable")  # upper nodes first: a layer is whole before its lower nodes come
    layers = [np.full((n, 2 * links if h == 0 else links), -1, np.int64) for h in range(int(level.max()) + 1 if n else 0)]
    if not n:
        return Graph(vectors, layers, level, -1)
    entry, placed, at = int(order[0]), 1, 1
    while at < n:
        part = order[at:at + min(batch, max(1, placed))]
        at, heights = at + len(part), level[part]
        start = np.full((len(part), 1), entry)
        for h in range(len(layers) - 1, -1, -1):
            nodes, near = beam(vectors, layers[h], vectors[part], start, width if (heights >= h).any() else 1, 1)
            start = nodes[:, :1] if h else start
            here = heights >= h
            if here.any():
                own = part[here]
                inside = vectors[own] @ vectors[own].T
                np.fill_diagonal(inside, -np.inf)
                few = min(width // 2, len(own) - 1)
                if few > 0:
                    pick = np.argpartition(-inside, few - 1, 1)[:, :few]
                    cand, value = np.concatenate([nodes[here], own[pick]], 1), \
                        np.concatenate([near[here], np.take_along_axis(inside, pick, 1)], 1)
                else:
                    cand, value = nodes[here], near[here]
                best = np.argsort(-value, 1, kind="stable")[:, :width]
                cand, value = np.take_along_axis(cand, best, 1), np.take_along_axis(value, best, 1)
                made = spread(vectors, own, cand, value, links)
                layers[h][own, :made.shape[1]] = made
                _link_back(vectors, layers[h], own, made)
        placed += len(part)
    return Graph(vectors, layers, level, entry)


def _link_back(vectors: np.ndarray, table: np.ndarray, own: np.ndarray, made: np.ndarray) -> None:
    """Link every chosen neighbour back; a full row keeps a spread choice of old and new."""
    a, b = np.nonzero(made >= 0)
    target, source = made[a, b], own[a]
    order = np.argsort(target, kind="stable")
    target, source = target[order], source[order]
    heads, first, size = np.unique(target, return_index=True, return_counts=True)
    most, limit = int(size.max()) if len(size) else 0, table.shape[1]
    if not most:
        return
    extra = np.full((len(heads), most), -1, np.int64)
    extra[np.repeat(np.arange(len(heads)), size), np.arange(len(target)) - np.repeat(first, size)] = source
    old = table[heads]
    extra[(extra[:, :, None] == old[:, None, :]).any(2)] = -1
    both = np.concatenate([old, extra], 1)
    near = _near(vectors, vectors[heads], both)
    best = np.argsort(-near, 1, kind="stable")
    both, near = np.take_along_axis(both, best, 1), np.take_along_axis(near, best, 1)
    fits = (both >= 0).sum(1) <= limit
    table[heads[fits]] = both[fits][:, :limit]
    for part in np.array_split(np.flatnonzero(~fits), max(1, int((~fits).sum()) // 256)):
        if len(part):
            table[heads[part]] = spread(vectors, heads[part], both[part], near[part], limit)


def search(graph: Graph, queries: np.ndarray, count: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, nearness) of the ``count`` nearest found, best first."""
    if graph.entry < 0 or not len(queries):
        return np.full((len(queries), 0), -1), np.zeros((len(queries), 0))
    start = np.full((len(queries), 1), graph.entry)
    for table in graph.layers[:0:-1]:
        start = beam(graph.vectors, table, queries, start, 4, 1)[0]
    nodes, near = beam(graph.vectors, graph.layers[0], queries, start, max(width, count))
    return nodes[:, :count], near[:, :count]


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & (F.size(v) > 0) & ~odd & F.exists(v, lambda x: x != 0.0))
    length = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (length["d"] if length else 0))


def nodes_of(rows: DataFrame, kept: int) -> DataFrame:
    """(v, ids): one row per distinct vector with its ``kept`` smallest distinct ids, ascending."""
    plain = rows.select("vec_id", F.transform("v", lambda x: x + F.lit(0.0)).alias("v")).distinct()  # -0.0 becomes 0.0
    first = plain.withColumn("nth", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("nth") <= kept)
    return first.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def nearest(df: DataFrame, count: int = 20, every: int = 20, shards: int = 8, shard_rows: int = 8192, block_rows: int = 4096,
            links: int = 16, width: int = 64, search_width: int = 128, ratio: float = 1.05, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``count`` largest inner products of every row whose id is divisible by ``every``.

    The nodes of a band of lengths make their share of ``shards`` graphs, at least one,
    and as many as keep them at ``shard_rows`` nodes: a walk of ``search_width`` finds
    less in a larger graph.  ``block_rows`` queries walk a graph together.
    """
    rows = stored(usable(df, id_col, vector_col), "vectors")
    nodes = stored(nodes_of(rows, count + 1), "vector-nodes")
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    banded = nodes.withColumn("h", F.xxhash64("v")).withColumn("band", F.floor(F.log(length) / F.lit(math.log(ratio)) + F.lit(0.5)).cast("int"))
    per = banded.groupBy("band").count().orderBy("band").collect()  # a row per band: at most some ten thousand
    n = sum(r["count"] for r in per)
    sizes = {r["band"]: max(1, round(shards * r["count"] / n), math.ceil(r["count"] / shard_rows)) for r in per}
    heads = dict(zip(sizes, np.cumsum([0, *sizes.values()]).tolist(), strict=False))
    n_shards = max(1, sum(sizes.values()))
    spread_over = nodes.sparkSession.createDataFrame([(b, heads[b], sizes[b]) for b in sizes], "band int, first int, shards int")

    def make(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("h")
        original = np.stack(group["v"].to_numpy())
        square = (original ** 2).sum(1)
        longest = float(square.max())
        rest = np.sqrt(np.maximum(longest - square, 0))
        graph = build(np.concatenate([original, rest[:, None]], 1).astype(np.float32) / math.sqrt(longest), links, width)
        return pd.DataFrame({"shard": group["shard"].iloc[:1], "graph": [pickle.dumps((graph, original, list(group["ids"])), 5)]})

    dealt = banded.join(spread_over, "band").withColumn("shard", (F.col("first") + F.pmod("h", F.col("shards"))).cast("int")).drop(
        "band", "first", "shards")
    graphs = stored(dealt.groupBy("shard").applyInPandas(make, "shard int, graph binary"), "graphs")
    asked = rows.where(F.col("vec_id") % every == 0).distinct()
    n_blocks = max(1, math.ceil(asked.count() / block_rows))
    block = F.pmod(F.xxhash64("vec_id", "v", F.lit("block")), F.lit(n_blocks)).cast("int")
    visits = asked.withColumn("block", block).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    copies = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))

    def walk(queries: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(found):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": int, "vec_id": int})
        graph, original, ids = pickle.loads(found["graph"].iloc[0])
        q = np.stack(queries["v"].to_numpy())
        flat = np.concatenate([q / np.linalg.norm(q, axis=1, keepdims=True), np.zeros((len(q), 1))], 1).astype(np.float32)
        out = []
        for a in range(0, len(q), 512):
            got, _ = search(graph, flat[a:a + 512], count + 1, search_width)
            for own, vector, nodes in zip(queries["vec_id"].to_numpy()[a:a + 512], q[a:a + 512], got, strict=True):
                nodes = nodes[nodes >= 0]
                score = original[nodes] @ vector
                pairs = [(-s, int(i)) for s, x in zip(score.tolist(), nodes.tolist(), strict=True) for i in ids[x] if i != own]
                out += [(int(own), i, -s) for s, i in sorted(pairs)[:count]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    hits = (visits.groupBy("shard", "block").cogroup(copies.groupBy("shard", "block"))
            .applyInPandas(walk, "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    merged = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return merged.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= count).select("query_id", "rank", "vec_id", "score")


def exact(df: DataFrame, count: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> Iterator:
    """Brute force in the driver, for measuring recall on small tables: yields (query_id, [(score, vec_id), ...])."""
    rows = usable(df, id_col, vector_col).distinct().toPandas()
    ids, v = rows["vec_id"].to_numpy(), np.stack(rows["v"].to_numpy()) if len(rows) else np.zeros((0, 1))
    for i in np.flatnonzero(ids % every == 0):
        other = np.flatnonzero(ids != ids[i])
        score = v[other] @ v[i]
        order = np.lexsort((ids[other], -score))[:count]
        yield int(ids[i]), list(zip(score[order].tolist(), ids[other][order].tolist(), strict=True))
