"""Exact k-nearest neighbours (H18) and SMOTE oversampling.

Exact search without an all-pairs join, by cells around pivots:

* identical vectors are compacted first (each distinct vector keeps at most
  k ids, via a partial top-k), so a vector copied a million times costs one
  row, not a million;
* pivots are spread over a bounded sample (each the farthest from those before),
  every vector lies in the cell of its nearest pivot, and a large cell is cut
  into rings by the distance from its pivot;
* pass A compares a query with the ring that it falls into (more rings while
  they hold fewer than k points): the k-th distance there bounds the radius;
* pass B compares a query only with rings that its radius can reach.  A point x
  of the cell of pivot p is at least ``|d(q, p) − d(x, p)|`` away, and at least as
  far as the plane between p and the query's own pivot;
* neighbouring rings share a block of at most ``TRAIN_BLOCK`` rows and a query is
  sent once to a block, with the rings it needs there, so that at worst (no
  structure in the data) queries travel as often as there are blocks;
* the distances of a block of queries and a block of points are one matrix
  product; the few pairs that can be among the nearest are computed again, term
  by term, and ranked by (distance, id).  Every true neighbour is within the
  radius, so the answer is exact; nothing is capped.

Distances are squared Euclidean (same order as Euclidean).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloop.operators.split import BUCKETS, SEED, _hash_bucket, shuffle_key
from labelloop.session import Held, cut_lineage, share_code

# ---- fixed values ----------------------------------------------------------
SMOTE_NEIGHBOURS = 5       # neighbours considered per minority row
KNN_VOTERS = 7             # k of the k-NN vote
# ---------------------------------------------------------------------------

# Granularity (not a candidate limit: pass B visits every ring within the
# radius).  Bounding cells and rings bounds what the driver holds and sends to
# tasks (the pivots and three numbers a ring); with more data the rings hold more
# rows and are split over more tasks (``QUERY_BLOCK`` × ``TRAIN_BLOCK`` rows a task).
MAX_CELLS, MAX_RINGS = 1024, 64
QUERY_BLOCK, TRAIN_BLOCK = 1024, 4096
STEP = 1000                # vectors that are compared with all pivots at once
COPY_CHUNK = 100_000       # synthetic copies generated per task unit in SMOTE


def sq_dist(a, b) -> Column:
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    diffs = F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), 2))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, x: acc + x)


def _compact(df: DataFrame, id_col: str, vec_col: str, keep: int | None) -> DataFrame:
    """(vec, ids) with the ``keep`` smallest ids of each distinct vector."""
    base = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"), _hashed(vec_col))
    if keep is not None:
        w = Window.partitionBy("__h", "vec").orderBy("id")
        base = base.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= keep)
    g = base.groupBy("__h", "vec").agg(F.sort_array(F.collect_list("id")).alias("ids")).drop("__h")
    return g.withColumn("gid", F.get(F.col("ids"), 0))


def _hashed(vec_col: str) -> Column:
    """A key put before a vector where rows are brought together by it: sorts then compare whole vectors only if hashes are equal."""
    return F.xxhash64(vec_col).alias("__h")


def _matrix(vectors: pd.Series | pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows; those of an Arrow column without an object for each."""
    if isinstance(vectors, pd.Series):
        return np.stack([np.asarray(v, np.float64) for v in vectors]) if len(vectors) else np.zeros((0, 0))
    values, _ = _lists(vectors)
    return values.astype(np.float64, copy=False).reshape(len(vectors), -1) if len(vectors) else np.zeros((0, 0))


def _lists(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(values of all lists one after the other, length of each)."""
    parts = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    if not parts:
        return np.zeros(0), np.zeros(0, np.int64)
    return (np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in parts]),
            np.concatenate([np.diff(c.offsets.to_numpy()) for c in parts]).astype(np.int64))


def _products(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared distances by one matrix product, and how far they may be off."""
    xx, yy = (x * x).sum(1), (y * y).sum(1)
    slack = 1e-12 * (xx.max(initial=0.0) + yy.max(initial=0.0)) + 1e-300
    return np.maximum(xx[:, None] + yy[None, :] - 2.0 * (x @ y.T), 0.0), slack


def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of row pairs, summed from the first coordinate to the last."""
    total = np.zeros(len(x))
    for j in range(x.shape[1] if len(x) else 0):
        total += (x[:, j] - y[:, j]) ** 2
    return total


def spread_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """``count`` rows of ``sample``: the first, then always the one farthest from those taken."""
    taken = [0]
    near, _ = _products(sample, sample[:1])
    near = near[:, 0]
    while len(taken) < min(count, len(sample)):
        far = int(near.argmax())
        if near[far] <= 0:
            break
        taken.append(far)
        near = np.minimum(near, _products(sample, sample[far:far + 1])[0][:, 0])
    return sample[taken]


class Rings:
    """The pivots and the rings around them: where vectors lie, and which rings a query can need."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        self.cuts: list[np.ndarray] = [np.zeros(0)] * len(pivots)

    @cached_property
    def between(self) -> np.ndarray:
        return np.sqrt(_products(self.pivots, self.pivots)[0])

    def __getstate__(self) -> dict:
        """Without the distances between pivots, which grow with their square and are computed again where they are needed."""
        return {k: v for k, v in self.__dict__.items() if k != "between"}

    def cut(self, stats: list[tuple], train_block: int, max_rings: int) -> None:
        """From (cell, rows, smallest distance, largest distance, quantiles of the distance) of each cell that has rows."""
        low, high, cell = [], [], []
        of = {s[0]: s for s in stats}
        self.first = np.zeros(len(self.pivots), np.int64)
        for c in range(len(self.pivots)):
            self.first[c] = len(cell)
            if c not in of:
                low, high, cell = [*low, np.inf], [*high, -np.inf], [*cell, c]
                continue
            _, n, least, most, quantiles = of[c]
            rings = min(max_rings, -(-n // train_block))
            at = [len(quantiles) * i // rings for i in range(1, rings)]
            self.cuts[c] = np.unique(np.array([quantiles[i] for i in at if least < quantiles[i] <= most]))
            edges = [least, *self.cuts[c], most]
            low, high, cell = [*low, *edges[:-1]], [*high, *edges[1:]], [*cell, *[c] * (len(edges) - 1)]
        self.low, self.high, self.cell = np.array(low), np.array(high), np.array(cell, np.int64)

    def fill(self, counts: dict[int, int], train_block: int) -> None:
        """Rows of each ring; blocks of rings around neighbouring pivots; the parts that a ring of very many rows is dealt to."""
        self.rows = np.zeros(len(self.cell), np.int64)
        for ring, n in counts.items():
            self.rows[ring] = n
        left, chain = set(range(len(self.pivots))), [0]
        left.discard(0)
        while left:   # from pivot to the nearest pivot that is left
            some = np.fromiter(left, np.int64)
            chain.append(int(some[self.between[chain[-1], some].argmin()]))
            left.discard(chain[-1])
        self.block = np.zeros(len(self.cell), np.int64)
        block, filled = 0, 0
        for c in chain:
            for ring in np.flatnonzero(self.cell == c):
                if filled and filled + self.rows[ring] > train_block:
                    block, filled = block + 1, 0
                self.block[ring] = block
                filled += self.rows[ring]
        self.parts = np.ones(block + 1, np.int64)   # a block of several rings has one part
        np.maximum.at(self.parts, self.block, -(-self.rows // train_block))

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each row and its distance from the cell's pivot."""
        d2, _ = _products(x, self.pivots)
        cell = d2.argmin(1)
        return cell, np.sqrt(_exact(x, self.pivots[cell]))

    def ring(self, cell: np.ndarray, radius: np.ndarray) -> np.ndarray:
        return np.array([self.first[c] + np.searchsorted(self.cuts[c], r, side="right") for c, r in zip(cell, radius, strict=True)], np.int64)

    def bounds(self, x: np.ndarray) -> np.ndarray:
        """(rows x rings) smallest possible distance to a point of each ring."""
        d2, _ = _products(x, self.pivots)
        d = np.sqrt(d2)
        own = d2.argmin(1)
        gap = self.between[own]
        plane = np.where(gap > 0, (d2 - d2[np.arange(len(x)), own][:, None]) / np.where(gap > 0, 2 * gap, 1), 0.0)
        at = d[:, self.cell]
        return np.maximum.reduce([at - self.high, self.low - at, plane[:, self.cell], np.zeros_like(at)])

    def within(self, x: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, ring) pairs whose bound is at most the row's ``limit`` (above 0): the planes rule cells out, then
        the rings of the cells that are left are looked at."""
        d2, _ = _products(x, self.pivots)
        own = d2.argmin(1)
        most = np.where(self.between > 0, 2 * self.between, np.inf)[own]
        most *= limit[:, None]
        most += d2[np.arange(len(x)), own][:, None]
        row, cell = np.nonzero(d2 <= most)
        many = np.diff(np.append(self.first, len(self.cell)))[cell]
        ring = np.repeat(self.first[cell], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        at, row = np.repeat(np.sqrt(d2[row, cell]), many), np.repeat(row, many)
        good = (at - self.high[ring] <= limit[row]) & (self.low[ring] - at <= limit[row]) & (self.rows[ring] > 0)
        return row[good], ring[good]


def _placed(df: DataFrame, sent: Broadcast) -> DataFrame:
    """``df`` with ``cell``, ``radius``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = _matrix(batch.column("vec"))
                found = [sent.value.place(x[first:first + STEP]) for first in range(0, len(x), STEP)]
                cell, radius = (np.concatenate(c) for c in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(radius)],
                                                 names=[*batch.schema.names, "cell", "radius"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, cell int, radius double")


def _sent(queries: DataFrame, sent: Broadcast, kk: int, radius: bool, counts_only: bool = False) -> DataFrame:
    """(qgid, vec, r2, block, part, rings) for each part of a block that a query is sent to, with the rings it needs there.

    Without a radius yet, these are the ring it falls into and, while they hold fewer
    than ``kk`` points, the next ones by their bound; with one (``r2``), every ring that it can reach.
    """

    def wanted(x: np.ndarray, r2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rings, row, ring = sent.value, [], []
        for first in range(0, len(x), step := max(1, 4_000_000 // len(rings.cell))):
            if radius:
                at, which = rings.within(x[first:first + step], np.sqrt(r2[first:first + step]) * (1 + 1e-9) + 1e-9)
            else:
                cell, distance = rings.place(x[first:first + step])
                home = rings.ring(cell, distance)
                enough = rings.rows[home] >= kk
                at, which = np.flatnonzero(enough), home[enough]
                few = np.flatnonzero(~enough)
                bound = rings.bounds(x[first + few])
                bound[:, rings.rows == 0] = np.inf
                for i, b in zip(few, bound, strict=True):
                    order = np.argsort(b, kind="stable")
                    need = order[:np.searchsorted(np.cumsum(rings.rows[order]), kk) + 1]
                    at, which = np.append(at, np.full(len(need), i)), np.append(which, need)
            row.append(at + first)
            ring.append(which)
        return np.concatenate(row).astype(np.int64), np.concatenate(ring).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            rings = sent.value
            row, ring = wanted(_matrix(batch.column("vec")), batch.column("r2").to_numpy())
            order = np.lexsort((ring, rings.block[ring], row))
            row, ring = row[order], ring[order]
            block = rings.block[ring]
            heads = np.flatnonzero(np.r_[True, (np.diff(row) != 0) | (np.diff(block) != 0)])
            sizes = np.diff(np.append(heads, len(ring)))
            row, pairs = row[heads], np.add.reduceat(rings.rows[ring], heads)
            block, copies = block[heads], rings.parts[block[heads]]
            # in the first pass one part of a ring will do if it surely has enough rows; parts are dealt by hash
            single = (not radius) & (rings.rows[ring[heads]] // copies >= 4 * kk)
            pairs = np.where(single, pairs // copies, pairs)
            if counts_only:
                at = np.repeat(np.arange(len(row)), np.where(single, 1, copies))
                part = np.arange(len(at)) - np.searchsorted(at, at)
                part = np.where(single[at], row[at] % copies[at], part)
                whole = np.where(single, pairs, pairs // copies)[at]
                found = pd.DataFrame({"block": block[at], "part": part, "pairs": whole}).groupby(["block", "part"])["pairs"].agg(
                    n="size", pairs="sum").reset_index().astype({"block": "int32", "part": "int32", "n": "int64", "pairs": "int64"})
                yield pa.RecordBatch.from_pandas(found, preserve_index=False)
                continue
            for first in range(0, len(row), 5_000):
                s = slice(first, first + 5_000)
                at = np.repeat(np.arange(first, min(first + 5_000, len(row))), np.where(single, 1, copies)[s])
                part = np.arange(len(at)) - np.searchsorted(at, at)
                part = np.where(single[at], row[at] % copies[at], part)
                taken = batch.select(["qgid", "vec", "r2"]).take(pa.array(row[at]))
                ends = np.append(0, np.cumsum(sizes[at]))
                place = np.repeat(heads[at] - ends[:-1], sizes[at]) + np.arange(ends[-1])
                sets = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ring[place].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(block[at].astype(np.int32)), pa.array(part.astype(np.int32)), sets],
                                                 names=["qgid", "vec", "r2", "block", "part", "rings"])

    if counts_only:
        found = queries.mapInArrow(run, "block int, part int, n long, pairs long")
        return found.groupBy("block", "part").agg(F.sum("n").alias("n"), F.sum("pairs").alias("pairs"))
    kind = {f.name: f.dataType.simpleString() for f in queries.schema.fields}
    return queries.mapInArrow(run, f"qgid {kind['qgid']}, vec {kind['vec']}, r2 double, block int, part int, rings array<int>")


def _compared(queries: DataFrame, train: DataFrame, rings: Broadcast, kk: int, radius: bool, query_block: int,
              report: dict | None) -> DataFrame:
    """(qgid, nid, d2): the ``kk`` nearest ids that each query meets in the rings it is sent to."""
    counts = _sent(queries, rings, kk, radius, counts_only=True)
    if report is not None:
        report["compared"] = report.get("compared", 0) + int(counts.agg(F.sum("pairs")).first()[0] or 0)
    share = counts.select("block", "part", F.ceil(F.col("n") / query_block).cast("int").alias("nq"))   # a row for each part of a block
    sent = _sent(queries, rings, kk, radius).join(share, ["block", "part"]).withColumn(
        "share", F.pmod(F.xxhash64("qgid"), F.col("nq")).cast("int")).drop("nq")
    shown = train.join(share, ["block", "part"]).withColumn("share", F.explode(F.sequence(F.lit(0), F.col("nq") - 1))).drop("nq")

    def nearest(x: np.ndarray, y: np.ndarray, r2: np.ndarray, gid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of x, row of y, d2): at least the ``kk`` nearest of each row of x, with ties."""
        near, slack = _products(x, y)
        limit = np.partition(near, kk - 1, axis=1)[:, kk - 1] + 2 * slack if len(y) > kk else np.full(len(x), np.inf)
        if radius:
            limit = np.minimum(limit, r2 * (1 + 1e-9) + 2 * slack)
        row, col = np.nonzero(near <= limit[:, None])
        return row, col, _exact(x[row], y[col])

    def best(q: pa.Table, t: pa.Table) -> pa.Table:
        out = []
        if len(q) and len(t):
            y, gid, (ids, copies) = _matrix(t.column("vec")), t.column("gid").to_numpy(), _lists(t.column("ids"))
            first_id, ring_of = np.cumsum(copies) - copies, t.column("ring").to_numpy()
            of = {r: np.flatnonzero(ring_of == r) for r in np.unique(ring_of)}
            qgid = q.column("qgid").to_numpy()
            for first in range(0, len(q), query_block):
                part = q.slice(first, query_block)
                x, r2 = _matrix(part.column("vec")), part.column("r2").to_numpy()
                which, many = _lists(part.column("rings"))
                who = np.repeat(np.arange(len(part)), many)
                found = []
                for ring in np.unique(which):
                    mine, theirs = who[which == ring], of.get(ring)
                    if theirs is not None:
                        row, col, d2 = nearest(x[mine], y[theirs], r2[mine], gid[theirs])
                        found.append((mine[row], theirs[col], d2))
                if not found:
                    continue
                row, col, d2 = (np.concatenate(c) for c in zip(*found, strict=True))
                many = copies[col]
                nid = ids[np.repeat(first_id[col] - np.cumsum(many) + many, many) + np.arange(many.sum())]
                row, d2 = np.repeat(row, many), np.repeat(d2, many)
                order = np.lexsort((nid, d2, row))
                row, nid, d2 = row[order], nid[order], d2[order]
                keep = np.arange(len(row)) - np.searchsorted(row, row) < kk
                out.append((qgid[first + row[keep]], nid[keep], d2[keep]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[], [], []]
        return pa.table([pa.array(c, k) for c, k in zip(columns, (q.schema.field("qgid").type, t.schema.field("gid").type, pa.float64()), strict=True)],
                        names=["qgid", "nid", "d2"])

    kind = train.schema["gid"].dataType.simpleString()
    of = {f.name: f.dataType.simpleString() for f in queries.schema.fields}
    found = sent.groupBy("block", "part", "share").cogroup(shown.groupBy("block", "part", "share")).applyInArrow(
        best, f"qgid {of['qgid']}, nid {kind}, d2 double")
    first = Window.partitionBy("qgid").orderBy("d2", "nid")
    return found.withColumn("__rn", F.row_number().over(first)).filter(F.col("__rn") <= kk)


def approximate_neighbours(train: DataFrame, queries: DataFrame, k: int, *, id_col: str = "id", vec_col: str = "vec",
                           exclude_self: bool = False, tables: int = 8, bucket_length: float = 1.0) -> DataFrame:
    """(query_id, neighbour_id, sq_distance, rank) among the train points that share a random-projection
    bucket with the query in one of ``tables`` tables: faster, and may miss neighbours
    (a query with no shared bucket has none).  More tables or longer buckets miss less."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector, vector_to_array
    as_vec = lambda df, i: df.select(F.col(id_col).alias(i), F.col(vec_col).cast("array<double>").alias(f"{i}_vec"),
                                     array_to_vector(F.col(vec_col).cast("array<double>")).alias("__v"))
    t, q = as_vec(train, "neighbour_id"), as_vec(queries, "query_id")
    lsh = BucketedRandomProjectionLSH(inputCol="__v", outputCol="__h", numHashTables=tables, bucketLength=bucket_length,
                                      seed=SEED).fit(t)
    placed = lambda df: lsh.transform(df).drop("__v").select(
        *[c for c in df.columns if c != "__v"], F.posexplode("__h").alias("__t", "__b")) \
        .withColumn("__b", F.get(vector_to_array("__b"), 0))
    met = placed(q).join(placed(t), ["__t", "__b"]).dropDuplicates(["query_id", "neighbour_id"])
    if exclude_self:
        met = met.filter(F.col("query_id") != F.col("neighbour_id"))
    met = met.withColumn("sq_distance", sq_dist("query_id_vec", "neighbour_id_vec"))
    best = Window.partitionBy("query_id").orderBy("sq_distance", "neighbour_id")
    return met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
        .select("query_id", "neighbour_id", "sq_distance", "rank")


def nearest_neighbours(train: DataFrame, queries: DataFrame, k: int, *, id_col: str = "id",
                       vec_col: str = "vec", exclude_self: bool = False, cell_rows: int | None = None,
                       max_cells: int = MAX_CELLS, max_rings: int = MAX_RINGS, query_block: int = QUERY_BLOCK,
                       train_block: int = TRAIN_BLOCK, report: dict | None = None, held: Held | None = None) -> DataFrame:
    """(query_id, neighbour_id, sq_distance, rank) — the k nearest train points
    of every query, ties broken by neighbour id.  ``exclude_self`` drops a
    query's own id (for a self-join such as SMOTE).  Exact; see
    :func:`approximate_neighbours` for the approximate search.

    ``report`` gets the numbers of distinct vectors on both sides and of the pairs compared.
    What the steps keep for each other goes to ``held``, whose owner drops it once the result is stored;
    without it, checkpoints are left to the session's cleaner."""
    share_code(train.sparkSession)
    keep, sent = (held.stored, held.sent) if held else (cut_lineage, train.sparkSession.sparkContext.broadcast)
    kk = k + 1 if exclude_self else k
    # Both tables feed several jobs (count, cells, two passes): each is written
    # once to the shared checkpoint directory instead of being computed again.
    tg = keep(_compact(train, id_col, vec_col, kk))
    qg = queries.select(F.col(id_col).alias("qid"), F.col(vec_col).alias("vec"), _hashed(vec_col))
    qv = keep(qg.groupBy("__h", "vec").agg(F.min("qid").alias("qgid")).withColumn("r2", F.lit(float("inf"))))
    n = tg.count()
    cells = min(max_cells, max(1, n // cell_rows if cell_rows else 2 * math.isqrt(n)))
    # the sample is bounded by the number of cells: at most 4 * max_cells vectors
    seeded = F.md5(F.concat(F.lit(str(SEED)), F.col("gid").cast("string")))
    sample = [r["vec"] for r in tg.orderBy(seeded, "gid").limit(4 * cells).select("vec").collect()]
    if not sample:
        kinds = (queries.schema[id_col].dataType.simpleString(), train.schema[id_col].dataType.simpleString())
        return queries.sparkSession.createDataFrame([], f"query_id {kinds[0]}, neighbour_id {kinds[1]}, sq_distance DOUBLE, rank INT")
    rings = Rings(spread_pivots(_matrix(pd.Series(sample)), cells))
    pivots = sent(rings)
    tg = keep(_placed(tg, pivots))
    quantiles = [i / max_rings for i in range(1, max_rings)]
    stats = tg.groupBy("cell").agg(F.count(F.lit(1)), F.min("radius"), F.max("radius"), F.percentile_approx("radius", quantiles, 1000))
    rings.cut([tuple(r) for r in stats.collect()], train_block, max_rings)   # a row per cell
    cut = sent(rings)
    ring_of = F.pandas_udf(lambda c, r: pd.Series(cut.value.ring(c, r)), "int")
    tg = tg.withColumn("ring", ring_of("cell", "radius"))
    rings.fill({r[0]: r[1] for r in tg.groupBy("ring").count().collect()}, train_block)   # a row per ring
    rings = sent(rings)   # once for all passes
    block_of = F.pandas_udf(lambda g: pd.Series(rings.value.block[g.to_numpy()]), "int")
    tg = tg.withColumn("block", block_of("ring"))
    part_of = F.pandas_udf(lambda b, h: pd.Series(h.to_numpy() % rings.value.parts[b.to_numpy()]), "int")
    tg = tg.withColumn("part", part_of("block", F.pmod(F.xxhash64("gid"), F.lit(1 << 30))))
    tg = keep(tg.select("gid", "ids", "vec", "ring", "block", "part"))
    for value in (pivots, cut):   # read no more: unpersisted on executors and driver, whoever drops the rest
        value.unpersist()

    # pass A: the ring a query falls into → radius holding kk points
    a = _compared(qv, tg, rings, kk, False, query_block, report)
    bound = a.groupBy("qgid").agg(F.max("__rn").alias("__n"), F.max("d2").alias("r2"))
    bound = bound.select("qgid", F.when(F.col("__n") >= kk, F.col("r2")).otherwise(F.lit(float("inf"))).alias("r2"))
    # pass B: every ring that can hold a point within the radius
    qb = keep(qv.drop("r2", "__h").join(bound, "qgid", "left").withColumn("r2", F.coalesce("r2", F.lit(float("inf")))))
    top = _compared(qb, tg, rings, kk, True, query_block, report)
    if report is not None:
        report["train"], report["queries"] = n, qv.count()

    # back to query ids (a vector shared by many queries is joined once per query)
    res = qg.join(qv.select("__h", "vec", "qgid"), ["__h", "vec"]).drop("__h", "vec").join(top, "qgid")
    if exclude_self:
        res = res.filter(F.col("nid") != F.col("qid"))
    wr = Window.partitionBy("qid").orderBy("d2", "nid")
    res = res.withColumn("rank", F.row_number().over(wr)).filter(F.col("rank") <= k)
    return res.select(F.col("qid").alias("query_id"), F.col("nid").alias("neighbour_id"),
                      F.col("d2").alias("sq_distance"), "rank")


def knn_vote(train: DataFrame, queries: DataFrame, label_col: str, k: int = KNN_VOTERS, *,
             id_col: str = "id", vec_col: str = "vec", threshold: float = 0.5) -> DataFrame:
    """probability = share of positive labels among the k nearest train rows."""
    nn = nearest_neighbours(train, queries, k, id_col=id_col, vec_col=vec_col)
    labels = train.select(F.col(id_col).alias("neighbour_id"), F.col(label_col).cast("double").alias("__y"))
    votes = nn.join(labels, "neighbour_id").groupBy("query_id").agg(F.avg("__y").alias("probability"))
    return votes.withColumn("prediction", (F.col("probability") >= threshold).cast("int"))


def _u32(key: Column) -> Column:
    """First 8 hex digits of an md5 as an integer in [0, 2^32)."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def _all_ranks(points: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Ranks 1 to k of every point: those found, over and over; the point itself where none was."""
    n = found.groupBy("query_id").agg(F.max("rank").alias("__n"))
    slots = points.select(F.col("id").alias("query_id"), F.explode(F.sequence(F.lit(1), F.lit(k))).alias("__slot")) \
        .join(n, "query_id", "left").withColumn("rank", (F.col("__slot") - 1) % F.col("__n") + 1)
    return slots.join(found, ["query_id", "rank"], "left").select(
        "query_id", F.coalesce("neighbour_id", "query_id").alias("neighbour_id"), F.col("__slot").alias("rank"))


def smote(df: DataFrame, label_col: str, *, id_col: str = "id", vec_col: str = "vec",
          k: int = SMOTE_NEIGHBOURS, seed: int = SEED, minority: int | None = None, approximate: dict | None = None,
          copy_chunk: int = COPY_CHUNK, held: Held | None = None) -> DataFrame:
    """Synthetic minority rows until both classes are equal in size.

    The minority is the smaller class unless it is given.  The n_new = n_major −
    n_minor synthetic rows are spread evenly over the minority rows (in
    seeded-hash order); synthetic row c of base x takes neighbour
    ``md5(seed‖x‖c) mod k`` among x's k nearest minority rows and gap u from
    another md5 draw: ``x + u · (nn − x)``.  Returns the synthetic rows only:
    (base_id, copy, neighbour_id, gap, vec, label).

    Raises if the minority has no more than ``k`` rows or if an id of it occurs
    twice.  ``approximate`` (options of :func:`approximate_neighbours`) replaces
    the exact neighbour search.  ``held`` is that of :func:`nearest_neighbours`.
    """
    from labelloop.operators.ordering import global_rank
    df = df.filter(F.col(label_col).isNotNull())
    counts = {int(r[0]): r[1] for r in df.groupBy(F.col(label_col).cast("int")).count().collect()}   # a row per class
    if minority is None:
        minority = min(counts, key=lambda c: (counts[c], -c)) if counts else 1
    n_min = counts.get(minority, 0)
    n_new = sum(counts.values()) - 2 * n_min
    mins = df.filter(F.col(label_col).cast("int") == F.lit(minority)).select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    if n_new <= 0:
        return df.sparkSession.createDataFrame(
            [], "base_id BIGINT, copy INT, neighbour_id BIGINT, gap DOUBLE, vec ARRAY<DOUBLE>, label INT")
    if n_min <= k:
        raise ValueError(f"SMOTE takes {k} neighbours, but class {minority} has only {n_min} rows; lower k or add rows")
    n_ids = mins.agg(F.count_distinct("id")).first()[0]
    if n_ids != n_min:
        raise ValueError(f"SMOTE needs one id per row, but {n_min} rows of class {minority} have {n_ids} ids")
    kk = k
    nn = nearest_neighbours(mins, mins, kk, exclude_self=True, held=held) if approximate is None else \
        _all_ranks(mins, approximate_neighbours(mins, mins, kk, exclude_self=True, **approximate), kk)
    n_part = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = global_rank(mins.withColumn("__h", shuffle_key("id", seed)), ["__h", "id"], rank_col="__r",
                         bucket=_hash_bucket("id", seed, n_part * BUCKETS))   # no copy of the vectors is kept for it
    per, extra = divmod(n_new, n_min)
    copies = ranked.select("id", "vec", (F.lit(per) + F.when(F.col("__r") <= extra, 1).otherwise(0)).alias("c"))
    # a base row may own millions of copies (tiny minority): cut its copy range
    # into chunks, spread the chunks over tasks, then explode each chunk
    chunks = copies.filter(F.col("c") > 0).withColumn(
        "__chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("c") - 1) / F.lit(copy_chunk)).cast("int"))))
    if per + 1 > copy_chunk:    # some base row owns several chunks: spread them first
        chunks = chunks.repartition(n_part, "id", "__chunk")
    gen = chunks.withColumn("copy", F.explode(F.sequence(
        F.col("__chunk") * copy_chunk + 1, F.least((F.col("__chunk") + 1) * copy_chunk, F.col("c"))))) \
        .drop("__chunk")
    key = F.concat_ws("|", F.lit(str(seed)), F.col("id").cast("string"), F.col("copy").cast("string"))
    gen = gen.withColumn("pick", (_u32(key) % kk + 1).cast("int")) \
        .withColumn("gap", _u32(F.concat(key, F.lit("|u"))).cast("double") / F.lit(float(2 ** 32)))
    nb = nn.select(F.col("query_id").alias("id"), F.col("rank").alias("pick"), "neighbour_id")
    gen = gen.join(nb, ["id", "pick"])
    nvec = mins.select(F.col("id").alias("neighbour_id"), F.col("vec").alias("nvec"))
    gen = gen.join(nvec, "neighbour_id")
    synth = F.zip_with("vec", "nvec", lambda x, y: x.cast("double") + F.col("gap") * (y.cast("double") - x.cast("double")))
    return gen.select(F.col("id").alias("base_id"), "copy", "neighbour_id", "gap", synth.alias("vec"),
                      F.lit(minority).cast("int").alias("label"))
