"""Gradient-boosted trees with second-order splits, many models in one pass.

Rows are binned once per group (a group is what shares rows and bins: a fold) and
stored; every model (a setting on a group) then grows one tree a round, and a level
of all trees of all models is one job: each task adds up gradients and curvatures
per (model, node, feature, bin) with numpy, the sums of all tasks meet by (model,
node), and one row per node with its best split comes back.  So the number of jobs is rounds
x depth, whatever the number of models.  What the driver holds are the trees.

The objective is the logistic loss.  With G and H the sums of gradients and
curvatures of a node, T its shrinkage by ``reg_alpha`` and ``L`` the penalty
``reg_lambda``, a node is worth T(G)^2 / (H + L), a split the worth of its
children above that of the node, and a leaf -T(G) / (H + L), times
``learning_rate``.  A child needs curvature of ``min_child_weight``.  Each tree
draws its features (``colsample_bytree``) and its rows (``subsample``); draws are
hashes of ``random_state``, so a fit can be repeated.

Margins are stored with the rows every ``KEEP_EVERY`` rounds; in between, tasks add
the trees grown since.  A missing value (NaN) lies above every edge.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloop.session import drop_scratch, scratch_path, share_code

# ---- fixed values ----------------------------------------------------------
# Settings of the reference's production model, by its own parameter names.
BOOSTED_DEFAULTS = {"n_estimators": 796, "max_depth": 10, "learning_rate": 0.11812558198339064, "subsample": 0.7724069195699388,
                    "colsample_bytree": 0.7000620673916282, "min_child_weight": 6, "reg_alpha": 3.479275996079184e-05,
                    "reg_lambda": 1.3538647103817488e-06, "random_state": 42}
# ---------------------------------------------------------------------------

MAX_BINS = 64          # bins of a feature
EDGE_ROWS = 20_000     # rows of a group (about so many of a larger one) that its bin edges are read from; all rows are binned and fitted on
KEEP_EVERY = 8         # rounds between stored margins
BLOCK_BYTES, BLOCKS = 1 << 12, 256   # bytes of a stored block of rows; blocks that numpy takes at once
COMBINE = 64           # partial sums of a node that one task adds up


def settings(params: dict) -> dict:
    """All nine parameters; unknown names are refused."""
    unknown = set(params) - set(BOOSTED_DEFAULTS)
    if unknown:
        raise ValueError(f"unknown parameters {sorted(unknown)}; known are {sorted(BOOSTED_DEFAULTS)}")
    p = {**BOOSTED_DEFAULTS, **params}
    return {k: int(v) if k in ("n_estimators", "max_depth", "random_state") else float(v) for k, v in p.items()}


@dataclass
class Tree:
    """Nodes in flat arrays; a leaf is its own child.  ``at`` is the last bin that goes left, ``edge`` its upper edge."""
    feature: list[int] = field(default_factory=lambda: [0])
    at: list[int] = field(default_factory=lambda: [0])
    edge: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    depth: int = 0

    def split(self, node: int, feature: int, at: int, edge: float) -> tuple[int, int]:
        a, b = len(self.left), len(self.left) + 1
        for child in (a, b):
            self.feature.append(0)
            self.at.append(0)
            self.edge.append(0.0)
            self.left.append(child)
            self.right.append(child)
            self.value.append(0.0)
        self.feature[node], self.at[node], self.edge[node], self.left[node], self.right[node] = feature, at, edge, a, b
        return a, b

    def leaves_of(self, x: np.ndarray, binned: bool) -> np.ndarray:
        """Node of each row of bins, or of values."""
        feature, left, right = np.array(self.feature), np.array(self.left), np.array(self.right)
        cut = np.array(self.at if binned else self.edge)
        node, flat, heads = np.zeros(len(x), np.int64), x.ravel(), np.arange(len(x)) * x.shape[1]
        for depth in range(self.depth):
            if depth == 0:   # all rows are at the root
                node = np.where(x[:, feature[0]] <= cut[0], left[0], right[0])
                continue
            node = np.where(flat.take(heads + feature.take(node)) <= cut.take(node), left.take(node), right.take(node))
        return node


def margins(trees: Sequence[Tree], x: np.ndarray, binned: bool = False) -> np.ndarray:
    total = np.zeros(len(x))
    for t in trees:
        total += np.array(t.value)[t.leaves_of(x, binned)]
    return total


def _hash(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x + np.uint64(seed % (1 << 63))) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def drawn_features(n: int, p: dict, round_: int) -> np.ndarray:
    take = max(1, int(p["colsample_bytree"] * n))
    return np.sort(np.argsort(_hash(np.arange(n, dtype=np.uint64), p["random_state"] * 1_000_003 + round_), kind="stable")[:take])


def drawn_rows(keys: np.ndarray, p: dict, round_: int) -> np.ndarray:
    if p["subsample"] >= 1:
        return np.ones(len(keys), bool)
    return (_hash(keys, p["random_state"] * 2_000_003 + round_ + 17) >> np.uint64(11)) < np.uint64(p["subsample"] * 2 ** 53)


def edges_of(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Upper edges of all but the last bin of each column: between neighbouring values, or at quantiles where there are more."""
    out = []
    for column in x.T:
        values = np.unique(column[~np.isnan(column)])
        if len(values) > bins:
            values = np.unique(np.quantile(column[~np.isnan(column)], np.linspace(0, 1, bins + 1), method="lower"))
        out.append((values[:-1] + values[1:]) / 2)
    return out


def binned(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    out = np.zeros(x.shape, np.uint8)
    for j, e in enumerate(edges):
        out[:, j] = ~(x[:, j] <= e[0]) if len(e) == 1 else np.searchsorted(e, x[:, j], side="left")   # NaN lies above every edge
    return out


def best_split(g: np.ndarray, h: np.ndarray, heads: np.ndarray, ends: np.ndarray, p: dict) -> tuple | None:
    """(feature, bin, gain, G left, H left, G, H) from sums per bin, features one after the other; None without a gain.

    ``heads`` and ``ends`` bound each drawn feature's bins.  Of equal gains the first feature and bin wins.
    """
    def worth(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        t = np.sign(a) * np.maximum(np.abs(a) - p["reg_alpha"], 0)
        return np.where(b + p["reg_lambda"] > 0, t * t / np.where(b + p["reg_lambda"] > 0, b + p["reg_lambda"], 1), 0.0)

    first = slice(heads[0], ends[0])
    total_g, total_h = g[first].sum(), h[first].sum()
    best = None
    for f, (a, b) in enumerate(zip(heads, ends, strict=True)):
        if b - a < 2:
            continue
        gl, hl = np.cumsum(g[a:b - 1]), np.cumsum(h[a:b - 1])
        gain = worth(gl, hl) + worth(total_g - gl, total_h - hl) - worth(total_g, total_h)
        gain[(hl < p["min_child_weight"]) | (total_h - hl < p["min_child_weight"])] = -np.inf
        at = int(gain.argmax())
        if gain[at] > 1e-6 and (best is None or gain[at] > best[2] * (1 + 1e-9)):
            best = (f, at, float(gain[at]), float(gl[at]), float(hl[at]), float(total_g), float(total_h))
    return best or (-1, -1, 0.0, 0.0, 0.0, float(total_g), float(total_h))


def leaf(g: float, h: float, p: dict) -> float:
    t = math.copysign(max(abs(g) - p["reg_alpha"], 0.0), g)
    return -p["learning_rate"] * t / (h + p["reg_lambda"]) if h + p["reg_lambda"] > 0 else 0.0


@dataclass
class Job:
    """One model: its group, settings, trees, and the nodes of the tree being grown."""
    group: int
    p: dict
    trees: list[Tree] = field(default_factory=list)
    growing: Tree | None = None
    open: list[int] = field(default_factory=list)
    features: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))


# A stored row is a block of rows of one group, each column the bytes of a numpy array: Spark passes it on whole.
STORED = pa.schema([("g", pa.int32()), ("y", pa.binary()), ("w", pa.binary()), ("key", pa.binary()), ("bins", pa.binary()), ("margins", pa.binary())])
STORED_SQL = "g int, y binary, w binary, key binary, bins binary, margins binary"


def _bytes_of(rows: np.ndarray) -> pa.Array:
    """A binary value for each row of a matrix."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows))])


def _blocks(g: int, *columns: np.ndarray) -> pa.RecordBatch:
    """Rows of a group as blocks of ``BLOCK_BYTES``: readers take thousands of them at once."""
    width = [c.itemsize * (c.shape[1] if c.ndim > 1 else 1) for c in columns]
    rows = max(1, BLOCK_BYTES // sum(width))
    heads = np.append(np.arange(0, len(columns[0]), rows), len(columns[0]))
    values = [pa.Array.from_buffers(pa.binary(), len(heads) - 1, [None, pa.py_buffer((heads * size).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(c))])
              for c, size in zip(columns, width, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(heads) - 1, g, np.int32)), *values], schema=STORED)


def _array_of(values: pa.Array, first: int, last: int, kind: type) -> np.ndarray:
    """The array that binary values ``first`` to ``last`` (exclusive) hold one after the other, without a copy."""
    ends = np.frombuffer(values.buffers()[1], np.int32, len(values) + 1, 4 * values.offset)
    a, b = int(ends[first]), int(ends[last])
    return np.frombuffer(values.buffers()[2], kind, (b - a) // np.dtype(kind).itemsize, a) if b > a else np.zeros(0, kind)


def _stored_rows(rows: DataFrame, edges: dict[int, list[np.ndarray]], slots: dict[int, int]) -> str:
    """Bin (g, y, w, x) once and store blocks of (g, y, w, key, bins, margins)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = batch.column("g").to_numpy()
            for g in np.unique(group):
                part = batch if (group == g).all() else batch.filter(pa.array(group == g))
                y, w, x = part.column("y").to_numpy(), part.column("w").to_numpy(), part.column("x")
                b = binned(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1), edges[int(g)])
                factors = _hash(np.arange(b.shape[1], dtype=np.uint64), 5) | np.uint64(1)
                key = (b.astype(np.uint64) * factors).sum(1, dtype=np.uint64) + y.astype(np.uint64)
                yield _blocks(int(g), y, w, key, b, np.zeros((len(b), slots[int(g)])))

    path = scratch_path(rows.sparkSession, "boosting")
    rows.select("g", "y", "w", "x").mapInArrow(run, STORED_SQL).write.parquet(path)
    return path


def _grouped(batch: pa.RecordBatch, features: dict[int, int], blocks: int) -> Iterator[tuple]:
    """(g, y, w, key, bins, margins) of up to ``blocks`` neighbouring blocks of a group."""
    group = batch.column("g").to_numpy()
    heads = np.flatnonzero(np.r_[True, np.diff(group) != 0, True]) if len(group) else []
    for start, stop in zip(heads[:-1], heads[1:], strict=True):
        for first in range(start, stop, blocks):
            last, g = min(first + blocks, stop), int(group[start])
            y, w, key, bins, state = (_array_of(batch.column(c), first, last, kind) for c, kind in (
                ("y", np.float64), ("w", np.float64), ("key", np.uint64), ("bins", np.uint8), ("margins", np.float64)))
            yield g, y, w, key, bins.reshape(len(y), features[g]), state.reshape(len(y), -1)


def _with_margins(stored: DataFrame, jobs: list[Job], recent: list[list[Tree]], features: dict[int, int]) -> DataFrame:
    """The stored rows with the ``recent`` trees of each model added to their margins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, y, w, key, bins, state in _grouped(batch, features, BLOCKS):
                own = [m for m, job in enumerate(jobs) if job.group == g]
                yield _blocks(g, y, w, key, bins, np.stack([state[:, s] + margins(recent[m], bins, True) for s, m in enumerate(own)], axis=1))

    return stored.mapInArrow(run, STORED_SQL)


class Sums:
    """Sums of gradients and curvatures by (node, feature, bin) of one model.

    Rows are added where a feature is not in its ``usual`` bin, whose sums are what is left of the node's; so a
    one-hot feature costs what it is set in."""

    def __init__(self, nodes: int, sizes: np.ndarray, usual: np.ndarray):
        self.nodes, self.ends, self.usual = nodes, np.cumsum(sizes), np.cumsum(sizes) - sizes + usual
        self.into = np.zeros((3, nodes, int(self.ends[-1])))   # gradients, curvatures, rows
        self.whole = np.zeros((3, nodes))

    def add(self, node: np.ndarray, row: np.ndarray, code: np.ndarray, grad: np.ndarray, curve: np.ndarray, use: np.ndarray) -> None:
        """``node`` of each row; ``code`` is a bin that is not usual of a ``row``; only rows to ``use`` count."""
        total = self.into.shape[2]
        if not use.all():
            node = np.where(use, node, self.nodes)   # what does not count lands behind the last node
        at = (node * total).take(row)
        at += code
        cells = (self.nodes + 1) * total
        for k, v in enumerate((grad, curve, None)):
            found = np.bincount(at, None if v is None else v.take(row), cells)[:self.nodes * total]
            self.into[k] += found.reshape(self.nodes, total)
            self.whole[k] += np.bincount(node, v, self.nodes + 1)[:self.nodes]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(gradients, curvatures) as nodes x bins, and which nodes have curvature."""
        heads = np.r_[0, self.ends[:-1]]
        rest = self.whole[:, :, None] - np.add.reduceat(self.into, heads, axis=2)
        rest[:2, rest[2] == 0] = 0.0   # no row, not the rounding of a difference
        self.into[:, :, self.usual] = rest
        return self.into[0], self.into[1], self.whole[1] > 0


def _level(stored: DataFrame, jobs: list[Job], recent: list[list[Tree]], sizes: dict[int, np.ndarray], usual: dict[int, np.ndarray], round_: int) -> list:
    """Best split of every open node of every model: (model, node, feature, bin, gain, G left, H left, G, H) rows."""
    ends, features = {g: np.cumsum(s) for g, s in sizes.items()}, {g: len(s) for g, s in sizes.items()}

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Sums] = {}
        for batch in batches:
            for group, y, w, keys, bins, state in _grouped(batch, features, BLOCKS):
                cell = np.flatnonzero((bins != usual[group].astype(np.uint8)).ravel())
                row, feature = np.divmod(cell, bins.shape[1])
                code = (ends[group] - sizes[group]).take(feature) + bins.ravel().take(cell)
                for slot, m in enumerate(m for m, job in enumerate(jobs) if job.group == group):
                    job = jobs[m]
                    if not job.open:
                        continue
                    place = np.full(len(job.growing.left), -1)
                    place[job.open] = np.arange(len(job.open))
                    node = place.take(job.growing.leaves_of(bins, True))
                    use = (node >= 0) & drawn_rows(keys, job.p, round_)
                    if not use.any():
                        continue
                    chance = 1 / (1 + np.exp(-(state[:, slot] + margins(recent[m], bins, True))))
                    if m not in held:
                        held[m] = Sums(len(job.open), sizes[group], usual[group])
                    held[m].add(node, row, code, (chance - y) * w, chance * (1 - chance) * w, use)
        for m, found in held.items():
            g, h, some = found.found()
            some = np.flatnonzero(some)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), m, np.int32)), pa.array(np.array(jobs[m].open, np.int32)[some]),
                                              pa.array(np.zeros(len(some), np.int32)), _bytes_of(g[some]), _bytes_of(h[some])],
                                             names=["model", "node", "lane", "g", "h"])

    def added(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.sum([np.frombuffer(x, np.float64) for x in part[c]], axis=0) for c in ("g", "h"))

    def combine(part: pd.DataFrame) -> pd.DataFrame:
        g, h = added(part)
        return pd.DataFrame({"model": part["model"].iloc[:1], "node": part["node"].iloc[:1], "lane": [0], "g": [g.tobytes()], "h": [h.tobytes()]})

    def choose(part: pd.DataFrame) -> pd.DataFrame:
        m, node = int(part["model"].iloc[0]), int(part["node"].iloc[0])
        job, (g, h) = jobs[m], added(part)
        end = ends[job.group][job.features]
        f, *rest = best_split(g, h, end - sizes[job.group][job.features], end, job.p)
        return pd.DataFrame([(m, node, int(job.features[f]) if f >= 0 else -1, *rest)], columns=names)

    names = ["model", "node", "feature", "bin", "gain", "gl", "hl", "g", "h"]
    schema = "model int, node int, lane int, g binary, h binary"
    part = stored.mapInArrow(sums, schema)
    tasks = stored.rdd.getNumPartitions()
    if tasks > COMBINE:   # many partial sums of a node are added up in two steps
        lanes = math.ceil(tasks / COMBINE)
        part = part.withColumn("lane", F.pmod(F.spark_partition_id(), F.lit(lanes))).groupBy("model", "node", "lane").applyInPandas(combine, schema)
    return part.groupBy("model", "node").applyInPandas(
        choose, "model int, node int, feature int, bin int, gain double, gl double, hl double, g double, h double").collect()


def edge_sample(rows: DataFrame, edge_rows: int) -> DataFrame:
    """(g, x, n): the rows that bin edges are read from, ``n`` of them equal to ``x``.

    All rows of a group of up to ``edge_rows``.  Of a larger one, every value ``x``
    stands for its share of ``edge_rows``, rounded up or down by its hash, so that
    copies weigh by their number, the sample hangs on the rows alone, and only
    hashes and counts are shuffled.
    """
    sizes = {r["g"]: r["count"] for r in rows.groupBy("g").count().collect()}   # a row per group
    large = {g: edge_rows / n for g, n in sizes.items() if n > edge_rows}
    small = rows.where(~F.col("g").isin(list(large))).select("g", "x", F.lit(1).cast("long").alias("n"))
    if not large:
        return small
    share = F.create_map(*[F.lit(v) for pair in large.items() for v in pair])[F.col("g")]
    hashed = rows.where(F.col("g").isin(list(large))).select("g", "x", F.xxhash64("x").alias("h"))
    part = F.shiftrightunsigned(F.xxhash64("h", "g"), 11) / F.lit(float(1 << 53))
    drawn = hashed.groupBy("g", "h").agg(F.count(F.lit(1)).alias("n")).withColumn("n", F.floor(F.col("n") * share + part)).where("n > 0")
    found = hashed.join(F.broadcast(drawn), ["g", "h"])   # about edge_rows rows a group
    return small.unionByName(found.groupBy("g", "h").agg(F.min("x").alias("x"), F.min("n").alias("n")).drop("h"))


def bin_edges(part: pd.DataFrame, max_bins: int) -> pd.DataFrame:
    """(g, edges, usual) of a group's sample: the edges of each column's bins, and the bin that most rows are in."""
    x = np.repeat(np.stack(part["x"].to_numpy()), part["n"], axis=0)
    edges = edges_of(x, max_bins)
    usual = [int(np.bincount(column).argmax()) for column in binned(x, edges).T]
    return pd.DataFrame({"g": part["g"].iloc[:1], "edges": [[e.tolist() for e in edges]], "usual": [usual]})


def fit_many(rows: DataFrame, models: Sequence[tuple[int, dict]], max_bins: int = MAX_BINS, edge_rows: int = EDGE_ROWS) -> list[list[Tree]]:
    """The trees of each model; ``rows`` are (g, y, w, x) with ``x`` an array of doubles, ``models`` (g, parameters).

    A group without rows gets no tree.
    """
    spark = rows.sparkSession
    share_code(spark)
    jobs = [Job(g, settings(p)) for g, p in models]
    found = edge_sample(rows, edge_rows).groupBy("g").applyInPandas(
        lambda part: bin_edges(part, max_bins), "g int, edges array<array<double>>, usual array<int>").collect()   # a row per group
    edges, usual = {r.g: [np.array(e) for e in r.edges] for r in found}, {r.g: np.array(r.usual) for r in found}
    sizes = {g: np.array([len(e) + 1 for e in es]) for g, es in edges.items()}
    for job in jobs:
        if job.group not in edges:
            job.p["n_estimators"] = 0
    slots = {g: sum(job.group == g for job in jobs) for g in edges}
    path = _stored_rows(rows.where(F.col("g").isin([g for g in slots if slots[g]])), edges, slots)
    stored = spark.read.parquet(path)
    recent: list[list[Tree]] = [[] for _ in jobs]
    for round_ in range(max([0, *(job.p["n_estimators"] for job in jobs)])):
        for job in jobs:
            if round_ < job.p["n_estimators"]:
                job.growing, job.open = Tree(), [0]
                job.features = drawn_features(len(edges[job.group]), job.p, round_)
        while any(job.open for job in jobs):
            splits = _level(stored, jobs, recent, sizes, usual, round_)
            for job in jobs:
                job.open = []
            deeper = {m: jobs[m].growing.depth + 1 for m, *_ in splits}
            for m, node, feature, at, _, gl, hl, g, h in sorted(splits):
                job = jobs[m]
                if feature < 0:
                    job.growing.value[node] = leaf(g, h, job.p)
                    continue
                job.growing.depth = deeper[m]
                a, b = job.growing.split(node, feature, at, float(edges[job.group][feature][at]))
                job.growing.value[a], job.growing.value[b] = leaf(gl, hl, job.p), leaf(g - gl, h - hl, job.p)
                if deeper[m] < job.p["max_depth"]:
                    job.open += [a, b]
        for m, job in enumerate(jobs):
            if job.growing is not None:
                job.trees.append(job.growing)
                recent[m].append(job.growing)
                job.growing = None
        if (round_ + 1) % KEEP_EVERY == 0 and any(round_ + 1 < job.p["n_estimators"] for job in jobs):
            after = scratch_path(spark, "boosting")
            _with_margins(stored, jobs, recent, {g: len(s) for g, s in sizes.items()}).write.parquet(after)
            drop_scratch(spark, path)
            path, stored, recent = after, spark.read.parquet(after), [[] for _ in jobs]
    drop_scratch(spark, path)
    return [job.trees for job in jobs]


class BoostedTreesModel(Model, HasFeaturesCol, MLWritable, MLReadable):
    """The trees of one fit as a pipeline stage: adds ``probability`` (a vector) and ``prediction``."""

    @keyword_only
    def __init__(self, *, featuresCol: str = "features"):  # noqa: N803  the name every stage uses
        super().__init__()
        self._set(**self._input_kwargs)
        self.trees: list[Tree] = []

    @classmethod
    def of(cls, trees: list[Tree], features: str) -> BoostedTreesModel:
        model = cls(featuresCol=features)
        model.trees = trees
        return model

    def copy(self, extra=None) -> BoostedTreesModel:
        other = super().copy(extra)
        other.trees = self.trees
        return other

    def _transform(self, dataset: DataFrame) -> DataFrame:
        share_code(dataset.sparkSession)
        trees = self.trees

        @F.pandas_udf("double")
        def chance(x: pd.Series) -> pd.Series:
            return pd.Series(1 / (1 + np.exp(-margins(trees, np.stack(x.to_numpy()))) if len(x) else np.zeros(0)))

        p = chance(vector_to_array(self.getFeaturesCol()))
        out = dataset.withColumn("__p", p)
        return out.withColumns({"probability": array_to_vector(F.array(F.lit(1.0) - F.col("__p"), F.col("__p"))),
                                "prediction": (F.col("__p") >= 0.5).cast("double")}).drop("__p")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: BoostedTreesModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:  # noqa: N802
        spark = SparkSession.active()
        DefaultParamsWriter.saveMetadata(self.model, path, spark)
        rows = [(i, t.depth, t.feature, t.at, t.edge, t.left, t.right, t.value) for i, t in enumerate(self.model.trees)]
        spark.createDataFrame(rows, "n int, depth int, feature array<int>, at array<int>, edge array<double>, left array<int>, "
                                    "right array<int>, value array<double>").write.parquet(f"{path}/trees")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> BoostedTreesModel:
        spark = SparkSession.active()
        model = self.cls()
        DefaultParamsReader.getAndSetParams(model, DefaultParamsReader.loadMetadata(path, spark))
        model.trees = [Tree(r.feature, r.at, r.edge, r.left, r.right, r.value, r.depth)
                       for r in sorted(spark.read.parquet(f"{path}/trees").collect(), key=lambda r: r.n)]
        return model
