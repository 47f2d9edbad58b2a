"""Boosted trees against a plain numpy version, and many models in one pass."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from labelloop.operators import boosting as B
from labelloop.operators import models as M
from labelloop.operators.search import run_search
from labelloop.plans import catalog
from labelloop.plans import catalog_models as CM
from labelloop.session import scratch_path

WHOLE = {"subsample": 1.0, "colsample_bytree": 1.0}


def data(seed, n=600):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(size=n), rng.integers(0, 3, n).astype(float), rng.normal(size=n).round(1), np.full(n, 2.0)], axis=1)
    y = (x[:, 0] + (x[:, 1] == 1) * 1.5 - x[:, 2] * 0.5 + rng.normal(size=n) > 0.5).astype(float)
    w = rng.uniform(0.5, 2, n)
    return x, y, w


def table(spark, parts):
    rows = [(g, float(a), float(b), [float(v) for v in r]) for g, (x, y, w) in parts.items() for r, a, b in zip(x, y, w, strict=True)]
    return spark.createDataFrame(rows, "g int, y double, w double, x array<double>").repartition(5)


def plain_trees(x, y, w, p, bins):
    """Rounds of trees as nested (feature, edge, left, right) or leaf values, by trying every split on every node's rows."""
    p, margin, out = B.settings(p), np.zeros(len(x)), []
    edges = B.edges_of(x, bins)

    def worth(g, h):
        t = np.sign(g) * max(abs(g) - p["reg_alpha"], 0)
        return t * t / (h + p["reg_lambda"])

    def grow(at, g, h, depth, features):
        gs, hs = g[at].sum(), h[at].sum()
        best = None
        for f in features if depth < p["max_depth"] else ():
            for e in edges[f]:
                left = at[x[at, f] <= e]
                gl, hl = g[left].sum(), h[left].sum()
                if min(hl, hs - hl) < p["min_child_weight"]:
                    continue
                gain = worth(gl, hl) + worth(gs - gl, hs - hl) - worth(gs, hs)
                if gain > 1e-6 and (best is None or gain > best[0] * (1 + 1e-9)):
                    best = (gain, f, e)
        if best is None:
            return -p["learning_rate"] * np.sign(gs) * max(abs(gs) - p["reg_alpha"], 0) / (hs + p["reg_lambda"])
        _, f, e = best
        return f, e, grow(at[x[at, f] <= e], g, h, depth + 1, features), grow(at[x[at, f] > e], g, h, depth + 1, features)

    def value(tree, row):
        while isinstance(tree, tuple):
            tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
        return tree

    for r in range(p["n_estimators"]):
        chance = 1 / (1 + np.exp(-margin))
        tree = grow(np.arange(len(x)), (chance - y) * w, chance * (1 - chance) * w, 0, B.drawn_features(x.shape[1], p, r))
        out.append(tree)
        margin += np.array([value(tree, row) for row in x])
    return out


def nested(t, node=0):
    return float(t.value[node]) if t.left[node] == node else (t.feature[node], t.edge[node], nested(t, t.left[node]), nested(t, t.right[node]))


def same(a, b):
    if isinstance(a, tuple) != isinstance(b, tuple):
        return False
    if isinstance(a, tuple):
        return a[0] == b[0] and a[1] == pytest.approx(b[1]) and same(a[2], b[2]) and same(a[3], b[3])
    return a == pytest.approx(b, rel=1e-6, abs=1e-9)


@pytest.mark.parametrize("params", [
    {"n_estimators": 2, "max_depth": 3, "min_child_weight": 1},
    {"n_estimators": 1, "max_depth": 4, "min_child_weight": 8, "reg_alpha": 3.0, "reg_lambda": 10.0},
    {"n_estimators": 2, "max_depth": 2, "min_child_weight": 1, "colsample_bytree": 0.5, "random_state": 7}])
def test_trees_equal_trying_every_split(spark, params):
    x, y, w = data(1)
    p = {**WHOLE, **params}
    found = B.fit_many(table(spark, {0: (x, y, w)}), [(0, p)], max_bins=16)[0]
    want = plain_trees(x, y, w, p, 16)
    assert len(found) == len(want)
    for a, b in zip(found, want, strict=True):
        assert same(nested(a), b)


def test_many_models_take_the_jobs_of_one(spark):
    parts = {g: data(g, 300) for g in range(3)}
    rows = table(spark, parts)
    several = [(g, {"n_estimators": 3, "max_depth": 3, "learning_rate": r, "random_state": s}) for g in range(3) for r, s in ((0.1, 1), (0.5, 2))]

    def jobs(models):
        spark.sparkContext.setJobGroup(f"fit{len(models)}", "")
        found = B.fit_many(rows, models)
        n = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"fit{len(models)}"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return found, n

    alone, one = jobs(several[:1])
    together, six = jobs(several)
    assert six <= one + 6                                       # a wider shuffle may take another stage, not six times the jobs
    assert len(together) == 6 and all(len(t) == 3 for t in together)
    assert same(nested(together[0][2]), nested(alone[0][2]))    # a model does not depend on what is fitted beside it
    assert nested(together[0][0]) != nested(together[2][0])


def test_margins_kept_between_rounds_change_nothing(spark, monkeypatch):
    rows = table(spark, {0: data(5)})
    p = {"n_estimators": 5, "max_depth": 2, "learning_rate": 0.3}
    plain = B.fit_many(rows, [(0, p)])[0]
    monkeypatch.setattr(B, "KEEP_EVERY", 2)
    monkeypatch.setattr(B, "COMBINE", 2)                        # partial sums meet in two steps
    kept = B.fit_many(rows, [(0, p)])[0]
    assert all(same(nested(a), nested(b)) for a, b in zip(plain, kept, strict=True))
    x, y, _ = data(5)
    assert ((B.margins(kept, x) > 0) == y).mean() > 0.7


def test_edges_come_from_a_bounded_sample_in_which_copies_weigh_by_their_number(spark):
    x = np.random.default_rng(3).normal(size=(4000, 2))
    rows = table(spark, {0: (x, (x[:, 0] > 0).astype(float), np.ones(4000)), 1: (x[:50], np.ones(50), np.ones(50))})
    first = rows.where("g = 0").orderBy(F.xxhash64("x")).first()   # a value that any order by hash meets before all others
    copied = rows.unionByName(spark.range(4000).select(*[F.lit(first[c]).cast(rows.schema[c].dataType).alias(c) for c in rows.columns]))
    tree = B.fit_many(copied, [(0, {"n_estimators": 1, "max_depth": 1, "min_child_weight": 1, "subsample": 1, "colsample_bytree": 1})], edge_rows=1000)[0][0]
    assert len(tree.left) == 3 and tree.feature[0] == 0 and abs(tree.edge[0]) < 0.3
    sample = B.edge_sample(copied, 1000)
    found = {(r.g, tuple(r.x)): r.n for r in sample.collect()}
    assert 400 < found[0, tuple(first.x)] < 600 and 900 < sum(n for (g, _), n in found.items() if g == 0) < 1100
    assert sum(n for (g, _), n in found.items() if g == 1) == 50
    assert "Window" not in sample._jdf.queryExecution().toString()   # no task takes a whole group
    assert {(r.g, tuple(r.x)): r.n for r in B.edge_sample(copied.repartition(5), 1000).collect()} == found


def test_rows_and_columns_are_drawn(spark):
    p = B.settings({"subsample": 0.5, "colsample_bytree": 0.3})
    keys = np.arange(10_000, dtype=np.uint64)
    assert 0.45 < B.drawn_rows(keys, p, 0).mean() < 0.55
    assert (B.drawn_rows(keys, p, 0) != B.drawn_rows(keys, p, 1)).any()
    assert [len(B.drawn_features(20, p, r)) for r in range(3)] == [6, 6, 6]
    assert len({tuple(B.drawn_features(20, p, r)) for r in range(5)}) > 1


def test_odd_rows_and_settings(spark):
    with pytest.raises(ValueError, match="maxIter"):
        B.settings({"maxIter": 3})
    assert set(B.settings({})) == set(B.BOOSTED_DEFAULTS) and len(B.BOOSTED_DEFAULTS) == 9
    x, y, w = data(2, 100)
    x[::7, 0] = np.nan
    found = B.fit_many(table(spark, {0: (x, y, w), 1: (x[:1], y[:1], w[:1])}),
                       [(0, {**WHOLE, "n_estimators": 2, "max_depth": 2, "min_child_weight": 1}), (1, {"n_estimators": 1}), (9, {"n_estimators": 1})])
    assert np.isfinite(B.margins(found[0], x)).all() and len(found[0]) == 2
    assert found[1][0].depth == 0 and found[2] == []            # one row cannot be split; a group without rows has no tree


def test_model_is_a_stage_that_is_saved_and_read(spark):
    x, y, w = data(3, 300)
    trees = B.fit_many(table(spark, {0: (x, y, w)}), [(0, {"n_estimators": 4, "max_depth": 3})])[0]
    df = table(spark, {0: (x, y, w)}).withColumn("features", array_to_vector("x"))
    model = PipelineModel(stages=[B.BoostedTreesModel.of(trees, "features")])
    path = scratch_path(spark, "test-model")
    model.write().overwrite().save(path)
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    a = [r.probability[1] for r in model.transform(df).select("probability").collect()]
    b = [r.probability[1] for r in again.transform(df).select("probability").collect()]
    assert a == b and np.allclose(sorted(a), sorted(1 / (1 + np.exp(-B.margins(trees, x)))))
    assert again.transform(df.limit(0)).count() == 0


def test_classifiers_score_in_a_session_that_observed_something(spark):
    """Spark's training summaries hold the session, which cannot be sent to tasks once it has observed anything."""
    from pyspark.sql import Observation

    from labelloop.operators import models as M
    seen = Observation("rows")
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 5
    rows = [(i, float(i % 7), "ab"[i % 2], int(i % 3 == 0), 1 + i % 12, 1 + i % 365) for i in range(60)]
    df = spark.createDataFrame(rows, "row_id long, x double, c string, label int, Month int, Dayofyear int")
    for kind, params in (("lr", {"maxIter": 3}), ("rf", {"numTrees": 2}), ("svc", {"maxIter": 2}), ("dt", {"maxDepth": 2}), ("gbt", {"n_estimators": 1})):
        model = M.fit_model(df, M.ModelSpec(["c"], ["x"], kind=kind, params=params))
        assert M.score(model, df).select("score").where("score is not null").count() == 60


# Queries that fit boosted trees, and the boosted part of those that fit more.
FITS = {
    "d18_fit_set_metrics": catalog.QUERIES["d18_fit_set_metrics"],
    "h22_batch_scoring": catalog.QUERIES["h22_batch_scoring"],
    "h23_score_every_station": catalog.QUERIES["h23_score_every_station"],
    "h12_boosted_trees": catalog.QUERIES["h12_boosted_trees"],
    "h24_model_round_trip": catalog.QUERIES["h24_model_round_trip"],
    "h20_search_trials": lambda spark, d: run_search(CM._with_folds(spark, d), CM.SPEC, CM._trials(spark).where("n < 2"), wave=2)[0],
    "h19_model_benchmark": lambda spark, d: M.benchmark(CM._with_folds(spark, d), CM.SPEC, kinds=("gbt",), params=CM.TINY),
}


@pytest.mark.parametrize("query", FITS)
def test_queries_read_their_edges_from_a_bounded_sample_of_each_group(spark, sf_dir, monkeypatch, query):
    seen, whole = [], B.edge_sample

    def sample(rows, edge_rows):
        seen.append((rows, whole(rows, 100)))
        return seen[-1][1]

    monkeypatch.setattr(B, "edge_sample", sample)
    assert FITS[query](spark, sf_dir).collect()
    rows, drawn = seen[0]
    of = {r.g: r.n for r in drawn.groupBy("g").agg(F.sum("n").alias("n")).collect()}
    assert {r.g for r in rows.groupBy("g").count().where("count > 500").collect()} == set(of)
    assert all(50 < n < 150 for n in of.values())
    assert "Window" not in drawn._jdf.queryExecution().toString()   # no task takes a whole group


def test_sums_touch_only_what_is_not_in_the_usual_bin():
    rng = np.random.default_rng(3)
    n, nodes = 2000, 3
    x = np.zeros((n, 21))
    x[np.arange(n), rng.integers(0, 20, n)] = 1     # a one-hot column of 20 levels
    x[:, 20] = rng.normal(size=n)
    x[::7, 20] = np.nan
    edges = B.edges_of(x, 16)
    bins, sizes = B.binned(x, edges), np.array([len(e) + 1 for e in edges])
    assert (bins[::7, 20] == len(edges[20])).all()
    usual = np.array([np.bincount(c).argmax() for c in bins.T])
    row, feature = np.nonzero(bins != usual)
    assert len(row) < 2.1 * n                       # of 21 features
    node, grad, curve, use = rng.integers(0, nodes, n), rng.normal(size=n), rng.uniform(0.1, 1, n), rng.random(n) < 0.8
    use &= ~((node == 1) & (bins[:, 0] == usual[0]))    # nobody of node 1 is in the usual bin of feature 0
    sums, heads = B.Sums(nodes, sizes, usual), np.cumsum(sizes) - sizes
    sums.add(np.where(use, node, -1), row, heads[feature] + bins[row, feature], grad, curve, use)
    g, h, some = sums.found()
    assert some.all() and h[1, usual[0]] == 0       # exactly
    for f in range(21):
        for k in range(nodes):
            at = use & (node == k)
            for got, v in ((g, grad), (h, curve)):
                want = np.bincount(bins[at, f], v[at], sizes[f])
                assert np.allclose(got[k, heads[f]:heads[f] + sizes[f]], want, atol=1e-9)


def test_stored_blocks_are_small_and_hold_every_row(spark):
    """Spark reads thousands of stored rows at once: a block stays small, whatever the width."""
    x, y, w = data(9, 3000)
    wide = np.repeat(x, 25, axis=1)     # 100 features
    edges = {0: B.edges_of(wide, 16)}
    path = B._stored_rows(table(spark, {0: (wide, y, w)}), edges, {0: 2})
    blocks = spark.read.parquet(path).collect()
    assert len(blocks) < 3000 / 20
    assert max(sum(len(r[c]) for c in ("y", "w", "key", "bins", "margins")) for r in blocks) <= B.BLOCK_BYTES
    assert sorted(np.concatenate([np.frombuffer(r.w) for r in blocks])) == sorted(w)
    bins = np.concatenate([np.frombuffer(r.bins, np.uint8) for r in blocks]).reshape(-1, 100)
    assert sorted(map(bytes, bins)) == sorted(map(bytes, B.binned(wide, edges[0])))
