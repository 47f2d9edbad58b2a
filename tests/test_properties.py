"""Properties of the seed/model-dependent operators (P rows of SURVEY §2)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloop.operators import models as M
from labelloop.operators.neighbours import nearest_neighbours, smote
from labelloop.operators.split import stratified_folds, stratified_split


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(7)
    pts = rng.normal(size=(120, 4)).round(3)
    pts[100:] = pts[0]                       # 20 copies of one vector (a hot duplicate group)
    rows = [(i, [float(x) for x in p], int(i % 4 == 0)) for i, p in enumerate(pts)]
    return spark.createDataFrame(rows, "id long, vec array<double>, y int"), pts


def test_knn_matches_bruteforce_with_duplicates(spark, points):
    df, pts = points
    got = nearest_neighbours(df, df, 5, cell_rows=8).collect()
    by_q = {}
    for r in got:
        by_q.setdefault(r["query_id"], []).append((r["rank"], r["neighbour_id"]))
    for q in range(len(pts)):
        d = ((pts - pts[q]) ** 2).sum(axis=1)
        want = [int(i) for i in sorted(range(len(pts)), key=lambda i: (d[i], i))[:5]]
        assert [n for _, n in sorted(by_q[q])] == want


def test_knn_exclude_self(spark, points):
    df, _ = points
    nn = nearest_neighbours(df, df, 3, exclude_self=True, cell_rows=8)
    assert nn.filter("query_id = neighbour_id").count() == 0
    assert nn.groupBy("query_id").count().filter("count <> 3").count() == 0


def test_smote_balances_and_interpolates(spark, points):
    df, _ = points
    s = smote(df, "y", k=5)
    n_min = df.filter("y = 1").count()
    n_maj = df.filter("y = 0").count()
    assert s.count() == n_maj - n_min
    # every synthetic point lies on the segment between its base and neighbour
    base = df.select(F.col("id").alias("base_id"), F.col("vec").alias("b"))
    nb = df.select(F.col("id").alias("neighbour_id"), F.col("vec").alias("n"))
    j = s.join(base, "base_id").join(nb, "neighbour_id").collect()
    for r in j:
        b, n, v, u = np.array(r["b"]), np.array(r["n"]), np.array(r["vec"]), r["gap"]
        assert 0 <= u < 1 and np.allclose(v, b + u * (n - b))


def test_smote_chooses_the_smaller_class_and_refuses_what_it_cannot_do(spark):
    make = lambda rows: spark.createDataFrame(rows, "id long, vec array<double>, y int")
    few = make([(i, [float(i), 0.0], int(i < 3)) for i in range(10)])
    with pytest.raises(ValueError, match="only 3 rows"):
        smote(few, "y", k=5)
    assert smote(few, "y", k=2).count() == 4
    mostly_positive = make([(i, [float(i % 7), float(i)], int(i >= 8)) for i in range(33)])
    made = smote(mostly_positive, "y", k=5)
    assert made.count() == 25 - 8 and {r["label"] for r in made.collect()} == {0}
    with pytest.raises(ValueError, match="ids"):
        smote(make([(i // 2, [float(i), 0.0], int(i < 12)) for i in range(40)]), "y", k=5)
    assert smote(make([]), "y").count() == 0


def test_binary_vectors_do_not_fill_one_task(spark):
    """Few distinct pivot distances: cells hold hundreds of rows, and are still exact."""
    rng = np.random.default_rng(1)
    pts = np.unique(rng.integers(0, 2, size=(400, 12)), axis=0).astype(float)
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(pts)], "id long, vec array<double>")
    got = nearest_neighbours(df, df, 4, cell_rows=8, query_block=16, train_block=32).collect()
    by_q = {}
    for r in got:
        by_q.setdefault(r["query_id"], []).append((r["rank"], r["neighbour_id"]))
    for q in range(len(pts)):
        d = ((pts - pts[q]) ** 2).sum(axis=1)
        assert [n for _, n in sorted(by_q[q])] == sorted(range(len(pts)), key=lambda i: (d[i], i))[:4]
def test_one_cell_is_many_tasks(spark):
    """All points at one distance from the pivot: the ring is dealt to parts of a bounded size, and so are its queries."""
    import labelloop.operators.neighbours as N
    rng = np.random.default_rng(2)
    pts = rng.normal(size=(900, 6))
    pts = np.concatenate([np.zeros((1, 6)), pts / np.linalg.norm(pts, axis=1, keepdims=True)])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(pts)], "id long, vec array<double>")
    rings = N.Rings(pts[:1])
    rings.cut([(0, 901, 0.0, 1.0, [1.0] * 63)], 100, 64)
    rings.fill({0: 1, 1: 900}, 100)
    assert rings.parts.max() == 9
    got = nearest_neighbours(df, df, 3, cell_rows=2000, query_block=50, train_block=100).collect()
    by_q = {}
    for r in got:
        by_q.setdefault(r["query_id"], []).append((r["rank"], r["neighbour_id"]))
    for q in range(len(pts)):
        d = ((pts - pts[q]) ** 2).sum(axis=1)
        assert [n for _, n in sorted(by_q[q])] == sorted(range(len(pts)), key=lambda i: (d[i], i))[:3]


def _one_hot_rows(n, seed=4):
    """Rows like the observations': a station, three wind directions and some numbers, each divided by its deviation."""
    rng = np.random.default_rng(seed)
    cats = [rng.integers(0, m, n) for m in (49, 16, 16, 16)]
    hot = np.concatenate([np.eye(c.max() + 1)[c] for c in cats], axis=1)
    x = np.concatenate([hot, rng.normal(size=(n, 12)) + rng.normal(size=(49, 12))[cats[0]]], axis=1)
    return x / x.std(0)


def test_few_pairs_are_compared_on_clustered_rows(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 10)) * 12
    pts = centres[rng.integers(0, 60, 6000)] + rng.normal(size=(6000, 10))
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(pts)], "id long, vec array<double>")
    report = {}
    got = nearest_neighbours(df, df, 5, exclude_self=True, report=report).collect()
    assert report["compared"] < 0.1 * report["train"] * report["queries"], report
    by_q = {}
    for r in got:
        by_q.setdefault(r["query_id"], []).append((r["rank"], r["neighbour_id"]))
    for q in range(0, 6000, 97):
        d = ((pts - pts[q]) ** 2).sum(axis=1)
        assert [n for _, n in sorted(by_q[q])] == [i for i in sorted(range(6000), key=lambda i: (d[i], i)) if i != q][:5]


def test_rings_within_reach_are_those_of_the_bounds(spark, monkeypatch):
    """Cells are ruled out first, and queries of full rings need no bounds at all."""
    import labelloop.operators.neighbours as N
    x = _one_hot_rows(400)
    rings = N.Rings(N.spread_pivots(x, 30))
    cell, radius = rings.place(x)
    rings.cut([(c, int((cell == c).sum()), radius[cell == c].min(), radius[cell == c].max(),
                np.quantile(radius[cell == c], np.arange(1, 8) / 8, method="lower").tolist()) for c in np.unique(cell)], 5, 8)
    at, counts = np.unique(rings.ring(cell, radius), return_counts=True)
    rings.fill(dict(zip(at.tolist(), counts.tolist(), strict=True)), 5)
    for limit in (np.full(400, 1e-9), np.linspace(0.1, 30, 400), np.full(400, np.inf)):
        row, ring = rings.within(x, limit)
        want = np.nonzero((rings.bounds(x) <= limit[:, None]) & (rings.rows > 0))
        assert set(zip(row.tolist(), ring.tolist(), strict=True)) == set(zip(want[0].tolist(), want[1].tolist(), strict=True))
        assert len(row) == len(want[0])


def test_neighbours_of_one_hot_rows(spark):
    x = _one_hot_rows(3000)
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(x)], "id long, vec array<double>")
    report = {}
    got = {(r["query_id"], r["rank"]): r["sq_distance"] for r in nearest_neighbours(df, df, 5, exclude_self=True, report=report).collect()}
    for q in range(0, 3000, 61):
        d = np.sort(((x - x[q]) ** 2).sum(axis=1))[1:6]
        assert np.allclose([got[(q, r)] for r in range(1, 6)], d, rtol=1e-9)
    assert len(got) == 15_000


def test_approximate_neighbours_find_most(spark, points):
    from labelloop.operators.neighbours import approximate_neighbours
    df, _ = points
    exact_nn = {(r["query_id"], r["rank"]): r["sq_distance"] for r in nearest_neighbours(df, df, 3).collect()}
    near = approximate_neighbours(df, df, 3, tables=12, bucket_length=2.0).collect()
    assert sum(abs(r["sq_distance"] - exact_nn[(r["query_id"], r["rank"])]) < 1e-9 for r in near) > 0.9 * len(exact_nn)
    assert smote(df, "y", approximate={"tables": 2, "bucket_length": 0.1}).count() == smote(df, "y").count()


def test_folds_partition_and_balance(spark):
    df = spark.range(103).select("id", (F.col("id") % 3 == 0).cast("int").alias("y"))
    f = stratified_folds(df, "y", "id", k=5)
    assert f.count() == 103 and f.select("id").distinct().count() == 103
    sizes = f.groupBy("y", "fold").count().groupBy("y").agg((F.max("count") - F.min("count")).alias("d")).collect()
    assert all(r["d"] <= 1 for r in sizes)
    s = stratified_split(df, "y", "id", 0.2)
    per = {(r["y"], r["split"]): r["count"] for r in s.groupBy("y", "split").count().collect()}
    assert per[(1, "test")] == round(35 * 0.2) and per[(0, "test")] == round(68 * 0.2)


def test_model_scores_unknown_category_and_round_trip(spark, tmp_path):
    train = spark.createDataFrame([(i, "a" if i % 2 else "b", float(i % 7), float(i % 3 == 0), 5, 1, i % 2)
                                   for i in range(60)],
                                  "event_id long, cat string, x double, z double, Dayofyear int, Month int, label int")
    spec = M.ModelSpec(categorical=["cat"], numeric=["x", "z"], kind="lr", params={"maxIter": 10})
    model = M.fit_model(train, spec)
    test = spark.createDataFrame([(1, "zzz", 1.0, None, 5, 1, 0), (2, None, None, 1.0, 5, 1, 1)],
                                 "event_id long, cat string, x double, z double, Dayofyear int, Month int, label int")
    out = M.score(model, test, threshold=0.5).collect()
    assert all(0.0 <= r["score"] <= 1.0 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    path = M.save_model(model, str(tmp_path / "m"))
    again = M.score(M.load_model(path), test).collect()
    assert [r["score"] for r in again] == [r["score"] for r in out]


def test_population_scaler_matches_population_std(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, c double")
    v = VectorAssembler(inputCols=["a", "c"], outputCol="f").transform(df)
    out = M.population_scaler(v, "f", "g").transform(v).select(vector_to_array("g").alias("g")).collect()
    std_a = np.std([1.0, 2.0, 4.0])                      # population std, as the reference's scaler
    assert np.allclose([r["g"][0] for r in out], np.array([1.0, 2.0, 4.0]) / std_a)
    assert [r["g"][1] for r in out] == [5.0, 5.0, 5.0]   # constant column passes through


def test_minimal_payload_is_scorable(spark):
    """The reference's API contract: a payload with only Date and Location
    (every measurement missing) still gets a probability and a class."""
    from pyspark.sql import types as T
    from labelloop.operators.cleaning import parse_payload
    from labelloop.plans.jobs import prepare_dataset
    rows = [(f"2024-01-{1 + i % 28:02d}", "AB"[i % 2], float(i % 9), float(i % 5), "NS"[i % 2], "YN"[i % 3 == 0],
             "Yes" if i % 4 == 0 else "No") for i in range(80)]
    train = spark.createDataFrame(rows, "Date string, Location string, Rainfall double, WindSpeed9am double, "
                                        "WindDir9am string, RainToday string, RainTomorrow string")
    data = prepare_dataset(train.withColumn("row_id", F.monotonically_increasing_id()))
    spec = M.ModelSpec(categorical=["Location", "WindDir9am", "RainToday"], numeric=["Rainfall", "WindSpeed9am"],
                       kind="gbt", params={"n_estimators": 3, "max_depth": 2})
    model = M.fit_model(data, spec)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("Date", "Location", "WindDir9am", "RainToday")]
                          + [T.StructField(c, T.DoubleType()) for c in ("Rainfall", "WindSpeed9am")])
    payload = spark.createDataFrame([('{"Date": "2024-02-01", "Location": "Sydney"}',)], "p string")
    ok, rejected = parse_payload(payload, "p", schema, ["Date", "Location"])
    assert rejected.count() == 0
    feats = ok.withColumns({"Dayofyear": F.dayofyear(F.to_date("Date")), "Month": F.month(F.to_date("Date"))})
    r = M.score(model, feats).first()
    assert 0.0 <= r["score"] <= 1.0 and r["predicted"] == int(r["score"] >= 0.5)


def test_knn_with_query_salting_matches_bruteforce(spark, points):
    df, pts = points
    got = nearest_neighbours(df, df, 5, cell_rows=8, query_block=3, train_block=5).collect()
    by_q = {}
    for r in got:
        by_q.setdefault(r["query_id"], []).append((r["rank"], r["neighbour_id"]))
    for q in range(len(pts)):
        d = ((pts - pts[q]) ** 2).sum(axis=1)
        want = [int(i) for i in sorted(range(len(pts)), key=lambda i: (d[i], i))[:5]]
        assert [n for _, n in sorted(by_q[q])] == want


def test_smote_chunked_copy_generation(spark, points):
    import labelloop.operators.neighbours as N
    df, _ = points
    plain = {(r["base_id"], r["copy"]): r["neighbour_id"] for r in smote(df, "y", k=5).collect()}
    chunked = {(r["base_id"], r["copy"]): r["neighbour_id"] for r in N.smote(df, "y", k=5, copy_chunk=1).collect()}  # spread path
    assert chunked == plain and len(plain) == df.filter("y = 0").count() - df.filter("y = 1").count()


def test_rings_are_sent_once_and_without_the_square_of_their_pivots(spark, monkeypatch):
    import pickle

    from labelloop.operators import neighbours as N
    x = np.random.default_rng(4).normal(size=(600, 5))
    rings = N.Rings(x)
    before = rings.between.copy()
    sent = pickle.dumps(rings)
    assert len(sent) < rings.between.nbytes / 10
    assert np.array_equal(pickle.loads(sent).between, before)
    values, send = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, v: values.append(v) or send(self, v))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, vec array<double>")
    assert N.nearest_neighbours(df, df, 3, exclude_self=True).count() == 1800
    assert sum(isinstance(v, N.Rings) for v in values) == 3     # before and after the cut and the count: not for each step that uses them


def test_smote_leaves_its_balanced_rows_only_and_drops_them(spark, sf_dir):
    import os

    from labelloop.operators import models as M
    from labelloop.plans import catalog_models as CM
    from labelloop.session import SHUFFLE_CLEANUP, ensure_checkpoint_dir
    top = ensure_checkpoint_dir(spark).removeprefix("file:")
    rows = CM._with_folds(spark, sf_dir).checkpoint()
    there = lambda: {(d, f) for d, _, fs in os.walk(top) for f in fs if f.startswith("part-")}
    before = there()
    folds = M.prepare_folds(rows, CM.SMOTED)
    counts = [{r["label"]: r["count"] for r in f.train.rows.groupBy("label").count().collect()} for f in folds]
    assert len(folds) == 5 and all(c[0.0] == c[1.0] for c in counts)
    new = there() - before
    kept = {p for f in folds for p in f.train.own.paths}
    assert len(kept) == 10 and all(any(os.path.basename(p) in d for p in kept) for d, _ in new)     # balanced and held-out rows of five folds
    M.drop_folds(folds)
    assert not there() - before
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"


def test_folds_side_by_side_are_bounded_by_smote_and_by_rows(spark, sf_dir, monkeypatch):
    import threading
    import time

    from labelloop.operators import models as M
    from labelloop.plans import catalog_models as CM
    rows = CM._with_folds(spark, sf_dir).checkpoint()
    now, most, lock = [0], [0], threading.Lock()

    def prepare(*args, **named):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.3)
        with lock:
            now[0] -= 1
        return M.Prepared([], rows, "Rainfall")

    monkeypatch.setattr(M, "prepare", prepare)

    def side_by_side(spec):
        most[0] = 0
        assert len(M.prepare_folds(rows, spec)) == 5
        return most[0]

    assert side_by_side(CM.SMOTED) <= 2 < side_by_side(CM.SPEC)
    monkeypatch.setattr(M, "FOLD_ROWS", rows.count() - 1)
    assert side_by_side(CM.SPEC) == 1
