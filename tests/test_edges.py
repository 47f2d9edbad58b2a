"""Hand-made edge rows (FIXTURES.md §3) per operator."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from labelloop.functions import values as V
from labelloop.functions.dates import parse_timestamp
from labelloop.functions.headers import normalise_text
from labelloop.operators.dedup import last_n, last_per_key
from labelloop.operators.metrics import evaluate, live_metrics
from labelloop.operators.ordering import global_rank, prefix_sums
from labelloop.operators.trials import patience_stop
from labelloop.plans.jobs import advance_watermark, build_retrain_set, count_new_rows, retrain_decision
from labelloop.session import scratch_path
from labelloop.sources import delimited as DL
from labelloop.sources.observation_files import read_observation_files


def _write_text(spark, name, text):
    path = scratch_path(spark, name).replace("file:", "")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w", encoding="utf-8") as f:
        f.write(text)
    return path


# ------------------------------------------------------------------ A3 ragged log
def test_ragged_log_arity_quotes_blank_lines(spark):
    text = ("logged_at_utc,feature_date,target_date,location,use_latest,station_name,rain_probability,predicted_rain\n"
            "\n"
            "2024-01-01T00:00:00,2024-01-01,2024-01-02,Sydney,True,\"Sydney, Obs\",0.8,1\n"   # v2 + quoted comma
            "2024-01-01T01:00:00+02:00,2024-01-02,Perth,False,Perth,0.2,0\n"                  # v1 (7), offset ts
            "2024-01-01T02:00:00,2024-01-01,2024-01-02,Hobart,True,Hobart,0.6,1,extra\n"      # 9 → first 8
            "2024-01-01T03:00:00,2024-01-01,2024-01-02,Cairns,True,Cairns\n"                  # 6 → dropped
            "not-a-date,,2024-01-02,,True,X,0.5,\n")                                          # bad ts, NULLs
    rows = DL.type_log(DL.read_prediction_log(spark, _write_text(spark, "log", text))).collect()
    by_loc = {r["location"]: r for r in rows}
    assert len(rows) == 4
    assert by_loc["Sydney"]["station_name"] == "Sydney, Obs"
    assert by_loc["Perth"]["feature_date"] is None and by_loc["Perth"]["target_date"] == dt.date(2024, 1, 2)
    assert by_loc["Perth"]["logged_at"].hour == 23          # 01:00+02:00 is 23:00 UTC the day before
    assert by_loc["Hobart"]["predicted_rain"] == 1
    bad = [r for r in rows if r["location"] is None][0]
    assert bad["logged_at"] is None and bad["predicted_rain"] is None


def test_log_records_with_line_breaks_and_their_places(spark):
    text = ("logged_at_utc,feature_date,target_date,location,use_latest,station_name,rain_probability,predicted_rain\n"
            "2024-01-01T00:00:00,2024-01-01,2024-01-02,A,True,\"two\nlines, \"\"quoted\"\"\",0.8,1\n"      # v2
            "2024-01-01T00:00:00,2024-01-02,A,True,\"v1\nalso\",0.2,0\n"                                    # v1
            "2024-01-01T00:00:00,2024-01-01,2024-01-02,B,True,\"x\ny\",0.2,0,more\n"                        # 9 fields
            "2024-01-01T00:00:00,2024-01-01,2024-01-02,C,True,,,\n")                                          # empty fields
    raw = DL.read_prediction_log(spark, _write_text(spark, "breaks", text))
    rows = sorted(DL.type_log(raw).collect(), key=lambda r: r["source_row"])
    assert [r["station_name"] for r in rows] == ['two\nlines, "quoted"', "v1\nalso", "x\ny", None]
    assert [r["location"] for r in rows] == ["A", "A", "B", "C"] and rows[3]["predicted_rain"] is None
    # equal log times: the later row of the file wins
    from labelloop.plans.jobs import score_log
    truth = spark.createDataFrame([("A", dt.date(2024, 1, 2), 1.0)], "location string, obs_date date, rainfall double")
    won = {r["location"]: r["predicted_rain"] for r in score_log(DL.type_log(raw), truth).collect()}
    assert won["A"] == 0


def test_header_only_log_is_empty(spark):
    path = _write_text(spark, "empty-log", "logged_at_utc,target_date\n")
    assert DL.read_prediction_log(spark, path).count() == 0
    with pytest.raises(ValueError):
        DL.require_rows(DL.read_prediction_log(spark, path))


# ------------------------------------------------------------------ A4 preamble / headers
def test_observation_file_preamble_blank_line_and_degree_forms(spark):
    root = scratch_path(spark, "obsfiles").replace("file:", "")
    for loc, head in (("A", "Minimum temperature (°C)"), ("B", "Minimum temperature (Ã‚Â°C)")):
        d = os.path.join(root, f"location={loc}")
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, "f.csv"), "w", encoding="utf-8") as f:
            f.write(f"Daily observations,{loc}\n\n,Date,{head},Rainfall (mm)\n,2024-01-01,10.5,0\n,2024-01-02,11,NA\n")
    rows = read_observation_files(spark, root).select("location", "Date", "MinTemp", "Rainfall", "Evaporation").collect()
    assert len(rows) == 4
    assert {r["MinTemp"] for r in rows} == {"10.5", "11"}
    assert all(r["Evaporation"] is None for r in rows)          # missing column → NULL


def test_normalise_header_rule():
    assert normalise_text("Minimum temperature (°C)") == "minimumtemperaturecc"
    assert normalise_text("Minimum temperature (â°C)") == "minimumtemperaturecc"
    assert normalise_text("Speed of maximum wind gust (km/h)") == "speedofmaximumwindgustkmh"


# ------------------------------------------------------------------ B cleaning
def test_cleaning_rules(spark):
    df = spark.createDataFrame([("350", " Yes "), ("350.0001", "TRUE"), ("NaN", "1"), ("1e2", "No"),
                                ("abc", "maybe"), (None, None)], "Rainfall string, lab string")
    out = V.null_outliers(V.coerce_numeric(df)).select("Rainfall", V.binary_label("lab").alias("y")).collect()
    assert [r["Rainfall"] for r in out] == [350.0, None, None, 100.0, None, None]
    assert [r["y"] for r in out] == [1, 1, 1, 0, 0, None]


def test_three_valued_label_and_threshold(spark):
    df = spark.createDataFrame([(0.0, 0.5), (0.2, 0.49), (None, 1.0)], "r double, p double")
    out = df.select(V.label_from_measure("r").alias("y"), V.decide("p").alias("c")).collect()
    assert [(r["y"], r["c"]) for r in out] == [(0, 1), (1, 0), (None, 1)]


def test_mixed_timestamp_parse(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00",), ("2024-01-01T10:00:00+02:00",), ("01/02/2024",), ("x",)], "s string")
    out = [r[0] for r in df.select(parse_timestamp("s")).collect()]
    assert out[0].hour == 10 and out[1].hour == 8 and (out[2].month, out[2].day) == (1, 2) and out[3] is None


def test_numeric_dates_are_month_first_and_textual_dates_are_read(spark):
    from labelloop.functions.dates import DAY_FIRST, parse_date
    cases = {"03/04/2024": (3, 4), "13/04/2024": (4, 13), "3/4/2024": (3, 4), "03-04-2024": (3, 4), "2024/3/4": (3, 4), "20240304": (3, 4),
             "Jan 5, 2024": (1, 5), "5 January 2024": (1, 5), "january 5, 2024": (1, 5), "5-Jan-2024": (1, 5), "Friday, January 5, 2024": (1, 5),
             "05/06/2024 7:08": (5, 6), "3/4/24": (3, 4), "2024-13-40": None, "": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r["s"]: r["d"] and (r["d"].month, r["d"].day) for r in df.select("s", parse_date("s").alias("d")).collect()}
    assert got == cases
    assert df.filter("s = '03/04/2024'").select(parse_date("s", DAY_FIRST)).first()[0] == dt.date(2024, 4, 3)


# ------------------------------------------------------------------ E dedupe / top-N
def test_last_wins_ties_broken_by_id(spark):
    ts = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, "a", ts, 10), (2, "a", ts, 20), (3, None, ts, 30), (4, None, ts, 40),
                                (5, "b", ts, 50)], "id int, k string, ts timestamp, v int")
    out = {r["k"]: r["v"] for r in last_per_key(df, ["k"], ["ts", "id"]).collect()}
    assert out == {"a": 20, None: 40, "b": 50}


def test_last_n_edge_sizes(spark):
    df = spark.range(5).withColumnRenamed("id", "t")
    assert last_n(df, 0, ["t"]).count() == 5
    assert last_n(df, 10, ["t"]).count() == 5
    assert [r[0] for r in last_n(df, 2, ["t"]).collect()] == [4, 3]


# ------------------------------------------------------------------ ordering helpers
def test_global_rank_equals_row_number(spark):
    from pyspark.sql import Window
    df = spark.range(2000).select((F.col("id") % 3).alias("g"), F.xxhash64("id").alias("k"), "id")
    got = global_rank(df, ["k", "id"], ["g"], "r", num_partitions=7)
    want = df.withColumn("w", F.row_number().over(Window.partitionBy("g").orderBy("k", "id")))
    assert got.join(want, ["g", "k", "id"]).filter("r <> w").count() == 0
    assert got.count() == 2000


def test_prefix_sums(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("g"), "id", F.lit(1).alias("one"))
    out = prefix_sums(df, ["id"], ["one"], ["g"], num_partitions=5)
    assert out.filter(F.col("one_before") != (F.col("id") / 2).cast("int")).count() == 0


# ------------------------------------------------------------------ D metrics
def _auc_bruteforce(rows):
    pos = [s for y, s in rows if y == 1 and s is not None]
    neg = [s for y, s in rows if y == 0 and s is not None]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("rows", [
    [(1, 0.9), (0, 0.1), (1, 0.4), (0, 0.4), (1, None), (0, 0.4)],
    [(1, 0.5), (0, 0.5), (1, 0.5)],          # all scores equal → 0.5
    [(1, 0.2), (1, 0.3)],                    # one class → NULL
])
def test_exact_auc_ties(spark, rows):
    df = spark.createDataFrame(rows, "y int, s double").withColumn("p", F.lit(0))
    want = _auc_bruteforce(rows)
    for bounded in (False, True):        # distributed prefix sums and the bounded-window path
        got = evaluate(df, y="y", pred="p", score="s", bounded=bounded).first()["roc_auc"]
        assert (got is None and want is None) or abs(got - want) < 1e-12


def test_zero_division_and_no_truth(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    m = evaluate(df, y="y", pred="p").first()
    assert m["precision"] == 0.0 and m["recall"] == 0.0 and m["f1"] == 0.0 and m["accuracy"] == 0.5
    empty = spark.createDataFrame([], "y_true int, predicted_rain int, rain_probability double")
    doc = live_metrics(empty, 200).first()
    assert doc["status"] == "no_ground_truth_available" and doc["recall_live"] == 1.0
    assert doc["accuracy_live"] is None and doc["positives_true"] is None and doc["scored_rows"] == 0


# ------------------------------------------------------------------ E7 patience
def test_patience_subdelta_gains_do_not_move_best(spark):
    vals = [1.0, 1.00005, 1.00011] + [None] + [1.0] * 10
    df = spark.createDataFrame([("s", i + 1, v) for i, v in enumerate(vals)], "study string, n long, value double")
    r = patience_stop(df).first()
    assert abs(r["best_value"] - 1.00011) < 1e-12          # third trial improves on the first by > 1e-4
    assert r["stopped_at"] == 14                           # ten flat trials after it, NULL skipped


def test_patience_never_stops(spark):
    df = spark.createDataFrame([("s", i, float(i)) for i in range(1, 6)], "study string, n long, value double")
    r = patience_stop(df).first()
    assert r["stopped_at"] is None and r["trials_run"] == 5


# ------------------------------------------------------------------ I8 gate
def test_retrain_gate_boundaries(spark):
    q = spark.createDataFrame([("ok", 0.59, 60), ("ok", 0.5899, 60), ("ok", 0.1, 59), ("bad", 0.1, 100),
                               (None, None, None)], "status string, recall_combined_cv double, new_rows_for_retrain long")
    assert [r["decision"] for r in retrain_decision(q).collect()] == \
        ["skip_optuna", "trigger_optuna", "skip_optuna", "skip_optuna", "skip_optuna"]


# ------------------------------------------------------------------ I4–I6 retrain set
def _hist_and_scored(spark):
    hist = spark.createDataFrame([(dt.date(2024, 1, 1), "A", 1.0, "No"), (dt.date(2024, 1, 2), "B", 2.0, "Yes")],
                                 "Date date, Location string, Rainfall double, RainTomorrow string")
    scored = spark.createDataFrame([
        (1, dt.datetime(2024, 1, 3), dt.date(2024, 1, 3), dt.date(2024, 1, 4), "A", True, 1),
        (2, dt.datetime(2024, 1, 3, 1), None, dt.date(2024, 1, 5), "A", True, 0),      # backfilled → 01-04
        (3, dt.datetime(2024, 1, 3), dt.date(2024, 1, 2), dt.date(2024, 1, 3), "B", True, 1),  # not beyond horizon
        (4, dt.datetime(2024, 1, 3), dt.date(2024, 1, 3), dt.date(2024, 1, 4), "C", False, None)],
        "event_id int, logged_at timestamp, feature_date date, target_date date, location string, "
        "truth_available boolean, y_true int")
    obs = spark.createDataFrame([(dt.date(2024, 1, 3), "A", 5.0, None), (dt.date(2024, 1, 4), "A", 0.0, None)],
                                "Date date, Location string, Rainfall double, RainTomorrow string")
    return hist, scored, obs


def test_retrain_set_and_meta(spark):
    hist, scored, obs = _hist_and_scored(spark)
    rows, meta = build_retrain_set(hist, scored, obs)
    m = meta.first()
    assert (m["historical_rows"], m["added_rows"], m["total_rows"]) == (2, 2, 4)
    added = {r["Date"]: r["RainTomorrow"] for r in rows.filter("Date > DATE'2024-01-02'").collect()}
    assert added == {dt.date(2024, 1, 3): "Yes", dt.date(2024, 1, 4): "No"}
    # missing column → history passes through unchanged
    _, meta2 = build_retrain_set(hist, scored.drop("truth_available"), obs)
    assert meta2.first()["added_rows"] == 0


def test_watermark_older_equal_newer(spark):
    hist, scored, _ = _hist_and_scored(spark)
    wm = advance_watermark(hist, scored).first()
    assert wm["last_feature_date"] == dt.date(2024, 1, 4) and wm["consumed_rows"] == 2
    for d, expect in ((dt.date(2024, 1, 1), 2), (dt.date(2024, 1, 3), 1), (dt.date(2024, 1, 9), 0)):
        w = spark.createDataFrame([(d, 1)], "last_feature_date date, consumed_rows long")
        assert count_new_rows(hist, scored, w).first()["new_rows_for_retrain"] == expect


def test_exact_quantiles_match_numpy_linear(spark):
    import numpy as np
    from labelloop.operators.profile import exact_quantiles
    vals = [5.0] * 40 + [float(i) for i in range(37)] + [None, float("nan")]
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(vals)], "g int, x double")
    clean = np.array([v for v in vals if v is not None and v == v])
    row = exact_quantiles(df, "x", (0.1, 0.25, 0.5, 0.9)).first()
    for name, p in (("p10", 0.1), ("p25", 0.25), ("p50", 0.5), ("p90", 0.9)):
        assert abs(row[name] - np.quantile(clean, p)) < 1e-12
    per = {r["g"]: r for r in exact_quantiles(df, "x", (0.5,), groups=["g"]).collect()}
    for g in (0, 1):
        sub = np.array([v for i, v in enumerate(vals) if i % 2 == g and v is not None and v == v])
        assert abs(per[g]["p50"] - np.quantile(sub, 0.5)) < 1e-12


def test_retrain_without_scored_log_and_nothing_new(spark):
    hist, scored, obs = _hist_and_scored(spark)
    _, meta = build_retrain_set(hist, None, obs)
    assert meta.first()["added_rows"] == 0 and meta.first()["total_rows"] == 2
    old = scored.filter("feature_date <= DATE'2024-01-02'")
    _, meta2 = build_retrain_set(hist, old, obs)
    assert meta2.first()["added_rows"] == 0


def test_corrupt_watermark_falls_back_to_history_horizon(spark):
    hist, scored, _ = _hist_and_scored(spark)
    corrupt = spark.createDataFrame([(None, None)], "last_feature_date date, consumed_rows long")
    r = count_new_rows(hist, scored, corrupt).first()
    assert r["new_rows_for_retrain"] == 2 and r["retrain_cutoff_date"] == dt.date(2024, 1, 2)


def test_single_class_retrain_quality(spark):
    from labelloop.operators.models import ModelSpec
    from labelloop.plans.jobs import retrain_quality
    hist = spark.createDataFrame([(dt.date(2024, 1, d), "A", 1.0, 2.0, "N", "No", "No") for d in range(1, 6)],
                                 "Date date, Location string, Rainfall double, WindSpeed9am double, "
                                 "WindDir9am string, RainToday string, RainTomorrow string")
    spec = ModelSpec(categorical=["Location"], numeric=["Rainfall"], kind="lr")
    q = retrain_quality(hist, None, hist, spec).first()
    assert q["status"] == "not_enough_classes" and q["rows_used"] == 5 and q["new_rows_for_retrain"] == 0


def test_small_class_folds_constant_and_null_columns(spark):
    from labelloop.operators.features import fill, fit_means, fit_scale
    from labelloop.operators.split import stratified_folds
    df = spark.createDataFrame([(i, int(i < 3), 7.0, None) for i in range(20)], "id long, y int, c double, z double")
    f = stratified_folds(df, "y", "id", k=5)
    assert sorted(r["fold"] for r in f.filter("y = 1").collect()) == [0, 1, 2]    # class smaller than k
    assert fit_scale(df, ["c"]) == {"c": 1.0}                                       # constant column passes
    means = fit_means(df, ["z"])
    assert means["z"] is None and fill(df, means).filter("z IS NULL").count() == 20  # all-NULL stays NULL


def test_counter_keeps_rows_without_location(spark):
    hist, scored, _ = _hist_and_scored(spark)
    extra = spark.createDataFrame([(9, dt.datetime(2024, 1, 3), dt.date(2024, 1, 6), dt.date(2024, 1, 7), None, True, 1)],
                                  scored.schema)
    both = scored.unionByName(extra)
    assert count_new_rows(hist, both).first()["new_rows_for_retrain"] == 3
    _, meta = build_retrain_set(hist, both, _hist_and_scored(spark)[2])
    assert meta.first()["added_rows"] == 2


def test_score_log_takes_last_observation_of_a_date(spark):
    from labelloop.plans.jobs import score_log
    log = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), dt.date(2024, 1, 1), dt.date(2024, 1, 2), "A", 0.7, 1)],
                                "event_id long, logged_at timestamp, feature_date date, target_date date, "
                                "location string, rain_probability double, predicted_rain int")
    obs = spark.createDataFrame([("A", dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 9), 3.0),
                                 ("A", dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 15), 0.0)],
                                "location string, obs_date date, ts timestamp, rainfall double")
    rows = score_log(log, obs, truth_order=("ts",)).collect()
    assert len(rows) == 1 and rows[0]["observed_rainfall_mm"] == 0.0 and rows[0]["y_true"] == 0


def test_bucket_rank_equals_row_number(spark):
    from pyspark.sql import Window
    from labelloop.operators.split import _hash_bucket, shuffle_key
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("g")).withColumn("h", shuffle_key("id"))
    got = global_rank(df, ["h", "id"], ["g"], "r", num_partitions=11, bucket=_hash_bucket("id", 42, 11))
    want = df.withColumn("w", F.row_number().over(Window.partitionBy("g").orderBy("h", "id")))
    assert got.count() == 5000
    assert got.join(want, ["g", "h", "id"]).filter("r <> w").count() == 0


def test_auc_equals_spark_ml_exact_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    df = spark.range(3000).select((F.col("id") % 3 == 0).cast("double").alias("y"),
                                  (F.round(F.rand(7), 2) + (F.col("id") % 3 == 0).cast("double") * 0.1)
                                  .alias("s"))                       # many ties (2-digit scores)
    ours = evaluate(df, y="y", pred=None, score="s").first()["roc_auc"]
    ev = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", metricName="areaUnderROC", numBins=0)
    assert abs(ours - ev.evaluate(df)) < 1e-9


def test_approximate_switches_stay_close(spark):
    from labelloop.operators.profile import describe, distinct_counts
    from labelloop.operators.split import stratified_folds, stratified_split
    df = spark.range(20000).select("id", (F.col("id") % 1000).cast("double").alias("x"),
                                   (F.col("id") % 4 == 0).cast("int").alias("y"))
    ex = {r["column_name"]: r for r in describe(df, ["x"]).collect()}["x"]
    ap = {r["column_name"]: r for r in describe(df, ["x"], exact=False).collect()}["x"]
    assert ap["count"] == ex["count"] and abs(ap["p50"] - ex["p50"]) <= 2.0
    dc = {r["column_name"]: r["n_unique"] for r in distinct_counts(df, ["x"], exact=False).collect()}
    assert abs(dc["x"] - 1000) <= 50
    s = stratified_split(df, "y", "id", 0.2, exact=False)
    share = s.filter("split = 'test'").count() / 20000
    assert 0.18 < share < 0.22
    f = stratified_folds(df, "y", "id", k=5, exact=False)
    sizes = [r["count"] for r in f.groupBy("fold").count().collect()]
    assert len(sizes) == 5 and min(sizes) > 3600


def test_metrics_report_first_present_name(spark):
    from labelloop.operators.metrics import metrics_report
    live = spark.createDataFrame([(0.12345, None)], "accuracy_live double, recall_live double")
    cv = spark.createDataFrame([(0.5, 0.6666)], "accuracy_combined_cv double, recall double")
    rows = {r["source"]: r for r in metrics_report({"live": live, "combined_cv": cv}).collect()}
    assert rows["live"]["accuracy"] == 0.123 and rows["live"]["recall"] is None and rows["live"]["f1"] is None
    assert rows["combined_cv"]["accuracy"] == 0.5 and rows["combined_cv"]["recall"] == 0.667


def test_conform_and_alias_pick(spark):
    from pyspark.sql import types as T
    from labelloop.functions.headers import normalise_header, pick
    from labelloop.operators.cleaning import conform
    df = spark.createDataFrame([("3", "x", "extra")], "b string, a string, z string")
    target = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.DoubleType()),
                           T.StructField("c", T.DateType())])
    out = conform(df, target)
    assert out.columns == ["a", "b", "c"] and out.first()["b"] == 3.0 and out.first()["c"] is None
    hdr = spark.createDataFrame([(["", "Date", "Minimum temperature (Ã‚Â°C)", "Rainfall (mm)"],)], "h array<string>")
    m = hdr.select(F.map_from_arrays(F.transform("h", lambda x: normalise_header(x)),
                                     F.sequence(F.lit(0), F.lit(3))).alias("m"))
    r = m.select(pick(F.col("m"), ("Minimum temperature (°C)", "Minimum temperature (Ã‚Â°C)")).alias("min_t"),
                 pick(F.col("m"), ("Evaporation (mm)",)).alias("evap")).first()
    assert r["min_t"] == 2 and r["evap"] is None


def test_read_delimited_names_from_header_and_na_tokens(spark):
    path = _write_text(spark, "csv-hdr", "Date,Location,Rainfall\n2024-01-01,A,NA\n2024-01-02, B ,#N/A\n2024-01-03,,1.5\n")
    df = DL.read_delimited(spark, path)
    assert df.columns == ["Date", "Location", "Rainfall"]
    rows = df.orderBy("Date").collect()
    assert [r["Rainfall"] for r in rows] == [None, None, "1.5"]
    assert rows[1]["Location"] == " B " and rows[2]["Location"] is None


def test_top_k_puts_null_metrics_last(spark):
    from labelloop.operators.dedup import top_k
    df = spark.createDataFrame([("a", 0.5), ("b", None), ("c", 0.9), ("d", 0.5)], "m string, auc double")
    assert [r["m"] for r in top_k(df, "auc", 3, ["m"]).collect()] == ["c", "a", "d"]
    assert [r["m"] for r in top_k(df, "auc", None, ["m"]).collect()][-1] == "b"


def test_daily_truth_takes_last_line_of_a_date(spark):
    from labelloop.sources.observation_files import daily_truth
    root = scratch_path(spark, "dtruth").replace("file:", "")
    d = os.path.join(root, "location=A")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "f.csv"), "w", encoding="utf-8") as f:
        f.write("Obs for A\n,Date,Rainfall (mm)\n,2024-01-01,3.0\n,2024-01-01,0\n,2024-01-02,NA\n,bad,1\n")
    rows = {(r["location"], r["obs_date"]): r["rainfall"]
            for r in daily_truth(read_observation_files(spark, root)).collect()}
    assert rows == {("A", dt.date(2024, 1, 1)): 0.0, ("A", dt.date(2024, 1, 2)): None}


# ------------------------------------------------------------------ rows that used to get lost or doubled
def test_quoted_cells_and_files_of_several_splits(spark):
    root = scratch_path(spark, "big-obs")
    lines = ["Preamble", "", ",Date,Rainfall (mm),Evaporation (mm)"] + [
        f',2024-01-{i % 28 + 1:02d},"{i}","1,5 about ""x"""' for i in range(3000)]
    local = os.path.join(root.replace("file:", ""), "location=A", "month=202401")
    os.makedirs(local)
    with open(os.path.join(local, "f.txt"), "w") as f:
        f.write("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        rows = read_observation_files(spark, root)
        assert rows.select("block_start").distinct().count() > 2     # one file, several splits
        got = rows.orderBy("file_path", "block_start", "line_no").select("Rainfall", "Evaporation").collect()
        from labelloop.sources.observation_files import daily_truth
        last = {r["obs_date"].day: r["rainfall"] for r in daily_truth(rows).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [int(r["Rainfall"]) for r in got] == list(range(3000)) and {r["Evaporation"] for r in got} == {'1,5 about "x"'}
    assert last == {d: max(i for i in range(3000) if i % 28 + 1 == d) for d in range(1, 29)}


def test_nan_scores_are_no_scores(spark):
    from labelloop.operators.metrics import evaluate
    df = spark.createDataFrame([(1, 1, 0.9), (0, 0, 0.1), (1, 1, float("nan")), (0, 1, None)], "y_true int, prediction int, s double")
    assert evaluate(df, score="s").first()["roc_auc"] == 1.0


def test_columns_without_values_are_left_out_of_a_fit(spark):
    from labelloop.operators.models import ModelSpec, fit_model, prepare, score
    rows = [(i, "a" if i % 3 else "b", None, None, float(i % 5), 1 + i % 300, 1 + i % 12, i % 2) for i in range(80)]
    df = spark.createDataFrame(rows, "event_id long, c string, none string, x double, z double, Dayofyear int, Month int, label int")
    spec = ModelSpec(categorical=["c", "none"], numeric=["x", "z"], kind="lr", id_col="event_id", oversample=True)
    assert prepare(df, spec).dropped == ("none", "x")
    assert score(fit_model(df, spec), df).filter("score is null").count() == 0


def test_modes_count_values_and_break_ties_low(spark):
    from labelloop.operators.features import fit_modes, impute_per_split
    df = spark.createDataFrame([("p", "b", None), ("p", "a", None), ("q", "c", None), ("q", None, None), (None, "z", None), (None, None, None)],
                               "s string, c string, n string")
    assert fit_modes(df, ["c", "n"]) == {"c": "a", "n": None}
    got = {(r["s"], r["c"]) for r in impute_per_split(df, "s", categorical=["c", "n"]).collect()}
    assert got == {("p", "a"), ("p", "b"), ("q", "c"), (None, "z")}


def test_equal_rows_get_keys_of_their_own(spark):
    from labelloop.plans.jobs import with_row_key
    df = spark.createDataFrame([("a", 1.0)] * 50 + [("b", None)] * 3, "x string, y double")
    out = with_row_key(df, "k")
    assert out.count() == 53 and out.select("k").distinct().count() == 53 and out.columns == ["x", "y", "k"]


def test_counting_without_history_log_or_columns(spark):
    hist, scored, _ = _hist_and_scored(spark)
    none = {"new_rows_for_retrain": 0, "retrain_cutoff_date": None}
    assert count_new_rows(hist.limit(0), scored).first().asDict() == none
    assert count_new_rows(hist, None).first().asDict() == none
    assert count_new_rows(hist, scored.drop("feature_date")).first()["new_rows_for_retrain"] == 0
    before = advance_watermark(hist, scored, run_id="r1")
    after = advance_watermark(hist.limit(0), scored, previous=before, run_id="r2").first()
    assert (after["last_feature_date"], after["consumed_rows"], after["run_id"]) == (dt.date(2024, 1, 4), 2, "r1")
    assert advance_watermark(hist, scored.drop("y_true")).first()["last_feature_date"] is None


def test_search_result_does_not_depend_on_the_wave(spark, monkeypatch):
    import labelloop.operators.search as S
    values = [0.5, 0.6, 0.6, 0.6, 0.9, 0.1]
    monkeypatch.setattr(S, "prepare_folds", lambda *a: [])
    monkeypatch.setattr(S, "evaluate_folds", lambda folds, spec, *a: spark.createDataFrame(
        [(values[spec.params["i"]],)], "recall double"))
    trials = spark.createDataFrame([(i, float(i)) for i in range(6)], "n long, i double")
    monkeypatch.setattr(S, "evaluate_settings", lambda folds, spec, params, *a: spark.createDataFrame(
        [(s, values[p["i"]]) for s, p in enumerate(params)], "setting int, recall double"))
    from labelloop.operators.models import ModelSpec
    for wave, kind in ((1, "lr"), (2, "lr"), (5, "lr"), (6, "lr"), (1, "gbt"), (2, "gbt"), (5, "gbt")):
        table, best = S.run_search(spark.range(1), ModelSpec([], [], kind=kind), trials, wave=wave, patience=2, to_params=lambda p: {"i": int(p["i"])})
        assert table.count() == 4 and best.first()["best_trial"] == 1


def test_a_cluster_needs_a_shared_checkpoint_folder():
    from types import SimpleNamespace

    from labelloop.session import ensure_checkpoint_dir
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=context, conf={}))


def test_search_and_retrain_take_prepared_folds(spark, monkeypatch):
    """I9 prepares its folds (and their SMOTE rows) once for both."""
    from labelloop.operators import models, search
    from labelloop.plans import jobs
    made, used = [], []
    monkeypatch.setattr(models, "prepare_folds", lambda data, spec, *a: made.append(data.count()) or ["folds"])
    monkeypatch.setattr(search, "run_search", lambda data, spec, trials, folds=None, **k: used.append(folds) or (None, None))
    monkeypatch.setattr(search, "retrain_with_best", lambda data, spec, best, folds=None, **k: used.append(folds) or (
        None, spark.sql("select current_timestamp() trained_at_utc, 'm' model_path, 1 rows_used")))
    rows = spark.createDataFrame([(i, i % 2) for i in range(40)], "event_id long, label int")
    monkeypatch.setattr(jobs, "_retrain_rows", lambda *a: (rows, None))
    monkeypatch.setattr(jobs, "advance_watermark", lambda *a, **k: spark.sql("select 1 consumed_rows"))
    assert jobs.tune_retrain_advance(rows, rows, rows, None, None).count() == 1
    assert made == [40] and used == [["folds"], ["folds"]]
