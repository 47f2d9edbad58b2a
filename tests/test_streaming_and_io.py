"""Incremental behaviour of the streaming forms and tolerant I/O."""

import datetime as dt
import random
import os
import time

import pytest
from pyspark.sql import types as T

from labelloop.operators.cleaning import parse_payload
from labelloop.operators.search import KNOWN_BEST, SEARCH_SPACE, trial_table
from labelloop.session import scratch_path
from labelloop.sources import sinks
from labelloop.streaming import feedback as S

PRED = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("location", T.StringType()),
                     T.StructField("target_date", T.DateType()), T.StructField("logged_at", T.TimestampType())])
TRUTH = T.StructType([T.StructField("location", T.StringType()), T.StructField("obs_date", T.DateType()),
                      T.StructField("rainfall", T.DoubleType())])


def test_late_and_corrected_truth_and_predictions(spark):
    d = [dt.date(2024, 1, i) for i in (1, 2, 3)]
    pl, tl, out, ck = (scratch_path(spark, n) for n in ("sp", "st", "so", "sc"))

    def land(preds, truth):
        if preds:
            spark.createDataFrame(preds, PRED).write.mode("append").parquet(pl)
        spark.createDataFrame(truth, TRUTH).write.mode("append").parquet(tl)
        S.delayed_label_join(spark, pl, PRED, tl, TRUTH, out, ck, max_files_per_trigger=1)
        return {(r["target_date"], r["event_id"]): r["observed_rainfall_mm"]
                for r in S.matched_predictions(spark, out, PRED, TRUTH).collect()}

    preds = [(i, "A", x, dt.datetime(2024, 1, 1)) for i, x in enumerate(d)]
    assert land(preds, [("A", d[0], 1.0)]) == {(d[0], 0): 1.0}
    open_now = S.open_predictions(spark.createDataFrame(preds, PRED), S.matched_predictions(spark, out, PRED, TRUTH))
    assert sorted(r["event_id"] for r in open_now.collect()) == [1, 2]
    # a correction, and truth that is older than any bound on lateness would allow
    old = dt.date(2020, 2, 2)
    assert land([(9, "A", dt.date(2024, 6, 1), dt.datetime(2024, 6, 1))], [("A", d[0], 2.5), ("A", old, 4.0)]) == {(d[0], 0): 2.5}
    # a truth without a measurement is no truth
    assert land([(7, "A", old, dt.datetime(2024, 6, 2)), (8, "A", d[0], dt.datetime(2024, 6, 2))], [("A", d[1], None)]) == {
        (d[0], 8): 2.5, (old, 7): 4.0}
    assert land([], [("A", d[1], 3.0), ("A", old, None)]) == {(d[0], 8): 2.5, (d[1], 1): 3.0}     # one comes late, one is taken back
    assert land([], [("A", old, 0.0)]) == {(d[0], 8): 2.5, (d[1], 1): 3.0, (old, 7): 0.0}


def test_truths_of_one_batch_are_taken_in_order(spark):
    pl, tl, ol = (scratch_path(spark, n) for n in ("sp", "st", "so"))
    day = dt.date(2024, 1, 1)
    spark.createDataFrame([(0, "A", day, dt.datetime(2024, 1, 1))], PRED).write.parquet(pl)
    spark.createDataFrame([("A", day, float(x)) for x in (5, 9, 7)], TRUTH).coalesce(1).write.parquet(tl)
    for order, want in (((), 7.0), (("rainfall",), 9.0)):      # by the place in the file, or as the caller says
        out = f"{ol}-{want}"
        S.delayed_label_join(spark, pl, PRED, tl, TRUTH, out, f"{out}-ckpt", truth_order=order)
        assert [r["observed_rainfall_mm"] for r in S.matched_predictions(spark, out, PRED, TRUTH).collect()] == [want]


def test_state_is_dropped_behind_the_watermark(spark):
    """On-time truth is joined by the state; the state then shrinks, and truth that comes after it is joined from the tables."""
    pl, tl, out, ck = (scratch_path(spark, n) for n in ("sp", "st", "so", "sc"))
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]

    def land(preds, truth):
        spark.createDataFrame(preds, PRED).coalesce(1).write.mode("append").parquet(pl)
        spark.createDataFrame(truth, TRUTH).coalesce(1).write.mode("append").parquet(tl)
        return S.delayed_label_join(spark, pl, PRED, tl, TRUTH, out, ck, state_days=3)

    first = land([(i, "A", d, dt.datetime(2024, 1, 1)) for i, d in enumerate(days[:20])], [("A", d, 1.0) for d in days[5:20]])
    second = land([(i, "A", d, dt.datetime(2024, 1, 1)) for i, d in enumerate(days) if i >= 20], [("A", d, 1.0) for d in days[20:]])
    held = [p["state_rows"] for p in (*first, *second)]
    assert max(held) >= 35 and held[-1] <= 2 * 4, held          # both sides, of the days that the watermark has not passed
    assert len(S.matched_predictions(spark, out, PRED, TRUTH).collect()) == 35
    land([(99, "A", days[-1], dt.datetime(2024, 1, 1))], [("A", d, 2.0) for d in days[:5]])
    found = {r["target_date"]: r["observed_rainfall_mm"] for r in S.matched_predictions(spark, out, PRED, TRUTH).collect()}
    assert found == {d: 2.0 if i < 5 else 1.0 for i, d in enumerate(days)}
    after = days[-1] + dt.timedelta(days=1)
    last = land([(100, "A", after, dt.datetime(2024, 1, 1))], [("A", after, 3.0)])
    assert last[-1]["state_rows"] <= 2 * 5, last                # what came late does not stay


def test_metrics_of_all_matches_are_kept_by_what_batches_change(spark):
    """After every run, with corrections, withdrawn and late truth and new predictions, the counts give what the rows give."""
    from labelloop.functions.values import label_from_measure
    from labelloop.operators.metrics import evaluate
    schema = T.StructType([*PRED.fields, T.StructField("rain_probability", T.DoubleType()), T.StructField("predicted_rain", T.IntegerType())])
    rng, pl, tl, out, ck = random.Random(3), *(scratch_path(spark, n) for n in ("sp", "st", "so", "sc"))
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(25)]
    for run in range(4):
        preds = [(100 * run + i, f"S{i % 3}", rng.choice(days[:8 * (run + 1)]), dt.datetime(2024, 1, 1, run, i), rng.randrange(5) / 4, rng.randrange(2))
                 for i in range(40)]
        truth = [(f"S{i % 3}", rng.choice(days[:8 * (run + 1)]), rng.choice([None, 0.0, 2.5])) for i in range(30)]
        spark.createDataFrame(preds, schema).coalesce(1).write.mode("append").parquet(pl)
        spark.createDataFrame(truth, TRUTH).coalesce(1).write.mode("append").parquet(tl)
        S.delayed_label_join(spark, pl, schema, tl, TRUTH, out, ck, state_days=3)
        rows = S.matched_predictions(spark, out, schema, TRUTH).withColumn("y", label_from_measure("observed_rainfall_mm"))
        want = evaluate(rows, y="y", pred="predicted_rain", score="rain_probability").first().asDict()
        got = S.matched_metrics(spark, out, schema).first().asDict()
        assert got == pytest.approx(want) and got["n"] > 5


def test_a_table_is_continued_with_a_new_checkpoint(spark):
    landing, table = scratch_path(spark, "il"), scratch_path(spark, "it")
    day = dt.datetime(2024, 1, 1)

    def land(ids, ck):
        spark.createDataFrame([(i, f"S{i}", day.date(), day) for i in ids], PRED).write.mode("append").parquet(landing)
        S.ingest_log(spark, landing, PRED, table, ck, max_files_per_trigger=1)
        return sorted(r["event_id"] for r in S.current_predictions(spark, table, PRED).collect())

    assert land(range(9), scratch_path(spark, "c1")) == list(range(9))
    assert land(range(9, 12), scratch_path(spark, "c2")) == list(range(12))


def test_a_batch_rewrites_only_the_parts_it_touches(spark):
    from labelloop.streaming import upsert as U
    table, day = scratch_path(spark, "ut"), dt.datetime(2024, 1, 1)
    rows = [(i, f"S{i % 50}", day.date() + dt.timedelta(days=i // 50), day) for i in range(50 * 90)]
    keys = ["location", "target_date"]
    assert len(U.upsert(spark.createDataFrame(rows, PRED), table, PRED, keys, ["logged_at", "event_id"])) == 3 * U.BUCKETS
    before = U.versions(spark, table)
    later = [(10_000 + k, "S1", day.date(), day + dt.timedelta(hours=k)) for k in range(3)]
    for row in later:
        assert len(U.upsert(spark.createDataFrame([row], PRED), table, PRED, keys, ["logged_at", "event_id"])) == 1
    after = U.versions(spark, table)
    changed = [part for part in after if after[part] != before[part]]
    assert len(changed) == 1 and [v for v, _ in after[changed[0]]] == [2, 3]      # older versions are gone
    live = {(r["location"], r["target_date"]): r["event_id"] for r in U.live(spark, table, PRED).collect()}
    assert len(live) == 50 * 90 and live["S1", day.date()] == 10_002


def test_ingest_consumes_each_file_once_and_keeps_the_last_row(spark):
    landing, table, ck = (scratch_path(spark, n) for n in ("il", "it", "ic"))
    rows = [(i, "A", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, i)) for i in range(4)]
    spark.createDataFrame(rows, PRED).repartition(2).write.parquet(landing)
    for _ in range(2):                         # the second run consumes nothing
        S.ingest_log(spark, landing, PRED, table, ck, max_files_per_trigger=1)
        last = S.current_predictions(spark, table, PRED).collect()
        assert len(last) == 1 and last[0]["event_id"] == 3
    late = [(9, "A", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 2)), (10, "B", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1))]
    spark.createDataFrame(late, PRED).write.mode("append").parquet(landing)
    S.ingest_log(spark, landing, PRED, table, ck)
    assert sorted(r["event_id"] for r in S.current_predictions(spark, table, PRED).collect()) == [3, 10]


def test_an_empty_table_is_read_and_a_broken_one_is_not_taken_for_empty(spark):
    assert S.current_predictions(spark, scratch_path(spark, "none"), PRED).count() == 0
    assert S.read_log_table(spark, scratch_path(spark, "none"), PRED).count() == 0
    path = scratch_path(spark, "broken")
    local = path.replace("file:", "")
    os.makedirs(local)
    with open(os.path.join(local, "part-0.parquet"), "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        S.read_log_table(spark, path, PRED).count()


def test_live_metrics_stream_over_all_rows(spark):
    """A window of zero means all rows, also when older rows land later."""
    log = T.StructType([*PRED.fields, T.StructField("rain_probability", T.DoubleType()), T.StructField("predicted_rain", T.IntegerType())])
    day = dt.date(2024, 1, 1)
    rows = [(i, "A", day + dt.timedelta(days=i), dt.datetime(2024, 3, 1) - dt.timedelta(days=i), 0.5, 1) for i in range(40)]
    truth = spark.createDataFrame([("A", r[2], float(i % 2)) for i, r in enumerate(rows)], TRUTH)
    landing, table, metrics, ck = (scratch_path(spark, n) for n in ("ml", "mt", "mm", "mc"))
    for part in (rows[:20], rows[20:]):
        spark.createDataFrame(part, log).coalesce(1).write.mode("append").parquet(landing)
        S.live_metrics_stream(spark, landing, log, truth, table, metrics, ck, window=0)
    doc = S.latest_metrics(spark, metrics, T.StructType([T.StructField("scored_rows", T.LongType())])).first()
    assert doc["scored_rows"] == 40


def test_tolerant_document_reader(spark):
    schema = T.StructType([T.StructField("status", T.StringType()), T.StructField("n", T.LongType())])
    missing = sinks.read_document(spark, scratch_path(spark, "nope"), schema).collect()
    assert len(missing) == 1 and missing[0]["status"] is None
    path = scratch_path(spark, "corrupt").replace("file:", "")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.json"), "w") as f:
        f.write("{not json\n")
    bad = sinks.read_document(spark, path, schema).collect()
    assert len(bad) == 1 and bad[0]["n"] is None
    good = scratch_path(spark, "doc")
    sinks.write_document(spark.createDataFrame([("ok", 3)], schema), good)
    assert sinks.read_document(spark, good, schema).first()["n"] == 3


def test_payload_reject_branch(spark):
    schema = T.StructType([T.StructField("Date", T.DateType()), T.StructField("Location", T.StringType()),
                           T.StructField("Rainfall", T.DoubleType())])
    df = spark.createDataFrame([('{"Date": "2024-01-01", "Location": "A"}',), ('{"Date": "2024-01-01"}',),
                                ("not json",)], "p string")
    ok, rejected = parse_payload(df, "p", schema, ["Date", "Location"])
    assert ok.count() == 1 and ok.first()["Rainfall"] is None and rejected.count() == 2


def test_trial_table_seeded_and_in_range(spark):
    t = trial_table(spark, n_trials=20).collect()
    assert t[0]["n_estimators"] == KNOWN_BEST["n_estimators"]
    for r in t[1:]:
        for name, (lo, hi, _) in SEARCH_SPACE.items():
            assert lo <= r[name] <= hi
    again = trial_table(spark, n_trials=20).collect()
    assert again == t


def test_live_metrics_stream_each_batch_equals_full_recompute(spark):
    from labelloop.plans.jobs import score_predictions
    log_schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("logged_at", T.TimestampType()),
                               T.StructField("feature_date", T.DateType()), T.StructField("target_date", T.DateType()),
                               T.StructField("location", T.StringType()),
                               T.StructField("rain_probability", T.DoubleType()),
                               T.StructField("predicted_rain", T.IntegerType())])
    day0 = dt.date(2024, 1, 1)
    t0 = dt.datetime(2024, 1, 1)
    truth = spark.createDataFrame([("A", day0 + dt.timedelta(days=i), float(i % 3)) for i in range(300)], TRUTH)
    first = [(i, t0 + dt.timedelta(hours=i), None, day0 + dt.timedelta(days=i), "A", (i % 10) / 10, int(i % 4 == 0))
             for i in range(250)]
    # later re-predictions of keys inside the window, with no class: they supersede window rows
    second = [(1000 + i, t0 + dt.timedelta(hours=400 + i), None, day0 + dt.timedelta(days=240 + i), "A", 0.5, None)
              for i in range(11)]
    third = [(2000 + i, t0 + dt.timedelta(hours=500 + i), None, day0 + dt.timedelta(days=260 + i), "A", 0.9, 1)
             for i in range(30)]
    landing = scratch_path(spark, "j3-landing")
    parts = []
    for k, rows in enumerate((first, second, third)):
        df = spark.createDataFrame(rows, log_schema)
        df.coalesce(1).write.mode("append").parquet(landing)
        parts.append(df)
        time.sleep(1.1)                      # distinct file times: one file per micro-batch, in order
    table, metrics, ck = (scratch_path(spark, n) for n in ("j3t", "j3m", "j3c"))
    S.live_metrics_stream(spark, landing, log_schema, truth, table, metrics, ck, window=200)
    docs = spark.read.json(metrics).orderBy("batch_id").collect()
    assert [d["batch_id"] for d in docs] == [0, 1, 2]
    log = None
    for d, part in zip(docs, parts):
        log = part if log is None else log.unionByName(part)
        _, want = score_predictions(log, truth, window=200)
        w = want.first()
        for c in ("scored_rows", "positives_true"):
            assert d[c] == w[c]
        for c in ("accuracy_live", "precision_live", "recall_live", "f1_live", "roc_auc_live"):
            assert (d[c] is None and w[c] is None) or abs(d[c] - w[c]) < 1e-12


def test_cluster_settings_scale_with_input():
    from labelloop.session import cluster_settings
    small, big = cluster_settings(10 << 30), cluster_settings(100 << 40)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert int(big["spark.sql.shuffle.partitions"]) == 200_000
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 << 20)


def test_observation_files_each_start_with_their_header(spark):
    import glob
    from pyspark.sql import functions as F
    from labelloop.sources.observation_files import write_observation_files
    rows = [(i, "A" if i % 3 else "B", dt.datetime(2024, 1, 1 + i % 28), float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "event_id long, location string, ts timestamp, v double") \
        .withColumn("month", F.date_format("ts", "yyyyMM")).withColumn("shard", (F.col("event_id") % 4).cast("int"))
    root = scratch_path(spark, "obsw")
    header = F.concat(F.lit("Preamble "), F.col("location"), F.lit("\n,Date,Id"))
    line = F.concat_ws(",", F.lit(""), F.to_date("ts").cast("string"), F.col("event_id").cast("string"))
    write_observation_files(df, root, "location", "month", "shard", header, line, ["ts", "event_id"])
    files = [f for f in glob.glob(root.replace("file:", "") + "/**/part-*", recursive=True)]
    assert len(files) == 8                       # 2 stations × 1 month × 4 shards
    for f in files:
        lines = open(f).read().splitlines()
        assert lines[0].startswith("Preamble") and lines[1] == ",Date,Id"
        assert all(not l.startswith("Preamble") for l in lines[2:])


def test_end_to_end_from_raw_files_equals_flagship(spark, sf_dir):
    """The reference's real inputs — a CSV prediction log and station-month
    observation files — through the readers give the flagship's document."""
    from pyspark.sql import functions as F
    from labelloop.functions.dates import parse_date
    from labelloop.functions.values import safe_double
    from labelloop.plans import catalog_io, fixtures as fx
    from labelloop.plans.catalog import QUERIES
    from labelloop.plans.jobs import score_predictions
    from labelloop.sources.delimited import read_prediction_log, type_log
    from labelloop.sources.observation_files import DEFAULT_ALIASES, read_observation_files
    log_dir, obs_dir = scratch_path(spark, "e2e-log"), scratch_path(spark, "e2e-obs")
    p = fx.pred_log(spark, sf_dir)
    line = F.concat_ws(",", F.date_format("logged_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
                       F.coalesce(F.col("feature_date").cast("string"), F.lit("")), F.col("target_date").cast("string"),
                       "location", F.lit("False"), F.concat(F.lit('"St '), F.col("event_id").cast("string"),
                                                            F.lit(', Inc"')),
                       F.col("rain_probability").cast("string"), F.col("predicted_rain").cast("string"))
    (p.select(line.alias(catalog_io._LOG_HEADER)).write.option("header", True).option("sep", "\u0001")
     .option("quote", "\u0000").option("escapeQuotes", False).csv(log_dir))
    catalog_io._obs_files_fixture(spark, sf_dir, obs_dir)
    log = type_log(read_prediction_log(spark, log_dir)) \
        .withColumn("event_id", F.regexp_extract("station_name", r"St (\d+)", 1).cast("bigint"))
    obs = read_observation_files(spark, obs_dir, dict(DEFAULT_ALIASES, Id=("Id",)))
    truth = obs.select(F.col("location").cast("string").alias("location"), parse_date("Date").alias("obs_date"),
                       F.col("Id").cast("bigint").alias("event_id"), safe_double("Rainfall").alias("rainfall")) \
        .filter(~F.col("location").isin(*fx.UNOBSERVED_STATIONS))
    _, doc = score_predictions(log, truth, window=200, truth_order=("event_id",))
    got, want = doc.first().asDict(), QUERIES["i3_live_metrics"](spark, sf_dir).first().asDict()
    for k, v in want.items():
        assert (got[k] == v) if not isinstance(v, float) else abs(got[k] - v) < 1e-6, k
