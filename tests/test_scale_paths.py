"""Forms that do the work of the data they touch: split logs, sketches, keyed tables, grouping sets."""

import csv
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloop.operators import profile as P
from labelloop.operators import sketches as SK
from labelloop.session import scratch_path
from labelloop.sources.delimited import quoted_records, read_prediction_log
from labelloop.sources.keyed import KeyedTable
from labelloop.sources.schemas import PREDICTION_LOG_V1, PREDICTION_LOG_V2


# ---------------------------------------------------------------- A3
def _log_files(folder, seed, files=2, rows=300):
    """CSV logs whose fields hold commas, quotes and line breaks, and the rows they stand for."""
    rng, want = random.Random(seed), []
    odd = ["plain", "a,b", 'say "x"', "two\nlines", "three\n\"quoted\",\nlines", "", "\n", "é,ü\n"]
    for f in range(files):
        path = folder / f"log{f}.csv"
        with open(path, "w", newline="", encoding="utf-8") as out:
            writer = csv.writer(out, lineterminator="\n")
            writer.writerow(PREDICTION_LOG_V2)
            for i in range(rows):
                names = PREDICTION_LOG_V2 if rng.random() < 0.7 else PREDICTION_LOG_V1
                row = {n: rng.choice(odd) if rng.random() < 0.3 else f"{n}{f}-{i}" for n in names}
                writer.writerow([row[n] for n in names])
                want.append(tuple(row.get(n) or None for n in PREDICTION_LOG_V2))
                if rng.random() < 0.05:
                    out.write("\n")
    return want


@pytest.mark.parametrize("block", [64, 300, 1 << 20])
def test_log_is_read_in_blocks_of_any_size(spark, tmp_path, block):
    """Line breaks inside quotes fall on block edges; every block size gives the rows that were written, in order."""
    want = _log_files(tmp_path, 5)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        found = read_prediction_log(spark, str(tmp_path))
        blocks = spark.read.text(str(tmp_path)).select(F.col("_metadata.file_block_start")).distinct().count()
        rows = found.orderBy("source_file", "source_row").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [tuple(r[n] for n in PREDICTION_LOG_V2) for r in rows] == want
    assert blocks > 100 if block == 64 else blocks >= 1
    assert len({(r.source_file, r.source_row) for r in rows}) == len(rows)


def test_records_without_quotes_are_not_put_together(spark, tmp_path):
    (tmp_path / "a.csv").write_text("h1,h2\n1,2\n\n3,4\n")
    got = [(r.source_row, r.record) for r in quoted_records(spark, str(tmp_path)).orderBy("source_row").collect()]
    assert got == [(1, "h1,h2"), (2, "1,2"), (3, ""), (4, "3,4")]


# ---------------------------------------------------------------- D5–D7
def test_sketches_merge_to_any_span(spark):
    rng = np.random.default_rng(1)
    x = rng.lognormal(size=30_000)
    rows = [(int(i % 30), f"S{i % 7}", float(v) if i % 11 else None, int(i % 2_500)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "day int, station string, x double, k int").cache()
    path = scratch_path(spark, "sk")
    SK.daily_sketches(df, ["day", "station"], ["x"], ["k"]).write.parquet(path)
    stored = spark.read.parquet(path)
    assert stored.count() == 2 * 210                       # a row per key and column, whatever the number of rows
    for span in (F.lit(True), F.col("day") < 10, F.col("station") == "S3"):
        some = df.filter(span)
        found, exact = SK.merged_describe(stored.filter(span)).first(), P.describe(some, ["x"]).first()
        for c in ("count", "mean", "std", "min", "max"):
            assert found[c] == pytest.approx(exact[c], rel=1e-9)
        values = np.sort([r.x for r in some.where("x is not null").select("x").collect()])
        for c, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
            assert abs(np.searchsorted(values, found[c]) / len(values) - q) <= SK.RANK_ERROR
        distinct = {r.column_name: r.n_unique for r in SK.merged_distinct(stored.filter(span)).collect()}
        for r in P.distinct_counts(some, ["x", "k"]).collect():
            assert abs(distinct[r.column_name] - r.n_unique) <= SK.DISTINCT_ERROR * r.n_unique
    groups = {r.station: r["count"] for r in SK.merged_describe(stored, ["station"]).collect()}
    assert groups == {r.station: r.n for r in df.where("x is not null").groupBy("station").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_sketches_of_nothing_and_of_one_value(spark):
    df = spark.createDataFrame([(1, None, None), (2, 5.0, "a"), (2, float("nan"), "a")], "day int, x double, k string")
    sketches = SK.daily_sketches(df, ["day"], ["x"], ["k"])
    one = SK.merged_describe(sketches).first()
    assert (one["count"], one["mean"], one["std"], one["p50"]) == (1, 5.0, None, 5.0)
    assert SK.merged_describe(sketches.filter("day = 1")).count() == 0
    assert SK.daily_sketches(df.limit(0), ["day"], ["x"]).count() == 0
    assert "Expand" not in sketches._jdf.queryExecution().executedPlan().toString()      # rows are not multiplied


# ---------------------------------------------------------------- C1–C3
def test_new_rows_join_stored_truth_without_moving_it(spark):
    rows = spark.range(12 * 28 * 50).select(
        F.concat(F.lit("S"), (F.col("id") % 50).cast("string")).alias("location"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.floor(F.col("id") / 50).cast("int")).alias("obs_date"), F.col("id").cast("double").alias("rainfall"))
    table = KeyedTable(spark, scratch_path(spark, "kt"), rows.schema, ["location", "obs_date"], "obs_date", buckets=4)
    table.append(rows)
    again = KeyedTable(spark, table.path, rows.schema, ["location", "obs_date"], "obs_date", buckets=4)
    new = rows.filter("obs_date >= '2024-03-30' and obs_date < '2024-04-03'").withColumnRenamed("rainfall", "p")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = new.join(again.for_dates(new, "obs_date"), ["location", "obs_date"], "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.where("rainfall = p").count() == new.count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    scan = plan[plan.index("spark_catalog"):]
    assert "202403" in scan and "202404" in scan and "PartitionFilters: [" in scan
    side = plan[:plan.index("spark_catalog")].splitlines()[-4:]
    assert plan.count("Exchange") == 1 and not any("Exchange" in line for line in side), plan
    read = again.for_dates(new, "obs_date")
    assert read.count() == 50 * (31 + 30) and read.columns == rows.columns


# ---------------------------------------------------------------- I8
def test_station_quality_takes_one_pass(spark):
    from labelloop.plans.jobs import station_quality
    path = scratch_path(spark, "scored")
    rows = [(f"S{i % 3}" if i % 10 else None, i % 2, (i // 2) % 2, i % 20) for i in range(200)]
    df = spark.createDataFrame(rows, "location string, y_true int, predicted_rain int, d int").select(
        "location", "y_true", "predicted_rain", F.lit(True).alias("truth_available"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")).alias("feature_date"))
    df.write.parquet(path)
    out = station_quality(spark.read.parquet(path), F.lit("2024-01-11").cast("date"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    got = {r.location: r for r in out.collect()}
    assert set(got) == {None, "S0", "S1", "S2"}
    new = {(r[0], r[3]) for r in rows if r[0] is not None and r[3] > 10}
    for s in (None, "S0", "S1", "S2"):
        own = [r for r in rows if s is None or r[0] == s]
        pos = [r for r in own if r[1] == 1]
        assert got[s].recall_combined_cv == pytest.approx(sum(r[2] for r in pos) / len(pos))
        assert got[s].new_rows_for_retrain == sum(s is None or k[0] == s for k in new)


def test_document_reader_only_forgives_a_missing_path(spark, tmp_path):
    from pyspark.errors import AnalysisException

    from labelloop.sources.sinks import read_document
    schema = T.StructType([T.StructField("a", T.LongType())])
    assert read_document(spark, str(tmp_path / "none"), schema).collect()[0].a is None
    (tmp_path / "doc.json").write_text('{"a": 1}\n')
    with pytest.raises(AnalysisException):
        read_document(spark, str(tmp_path / "doc.json"), T.StructType([*schema.fields, *schema.fields])).collect()


def test_weights_and_vectors_leave_no_task_with_a_class(spark, monkeypatch):
    from labelloop.operators import models as M
    from labelloop.operators.features import balanced_weights
    days = {"Dayofyear": F.col("id") % 365 + 1, "Month": F.col("id") % 12 + 1}
    df = spark.range(0, 4000, 1, 8).withColumns({"n": F.col("id").cast("double"), "label": (F.col("id") % 10 == 0).cast("int"), **days})
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        weighed = balanced_weights(df, "label")
        per = [r["count"] for r in weighed.groupBy(F.spark_partition_id()).count().collect()]
        assert len(per) == 8 and max(per) == 500
        assert {(r.label, r.w) for r in weighed.groupBy("label").agg(F.max("weight").alias("w")).collect()} == {(0, 4000 / 7200), (1, 5.0)}
        monkeypatch.setattr(M, "PART_ROWS", 100)
        ready = M.prepare(weighed, M.ModelSpec(categorical=(), numeric=("n",), kind="rf", weight="weight"))
        per = [r["count"] for r in ready.rows.groupBy(F.spark_partition_id()).count().collect()]
        assert len(per) == 40 and max(per) <= 150 and sum(per) == 4000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_split_leaves_no_task_with_a_class(spark):
    from labelloop.operators.split import stratified_split
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = stratified_split(spark.range(4000).withColumn("label", (F.col("id") % 10 == 0).cast("int")), "label", "id")
        assert out.where("split = 'test'").groupBy("label").count().orderBy("label").collect() == [(0, 720), (1, 80)]
        assert "BroadcastHashJoin" in out._jdf.queryExecution().toString()   # by class: sizes are broadcast, rows are not shuffled
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_folds_deal_classes_evenly_to_tasks(spark):
    from labelloop.operators.split import stratified_folds
    was = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # partitions stay as they are dealt
    try:
        df = spark.range(48_000).withColumn("label", (F.col("id") % 3 == 0).cast("int"))
        per = [r["count"] for r in stratified_folds(df, "label", "id").groupBy(F.spark_partition_id()).count().collect()]
        assert sum(per) == 48_000 and max(per) < 2 * 48_000 / 24
    finally:
        for c, v in was.items():
            spark.conf.set(c, v)
