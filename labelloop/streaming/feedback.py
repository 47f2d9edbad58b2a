"""Structured Streaming forms of the feedback loop.

* J1 — the prediction log is a file-stream source; every micro-batch is merged
  into a keyed table (:mod:`labelloop.streaming.upsert`), where the last row per
  key stays; the checkpoint makes a second run consume nothing, and a table can be
  continued with a new checkpoint.
* J2 — predictions and truth are two file streams joined by Spark's stream-stream
  join: each side's rows wait in the state store until the event-time watermark
  passes their date by ``state_days``.  What comes later than that is joined from
  the keyed tables of both sides (only the keys concerned), so truth is joined
  whenever it comes, and a corrected truth or prediction replaces the earlier
  match.  A truth without a measurement is no truth: its prediction is open, also
  if an earlier truth had a value.  Confusion counts per score go along: a batch
  adds what it matched and takes back what it replaced, so the metrics of all
  matched predictions cost the batch and not the log.
* J3 — ``foreachBatch`` appends the batch and refreshes the live metrics (I3),
  one document per batch; an exact lower bound on log time keeps each
  refresh to the recent part of the log.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloop.functions.values import label_from_measure
from labelloop.operators.dedup import last_per_key
from labelloop.operators.metrics import evaluate
from labelloop.session import cut_lineage
from labelloop.streaming.upsert import BUCKETS, live, part_of, upsert


def _run(writer):
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:  # surface task failures instead of a silent partial run
        raise RuntimeError(str(q.exception()))
    return q


def _stream(spark: SparkSession, landing: str, schema: T.StructType, max_files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(landing)


def ingest_log(spark: SparkSession, landing: str, schema: T.StructType, table: str, checkpoint: str,
               max_files_per_trigger: int | None = None, keys=("location", "target_date"),
               order=("logged_at", "event_id")) -> None:
    """Consume new log files once; each micro-batch is merged last-wins (E1) into the keyed table."""
    present = [c for c in order if c in schema.fieldNames()]   # e.g. logs without an event id

    def sink(batch: DataFrame, batch_id: int) -> None:
        upsert(last_per_key(batch, list(keys), present), table, schema, keys, present)

    _run(_stream(spark, landing, schema, max_files_per_trigger).writeStream.foreachBatch(sink)
         .option("checkpointLocation", checkpoint))


def read_log_table(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """All rows of an append-only batch table (J3), without the batch column; empty before the first batch."""
    try:
        return spark.read.schema(schema).parquet(table).select(*schema.fieldNames())
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def current_predictions(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """J1 read side: the live row per key (E1 over everything ingested)."""
    return live(spark, table, schema)


#: Which of two truths came later, after the caller's own order: the file's time and name, and the place in it.
ARRIVED = (T.StructField("file_modification_time", T.TimestampType()), T.StructField("file_path", T.StringType()),
           T.StructField("row_index", T.LongType()))


def _with_order(schema: T.StructType, truth_schema: T.StructType, truth_order) -> T.StructType:
    """``schema`` with ``truth_at``, by which truths are ordered."""
    return T.StructType([*schema.fields, T.StructField("truth_at", T.StructType([*(truth_schema[c] for c in truth_order), *ARRIVED]))])


def _matched_schema(pred_schema: T.StructType, truth_schema: T.StructType) -> T.StructType:
    return T.StructType([*pred_schema.fields, T.StructField("observed_rainfall_mm", truth_schema["rainfall"].dataType)])


def delayed_label_join(spark: SparkSession, preds_landing: str, pred_schema: T.StructType,
                       truth_landing: str, truth_schema: T.StructType, out: str, checkpoint: str,
                       max_files_per_trigger: int | None = None, pred_order=("logged_at", "event_id"),
                       truth_order=(), state_days: int = 7) -> list[dict]:
    """Join predictions with truth on (location, date) as either of them arrives.

    ``out`` holds the keyed tables ``predictions``, ``truth`` and ``matched``.  Of
    several truths for a key the last counts: by ``truth_order`` and then by arrival
    (file time, file, place in the file).  Returns the progress of the stream-stream
    join, batch by batch (watermark, rows in its state)."""
    keys, truth_keys = ["location", "target_date"], ["location", "obs_date"]
    p_table, t_table, m_table = (os.path.join(out, n) for n in ("predictions", "truth", "matched"))
    t_schema = _with_order(truth_schema, truth_schema, truth_order)
    m_schema = _with_order(_matched_schema(pred_schema, truth_schema), truth_schema, truth_order)
    p_order = [c for c in pred_order if c in pred_schema.fieldNames()]

    def preds() -> DataFrame:
        return _stream(spark, preds_landing, pred_schema, max_files_per_trigger)

    def truth() -> DataFrame:
        at = F.struct(*truth_order, *[F.col(f"_metadata.{f.name}").cast(f.dataType).alias(f.name) for f in ARRIVED])
        return _stream(spark, truth_landing, truth_schema, max_files_per_trigger).select("*", at.alias("truth_at"))

    scored = {"predicted_rain", "rain_probability"} <= set(pred_schema.fieldNames())

    def store(pairs: DataFrame, batch: str) -> None:
        """Keep the pair of the last prediction and the last truth of each key; what that changes in the counts is
        written first, once for each batch of a checkpoint, so a batch that is run again changes them once."""
        order = [*p_order, "truth_at"]
        rows = cut_lineage(last_per_key(pairs.select(*m_schema.fieldNames()), keys, order))
        if scored:
            parts = {(r["month"], r["bucket"]) for r in rows.select(*part_of(keys, m_schema, BUCKETS)).distinct().collect()}  # months x buckets
            old = live(spark, m_table, m_schema, parts).join(rows.select(*keys), keys, "left_semi")
            after = last_per_key(old.unionByName(rows), keys, order)
            change = _counts(after, 1).unionByName(_counts(old, -1)).groupBy(*COUNTED).agg(F.sum("n").alias("n")).where("n != 0")
            run = hashlib.md5(checkpoint.encode()).hexdigest()[:12]
            change.coalesce(1).write.mode("ignore").parquet(os.path.join(out, "counts", f"change={run}-{batch}"))
        upsert(rows, m_table, m_schema, keys, order)

    # On-time rows: both sides wait in the join's state until the watermark passes their date.
    day = lambda c: F.col(c).cast("timestamp")
    left = preds().withColumn("p_day", day("target_date")).withWatermark("p_day", f"{state_days} days")
    right = truth().select(F.col("location").alias("t_location"), day("obs_date").alias("t_day"),
                           F.col("rainfall").alias("observed_rainfall_mm"), "truth_at").withWatermark("t_day", f"{state_days} days")
    pairs = left.join(right, (F.col("location") == F.col("t_location")) & (F.col("p_day") == F.col("t_day")))
    joined = _run(pairs.writeStream.foreachBatch(lambda batch, i: store(batch, f"join-{i}"))
                  .option("checkpointLocation", os.path.join(checkpoint, "join")))

    def repair(touched: DataFrame, batch: str) -> None:
        """Join the late ones of the ``touched`` keys from the tables: dates that the watermark may have passed by now."""
        newest = [live(spark, t, s).agg(F.max(c)).first()[0] for t, s, c in ((p_table, pred_schema, "target_date"), (t_table, t_schema, "obs_date"))]
        if None in newest:
            return
        late = touched.where(F.col("target_date") <= F.date_sub(F.lit(min(newest)), state_days)).distinct()
        t = live(spark, t_table, t_schema).select(F.col("location").alias("t_location"), F.col("obs_date").alias("t_date"),
                                                  F.col("rainfall").alias("observed_rainfall_mm"), "truth_at")
        store(live(spark, p_table, pred_schema).join(late, keys, "left_semi")
              .join(t, (F.col("location") == F.col("t_location")) & (F.col("target_date") == F.col("t_date"))), batch)

    def on_predictions(batch: DataFrame, batch_id: int) -> None:
        upsert(last_per_key(batch, keys, p_order), p_table, pred_schema, keys, p_order)
        repair(batch.select(*keys), f"predictions-{batch_id}")

    def on_truth(batch: DataFrame, batch_id: int) -> None:
        upsert(last_per_key(batch, truth_keys, ["truth_at"]), t_table, t_schema, truth_keys, ["truth_at"])
        repair(batch.select("location", F.col("obs_date").alias("target_date")), f"truth-{batch_id}")

    for stream, sink in ((preds(), on_predictions), (truth(), on_truth)):
        _run(stream.writeStream.foreachBatch(sink).option("checkpointLocation", os.path.join(checkpoint, sink.__name__)))
    return [{"batch": p["batchId"], "watermark": p["eventTime"].get("watermark"),
             "state_rows": sum(s["numRowsTotal"] for s in p["stateOperators"])} for p in joined.recentProgress]


def matched_predictions(spark: SparkSession, out: str, pred_schema: T.StructType, truth_schema: T.StructType) -> DataFrame:
    """J2 read side: predictions with their truth, one row per key; a truth without a measurement is none."""
    found = live(spark, os.path.join(out, "matched"), _matched_schema(pred_schema, truth_schema))
    return found.where("observed_rainfall_mm is not null")


#: What a matched prediction counts as.
COUNTED = ("rain_probability", "predicted_rain", "y_true")


def _counts(matched: DataFrame, sign: int) -> DataFrame:
    """(``COUNTED``, n): matched rows with a label, added or taken back."""
    rows = matched.where("observed_rainfall_mm is not null").withColumn("y_true", label_from_measure("observed_rainfall_mm"))
    return rows.groupBy(*COUNTED).agg((F.count(F.lit(1)) * sign).alias("n"))


def matched_metrics(spark: SparkSession, out: str, pred_schema: T.StructType) -> DataFrame:
    """J3 over all matched predictions: accuracy, precision, recall, F1 and exact AUC from the counts that the
    batches of :func:`delayed_label_join` changed; neither the log nor the matched rows are read."""
    fields = [pred_schema["rain_probability"], pred_schema["predicted_rain"], T.StructField("y_true", T.IntegerType()), T.StructField("n", T.LongType())]
    counts = read_log_table(spark, os.path.join(out, "counts"), T.StructType(fields))
    now = counts.groupBy(*COUNTED).agg(F.sum("n").alias("n")).where("n != 0")
    return evaluate(now, y="y_true", pred="predicted_rain", score="rain_probability", weight="n")


def open_predictions(preds: DataFrame, matched: DataFrame, keys=("location", "target_date")) -> DataFrame:
    """J2 read side: predictions still waiting for their truth."""
    return preds.join(matched.select(*keys).distinct(), list(keys), "left_anti")


def live_metrics_stream(spark: SparkSession, landing: str, schema: T.StructType, truth: DataFrame,
                        table: str, metrics: str, checkpoint: str, window: int = 200,
                        max_files_per_trigger: int | None = 1) -> None:
    """Per micro-batch — append the batch, recompute the scored log and the
    live metrics, write ``metrics/batch_id=N``.

    Exact incremental bound: if the previous window of ``window`` labelled
    rows started at log time T, rows logged before T can only matter when the
    rows logged from T on no longer fill a window (newer rows outrank them and
    they cannot supersede newer rows in the last-wins dedupe).  So each batch
    first scores only ``logged_at >= T`` (a filter pushed to the log scan) and
    falls back to the whole log when that yields fewer than ``window`` rows.
    """
    from labelloop.plans.jobs import live_eval_rows, score_log
    from labelloop.operators.metrics import live_metrics
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(landing)
    state = {"start": None}          # driver-side: one timestamp carried between batches

    def window_rows(since):
        log = read_log_table(spark, table, schema)
        if since is not None and window > 0:
            log = log.filter(F.col("logged_at") >= F.lit(since))
        return live_eval_rows(score_log(log, truth), window)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(table, f"batch_id={batch_id}"))
        rows = window_rows(state["start"])
        stats = rows.agg(F.count(F.lit(1)).alias("n"), F.min("logged_at").alias("start")).first()
        if state["start"] is not None and stats["n"] < window:     # bound too tight: exact fallback
            rows = window_rows(None)
            stats = rows.agg(F.count(F.lit(1)).alias("n"), F.min("logged_at").alias("start")).first()
        state["start"] = stats["start"] if 0 < window <= stats["n"] else None  # a window of all rows has no bound
        live_metrics(rows, window).withColumn("batch_id", F.lit(batch_id).cast("bigint")).coalesce(1) \
            .write.mode("overwrite").json(os.path.join(metrics, f"batch_id={batch_id}"))

    _run(stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint))


def latest_metrics(spark: SparkSession, metrics: str, schema: T.StructType) -> DataFrame:
    """The document of the most recent batch (one row)."""
    docs = spark.read.schema(T.StructType(schema.fields + [T.StructField("batch_id", T.LongType())])).json(metrics)
    last = docs.select(F.max("batch_id")).scalar()
    return docs.filter(F.col("batch_id") == last).drop("batch_id")
