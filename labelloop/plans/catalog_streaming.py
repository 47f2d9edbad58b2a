"""Catalog part 7: streaming forms (J1–J3), checked against their batch twins.

Each query lands files derived from the driver tables under the checkpoint
directory and drives the stream to completion with ``availableNow``.
"""

from __future__ import annotations


import os

from pyspark.sql import functions as F

from labelloop.operators.dedup import last_per_key
from labelloop.operators.metrics import METRIC_NAMES
from labelloop.plans import catalog_io, catalog_rows  # noqa: F401  (oracles reused below)
from labelloop.plans import fixtures as fx
from labelloop.plans.catalog import ORACLE, r6, register, sql_metrics
from labelloop.plans.fixtures import with_fixtures as W
from labelloop.session import cut_lineage, scratch_path
from labelloop.streaming import feedback as S


def _land_log(spark, sf_dir, files: int) -> tuple[str, object]:
    landing = scratch_path(spark, "log-landing")
    p = fx.pred_log(spark, sf_dir)
    p.repartitionByRange(files, "event_id").write.parquet(landing)
    return landing, p.schema


def j1(spark, sf_dir):
    """Ingest half of the log in micro-batches, run again (consumes nothing), then go on with the whole log
    under a new checkpoint, so that the table meets rows anew and batch numbers again; read last-wins."""
    landing = scratch_path(spark, "log-landing")
    p = fx.pred_log(spark, sf_dir)
    half = F.xxhash64("event_id") % 2 == 0
    table = scratch_path(spark, "j1-table")
    for part, ckpt in ((half, scratch_path(spark, "j1-ckpt")), (~half, scratch_path(spark, "j1-ckpt"))):
        p.filter(part).repartitionByRange(3, "event_id").write.mode("append").parquet(landing)
        for _ in range(2):   # the second run has no new files
            S.ingest_log(spark, landing, p.schema, table, ckpt, max_files_per_trigger=2)
    out = S.current_predictions(spark, table, p.schema)
    return out.withColumn("rain_probability", r6("rain_probability"))


def _join_in_two_runs(spark, sf_dir):
    """Two runs of several micro-batches.  Before the first run: the predictions of one half
    of the dates, and a preliminary truth (one millimetre too much) of every second date.
    Before the second: all other predictions, the truth that was late, and corrections of
    the preliminary one.  Where the final truth has no measurement, it takes back a match
    of the preliminary one, or leaves a prediction open that never had any.  The state
    lasts two days, so most of the second run is late for it."""
    preds = last_per_key(fx.pred_log(spark, sf_dir), ["location", "target_date"], ["logged_at", "event_id"])
    truth = cut_lineage(fx.truth(spark, sf_dir))
    pl, tl, out, ckpt = (scratch_path(spark, n) for n in ("j2-preds", "j2-truth", "j2-out", "j2-ckpt"))
    early = F.dayofyear("target_date") % 2 == 0
    seen = F.dayofyear("obs_date") % 4 < 2

    def land(p, t):
        p.coalesce(2).write.mode("append").parquet(pl)
        t.coalesce(2).write.mode("append").parquet(tl)
        S.delayed_label_join(spark, pl, preds.schema, tl, truth.schema, out, ckpt, max_files_per_trigger=1, state_days=2)

    land(preds.filter(early), truth.filter(seen).withColumn("rainfall", F.coalesce(F.col("rainfall"), F.lit(0.0)) + 1))
    land(preds.filter(~early), truth)
    return (S.live(spark, os.path.join(out, "predictions"), preds.schema),
            S.matched_predictions(spark, out, preds.schema, truth.schema), S.matched_metrics(spark, out, preds.schema))


@register("j2_delayed_label_join", W("""
SELECT p.event_id, p.location, p.target_date, ROUND(t.rainfall, 6) AS observed_rainfall_mm
FROM (SELECT q.*, ROW_NUMBER() OVER (PARTITION BY location, target_date ORDER BY logged_at DESC, event_id DESC) AS rn
      FROM pred_log q) p JOIN truth t ON p.location = t.location AND p.target_date = t.obs_date
WHERE p.rn = 1 AND t.rainfall IS NOT NULL"""))
def j2(spark, sf_dir):
    _, matched, _ = _join_in_two_runs(spark, sf_dir)
    return matched.select("event_id", "location", "target_date", r6("observed_rainfall_mm").alias("observed_rainfall_mm"))


@register("j2_open_predictions", W("""
SELECT p.event_id, p.location, p.target_date FROM (SELECT q.*, ROW_NUMBER() OVER (PARTITION BY location, target_date
  ORDER BY logged_at DESC, event_id DESC) AS rn FROM pred_log q) p
WHERE p.rn = 1 AND NOT EXISTS (SELECT 1 FROM truth t WHERE t.location = p.location AND t.obs_date = p.target_date
  AND t.rainfall IS NOT NULL)"""))
def j2_open(spark, sf_dir):
    """J2 read side: predictions whose truth has not arrived."""
    preds, matched, _ = _join_in_two_runs(spark, sf_dir)
    return S.open_predictions(preds, matched).select("event_id", "location", "target_date")


_all_ctes, _all_metrics = sql_metrics("ev", "y_true", "predicted_rain", "rain_probability")


@register("j3_matched_metrics", W("SELECT CAST(n AS BIGINT) AS n, CAST(pos AS BIGINT) AS positives, "
                                  + ", ".join(f"ROUND({e}, 6) AS {c}" for e, c in zip(_all_metrics, METRIC_NAMES, strict=True))
                                  + " FROM m_cnt, m_auc",
                                  ev="SELECT * FROM scored WHERE truth_available AND y_true IS NOT NULL", **_all_ctes))
def j3_matched(spark, sf_dir):
    """J3 over all matched predictions, from counts that late, corrected and withdrawn truth was taken back from."""
    _, _, metrics = _join_in_two_runs(spark, sf_dir)
    return metrics.select("n", "positives", *[r6(c).alias(c) for c in METRIC_NAMES])


def j3(spark, sf_dir):
    """Live metrics refreshed per micro-batch; the last document equals I3."""
    landing, schema = _land_log(spark, sf_dir, 4)
    table, metrics, ckpt = (scratch_path(spark, n) for n in ("j3-table", "j3-metrics", "j3-ckpt"))
    S.live_metrics_stream(spark, landing, schema, fx.truth(spark, sf_dir), table, metrics, ckpt, window=200)
    doc = S.latest_metrics(spark, metrics, catalog_io._LIVE_SCHEMA)
    return doc.select("status", *[r6(c).alias(c) for c in ("accuracy_live", "precision_live", "recall_live",
                                                            "f1_live", "roc_auc_live")],
                      "scored_rows", "positives_true", "window")


register("j1_incremental_ingest", W("""
SELECT event_id, logged_at, feature_date, target_date, location, ROUND(rain_probability, 6) AS rain_probability,
       predicted_rain FROM (SELECT q.*, ROW_NUMBER() OVER (PARTITION BY location, target_date
       ORDER BY logged_at DESC, event_id DESC) AS rn FROM pred_log q) t WHERE rn = 1"""))(j1)
register("j3_live_metrics_stream", ORACLE["i3_live_metrics"])(j3)
