"""Catalog part 4: the composite jobs of the feedback loop."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloop.functions.dates import add_calendar_features
from labelloop.functions.values import binary_label, null_outliers
from labelloop.operators.cleaning import drop_unlabelled
from labelloop.plans import fixtures as fx
from labelloop.plans.catalog import r6, register
from labelloop.plans.fixtures import _I4_CTES, _LASTOBS, _feature_sql, _newl, HISTORY_HORIZON as H, with_fixtures as W
from labelloop.plans.jobs import (_date_lit, _latest_date, advance_watermark, build_retrain_set, count_new_rows, read_watermark,
                                  retrain_decision, station_quality, write_retrain_set, write_watermark)
from labelloop.session import scratch_path


def _retrain(spark, sf_dir):
    return build_retrain_set(fx.history(spark, sf_dir), fx.scored(spark, sf_dir), fx.observations(spark, sf_dir))


@register("i4_retrain_set", W("SELECT * FROM hist UNION ALL SELECT * FROM added", **_I4_CTES))
def i4(spark, sf_dir):
    rows, _ = _retrain(spark, sf_dir)
    return rows.withColumns({"Rainfall": r6("Rainfall"), "WindSpeed9am": r6("WindSpeed9am")})


@register("d11_row_accounting", W("""
SELECT CAST((SELECT COUNT(*) FROM hist) AS BIGINT) AS historical_rows,
       CAST((SELECT COUNT(*) FROM added) AS BIGINT) AS added_rows,
       CAST((SELECT COUNT(*) FROM hist) + (SELECT COUNT(*) FROM added) AS BIGINT) AS total_rows""", **_I4_CTES))
def d11(spark, sf_dir):
    """D11, counted while the retrain set is written."""
    return write_retrain_set(fx.history(spark, sf_dir), fx.scored(spark, sf_dir), fx.observations(spark, sf_dir), scratch_path(spark, "retrain-set"))


@register("i1_prepare_dataset", W("""
SELECT Location, ROUND(CASE WHEN Rainfall > 350 THEN NULL ELSE Rainfall END, 6) AS Rainfall,
       ROUND(CASE WHEN WindSpeed9am > 100 THEN NULL ELSE WindSpeed9am END, 6) AS WindSpeed9am, WindDir9am, RainToday,
       CAST(dayofyear(Date) AS INTEGER) AS Dayofyear, CAST(month(Date) AS INTEGER) AS Month,
       CASE WHEN lower(trim(RainTomorrow)) IN ('yes', '1', 'true') THEN 1 ELSE 0 END AS label
FROM feat WHERE RainTomorrow IS NOT NULL""", feat=_feature_sql("obs")))
def i1(spark, sf_dir):
    """B1 drop unlabelled → B2/B3 numeric cleaning → B5 calendar → B6 label."""
    x = drop_unlabelled(fx.feature_rows(fx.obs(spark, sf_dir)), "RainTomorrow")
    x = add_calendar_features(null_outliers(x), "Date")
    x = x.withColumn("label", binary_label("RainTomorrow"))
    return x.select("Location", r6("Rainfall").alias("Rainfall"), r6("WindSpeed9am").alias("WindSpeed9am"),
                    "WindDir9am", "RainToday", "Dayofyear", "Month", "label")


_SNAPSHOT = "logged_at < TIMESTAMP '2024-01-25 00:00:00'"


@register("i5_new_rows_beyond_watermark", W(f"""
SELECT CAST((SELECT COUNT(*) FROM newl2) AS BIGINT) AS new_rows_for_retrain,
       (SELECT GREATEST((SELECT max(Date) FROM hist), (SELECT max(feature_date) FROM wm_rows))) AS retrain_cutoff_date""",
                                          hist=_I4_CTES["hist"],
                                          wm_rows=_newl("SELECT max(Date) FROM hist", _SNAPSHOT),
                                          newl2=_newl("SELECT GREATEST((SELECT max(Date) FROM hist), "
                                                      "(SELECT max(feature_date) FROM wm_rows))")))
def i5(spark, sf_dir):
    """I5 after an earlier run: the watermark advanced on the log as it was at
    2024-01-25 (I6), then new rows are counted beyond max(horizon, watermark)."""
    hist, scored = fx.history(spark, sf_dir), fx.scored(spark, sf_dir)
    earlier = scored.filter(F.col("logged_at") < F.lit("2024-01-25 00:00:00").cast("timestamp_ntz"))
    wm = advance_watermark(hist, earlier)
    return count_new_rows(hist, scored, wm)


@register("i6_advance_watermark", W("""
SELECT max(feature_date) AS last_feature_date, CAST(COUNT(*) AS BIGINT) AS consumed_rows,
       CAST(COUNT(*) AS BIGINT) AS rows_beyond_previous, TRUE AS has_time, 'run-1' AS run_id FROM newl""",
                                    hist=_I4_CTES["hist"], newl=_newl("SELECT max(Date) FROM hist")))
def i6(spark, sf_dir):
    """I6, written as a document and read back."""
    path = write_watermark(advance_watermark(fx.history(spark, sf_dir), fx.scored(spark, sf_dir), run_id="run-1"),
                           scratch_path(spark, "watermark"))
    back = read_watermark(spark, path)
    return back.withColumn("has_time", F.col("updated_at_utc").isNotNull()).drop("updated_at_utc")


@register("i6_watermark_delta", W("""
SELECT max(feature_date) AS last_feature_date, CAST(COUNT(*) AS BIGINT) AS consumed_rows,
       CAST(SUM(CASE WHEN feature_date > (SELECT max(feature_date) FROM wm_rows) THEN 1 ELSE 0 END) AS BIGINT)
         AS rows_beyond_previous FROM newl""", hist=_I4_CTES["hist"], newl=_newl("SELECT max(Date) FROM hist"),
                                  wm_rows=_newl("SELECT max(Date) FROM hist", _SNAPSHOT)))
def i6_delta(spark, sf_dir):
    """I6 twice: advanced on the log as of 2024-01-25, then on the whole log;
    the second row reports how many consumed rows lie beyond the first."""
    hist, scored = fx.history(spark, sf_dir), fx.scored(spark, sf_dir)
    earlier = scored.filter(F.col("logged_at") < F.lit("2024-01-25 00:00:00").cast("timestamp_ntz"))
    return advance_watermark(hist, scored, previous=advance_watermark(hist, earlier)).drop("updated_at_utc", "run_id")


@register("i5_fallbacks", W("""
SELECT 'no history' AS given, CAST(0 AS BIGINT) AS new_rows_for_retrain, CAST(NULL AS DATE) AS retrain_cutoff_date
UNION ALL SELECT 'no log', 0, NULL
UNION ALL SELECT 'missing column', 0, max(Date) FROM hist
UNION ALL SELECT 'corrupt watermark', (SELECT COUNT(*) FROM newl), max(Date) FROM hist""",
                          hist=_I4_CTES["hist"], newl=_newl("SELECT max(Date) FROM hist")))
def i5_fallbacks(spark, sf_dir):
    """I5 where something it counts from is missing or broken."""
    hist, scored = fx.history(spark, sf_dir), fx.scored(spark, sf_dir)
    path = scratch_path(spark, "corrupt-watermark")
    spark.range(1).select(F.lit("{broken").alias("value")).write.text(path)
    cases = {"no history": count_new_rows(hist.filter(F.col("Date").isNull()), scored), "no log": count_new_rows(hist, None),
             "missing column": count_new_rows(hist, scored.drop("y_true")),
             "corrupt watermark": count_new_rows(hist, scored, read_watermark(spark, path))}
    return reduce(DataFrame.unionByName, [d.withColumn("given", F.lit(name)) for name, d in cases.items()])


@register("i8_retrain_decision", W(f"""
SELECT scope, status, ROUND(recall_combined_cv, 6) AS recall_combined_cv, new_rows_for_retrain,
  CASE WHEN status <> 'ok' THEN 'skip_optuna' WHEN new_rows_for_retrain < 60 THEN 'skip_optuna'
       WHEN COALESCE(recall_combined_cv, 1e0) < 0.59 THEN 'trigger_optuna' ELSE 'skip_optuna' END AS decision
FROM (SELECT q.scope, CASE WHEN q.pos > 0 AND q.pos < q.n THEN 'ok' ELSE 'not_enough_classes' END AS status,
             q.recall AS recall_combined_cv, CAST(COALESCE(c.cnt, 0) AS BIGINT) AS new_rows_for_retrain
      FROM q LEFT JOIN c ON q.scope = c.scope) t""",
                                   hist=_I4_CTES["hist"], newl=_newl("SELECT max(Date) FROM hist"),
                                   lab="SELECT * FROM scored WHERE truth_available AND y_true IS NOT NULL",
                                   q="""SELECT location AS scope, COUNT(*) AS n, SUM(y_true) AS pos,
  COALESCE(SUM(CASE WHEN y_true = 1 AND predicted_rain = 1 THEN 1 ELSE 0 END) * 1e0 / NULLIF(SUM(y_true), 0), 0e0) AS recall
  FROM lab GROUP BY location
  UNION ALL SELECT 'ALL', COUNT(*), SUM(y_true),
  COALESCE(SUM(CASE WHEN y_true = 1 AND predicted_rain = 1 THEN 1 ELSE 0 END) * 1e0 / NULLIF(SUM(y_true), 0), 0e0) FROM lab""",
                                   c="""SELECT location AS scope, COUNT(*) AS cnt FROM newl GROUP BY location
  UNION ALL SELECT 'ALL', COUNT(*) FROM newl"""))
def i8(spark, sf_dir):
    """I8 over per-station quality rows plus one overall row, from one pass over the scored log."""
    scored = fx.scored(spark, sf_dir)
    horizon = _date_lit(_latest_date(fx.history(spark, sf_dir), "Date"))
    quality = station_quality(scored, horizon).select(
        F.coalesce("location", F.lit("ALL")).alias("scope"), "status", "recall_combined_cv", "new_rows_for_retrain")
    return retrain_decision(quality).select("scope", "status", r6("recall_combined_cv").alias("recall_combined_cv"),
                                            "new_rows_for_retrain", "decision")
