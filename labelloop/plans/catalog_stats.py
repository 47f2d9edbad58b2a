"""Catalog part 2: profiling (D1–D11) and quality metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloop.operators import profile as P
from labelloop.operators import sketches as SK
from labelloop.operators.metrics import confusion_matrix, evaluate, fold_means, live_metrics, metrics_report
from labelloop.operators.split import stratified_folds, stratified_split
from labelloop.plans import fixtures as fx
from labelloop.plans.catalog import r6, register, sql_metrics
from labelloop.plans.fixtures import HISTORY_HORIZON as H, with_fixtures as W
from labelloop.session import scratch_path

OBS_COLS = ("event_id", "ts", "obs_date", "location", "rainfall_txt", "wind_dir", "wind_speed9am",
            "rain_tomorrow")


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# ------------------------------------------------------------------ D1 – D11
@register("d1_missing_rate", W(_union([
    f"SELECT '{c}' AS column_name, ROUND(AVG(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END) * 100, 6) AS missing_pct FROM obs"
    for c in OBS_COLS])))
def d1(spark, sf_dir):
    return P.missing_rate(fx.obs(spark, sf_dir)).withColumn("missing_pct", r6("missing_pct"))


@register("d2_null_patterns", W("""
SELECT wind_dir IS NULL AS wind_dir_missing, rain_tomorrow IS NULL AS rain_tomorrow_missing,
       CAST(COUNT(*) AS BIGINT) AS n FROM obs GROUP BY 1, 2"""))
def d2(spark, sf_dir):
    return P.null_patterns(fx.obs(spark, sf_dir), "wind_dir", "rain_tomorrow")


@register("d3_class_counts", W("""
SELECT rain_tomorrow, CAST(COUNT(*) AS BIGINT) AS n FROM obs WHERE rain_tomorrow IS NOT NULL GROUP BY 1"""))
def d3(spark, sf_dir):
    return P.class_counts(fx.obs(spark, sf_dir), "rain_tomorrow")


@register("d4_class_share", W("""
SELECT rain_tomorrow, ROUND(COUNT(*) * 100e0 / SUM(COUNT(*)) OVER (), 6) AS share_pct
FROM obs WHERE rain_tomorrow IS NOT NULL GROUP BY 1"""))
def d4(spark, sf_dir):
    return P.class_share(fx.obs(spark, sf_dir), "rain_tomorrow").withColumn("share_pct", r6("share_pct"))


_NUM_CTE = "SELECT location, wind_speed9am, TRY_CAST(rainfall_txt AS DOUBLE) AS rainfall FROM obs"


def _describe_sql(c: str) -> str:
    return (f"SELECT '{c}' AS column_name, CAST(COUNT({c}) AS BIGINT) AS count, ROUND(AVG({c}), 6) AS mean, "
            f"ROUND(STDDEV_SAMP({c}), 6) AS std, ROUND(MIN({c}), 6) AS min, "
            f"ROUND(QUANTILE_CONT({c}, 0.25), 6) AS p25, ROUND(QUANTILE_CONT({c}, 0.5), 6) AS p50, "
            f"ROUND(QUANTILE_CONT({c}, 0.75), 6) AS p75, ROUND(MAX({c}), 6) AS max FROM num")


def _numeric_obs(spark, sf_dir) -> DataFrame:
    from labelloop.functions.values import safe_double
    return fx.obs(spark, sf_dir).select("location", "wind_speed9am",
                                        safe_double("rainfall_txt").alias("rainfall"))


@register("d5_describe", W(_union([_describe_sql("wind_speed9am"), _describe_sql("rainfall")]), num=_NUM_CTE))
def d5(spark, sf_dir):
    out = P.describe(_numeric_obs(spark, sf_dir), ["wind_speed9am", "rainfall"])
    return out.select("column_name", "count", *[r6(s).alias(s) for s in P.STATS[1:]])


@register("d6_grouped_describe", W("""
SELECT location, CAST(COUNT(wind_speed9am) AS BIGINT) AS count, ROUND(AVG(wind_speed9am), 6) AS mean,
       ROUND(STDDEV_SAMP(wind_speed9am), 6) AS std, ROUND(MIN(wind_speed9am), 6) AS min,
       ROUND(QUANTILE_CONT(wind_speed9am, 0.25), 6) AS p25, ROUND(QUANTILE_CONT(wind_speed9am, 0.5), 6) AS p50,
       ROUND(QUANTILE_CONT(wind_speed9am, 0.75), 6) AS p75, ROUND(MAX(wind_speed9am), 6) AS max
FROM num GROUP BY location""", num=_NUM_CTE))
def d6(spark, sf_dir):
    out = P.grouped_describe(_numeric_obs(spark, sf_dir), "location", "wind_speed9am")
    return out.select("location", "count", *[r6(s).alias(s) for s in P.STATS[1:]])


def _sketches(spark, sf_dir):
    """Sketches per day and station of the observations, stored once."""
    path = scratch_path(spark, "sketches")
    from labelloop.functions.values import safe_double
    o = fx.obs(spark, sf_dir).select("event_id", "obs_date", "location", "wind_dir", "wind_speed9am", safe_double("rainfall_txt").alias("rainfall"))
    SK.daily_sketches(o, ["obs_date", "location"], ["wind_speed9am", "rainfall"], ["event_id", "location", "wind_dir"]).write.parquet(path)
    return o, spark.read.parquet(path)


def _near_ranks(exact: DataFrame, found: DataFrame, on: list[str]) -> DataFrame:
    """``found`` with ``ranks_ok``: each quartile has a share of the values at or around it within the error bound."""
    ok = F.lit(True)
    for q, name in zip(P.QUARTILES, ("p25", "p50", "p75")):
        below = F.count_if(F.col("value") < F.col(name)) / F.count(F.lit(1))
        upto = F.count_if(F.col("value") <= F.col(name)) / F.count(F.lit(1))
        ok = ok & (below <= q + SK.RANK_ERROR) & (upto >= q - SK.RANK_ERROR)
    return exact.join(found, on).groupBy(*on).agg(ok.alias("ranks_ok"))


def _merged_sql(column: str) -> str:
    return (f"SELECT '{column}' AS column_name, CAST(COUNT({column}) AS BIGINT) AS count, ROUND(AVG({column}), 6) AS mean, "
            f"ROUND(STDDEV_SAMP({column}), 6) AS std, ROUND(MIN({column}), 6) AS min, ROUND(MAX({column}), 6) AS max, TRUE AS ranks_ok "
            f"FROM daynum WHERE obs_date > DATE '{H}'")


@register("d5_merged_sketches", W(_union([_merged_sql("wind_speed9am"), _merged_sql("rainfall")]),
                                  daynum="SELECT obs_date, wind_speed9am, TRY_CAST(rainfall_txt AS DOUBLE) AS rainfall FROM obs"))
def d5_merged(spark, sf_dir):
    """D5 of the days after the horizon, merged from stored day sketches; quartiles are checked against the rows."""
    rows, sketches = _sketches(spark, sf_dir)
    after = F.col("obs_date") > F.lit(H).cast("date")
    found = SK.merged_describe(sketches.filter(after))
    values = rows.filter(after).select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"))
                                                          for c in ("wind_speed9am", "rainfall")]))).where("value is not null")
    out = found.join(_near_ranks(values, found, ["column_name"]), "column_name")
    return out.select("column_name", "count", *[r6(c).alias(c) for c in ("mean", "std", "min", "max")], "ranks_ok")


@register("d6_merged_sketches", W("""
SELECT num.location, CAST(COUNT(num.wind_speed9am) AS BIGINT) AS count, ROUND(AVG(num.wind_speed9am), 6) AS mean,
       ROUND(MIN(num.wind_speed9am), 6) AS min, ROUND(MAX(num.wind_speed9am), 6) AS max, TRUE AS ranks_ok
FROM num GROUP BY num.location""", num=_NUM_CTE))
def d6_merged(spark, sf_dir):
    """D6 per station over all days, merged from the same sketches."""
    rows, sketches = _sketches(spark, sf_dir)
    found = SK.merged_describe(sketches.filter(F.col("column_name") == "wind_speed9am"), ["location"])
    values = rows.select("location", F.col("wind_speed9am").alias("value")).where("value is not null")
    out = found.join(_near_ranks(values, found, ["location"]), "location")
    return out.select("location", "count", *[r6(c).alias(c) for c in ("mean", "min", "max")], "ranks_ok")


@register("d7_merged_sketches", W(_union([
    f"SELECT '{c}' AS column_name, TRUE AS near FROM (SELECT COUNT(*) FROM obs) x" for c in ("event_id", "location", "wind_dir", "wind_speed9am", "rainfall")])))
def d7_merged(spark, sf_dir):
    """D7 over all days from merged sketches, within the error bound of the exact counts."""
    rows, sketches = _sketches(spark, sf_dir)
    found = SK.merged_distinct(sketches)
    exact = P.distinct_counts(rows, ["event_id", "location", "wind_dir", "wind_speed9am", "rainfall"]).withColumnRenamed("n_unique", "exact")
    near = F.abs(F.col("n_unique") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * SK.DISTINCT_ERROR)
    return found.join(exact, "column_name").select("column_name", near.alias("near"))


@register("d7_distinct_counts", W(_union([
    f"SELECT '{c}' AS column_name, CAST(COUNT(DISTINCT {c}) AS BIGINT) AS n_unique FROM obs" for c in OBS_COLS])))
def d7(spark, sf_dir):
    return P.distinct_counts(fx.obs(spark, sf_dir))


@register("d8_table_info", W(_union([
    f"SELECT {i} AS position, '{c}' AS column_name, CAST(COUNT({c}) AS BIGINT) AS non_null, "
    f"CAST(COUNT(*) AS BIGINT) AS n_rows FROM obs" for i, c in enumerate(OBS_COLS)])))
def d8(spark, sf_dir):
    return P.table_info(fx.obs(spark, sf_dir)).drop("dtype")


@register("d9_nulls_by_split", W(f"""
SELECT CASE WHEN obs_date <= DATE '{H}' THEN 'history' ELSE 'new' END AS split,
       CAST(SUM(CASE WHEN wind_dir IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS wind_dir_nulls,
       CAST(SUM(CASE WHEN rain_tomorrow IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS rain_tomorrow_nulls,
       CAST(SUM(CASE WHEN TRY_CAST(rainfall_txt AS DOUBLE) IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS rainfall_nulls
FROM obs GROUP BY 1"""))
def d9(spark, sf_dir):
    from labelloop.functions.values import safe_double
    o = fx.obs(spark, sf_dir)
    o = o.select(F.when(F.col("obs_date") <= F.lit(H).cast("date"), "history").otherwise("new").alias("split"),
                 "wind_dir", "rain_tomorrow", safe_double("rainfall_txt").alias("rainfall"))
    return P.null_counts_by(o, "split", ["wind_dir", "rain_tomorrow", "rainfall"])


@register("d10_history_horizon", W(f"SELECT MAX(obs_date) AS max_date FROM obs WHERE obs_date <= DATE '{H}'"))
def d10(spark, sf_dir):
    hist = fx.obs(spark, sf_dir, until=H)
    return P.max_value(hist, "obs_date", "max_date")


# ------------------------------------------------------------------ D12 – D17
_LAB = "SELECT doc_id, quality AS y, toxic AS p FROM labels"


@register("d12_confusion_matrix", W("""
SELECT 0 AS actual, CAST(SUM(CASE WHEN y = 0 AND p = 0 THEN 1 ELSE 0 END) AS BIGINT) AS pred_0,
       CAST(SUM(CASE WHEN y = 0 AND p = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pred_1 FROM lab
UNION ALL
SELECT 1, CAST(SUM(CASE WHEN y = 1 AND p = 0 THEN 1 ELSE 0 END) AS BIGINT),
       CAST(SUM(CASE WHEN y = 1 AND p = 1 THEN 1 ELSE 0 END) AS BIGINT) FROM lab""", lab=_LAB))
def d12(spark, sf_dir):
    return confusion_matrix(fx.table(spark, sf_dir, "labels"), "quality", "toxic")


_c13, (_a, _p, _r, _f) = sql_metrics("lab", "y", "p", None)


@register("d13_classification_metrics", W(f"""
SELECT CAST(n AS BIGINT) AS n, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn,
       CAST(tn AS BIGINT) AS tn, ROUND({_a}, 6) AS accuracy, ROUND({_p}, 6) AS precision,
       ROUND({_r}, 6) AS recall, ROUND({_f}, 6) AS f1 FROM m_cnt""", lab=_LAB, **_c13))
def d13(spark, sf_dir):
    m = evaluate(fx.table(spark, sf_dir, "labels"), y="quality", pred="toxic")
    return m.select("n", "tp", "fp", "fn", "tn", *[r6(c).alias(c) for c in ("accuracy", "precision",
                                                                              "recall", "f1")])


_c14, _s14 = sql_metrics("sc", "y", None, "s")


@register("d14_exact_auc", W(f"SELECT ROUND({_s14[-1]}, 6) AS roc_auc FROM m_auc",
                             sc="SELECT l.quality AS y, CAST(d.n_chars AS DOUBLE) AS s FROM labels l "
                                "JOIN documents d ON l.doc_id = d.doc_id", **_c14))
def d14(spark, sf_dir):
    from labelloop.operators.metrics import roc_auc
    lab = fx.table(spark, sf_dir, "labels")
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return roc_auc(lab.join(docs, "doc_id"), "quality", "n_chars").select(r6("roc_auc").alias("roc_auc"))


@register("d14_grouped_auc", W(f"""
SELECT toxic, ROUND(CASE WHEN SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END) > 0 AND SUM(CASE WHEN y = 0 THEN 1 ELSE 0 END) > 0 THEN
  (SUM(CASE WHEN y = 1 THEN r ELSE 0 END) - SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END) * (SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END) + 1) / 2e0)
  / (SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END) * 1e0 * SUM(CASE WHEN y = 0 THEN 1 ELSE 0 END)) END, 6) AS roc_auc
FROM (SELECT toxic, y, RANK() OVER (PARTITION BY toxic ORDER BY s) + (COUNT(*) OVER (PARTITION BY toxic, s) - 1) / 2e0 AS r
      FROM sc) t GROUP BY toxic""",
                               sc="SELECT l.toxic, l.quality AS y, CAST(d.n_chars AS DOUBLE) AS s FROM labels l "
                                  "JOIN documents d ON l.doc_id = d.doc_id"))
def d14g(spark, sf_dir):
    from labelloop.operators.metrics import roc_auc
    lab = fx.table(spark, sf_dir, "labels")
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return roc_auc(lab.join(docs, "doc_id"), "quality", "n_chars", groups=["toxic"]) \
        .select("toxic", r6("roc_auc").alias("roc_auc"))


@register("d15_no_truth_document", W("""
SELECT 'no_ground_truth_available' AS status, CAST(NULL AS DOUBLE) AS accuracy_live,
       CAST(NULL AS DOUBLE) AS precision_live, 1e0 AS recall_live, CAST(NULL AS DOUBLE) AS f1_live,
       CAST(NULL AS DOUBLE) AS roc_auc_live, CAST(COUNT(*) AS BIGINT) AS scored_rows,
       CAST(NULL AS BIGINT) AS positives_true, CAST(200 AS BIGINT) AS "window"
FROM scored WHERE location IN ('S0', 'S7') AND truth_available"""))
def d15(spark, sf_dir):
    """D15's no-truth branch: the stations that are never observed."""
    from labelloop.plans.jobs import live_eval_rows
    s = fx.scored(spark, sf_dir).filter(F.col("location").isin(*fx.UNOBSERVED_STATIONS))
    return live_metrics(live_eval_rows(s, 200), 200)


_FOLD_LAB = ("SELECT doc_id, quality AS y, toxic AS p, CAST((ROW_NUMBER() OVER (PARTITION BY quality "
             "ORDER BY md5('42' || CAST(doc_id AS VARCHAR)), doc_id) - 1) % 5 AS INTEGER) AS fold FROM labels")
_FOLD_METRICS = """SELECT fold, COALESCE((tp + tn) * 1e0 / NULLIF(n, 0), 0e0) AS accuracy,
    COALESCE(tp * 1e0 / NULLIF(tp + fp, 0), 0e0) AS precision, COALESCE(tp * 1e0 / NULLIF(tp + fn, 0), 0e0) AS recall,
    COALESCE(2e0 * tp / NULLIF(2 * tp + fp + fn, 0), 0e0) AS f1 FROM (
  SELECT fold, COUNT(*) AS n, SUM(CASE WHEN y = 1 AND p = 1 THEN 1 ELSE 0 END) AS tp,
         SUM(CASE WHEN y = 0 AND p = 1 THEN 1 ELSE 0 END) AS fp, SUM(CASE WHEN y = 1 AND p = 0 THEN 1 ELSE 0 END) AS fn,
         SUM(CASE WHEN y = 0 AND p = 0 THEN 1 ELSE 0 END) AS tn FROM flab GROUP BY fold) t"""


def _fold_metrics(spark, sf_dir) -> DataFrame:
    lab = stratified_folds(fx.table(spark, sf_dir, "labels"), "quality", "doc_id", k=5, seed=42)
    return evaluate(lab, y="quality", pred="toxic", groups=["fold"])


@register("h9_stratified_folds", W("SELECT doc_id, fold FROM flab", flab=_FOLD_LAB))
def h9(spark, sf_dir):
    return stratified_folds(fx.table(spark, sf_dir, "labels"), "quality", "doc_id", k=5, seed=42) \
        .select("doc_id", "fold")


@register("h8_stratified_split", W("""
SELECT doc_id, CASE WHEN rn <= ROUND(cnt * 0.2e0) THEN 'test' ELSE 'train' END AS split FROM (
  SELECT doc_id, ROW_NUMBER() OVER (PARTITION BY quality ORDER BY md5('42' || CAST(doc_id AS VARCHAR)), doc_id) AS rn,
         COUNT(*) OVER (PARTITION BY quality) AS cnt FROM labels) t"""))
def h8(spark, sf_dir):
    return stratified_split(fx.table(spark, sf_dir, "labels"), "quality", "doc_id", 0.2, 42) \
        .select("doc_id", "split")


@register("d16_fold_means", W("""
SELECT ROUND(AVG(accuracy), 6) AS accuracy_combined_cv, ROUND(AVG(precision), 6) AS precision_combined_cv,
       ROUND(AVG(recall), 6) AS recall_combined_cv, ROUND(AVG(f1), 6) AS f1_combined_cv,
       CAST(COUNT(*) AS BIGINT) AS folds FROM fm""", flab=_FOLD_LAB, fm=_FOLD_METRICS))
def d16(spark, sf_dir):
    m = fold_means(_fold_metrics(spark, sf_dir), metrics=("accuracy", "precision", "recall", "f1"))
    return m.select(*[r6(f"{c}_combined_cv").alias(f"{c}_combined_cv")
                      for c in ("accuracy", "precision", "recall", "f1")], "folds")


_m3, (_a3, _p3, _r3, _f3, _u3) = sql_metrics("ev", "y_true", "predicted_rain", "rain_probability")
_c3b, (_a3b, _p3b, _r3b, _f3b) = sql_metrics("lab", "y", "p", None, prefix="o")


@register("d17_metrics_report", W(f"""
SELECT 'live' AS source, ROUND({_a3}, 3) AS accuracy, ROUND({_p3}, 3) AS precision, ROUND({_r3}, 3) AS recall,
       ROUND({_f3}, 3) AS f1, ROUND({_u3}, 3) AS roc_auc FROM m_cnt, m_auc
UNION ALL
SELECT 'combined_cv', ROUND(AVG(accuracy), 3), ROUND(AVG(precision), 3), ROUND(AVG(recall), 3), ROUND(AVG(f1), 3),
       CAST(NULL AS DOUBLE) FROM fm
UNION ALL
SELECT 'offline', ROUND({_a3b}, 3), ROUND({_p3b}, 3), ROUND({_r3b}, 3), ROUND({_f3b}, 3), CAST(NULL AS DOUBLE)
FROM o_cnt""", ev="""SELECT * FROM scored WHERE truth_available AND y_true IS NOT NULL
    AND predicted_rain IS NOT NULL ORDER BY logged_at DESC, event_id DESC LIMIT 200""",
                                  lab=_LAB, flab=_FOLD_LAB, fm=_FOLD_METRICS, **_m3, **_c3b))
def d17(spark, sf_dir):
    from labelloop.plans.jobs import score_predictions
    _, live = score_predictions(fx.pred_log(spark, sf_dir), fx.truth(spark, sf_dir), window=200)
    cv = fold_means(_fold_metrics(spark, sf_dir), metrics=("accuracy", "precision", "recall", "f1"))
    offline = evaluate(fx.table(spark, sf_dir, "labels"), y="quality", pred="toxic").drop("roc_auc")
    return metrics_report({"live": live, "combined_cv": cv, "offline": offline})
