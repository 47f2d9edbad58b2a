"""Catalog part 6: models, search and the model-based jobs (C5, D18, H10, H12,
H13, H15–H17, H19–H24, I2, I7, I9).

What a learner puts out is its own, so these queries return what does not
depend on it (keys, labels, row counts, folds, parameters, dates) beside
properties that must hold for any learner: scores in [0, 1], the class at the
threshold, metrics within bounds or above a floor.  The oracle states the former
from SQL and TRUE for the latter.  Fixture settings are tiny (≤ 10 trees,
depth ≤ 4); cluster defaults live in the operators.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloop.operators import models as M
from labelloop.operators.dedup import last_per_key
from labelloop.operators.features import balanced_weights
from labelloop.operators.metrics import METRIC_NAMES, evaluate
from labelloop.operators.search import retrain_with_best, run_search, trial_table
from labelloop.operators.split import stratified_folds, stratified_split
from labelloop.operators.trials import patience_stop
from labelloop.plans import fixtures as fx
from labelloop.plans.catalog import register
from labelloop.plans.fixtures import _I4_CTES, with_fixtures as W
from labelloop.plans.jobs import prepare_dataset, retrain_quality, tune_retrain_advance
from labelloop.session import cut_lineage, scratch_path
from labelloop.sources.schemas import TARGET_SCHEMA
from labelloop.sources.stations import lookup_dimension

# All feature columns of the target schema; those without any value are left out by the fit.
CATS = tuple(f.name for f in TARGET_SCHEMA.fields if isinstance(f.dataType, T.StringType) and f.name != "RainTomorrow")
NUMS = tuple(f.name for f in TARGET_SCHEMA.fields if isinstance(f.dataType, T.DoubleType))
SPEC = M.ModelSpec(categorical=CATS, numeric=NUMS, kind="gbt", params={"n_estimators": 5, "max_depth": 3},
                   id_col="event_id")
SMOTED = replace(SPEC, oversample=True)     # the production pipeline
TINY = {"gbt": {"n_estimators": 5, "max_depth": 3}, "rf": {"numTrees": 5, "maxDepth": 4},
        "dt": {"maxDepth": 4}, "lr": {"maxIter": 100}, "svc": {"maxIter": 10}}
# search space and known best scaled to fixture size (the cluster's are in the search module)
FIXTURE_SPACE = {"n_estimators": (2, 4, "int"), "max_depth": (2, 3, "int"), "learning_rate": (0.05, 0.3, "log"),
                 "subsample": (0.7, 0.95, "float"), "colsample_bytree": (0.7, 1.0, "float"),
                 "min_child_weight": (1, 6, "int")}
FIXTURE_BEST = {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.1, "subsample": 0.9, "colsample_bytree": 1.0,
                "min_child_weight": 2}
FIXTURE_TRIALS, FIXTURE_PATIENCE = 12, 4
AUC_FLOOR = 0.6             # the fixture label depends on Rainfall, so any learner is far above chance

# ---- oracle blocks: labelled rows, their hold-out split and folds
_LAB = ("SELECT event_id, location, CASE WHEN lower(trim(rain_tomorrow)) IN ('yes', '1', 'true') THEN 1 ELSE 0 END AS label "
        "FROM obs WHERE rain_tomorrow IS NOT NULL")
_RANKED = ("SELECT *, ROW_NUMBER() OVER (PARTITION BY label ORDER BY md5('42' || CAST(event_id AS VARCHAR)), event_id) AS rn, "
           "COUNT(*) OVER (PARTITION BY label) AS cnt FROM lab")
_CTES = {"lab": _LAB, "ranked": _RANKED}
_SCORED_SQL = W("SELECT event_id, label, TRUE AS score_ok, TRUE AS class_ok FROM lab", **_CTES)


def prepared(spark, sf_dir) -> DataFrame:
    """I1 over the observation fixture, keeping the event id as row key."""
    return prepare_dataset(fx.feature_rows(fx.obs(spark, sf_dir), keep=("event_id",)))


def _with_folds(spark, sf_dir, k: int = 5) -> DataFrame:
    return stratified_folds(prepared(spark, sf_dir), "label", "event_id", k=k)


def _within(c: str, low: float = 0.0, high: float = 1.0) -> Column:
    return F.coalesce(F.col(c).between(low, high), F.lit(False))


def _scored_out(df: DataFrame, margin: bool = False) -> DataFrame:
    """Key and label, and whether score and class are what they must be (a margin only has a sign)."""
    ok = F.col("score").isNotNull() & ~F.isnan("score") if margin else _within("score")
    at = F.col("score") > 0 if margin else F.col("score") >= 0.5
    return df.select("event_id", "label", ok.alias("score_ok"), (F.col("predicted") == at.cast("int")).alias("class_ok"))


def _metrics_ok(suffix: str = "", floor: float = AUC_FLOOR) -> Column:
    """Every metric within [0, 1] and the AUC above the floor."""
    ok = F.col(f"roc_auc{suffix}") >= floor
    for m in METRIC_NAMES:
        ok = ok & _within(f"{m}{suffix}")
    return F.coalesce(ok, F.lit(False))


@register("i2_train_evaluate", W("""
SELECT CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(label) AS BIGINT) AS positives, TRUE AS metrics_ok
FROM ranked WHERE rn <= ROUND(cnt * 0.2e0)""", **_CTES))
def i2(spark, sf_dir):
    """I2 (+ C5): stratified 80/20 split, fit with SMOTE inside the fit, evaluate
    the hold-out rows — label and prediction stay in one row, no positional join."""
    data = cut_lineage(stratified_split(prepared(spark, sf_dir), "label", "event_id"))
    model = M.fit_model(data.filter(F.col("split") == "train"), SMOTED)
    held = M.score(model, data.filter(F.col("split") == "test"))
    return evaluate(held, y="label", pred="predicted", score="score").select("n", "positives", _metrics_ok().alias("metrics_ok"))


@register("c5_split_evaluation_rows", W("""
SELECT event_id, label, TRUE AS score_ok, TRUE AS class_ok FROM ranked WHERE rn <= ROUND(cnt * 0.2e0)""", **_CTES))
def c5(spark, sf_dir):
    """Scoring keeps key, label and prediction in one row (no positional alignment)."""
    data = cut_lineage(stratified_split(prepared(spark, sf_dir), "label", "event_id"))
    model = M.fit_model(data.filter(F.col("split") == "train"), SPEC)
    return _scored_out(M.score(model, data.filter(F.col("split") == "test")))


@register("h10_cross_validate", W("""
SELECT CAST((rn - 1) % 5 AS INTEGER) AS fold, CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(label) AS BIGINT) AS positives,
       TRUE AS metrics_ok FROM ranked GROUP BY 1""", **_CTES))
def h10(spark, sf_dir):
    """Five folds of the production pipeline (boosted trees, SMOTE in each fit)."""
    per_fold = M.cross_validate(_with_folds(spark, sf_dir), SMOTED)
    return per_fold.select("fold", "n", "positives", _metrics_ok().alias("metrics_ok"))


@register("h12_boosted_trees", _SCORED_SQL)
def h12(spark, sf_dir):
    data = prepared(spark, sf_dir)
    return _scored_out(M.score(M.fit_model(data, SPEC), data))


@register("h13_random_forest_balanced", _SCORED_SQL)
def h13(spark, sf_dir):
    data = balanced_weights(prepared(spark, sf_dir), "label")
    spec = replace(SPEC, kind="rf", params=TINY["rf"], weight="weight")
    return _scored_out(M.score(M.fit_model(data, spec), data))


@register("h15_logistic_regression", W("""
SELECT CAST(COUNT(*) AS BIGINT) AS n, ROUND(AVG(label), 2) AS mean_score, TRUE AS scores_ok, TRUE AS classes_ok FROM lab""", **_CTES))
def h15(spark, sf_dir):
    """At convergence a logistic regression with intercept predicts the share of positives on its own rows."""
    data = prepared(spark, sf_dir)
    s = M.score(M.fit_model(data, replace(SPEC, kind="lr", params=TINY["lr"])), data)
    out = s.select("score", _within("score").alias("ok"), (F.col("predicted") == (F.col("score") >= 0.5).cast("int")).alias("class_ok"))
    return out.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 2).alias("mean_score"),
                   F.bool_and("ok").alias("scores_ok"), F.bool_and("class_ok").alias("classes_ok"))


@register("h16_decision_tree", _SCORED_SQL)
def h16(spark, sf_dir):
    data = prepared(spark, sf_dir)
    return _scored_out(M.score(M.fit_model(data, replace(SPEC, kind="dt", params=TINY["dt"])), data))


@register("h17_linear_svc", _SCORED_SQL)
def h17(spark, sf_dir):
    data = prepared(spark, sf_dir)
    return _scored_out(M.score(M.fit_model(data, replace(SPEC, kind="svc", params=TINY["svc"])), data), margin=True)


@register("h19_model_benchmark", "SELECT unnest(['lr', 'dt', 'rf', 'gbt', 'svc']) AS model, CAST(5 AS BIGINT) AS folds, TRUE AS metrics_ok")
def h19(spark, sf_dir):
    out = M.benchmark(_with_folds(spark, sf_dir), SPEC, params=TINY)
    return out.select("model", "folds", _metrics_ok().alias("metrics_ok"))


def _trials(spark) -> DataFrame:
    return trial_table(spark, n_trials=FIXTURE_TRIALS, space=FIXTURE_SPACE, known_best=FIXTURE_BEST)


def _search(data: DataFrame, spec=SPEC):
    """Recall of five folds; the known best is trial 0, and the search stops by patience."""
    return run_search(data, spec, _trials(data.sparkSession), study="gbt_recall_fixture", objective="recall", wave=4,
                      patience=FIXTURE_PATIENCE)


def _param_sql(name: str) -> str:
    lo, hi, kind = FIXTURE_SPACE[name]
    u = f"(CAST('0x' || substring(md5('42|' || CAST(n AS VARCHAR) || '|{name}'), 1, 8) AS BIGINT) / 4294967296e0)"
    v = {"int": f"floor({lo}e0 + {u} * {hi - lo + 1}e0)", "float": f"{lo}e0 + {u} * ({hi}e0 - {lo}e0)",
         "log": f"exp(ln({lo}e0) + {u} * (ln({hi}e0) - ln({lo}e0)))"}[kind]
    return f"ROUND(CASE WHEN n = 0 THEN {FIXTURE_BEST[name]}e0 ELSE {v} END, 6) AS {name}"


@register("h20_search_trials", f"""
SELECT n, {', '.join(_param_sql(p) for p in FIXTURE_SPACE)}, TRUE AS run_ok
FROM (SELECT unnest(range({FIXTURE_TRIALS})) AS n) t""")
def h20(spark, sf_dir):
    """The trial plan, and whether the search ran exactly the trials up to its stop, with values in [0, 1],
    and chose the best of them."""
    table, best = _search(_with_folds(spark, sf_dir))
    table = cut_lineage(table)
    stop = patience_stop(table, patience=FIXTURE_PATIENCE).first()
    last = stop["stopped_at"] if stop["stopped_at"] is not None else FIXTURE_TRIALS - 1
    top = best.first()
    chosen = top is not None and abs(top["best_value"] - table.agg(F.max("value")).first()[0]) < 1e-12 and top["best_trial"] <= last
    ran = table.select("n", "value", F.lit(True).alias("ran"))
    ok = (F.coalesce("ran", F.lit(False)) == (F.col("n") <= F.lit(last))) & F.lit(chosen) & (F.col("n").__gt__(last) | _within("value"))
    return _trials(spark).join(ran, "n", "left").select("n", *[F.round(p, 6).alias(p) for p in FIXTURE_SPACE], ok.alias("run_ok"))


@register("h21_retrain_best", W("""
SELECT CAST(COUNT(*) AS BIGINT) AS rows_used, 'gbt_recall_fixture' AS best_study_name, CAST(5 AS BIGINT) AS folds,
       CAST(6 AS BIGINT) AS parameters, TRUE AS best_ok, TRUE AS cv_ok, TRUE AS fit_ok FROM lab""", **_CTES))
def h21(spark, sf_dir):
    """Search, then the best setting with SMOTE: five-fold metrics, fit on all rows, metrics on the fit set."""
    data = cut_lineage(_with_folds(spark, sf_dir))
    _, best = _search(data)
    _, meta = retrain_with_best(data, SMOTED, best, model_path=scratch_path(spark, "h21-model"))
    return meta.select("rows_used", "best_study_name", "folds", F.size("best_params").cast("bigint").alias("parameters"),
                       _within("best_value").alias("best_ok"), _metrics_ok("_combined_cv").alias("cv_ok"),
                       _metrics_ok("_fit").alias("fit_ok"))


@register("h22_batch_scoring", W("""
SELECT event_id, location AS "Location", TRUE AS score_ok, TRUE AS class_ok FROM obs
WHERE obs_date = (SELECT max(obs_date) FROM obs)"""))
def h22(spark, sf_dir):
    """Score the rows of the latest observation date (E5, mode all)."""
    data = prepared(spark, sf_dir)
    model = M.fit_model(data, SPEC)
    o = fx.obs(spark, sf_dir)
    latest = o.filter(F.col("obs_date") == o.select(F.max("obs_date")).scalar())
    rows = fx.feature_rows(latest, keep=("event_id",))
    rows = rows.withColumns({"Dayofyear": F.dayofyear("Date"), "Month": F.month("Date")})
    s = M.score(model, rows).withColumn("label", F.lit(None))
    return _scored_out(s).drop("label").join(rows.select("event_id", "Location"), "event_id")


@register("h23_score_every_station", W("""
SELECT s.location, l.event_id, CASE WHEN d.location IS NULL THEN 'unknown station' WHEN l.event_id IS NULL THEN 'no observation' END AS error,
       d.location IS NOT NULL AND l.event_id IS NOT NULL AS scored, TRUE AS score_ok
FROM (SELECT location FROM truth UNION SELECT location FROM obs) s
LEFT JOIN (SELECT DISTINCT location FROM truth) d ON s.location = d.location
LEFT JOIN (SELECT * FROM (SELECT o.*, ROW_NUMBER() OVER (PARTITION BY location ORDER BY obs_date DESC, ts DESC, event_id DESC) AS rn
           FROM obs o) t WHERE rn = 1) l ON s.location = l.location"""))
def h23(spark, sf_dir):
    """A10 + E4 + H22 for every station of the dimension or the observations:
    latest observation scored; an unknown station or a station without an
    observation gets an error string instead of failing the batch."""
    data = prepared(spark, sf_dir)
    model = M.fit_model(data, SPEC)
    dim = fx.truth(spark, sf_dir).select("location").distinct().withColumn("code", F.col("location"))
    latest = last_per_key(fx.obs(spark, sf_dir), ["location"], ["obs_date", "ts", "event_id"])
    stations = dim.select("location").unionByName(latest.select("location")).distinct()
    rows = lookup_dimension(stations, dim, "location", "code").join(latest, "location", "left")
    feats = fx.feature_rows(rows, keep=("event_id", "is_known"))
    feats = feats.withColumns({"Dayofyear": F.dayofyear("Date"), "Month": F.month("Date")})
    error = (F.when(~F.col("is_known"), F.lit("unknown station"))
             .when(F.col("event_id").isNull(), F.lit("no observation")))
    s = M.score(model, feats.filter(F.col("event_id").isNotNull())).select("Location", "score", "predicted")
    out = feats.select("Location", "event_id", "is_known").join(s, "Location", "left").withColumn("error", error)
    right = _within("score") & (F.col("predicted") == (F.col("score") >= 0.5).cast("int"))
    return out.select(F.col("Location").alias("location"), "event_id", "error", F.col("error").isNull().alias("scored"),
                      (F.col("error").isNotNull() | right).alias("score_ok"))


@register("h24_model_round_trip", W("SELECT CAST(COUNT(*) AS BIGINT) AS compared, CAST(0 AS BIGINT) AS differing FROM lab", **_CTES))
def h24(spark, sf_dir):
    """Save, reload, score each row with both models (one pass, no join): rows compared and rows that differ."""
    data = prepared(spark, sf_dir)
    model = M.fit_model(data, SPEC)
    again = M.load_model(M.save_model(model, scratch_path(spark, "h24-model")))
    first = M.score(model, data).select(*data.columns, F.col("score").alias("s1"))
    both = M.score(again, first)
    differs = F.abs(F.col("s1") - F.col("score")) > 1e-12
    return both.agg(F.count(F.lit(1)).alias("compared"), F.count(F.when(F.coalesce(differs, F.lit(True)), 1)).alias("differing"))


@register("d18_fit_set_metrics", W("""
SELECT CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(label) AS BIGINT) AS positives, TRUE AS metrics_ok FROM lab""", **_CTES))
def d18(spark, sf_dir):
    data = prepared(spark, sf_dir)
    m = evaluate(M.score(M.fit_model(data, SPEC), data), y="label", pred="predicted", score="score")
    return m.select("n", "positives", _metrics_ok().alias("metrics_ok"))


_RETRAIN = {**_I4_CTES, "usable": "SELECT * FROM (SELECT * FROM hist UNION ALL SELECT * FROM added) u WHERE RainTomorrow IS NOT NULL"}


@register("i7_retrain_quality", W("""
SELECT 'ok' AS status, (SELECT CAST(COUNT(*) AS BIGINT) FROM usable) AS rows_used, CAST(5 AS INTEGER) AS cv_splits,
       TRUE AS metrics_ok, (SELECT CAST(COUNT(*) AS BIGINT) FROM hist) AS historical_rows,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM added) AS added_rows,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM newl) AS new_rows_for_retrain, (SELECT max(Date) FROM hist) AS retrain_cutoff_date""", **_RETRAIN))
def i7(spark, sf_dir):
    """Retrain set → 5-fold CV of the production pipeline → one quality row (+ dataset meta, new rows, cutoff)."""
    q = retrain_quality(fx.history(spark, sf_dir), fx.scored(spark, sf_dir), fx.observations(spark, sf_dir), SMOTED, k=5)
    return q.select("status", "rows_used", "cv_splits", _metrics_ok("_combined_cv", 0.5).alias("metrics_ok"),
                    "retrain_dataset_meta.historical_rows", "retrain_dataset_meta.added_rows", "new_rows_for_retrain",
                    "retrain_cutoff_date")


@register("i9_tune_retrain_watermark", W("""
SELECT (SELECT CAST(COUNT(*) AS BIGINT) FROM usable) AS rows_used, 'gbt_recall_retrain' AS best_study_name, CAST(5 AS BIGINT) AS folds,
       TRUE AS best_ok, TRUE AS cv_ok, max(feature_date) AS last_feature_date, CAST(COUNT(*) AS BIGINT) AS consumed_rows,
       CAST(COUNT(*) AS BIGINT) AS rows_beyond_previous, 'run-9' AS run_id FROM newl""", **_RETRAIN))
def i9(spark, sf_dir):
    """Tune → best trial → retrain on all (SMOTE in every fit) → advance the watermark, over one snapshot."""
    out = tune_retrain_advance(fx.history(spark, sf_dir), fx.scored(spark, sf_dir), fx.observations(spark, sf_dir),
                               SMOTED, _trials(spark), k=5, model_path=scratch_path(spark, "i9-model"), run_id="run-9",
                               patience=FIXTURE_PATIENCE)
    return out.select("rows_used", "best_study_name", "folds", _within("best_value").alias("best_ok"),
                      _metrics_ok("_combined_cv", 0.5).alias("cv_ok"), "last_feature_date", "consumed_rows",
                      "rows_beyond_previous", "run_id")
