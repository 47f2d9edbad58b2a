"""Hyper-parameter search and retrain.

Trials are a DataFrame: trial 0 is the known-best setting, the others are
seeded draws (uniform or log-uniform from md5), so a search is reproducible
and can be resumed.  Each trial's objective is a distributed cross-validation;
trials run in waves and the patience rule (E7) is evaluated on the trials
table between waves; the best trial is picked with E8.  The driver only
schedules jobs — it never holds data beyond one wave of parameter rows.
"""

from __future__ import annotations

import math
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from labelloop.operators.metrics import evaluate, fold_means
from labelloop.operators.models import Fold, ModelSpec, drop_folds, evaluate_folds, evaluate_settings, fit_prepared, prepare, prepare_folds, save_model, score
from labelloop.operators.trials import MIN_DELTA, PATIENCE, best_trial, patience_stop
from labelloop.session import scratch_path

# ---- fixed values ----------------------------------------------------------
# Search space (narrow, around the known best), as (low, high, kind) with
# kind "int", "float" or "log"; names are the reference's parameter names.
SEARCH_SPACE = {
    "n_estimators": (400, 800, "int"),
    "max_depth": (5, 10, "int"),
    "learning_rate": (0.02, 0.12, "log"),
    "subsample": (0.7, 0.95, "float"),
    "colsample_bytree": (0.7, 1.0, "float"),
    "min_child_weight": (1, 6, "int"),
}
# The wider space of the search for ROC AUC.
WIDE_SPACE = {
    "n_estimators": (100, 600, "int"),
    "max_depth": (3, 8, "int"),
    "learning_rate": (0.01, 0.3, "log"),
    "subsample": (0.6, 1.0, "float"),
    "colsample_bytree": (0.6, 1.0, "float"),
    "min_child_weight": (1, 10, "int"),
}
WIDE_BUDGET_S = 1800
# Known-best trial, enqueued first.
KNOWN_BEST = {"n_estimators": 598, "max_depth": 8, "learning_rate": 0.06023585382561457,
              "subsample": 0.8218142946598608, "colsample_bytree": 0.9462874097203866,
              "min_child_weight": 2}
N_TRIALS = 30
# ---------------------------------------------------------------------------


def trial_table(spark: SparkSession, n_trials: int = N_TRIALS, space: dict = SEARCH_SPACE,
                known_best: dict | None = KNOWN_BEST, seed: int = 42) -> DataFrame:
    """One row per trial n with its parameters (trial 0 = known best if given)."""
    t = spark.range(n_trials).withColumnRenamed("id", "n")
    cols = []
    for name, (lo, hi, kind) in space.items():
        u = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("n").cast("string"), F.lit(name))),
                               1, 8), 16, 10).cast("double") / F.lit(float(2 ** 32))
        if kind == "log":
            v = F.exp(F.lit(math.log(lo)) + u * F.lit(math.log(hi) - math.log(lo)))
        elif kind == "int":
            v = F.floor(F.lit(float(lo)) + u * F.lit(float(hi - lo + 1))).cast("double")
        else:
            v = F.lit(float(lo)) + u * F.lit(float(hi - lo))
        if known_best is not None and name in known_best:
            v = F.when(F.col("n") == 0, F.lit(float(known_best[name]))).otherwise(v)
        cols.append(v.alias(name))
    return t.select("n", *cols)


def run_search(data: DataFrame, spec: ModelSpec, trials: DataFrame, *, study: str = "gbt_recall",
               objective: str = "recall", wave: int = 4, fold_col: str = "fold",
               min_delta: float = MIN_DELTA, patience: int = PATIENCE, budget_s: float | None = None,
               to_params=dict, parallelism: int = 4, folds: Sequence[Fold] | None = None) -> tuple[DataFrame, DataFrame]:
    """Evaluate trials wave by wave; stop when E7 says so, or before a wave once
    ``budget_s`` seconds are over.  The folds are prepared once for all trials; boosted
    trees of a wave (every trial on every fold) grow in one pass, other classifiers are
    fitted at most ``parallelism`` at a time.  ``folds`` are those of ``data`` if they were prepared before.  Returns (trials with objective values, best trial row)."""
    spark = data.sparkSession
    given = folds
    folds, began = folds or prepare_folds(data, spec, fold_col, parallelism), time.monotonic()
    params = [r.asDict() for r in trials.orderBy("n").collect()]   # the trial plan: tens of rows
    done: list[tuple] = []

    def evaluate_trial(p: dict) -> tuple:
        p = dict(p)
        n = int(p.pop("n"))
        m = evaluate_folds(folds, replace(spec, params=to_params(p)), fold_col, max(1, parallelism // wave))
        value = m.agg(F.avg(objective)).first()[0]
        return study, n, None if value is None else float(value), p

    def evaluate_wave(trials: list[dict]) -> list[tuple]:
        settings = [{k: v for k, v in t.items() if k != "n"} for t in trials]
        means = evaluate_settings(folds, spec, [to_params(p) for p in settings], fold_col).groupBy("setting").agg(F.avg(objective).alias("v"))
        values = {r["setting"]: r["v"] for r in means.collect()}   # a row per trial of the wave
        return [(study, int(t["n"]), values.get(i), p) for i, (t, p) in enumerate(zip(trials, settings, strict=True))]

    for start in range(0, len(params), wave):
        if done and budget_s is not None and time.monotonic() - began > budget_s:
            break
        some = params[start:start + wave]
        if spec.kind == "gbt":
            done += evaluate_wave(some)
        else:   # the trials of one wave are independent: their CV jobs run concurrently
            with ThreadPoolExecutor(max_workers=wave) as pool:
                done += list(pool.map(evaluate_trial, some))
        table = spark.createDataFrame([(s, n, v) for s, n, v, _ in done], "study STRING, n BIGINT, value DOUBLE")
        stop = patience_stop(table, min_delta=min_delta, patience=patience).first()["stopped_at"]
        if stop is not None:  # later trials of the wave do not count: the result must not depend on its size
            done = [t for t in done if t[1] <= stop]
            break
    if not given:
        drop_folds(folds)
    table = spark.createDataFrame([(s, n, v, {k: float(x) for k, x in p.items()}) for s, n, v, p in done],
                                  "study STRING, n BIGINT, value DOUBLE, params MAP<STRING, DOUBLE>")
    best = best_trial(table).join(table.select(F.col("study").alias("study_name"), F.col("n").alias("best_trial"),
                                               "params"), ["study_name", "best_trial"])
    return table, best


def retrain_with_best(data: DataFrame, spec: ModelSpec, best: DataFrame, to_params=dict,
                      model_path: str | None = None, fold_col: str = "fold", raw_path: str | None = None,
                      folds: Sequence[Fold] | None = None):
    """With the best parameters, cross-validate over the folds of ``data``, fit on
    all rows, save (H24).  Returns the model and a one-row description of the run:
    the fold means (``…_cv``), the metrics on the fit set (``…_fit``), rows and parameters.
    The rows are stored once (at ``raw_path``, which the description names) and counted while they are.
    ``folds`` are those of ``data`` if they were prepared before."""
    row = best.first()
    params = to_params(dict(row["params"])) if row is not None else {}
    spec = replace(spec, params=params)
    spark, path, seen = data.sparkSession, raw_path or scratch_path(data.sparkSession, "retrain-rows"), Observation("retrain-rows")
    data.observe(seen, F.count(F.lit(1)).alias("rows_used")).write.mode("overwrite").parquet(path)
    data = spark.read.schema(data.schema).parquet(path)
    cv = None
    if fold_col in data.columns:
        own = folds or prepare_folds(data, spec, fold_col)
        cv = fold_means(evaluate_folds(own, spec, fold_col)).first()
        if not folds:
            drop_folds(own)
    ready = prepare(data, spec, stored=True)
    model = fit_prepared(ready, spec)
    ready.drop()
    if model_path:
        save_model(model, model_path)
    fit = evaluate(score(model, data), y=spec.label, pred="predicted", score="score").first()
    meta = spark.createDataFrame([(seen.get["rows_used"],)], "rows_used bigint").select(
        F.current_timestamp().alias("trained_at_utc"), F.lit(model_path).cast("string").alias("model_path"),
        F.lit(path).alias("retrain_raw_path"), "rows_used",
        F.lit(row["study_name"] if row else None).alias("best_study_name"),
        F.lit(row["best_value"] if row else None).cast("double").alias("best_value"),
        (F.create_map(*[x for k, v in params.items() for x in (F.lit(k), F.lit(str(v)))]) if params
         else F.lit(None).cast("map<string,string>")).alias("best_params"),
        F.lit(list(ready.dropped)).cast("array<string>").alias("columns_without_values"),
        *[F.lit(fit[c]).cast("double").alias(f"{c}_fit") for c in ("accuracy", "precision", "recall", "f1", "roc_auc")])
    if cv is not None:
        meta = meta.withColumns({c: F.lit(v) for c, v in cv.asDict().items()})
    return model, meta
