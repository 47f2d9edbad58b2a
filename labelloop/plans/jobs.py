"""User-level jobs (I1–I9), composed from the operators.

Jobs return DataFrames and leave writing to the caller.  Plans stay lazy
except where a job needs a value first (one-row statistics, model fits) or
materialises an intermediate table in the checkpoint directory (ranks).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloop.functions.dates import backfill_feature_date
from labelloop.operators.cleaning import labelled_rows, require_columns
from labelloop.operators.dedup import last_n, last_per_key
from labelloop.operators.joins import attach_truth
from labelloop.operators.metrics import live_metrics
from labelloop.sources.delimited import LOG_POSITION, require_rows

# ---- fixed values ----------------------------------------------------------
LIVE_WINDOW = 200     # live metrics look at the latest 200 labelled predictions
# ---------------------------------------------------------------------------

LOG_REQUIRED = ("logged_at", "target_date", "location", "predicted_rain")


def log_order(log: DataFrame, id_col: str = "event_id") -> list[str]:
    """Columns that say which of two predictions is the later: log time, then the id
    or, for a log read from files, the place in them."""
    return ["logged_at", *[c for c in (id_col, *LOG_POSITION) if c in log.columns]]


def score_log(log: DataFrame, truth: DataFrame, *, truth_keys=("location", "obs_date"),
              measure: str = "rainfall", id_col: str = "event_id",
              truth_order: tuple[str, ...] | None = None, must_have_rows: bool = False) -> DataFrame:
    """I3 part 1 — the scored log: keys complete (B15), last prediction per
    (location, target_date) wins (E1), feature date backfilled (B14), truth
    attached with a three-valued label (C1, B16).

    ``truth`` must hold one row per key; pass ``truth_order`` to hand in raw
    observations instead (the last one per key by that order wins, E4), so
    the join never multiplies predictions.  ``must_have_rows`` raises for a log
    without a usable row (one small job)."""
    require_columns(log, LOG_REQUIRED)
    if must_have_rows:
        require_rows(log)
    if truth_order:
        truth = last_per_key(truth, list(truth_keys), list(truth_order))
    order = log_order(log, id_col)
    p = log.dropna(subset=["logged_at", "target_date", "location"])
    p = last_per_key(p, keys=["location", "target_date"], order_cols=order)
    if "feature_date" in p.columns:
        p = p.withColumn("feature_date", backfill_feature_date("feature_date", "target_date"))
    else:
        p = p.withColumn("feature_date", F.date_sub("target_date", 1))
    return attach_truth(p, truth, truth_keys=truth_keys, measure=measure)


def live_eval_rows(scored: DataFrame, window: int = LIVE_WINDOW, id_col: str = "event_id") -> DataFrame:
    """I3 part 2 — labelled rows (B20) with a prediction, latest ``window``."""
    rows = labelled_rows(scored).filter(F.col("predicted_rain").isNotNull())
    return last_n(rows, window, log_order(scored, id_col))


def score_predictions(log: DataFrame, truth: DataFrame, window: int = LIVE_WINDOW,
                      **kw) -> tuple[DataFrame, DataFrame]:
    """(scored log, one-row live metrics document)."""
    scored = score_log(log, truth, **kw)
    return scored, live_metrics(live_eval_rows(scored, window), window)


# ---------------------------------------------------------------- I4 – I8
RETRAIN_REQUIRED = ("truth_available", "y_true", "feature_date", "location")


def _latest_date(df: DataFrame, col: str):
    """A one-row aggregate read once on the driver (a date or None); used as a
    literal bound, so it is not re-planned per use and can prune scans."""
    return df.agg(F.max(F.col(col).cast("date"))).first()[0]


def _date_lit(d) -> Column:
    return F.lit(d).cast("date")


def new_labelled_rows(scored: DataFrame, cutoff, id_col: str = "event_id",
                      drop_null_location: bool = True) -> DataFrame:
    """Rows a retrain may consume: labelled (B20), feature date backfilled
    (B14), strictly after ``cutoff`` (C4; a one-row DataFrame or a Column,
    NULL parts skipped), last prediction per (location, feature_date) (E2).
    The retrain builder drops rows without a location; the counter and the
    watermark keep them (a missing location is then one dedupe group)."""
    from labelloop.operators.joins import after_cutoff
    s = labelled_rows(scored)
    if drop_null_location:
        s = s.dropna(subset=["location"])
    if "target_date" in s.columns:
        s = s.withColumn("feature_date", backfill_feature_date("feature_date", "target_date"))
    s = s.dropna(subset=["feature_date"])
    cut = list(cutoff) if isinstance(cutoff, (list, tuple)) else [cutoff]
    s = after_cutoff(s, "feature_date", *cut)
    order = [c for c in log_order(s, id_col) if c in s.columns] or ["feature_date"]
    return last_per_key(s, ["location", "feature_date"], order)


def build_retrain_set(history: DataFrame, scored: DataFrame | None, observations: DataFrame,
                      *, date_col: str = "Date", key_col: str = "Location",
                      label_col: str = "RainTomorrow") -> tuple[DataFrame, DataFrame]:
    """I4: history ∪ newly labelled rows whose features exist, plus the D11 meta row.

    ``history`` and ``observations`` share the target schema (``observations``
    holds the feature row of every (Location, Date) that was observed, one per
    key).  A missing or non-conforming scored log (B10) leaves the history as is.
    """
    from labelloop.operators.profile import row_accounting
    merged = _tagged_retrain_rows(history, scored, observations, date_col=date_col, key_col=key_col, label_col=label_col)
    return merged.drop("__src"), row_accounting(merged, tag="__src")


def _tagged_retrain_rows(history: DataFrame, scored: DataFrame | None, observations: DataFrame, *, date_col: str = "Date",
                         key_col: str = "Location", label_col: str = "RainTomorrow") -> DataFrame:
    """The rows of I4 with ``__src``: history or added."""
    from labelloop.operators.cleaning import conform
    from labelloop.operators.joins import exclude_known

    tagged_hist = history.withColumn("__src", F.lit("history"))
    if scored is None or not require_columns(scored, RETRAIN_REQUIRED, on_missing="empty"):
        merged = tagged_hist
    else:
        horizon = _date_lit(_latest_date(history, date_col))
        new = new_labelled_rows(scored, horizon)
        new = exclude_known(new, history, ["feature_date", "location"], [date_col, key_col])
        feats = observations.drop(label_col)
        joined = new.select(F.col("location").alias("__loc"), F.col("feature_date").alias("__d"),
                            F.when(F.col("y_true").cast("int") == 1, F.lit("Yes"))
                            .otherwise(F.lit("No")).alias(label_col)) \
            .join(feats, on=[F.col("__loc") == F.col(key_col), F.col("__d") == F.col(date_col)], how="inner")
        added = conform(joined, history.schema).withColumn("__src", F.lit("added"))
        merged = tagged_hist.unionByName(added)
    return merged


COUNT_REQUIRED = ("truth_available", "feature_date", "y_true")


def count_new_rows(history: DataFrame | None, scored: DataFrame | None, watermark: DataFrame | None = None,
                   date_col: str = "Date") -> DataFrame:
    """One row — new labelled rows beyond ``max(history horizon, watermark)`` and that cutoff
    (a missing or unreadable watermark date is skipped).

    Without a scored log or a dated history there is nothing to count from: 0 rows
    and no cutoff.  A log that lacks a needed column (B10) gives 0 rows beyond the cutoff."""
    horizon = _latest_date(history, date_col) if history is not None and date_col in history.columns else None
    if scored is None or horizon is None:
        spark = (history if history is not None else scored).sparkSession if (history is not None or scored is not None) \
            else SparkSession.getActiveSession()
        return spark.createDataFrame([(0, None)], "new_rows_for_retrain BIGINT, retrain_cutoff_date DATE")
    mark = _latest_date(watermark, "last_feature_date") if watermark is not None and "last_feature_date" in watermark.columns else None
    cutoff = _date_lit(max(d for d in (horizon, mark) if d is not None))
    if not require_columns(scored, COUNT_REQUIRED, on_missing="empty"):
        return history.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("new_rows_for_retrain"),
                                                    cutoff.alias("retrain_cutoff_date"))
    new = new_labelled_rows(scored, cutoff, drop_null_location=False)
    return new.agg(F.count(F.lit(1)).cast("bigint").alias("new_rows_for_retrain")) \
        .select("new_rows_for_retrain", cutoff.alias("retrain_cutoff_date"))


WATERMARK = T.StructType([T.StructField("last_feature_date", T.DateType()), T.StructField("consumed_rows", T.LongType()),
                          T.StructField("rows_beyond_previous", T.LongType()), T.StructField("updated_at_utc", T.TimestampType()),
                          T.StructField("run_id", T.StringType())])


def advance_watermark(history: DataFrame, scored: DataFrame, previous: DataFrame | None = None,
                      date_col: str = "Date", run_id: str | None = None) -> DataFrame:
    """One ``WATERMARK`` row — last consumed feature date and rows consumed beyond the
    history horizon (the reference counts from the horizon, not from the previous
    watermark); ``rows_beyond_previous`` reports the delta since ``previous``.
    When nothing is new, the history has no date or the log lacks a needed column,
    the previous watermark is kept as it is (NULLs if there is none)."""
    spark = scored.sparkSession
    # the previous watermark is a one-row document: read it once, use literals
    row = previous.first() if previous is not None else None
    old = row.asDict() if row else {}
    kept = {f.name: F.lit(old.get(f.name)).cast(f.dataType) for f in WATERMARK.fields}
    kept["rows_beyond_previous"] = F.lit(0).cast("bigint")
    horizon = _latest_date(history, date_col)
    if horizon is None or not require_columns(scored, COUNT_REQUIRED, on_missing="empty"):
        return spark.range(1).select(*[c.alias(n) for n, c in kept.items()])
    new = new_labelled_rows(scored, _date_lit(horizon), drop_null_location=False)
    prev_d = kept["last_feature_date"]
    now = {"last_feature_date": F.max("feature_date"), "consumed_rows": F.count(F.lit(1)).cast("bigint"),
           "rows_beyond_previous": F.count(F.when(prev_d.isNull() | (F.col("feature_date") > prev_d), 1)).cast("bigint")}
    cur = new.agg(*[c.alias(n) for n, c in now.items()]).withColumns(
        {"updated_at_utc": F.current_timestamp(), "run_id": F.lit(run_id).cast("string")})
    moved = F.col("last_feature_date").isNotNull()
    return cur.select(*[F.when(moved, F.col(n)).otherwise(kept[n]).alias(n) for n in WATERMARK.fieldNames()])


def write_watermark(watermark: DataFrame, path: str) -> str:
    """A7 for the watermark: the one-row document as JSON."""
    from labelloop.sources.sinks import write_document
    return write_document(watermark, path)


def read_watermark(spark: SparkSession, path: str) -> DataFrame:
    """The watermark document; a missing or corrupt one reads as NULLs."""
    from labelloop.sources.sinks import read_document
    return read_document(spark, path, WATERMARK)


# ---- fixed values (retrain gate defaults) ----------------------------------
RECALL_THRESHOLD = 0.59
MIN_NEW_ROWS = 60
# ---------------------------------------------------------------------------


def retrain_decision(quality: DataFrame, recall_threshold: float = RECALL_THRESHOLD,
                     min_new_rows: int = MIN_NEW_ROWS, recall_col: str = "recall_combined_cv") -> DataFrame:
    """I8: one decision per quality row — status not ok → skip; too few new rows →
    skip; recall below the threshold → trigger; otherwise skip.  A missing
    recall counts as 1.0 and a missing row count as 0."""
    recall = F.coalesce(F.col(recall_col).cast("double"), F.lit(1.0))
    rows = F.coalesce(F.col("new_rows_for_retrain").cast("bigint"), F.lit(0))
    decision = (F.when(F.coalesce(F.col("status"), F.lit("")) != "ok", F.lit("skip_optuna"))
                .when(rows < min_new_rows, F.lit("skip_optuna"))
                .when(recall < recall_threshold, F.lit("trigger_optuna"))
                .otherwise(F.lit("skip_optuna")))
    return quality.withColumn("decision", decision)


def station_quality(scored: DataFrame, cutoff: Column, id_col: str = "event_id") -> DataFrame:
    """I8's input: (location, status, recall_combined_cv, new_rows_for_retrain), one row per station and one
    overall (location NULL), by grouping sets over one pass of the scored log.

    New rows are the (location, feature_date) pairs that :func:`new_labelled_rows`
    keeps beyond ``cutoff``: counted as distinct dates, per station first, so that a
    date held by many rows is one before the shuffle.  Rows without a location are in
    no station and not among the new rows."""
    s = labelled_rows(scored)
    if "target_date" in s.columns:
        s = s.withColumn("feature_date", backfill_feature_date("feature_date", "target_date"))
    y, p = F.col("y_true").cast("int"), F.col("predicted_rain").cast("int")
    daily = s.groupBy("location", F.when((F.col("feature_date") > cutoff) & F.col("location").isNotNull(), F.col("feature_date")).alias("new")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(y).alias("pos"), F.count(F.when((y == 1) & (p == 1), 1)).alias("tp"))
    sets = daily.groupingSets([["location"], []], "location").agg(
        F.grouping_id().alias("whole"), F.sum("n").alias("n"), F.sum("pos").alias("pos"), F.sum("tp").alias("tp"),
        F.count("new").alias("new_rows_for_retrain"))
    recall = F.coalesce(F.try_divide(F.col("tp"), F.col("pos")), F.lit(0.0))
    return sets.where("whole = 1 or location is not null").select(
        "location", F.when((F.col("pos") > 0) & (F.col("pos") < F.col("n")), "ok").otherwise("not_enough_classes").alias("status"),
        recall.alias("recall_combined_cv"), "new_rows_for_retrain")


def prepare_dataset(raw: DataFrame, label_col: str = "RainTomorrow", date_col: str = "Date") -> DataFrame:
    """Drop unlabelled rows (B1), numeric coercion and outliers (B2, B3),
    calendar features with the date dropped (B5), binary ``label`` (B6)."""
    from labelloop.functions.dates import add_calendar_features
    from labelloop.functions.values import binary_label, coerce_numeric, null_outliers
    from labelloop.operators.cleaning import drop_unlabelled
    x = null_outliers(coerce_numeric(drop_unlabelled(raw, label_col)))
    x = add_calendar_features(x, date_col)
    return x.withColumn("label", binary_label(label_col)).drop(label_col)


def _merge_docs(*docs: DataFrame) -> DataFrame:
    """Merge one-row documents side by side: each further document becomes one
    struct-valued scalar subquery (evaluated once), so no join is planned."""
    out = docs[0]
    for i, d in enumerate(docs[1:]):
        out = out.withColumn(f"__doc{i}", d.select(F.struct(*d.columns)).scalar()).select("*", f"__doc{i}.*") \
            .drop(f"__doc{i}")
    return out


def with_row_key(rows: DataFrame, key: str) -> DataFrame:
    """Rows with a key of their own: the hash of all columns and, among equal rows, a number.

    Equal rows are counted before they are shuffled and written out again from
    their count, so no task holds a group of them."""
    every = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("__n"))
    return every.withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int")))) \
        .withColumn(key, F.xxhash64(*rows.columns, "__i")).drop("__n", "__i")


def write_retrain_set(history: DataFrame, scored: DataFrame | None, observations: DataFrame, path: str,
                      **columns) -> DataFrame:
    """I4 + A8 + D11 in one job: write the retrain set to ``path``; its row accounting is counted while it is written."""
    from pyspark.sql import Observation

    from labelloop.operators.profile import accounting_columns
    merged = _tagged_retrain_rows(history, scored, observations, **columns)
    seen = Observation("retrain-set")
    merged.observe(seen, *accounting_columns("__src")).drop("__src").write.mode("overwrite").parquet(path)
    found = seen.get
    return history.sparkSession.createDataFrame([tuple(found[c] for c in ACCOUNTING)], ", ".join(f"{c} bigint" for c in ACCOUNTING))


ACCOUNTING = ("historical_rows", "added_rows", "total_rows")


def _retrain_rows(history: DataFrame, scored: DataFrame | None, observations: DataFrame):
    """The retrain set ready for models, with a unique key, stored once (it is passed over many times); and its meta."""
    from labelloop.session import cut_lineage, scratch_path
    spark = history.sparkSession
    path = scratch_path(spark, "retrain-set")
    meta = write_retrain_set(history, scored, observations, path)
    return cut_lineage(prepare_dataset(with_row_key(spark.read.schema(history.schema).parquet(path), "event_id"))), meta


def retrain_quality(history: DataFrame, scored: DataFrame | None, observations: DataFrame, spec,
                    k: int = 5, watermark: DataFrame | None = None) -> DataFrame:
    """Retrain set → stratified k-fold CV of the pipeline in ``spec`` → one quality row
    with the dataset meta (a struct), the new-row count and its cutoff.  A single
    class gives status ``not_enough_classes`` and no metrics."""
    from labelloop.operators.metrics import fold_means
    from labelloop.operators.models import cross_validate
    from labelloop.operators.split import stratified_folds
    data, meta = _retrain_rows(history, scored, observations)
    meta = meta.select(F.struct(*meta.columns).alias("retrain_dataset_meta"))
    new = count_new_rows(history, scored, watermark)
    classes = data.agg(F.count_distinct("label")).first()[0]
    rows_used = data.agg(F.count(F.lit(1)).cast("bigint").alias("rows_used"))
    if classes < 2:
        q = rows_used.withColumn("status", F.lit("not_enough_classes"))
    else:
        per_fold = cross_validate(stratified_folds(data, "label", "event_id", k=k), spec)
        q = _merge_docs(fold_means(per_fold).withColumn("status", F.lit("ok")), rows_used)
    return _merge_docs(q.withColumn("cv_splits", F.lit(k)), meta, new)


def tune_retrain_advance(history: DataFrame, scored: DataFrame, observations: DataFrame, spec, trials: DataFrame,
                         *, k: int = 5, study: str = "gbt_recall_retrain", model_path: str | None = None,
                         wave: int = 4, run_id: str | None = None, **search) -> DataFrame:
    """Tune on the retrain set (H20, E7, E8) → retrain on all rows with the
    best trial (H21) → advance the watermark (I6); one snapshot of the scored
    log feeds both the training set and the watermark."""
    from labelloop.operators.models import drop_folds, prepare_folds
    from labelloop.operators.search import retrain_with_best, run_search
    from labelloop.operators.split import stratified_folds
    from labelloop.session import cut_lineage
    # one snapshot of the scored log feeds the training set and the watermark
    # (rows logged while tuning runs are not marked as consumed)
    scored = cut_lineage(scored)
    data, _ = _retrain_rows(history, scored, observations)
    data = cut_lineage(stratified_folds(data, "label", "event_id", k=k))
    folds = prepare_folds(data, spec)   # the search and the retrain's cross-validation differ in parameters only
    _, best = run_search(data, spec, trials, study=study, wave=wave, folds=folds, **search)
    _, meta = retrain_with_best(data, spec, best, model_path=model_path, folds=folds)
    drop_folds(folds)
    return _merge_docs(meta.drop("trained_at_utc", "model_path"), advance_watermark(history, scored, run_id=run_id))
