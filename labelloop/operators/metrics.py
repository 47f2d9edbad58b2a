"""Classification quality as DataFrames.

All metrics for one evaluation set come out of a single aggregation pipeline:

* group rows by ``(groups…, score)`` — partial aggregation collapses hot
  scores map-side — keeping positives, negatives and the four confusion
  counters per score;
* exclusive prefix sums of negatives over scores (distributed, see
  :mod:`labelloop.operators.ordering`) give, per score, how many negatives
  rank below it;
* one final aggregate yields the counters and the exact Mann–Whitney AUC
  (ties count one half), identical to a rank-based ROC AUC.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloop.operators.ordering import prefix_sums

METRIC_NAMES = ("accuracy", "precision", "recall", "f1", "roc_auc")


def _ratio(num: Column, den: Column) -> Column:
    """num / den with zero (or NULL) denominator → 0.0, as with zero_division=0."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def _score_table(df: DataFrame, y: str, pred: str | None, score: str | None,
                 groups: Sequence[str], weight: str | None = None) -> DataFrame:
    yv = F.col(y).cast("int")
    s = F.lit(None).cast("double")
    if score:  # a NaN score is no score: it would rank above all others
        s = F.nanvl(F.col(score).cast("double"), s)
    base = df.select(*groups, yv.alias("__y"),
                     (F.col(pred).cast("int") if pred else F.lit(None).cast("int")).alias("__p"),
                     s.alias("__s"), (F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")).alias("__w"))
    has_s, is_y = F.col("__s").isNotNull(), lambda v: F.col("__y") == v
    both = lambda v, p: is_y(v) & (F.col("__p") == p)
    of = {"__n": F.lit(True), "__pos_all": is_y(1), "__pos": is_y(1) & has_s, "__neg": is_y(0) & has_s,
          "__tp": both(1, 1), "__fp": both(0, 1), "__fn": both(1, 0), "__tn": both(0, 0)}
    return base.groupBy(*groups, "__s").agg(*[F.sum(F.when(c, F.col("__w")).otherwise(0)).alias(name) for name, c in of.items()])


def evaluate(df: DataFrame, y: str = "y_true", pred: str | None = "prediction",
             score: str | None = None, groups: Sequence[str] = (), suffix: str = "",
             bounded: bool = False, weight: str | None = None) -> DataFrame:
    """D13 + D14 in one pass: counts, accuracy/precision/recall/F1, exact ROC AUC.

    Rows need a non-NULL label; a NULL or NaN score only leaves the row out
    of the AUC.  AUC is NULL when the scored rows hold a single class or none.
    Without ``groups`` the result is exactly one row, also for empty input.
    ``bounded=True`` is for inputs with a small row bound known by
    construction (the live window): the running sum over its few distinct
    scores is a plain window, skipping the distributed prefix sums.
    ``weight`` says for how many rows a row stands.
    """
    groups = list(groups)
    table = _score_table(df, y, pred, score, groups, weight)
    if score and bounded:
        below = Window.partitionBy(*groups).orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
        table = table.withColumn("__neg_below", F.coalesce(F.sum("__neg").over(below), F.lit(0)))
    elif score:
        table = prefix_sums(table, ["__s"], ["__neg"], groups, suffix="_below")
    else:  # no ranking needed: AUC is NULL, counts come from the same aggregate
        table = table.withColumn("__neg_below", F.lit(0).cast("bigint"))
    tp, fp, fn, tn = (F.sum(f"__{c}") for c in ("tp", "fp", "fn", "tn"))
    agg = table.groupBy(*groups).agg(
        F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("n"),
        F.coalesce(F.sum("__pos_all"), F.lit(0)).cast("bigint").alias("positives"),
        F.coalesce(tp, F.lit(0)).cast("bigint").alias("tp"),
        F.coalesce(fp, F.lit(0)).cast("bigint").alias("fp"),
        F.coalesce(fn, F.lit(0)).cast("bigint").alias("fn"),
        F.coalesce(tn, F.lit(0)).cast("bigint").alias("tn"),
        F.sum(F.col("__pos") * (F.col("__neg_below") + F.col("__neg") * F.lit(0.5))).alias("__u"),
        F.sum("__pos").alias("__P"), F.sum("__neg").alias("__N"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    auc = F.when((F.col("__P") > 0) & (F.col("__N") > 0),
                 F.col("__u") / (F.col("__P").cast("double") * F.col("__N").cast("double")))
    out = agg.select(
        *groups, "n", "positives", "tp", "fp", "fn", "tn",
        _ratio(tp + tn, F.col("n")).alias(f"accuracy{suffix}"),
        _ratio(tp, tp + fp).alias(f"precision{suffix}"),
        _ratio(tp, tp + fn).alias(f"recall{suffix}"),
        _ratio(tp * 2, tp * 2 + fp + fn).alias(f"f1{suffix}"),
        auc.cast("double").alias(f"roc_auc{suffix}"),
    )
    return out


def rollup_counts(per_group: DataFrame, groups: Sequence[str] = (), suffix: str = "") -> DataFrame:
    """Counter-based metrics (accuracy, precision, recall, F1) of a coarser
    grouping, summed from the counters of a finer one — no second pass over
    the rows.  AUC is not additive and is left NULL."""
    s = per_group.groupBy(*groups).agg(*[F.sum(c).cast("bigint").alias(c)
                                         for c in ("n", "positives", "tp", "fp", "fn", "tn")])
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return s.select(*groups, "n", "positives", "tp", "fp", "fn", "tn",
                    _ratio(tp + tn, F.col("n")).alias(f"accuracy{suffix}"),
                    _ratio(tp, tp + fp).alias(f"precision{suffix}"),
                    _ratio(tp, tp + fn).alias(f"recall{suffix}"),
                    _ratio(tp * 2, tp * 2 + fp + fn).alias(f"f1{suffix}"),
                    F.lit(None).cast("double").alias(f"roc_auc{suffix}"))


def roc_auc(df: DataFrame, y: str, score: str, groups: Sequence[str] = ()) -> DataFrame:
    """D14 alone: exact ROC AUC per group."""
    return evaluate(df, y=y, pred=None, score=score, groups=groups).select(*groups, "roc_auc")


def confusion_matrix(df: DataFrame, y: str, pred: str, groups: Sequence[str] = ()) -> DataFrame:
    """Binary confusion matrix, rows = actual class, zero-filled."""
    groups = list(groups)
    counts = df.groupBy(*groups).agg(
        *[F.count(F.when((F.col(y) == a) & (F.col(pred) == p), 1)).alias(f"a{a}p{p}")
          for a in (0, 1) for p in (0, 1)])
    return counts.select(*groups, F.inline(F.array(
        F.struct(F.lit(0).alias("actual"), F.col("a0p0").alias("pred_0"), F.col("a0p1").alias("pred_1")),
        F.struct(F.lit(1).alias("actual"), F.col("a1p0").alias("pred_0"), F.col("a1p1").alias("pred_1")),
    )))


def live_metrics(eval_rows: DataFrame, window: int, y: str = "y_true",
                 pred: str = "predicted_rain", score: str = "rain_probability") -> DataFrame:
    """One-row live-metrics document over ``eval_rows``, which must be
    the E3 window (at most ``window`` rows, e.g. from ``live_eval_rows``).

    With no evaluable row: status ``no_ground_truth_available``, recall 1.0
    and every other metric NULL (that is the contract a scheduler reads).
    """
    # the window holds at most ``window`` rows by construction
    m = evaluate(eval_rows, y=y, pred=pred, score=score, bounded=window > 0)
    has = F.col("n") > 0
    return m.select(
        F.when(has, F.lit("ok")).otherwise(F.lit("no_ground_truth_available")).alias("status"),
        F.when(has, F.col("accuracy")).alias("accuracy_live"),
        F.when(has, F.col("precision")).alias("precision_live"),
        F.when(has, F.col("recall")).otherwise(F.lit(1.0)).alias("recall_live"),
        F.when(has, F.col("f1")).alias("f1_live"),
        F.when(has, F.col("roc_auc")).alias("roc_auc_live"),
        F.col("n").alias("scored_rows"),
        F.when(has, F.col("positives")).alias("positives_true"),
        F.lit(int(window)).cast("bigint").alias("window"),
    )


def fold_means(per_fold: DataFrame, metrics: Sequence[str] = METRIC_NAMES,
               groups: Sequence[str] = (), suffix: str = "_combined_cv") -> DataFrame:
    """Unweighted mean over folds of each metric."""
    return per_fold.groupBy(*groups).agg(
        *[F.avg(m).alias(f"{m}{suffix}") for m in metrics],
        F.count(F.lit(1)).cast("bigint").alias("folds"))


def metrics_report(sources: dict[str, DataFrame], metrics: Sequence[str] = ("accuracy", "precision",
                   "recall", "f1", "roc_auc"), digits: int = 3) -> DataFrame:
    """One row per source; each metric is the first present of its two names.

    ``sources`` maps a source name (e.g. live, combined_cv, offline) to a
    one-row document whose metric columns may be called ``m`` or ``m_<source>``.
    """
    frames = []
    for name, doc in sources.items():
        cols = []
        for m in metrics:
            cands = [c for c in (f"{m}_{name}", m) if c in doc.columns]
            value = F.coalesce(*[F.col(c).cast("double") for c in cands]) if cands else F.lit(None)
            cols.append(F.round(value.cast("double"), digits).alias(m))
        frames.append(doc.select(F.lit(name).alias("source"), *cols))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
