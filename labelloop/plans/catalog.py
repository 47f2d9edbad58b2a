"""Registered queries: one Spark plan per SURVEY §2 operator, plus its DuckDB oracle.

Every query reads the driver tables (directly or through the fixture views
of :mod:`labelloop.plans.fixtures`) in full.  Doubles are rounded to 6
digits on both sides, counts are BIGINT, and every computed column carries
the same alias in the Spark plan and in the SQL.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloop.plans import fixtures as fx
from labelloop.plans.fixtures import with_fixtures

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _pinned(fn: Query) -> Query:
    """Run a query under the settings its semantics rely on: UTC session time
    (log timestamps mix offsets) and a checkpoint directory (set only if the
    cluster has none, as in local tests)."""
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from labelloop.session import ensure_checkpoint_dir
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        ensure_checkpoint_dir(spark)
        return fn(spark, sf_dir)
    return run


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = _pinned(fn)
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def r6(c) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), 6)


def sql_metrics(src: str, y: str, pred: str | None, score: str | None, suffix: str = "",
                prefix: str = "m") -> tuple[dict[str, str], list[str]]:
    """Oracle building block: CTEs + select list for D13/D14 over CTE ``src``.

    AUC = (Σ average rank of positives − P(P+1)/2) / (P·N), ties averaged.
    """
    ctes = {}
    p_ = pred or "NULL"
    ctes[f"{prefix}_cnt"] = f"""SELECT COUNT(*) AS n,
        SUM(CASE WHEN {y} = 1 THEN 1 ELSE 0 END) AS pos,
        SUM(CASE WHEN {y} = 1 AND {p_} = 1 THEN 1 ELSE 0 END) AS tp,
        SUM(CASE WHEN {y} = 0 AND {p_} = 1 THEN 1 ELSE 0 END) AS fp,
        SUM(CASE WHEN {y} = 1 AND {p_} = 0 THEN 1 ELSE 0 END) AS fn,
        SUM(CASE WHEN {y} = 0 AND {p_} = 0 THEN 1 ELSE 0 END) AS tn FROM {src}"""
    sel = []
    if score:
        ctes[f"{prefix}_rk"] = f"""SELECT {y} AS yy, RANK() OVER (ORDER BY {score})
            + (COUNT(*) OVER (PARTITION BY {score}) - 1) / 2e0 AS r FROM {src} WHERE {score} IS NOT NULL"""
        ctes[f"{prefix}_auc"] = f"""SELECT SUM(CASE WHEN yy = 1 THEN 1 ELSE 0 END) AS p,
            SUM(CASE WHEN yy = 0 THEN 1 ELSE 0 END) AS q,
            SUM(CASE WHEN yy = 1 THEN r ELSE 0 END) AS rs FROM {prefix}_rk"""
    acc = f"COALESCE((tp + tn) / NULLIF(n, 0) * 1e0, 0e0)"
    prec = f"COALESCE(tp * 1e0 / NULLIF(tp + fp, 0), 0e0)"
    rec = f"COALESCE(tp * 1e0 / NULLIF(tp + fn, 0), 0e0)"
    f1 = f"COALESCE(2e0 * tp / NULLIF(2 * tp + fp + fn, 0), 0e0)"
    sel += [acc, prec, rec, f1]
    if score:
        sel.append("CASE WHEN p > 0 AND q > 0 THEN (rs - p * (p + 1) / 2e0) / (p * 1e0 * q) END")
    return ctes, sel


def _oracle(body: str, **ctes: str) -> str:
    return with_fixtures(body, **ctes)


# ---------------------------------------------------------------- I3 (flagship)
_m_ctes, (_acc, _prec, _rec, _f1, _auc) = sql_metrics("ev", "y_true", "predicted_rain", "rain_probability")


@register("i3_live_metrics", _oracle(f"""
SELECT CASE WHEN n > 0 THEN 'ok' ELSE 'no_ground_truth_available' END AS status,
       CASE WHEN n > 0 THEN ROUND({_acc}, 6) END AS accuracy_live,
       CASE WHEN n > 0 THEN ROUND({_prec}, 6) END AS precision_live,
       CASE WHEN n > 0 THEN ROUND({_rec}, 6) ELSE 1e0 END AS recall_live,
       CASE WHEN n > 0 THEN ROUND({_f1}, 6) END AS f1_live,
       CASE WHEN n > 0 THEN ROUND({_auc}, 6) END AS roc_auc_live,
       CAST(n AS BIGINT) AS scored_rows,
       CASE WHEN n > 0 THEN CAST(pos AS BIGINT) END AS positives_true,
       CAST(200 AS BIGINT) AS "window"
FROM m_cnt, m_auc""", ev="""SELECT * FROM scored WHERE truth_available AND y_true IS NOT NULL
    AND predicted_rain IS NOT NULL ORDER BY logged_at DESC, event_id DESC LIMIT 200""", **_m_ctes))
def i3_live_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelloop.plans.jobs import score_predictions
    _, metrics = score_predictions(fx.pred_log(spark, sf_dir), fx.truth(spark, sf_dir), window=200)
    return metrics.select("status", *[r6(c).alias(c) for c in (
        "accuracy_live", "precision_live", "recall_live", "f1_live", "roc_auc_live")],
        "scored_rows", "positives_true", "window")


# Register the remaining queries (modules call ``register`` on import).
from labelloop.plans import catalog_rows, catalog_stats, catalog_jobs, catalog_io, catalog_features, catalog_models, catalog_streaming  # noqa: E402,F401
