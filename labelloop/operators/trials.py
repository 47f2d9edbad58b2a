"""Trial bookkeeping for hyper-parameter search.

The patience rule is an ordered fold with state (best, flat count, stop),
and sub-threshold gains must not move ``best``, so a running-max window is
not equivalent.  Each study's trials are folded with ``aggregate`` over its
sorted trial array; a study holds at most its trial budget (tens of rows),
which is what bounds the array.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values ----------------------------------------------------------
MIN_DELTA = 1e-4    # a trial improves only if value − best > MIN_DELTA
PATIENCE = 10       # stop after this many trials in a row without improvement
# ---------------------------------------------------------------------------


def patience_stop(trials: DataFrame, study: str = "study", n: str = "n", value: str = "value",
                  min_delta: float = MIN_DELTA, patience: int = PATIENCE) -> DataFrame:
    """Per study — best value when the search stops, the trial it stops at
    (NULL if it never does) and how many trials ran."""
    t = trials.select(F.col(study).alias("__s"), F.col(n).cast("bigint").alias("n"),
                      F.col(value).cast("double").alias("v"))
    per = t.groupBy("__s").agg(F.sort_array(F.collect_list(F.struct("n", "v"))).alias("__t"),
                               F.max("n").alias("__last"))
    init = F.struct(F.lit(None).cast("double").alias("best"), F.lit(0).alias("cnt"),
                    F.lit(None).cast("bigint").alias("stop"))

    def step(acc, x):
        frozen = acc["stop"].isNotNull() | x["v"].isNull()
        improves = acc["best"].isNull() | ((x["v"] - acc["best"]) > F.lit(min_delta))
        flat = acc["cnt"] + 1
        return F.when(frozen, acc).when(
            improves, F.struct(x["v"].alias("best"), F.lit(0).alias("cnt"),
                               F.lit(None).cast("bigint").alias("stop"))
        ).otherwise(F.struct(acc["best"].alias("best"), flat.alias("cnt"),
                             F.when(flat >= patience, x["n"]).cast("bigint").alias("stop")))

    folded = per.select("__s", "__last", F.aggregate("__t", init, step).alias("__f"))
    return folded.select(
        F.col("__s").alias(study), F.col("__f.best").alias("best_value"),
        F.col("__f.stop").alias("stopped_at"),
        F.coalesce(F.col("__f.stop"), F.col("__last")).alias("trials_run"))


def best_trial(trials: DataFrame, study: str = "study", n: str = "n", value: str = "value") -> DataFrame:
    """The single best trial over all studies (NULL values ignored; ties →
    lower study name, then earlier trial).  Empty when no trial has a value."""
    valid = trials.filter(F.col(value).isNotNull())
    return valid.orderBy(F.col(value).desc(), F.col(study).asc(), F.col(n).asc()).limit(1) \
        .select(F.col(study).alias("study_name"), F.col(value).alias("best_value"),
                F.col(n).alias("best_trial"))
