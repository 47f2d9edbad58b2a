"""Join operators.

Strategies are left to Catalyst/AQE: neither side's size is bounded in
general (truth grows with stations × days), so no side is force-broadcast
here; AQE turns a sort-merge join into a broadcast join from runtime sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloop.functions.values import label_from_measure


def attach_truth(preds: DataFrame, truth: DataFrame, *, pred_keys: Sequence[str] = ("location", "target_date"),
                 truth_keys: Sequence[str] = ("location", "obs_date"), measure: str = "rainfall",
                 measure_as: str = "observed_rainfall_mm") -> DataFrame:
    """C1 + B16: left join predictions with (already deduplicated) truth.

    No match or a NULL measurement means no truth; adds ``truth_available``
    and the three-valued ``y_true``.
    """
    t = truth.select(*[F.col(k).alias(f"__t{i}") for i, k in enumerate(truth_keys)],
                     F.col(measure).alias(measure_as))
    cond = [F.col(p) == F.col(f"__t{i}") for i, p in enumerate(pred_keys)]
    joined = preds.join(t, on=cond, how="left").drop(*[f"__t{i}" for i in range(len(truth_keys))])
    return joined.withColumns({
        "truth_available": F.col(measure_as).isNotNull(),
        "y_true": label_from_measure(measure_as),
    })


def exclude_known(df: DataFrame, known: DataFrame, keys: Sequence[str],
                  known_keys: Sequence[str] | None = None) -> DataFrame:
    """Drop rows whose key already exists in ``known`` (NULL keys never match)."""
    known_keys = list(known_keys or keys)
    k = known.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(known_keys)])
    cond = [F.col(a) == F.col(f"__k{i}") for i, a in enumerate(keys)]
    return df.join(k, on=cond, how="left_anti")


def join_features(labelled: DataFrame, obs: DataFrame, left_keys: Sequence[str],
                  right_keys: Sequence[str]) -> DataFrame:
    """Inner join labelled rows with the observation that carries the features."""
    cond = [labelled[a] == obs[b] for a, b in zip(left_keys, right_keys)]
    return labelled.join(obs, on=cond, how="inner")


def after_cutoff(df: DataFrame, date_col: str, *cutoffs: Column | DataFrame) -> DataFrame:
    """C4: keep rows strictly after ``greatest(cutoffs)`` (NULL cutoffs are skipped).

    A cutoff given as a one-row/one-column DataFrame becomes a scalar subquery,
    evaluated once and inlined, so no join with the 1-row table is planned.
    """
    parts = [c.scalar() if isinstance(c, DataFrame) else c for c in cutoffs]
    bound = parts[0] if len(parts) == 1 else F.greatest(*parts)
    return df.filter(F.col(date_col) > bound)
