"""Profiles from stored sketches (D5–D7 without reading rows again).

A day's rows are read once into a small table: per key (day, station, …) and
column the count, the moments, the extremes, a KLL sketch of the values and an HLL
sketch of the distinct ones.  Any span of days, and any coarser grouping, is then
profiled by merging these rows.  Counts, moments and extremes are exact; a quantile
is at the asked rank within ``RANK_ERROR`` of the count, a distinct count within
``DISTINCT_ERROR`` of the truth (both with high probability).  The exact operators
are in :mod:`labelloop.operators.profile`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KLL_K, HLL_LG_K = 400, 12
RANK_ERROR, DISTINCT_ERROR = 0.01, 0.06


def daily_sketches(df: DataFrame, by: Sequence[str], numeric: Sequence[str], columns: Sequence[str] = ()) -> DataFrame:
    """One row per key ``by`` and column; ``numeric`` columns get all of it, other ``columns`` only the distinct values.

    One aggregate over the rows, whatever the number of columns: no row is multiplied."""
    by, every = list(by), [*numeric, *(c for c in columns if c not in numeric)]
    aggs = []
    for i, c in enumerate(every):
        text = F.col(c).cast("string")
        aggs.append(F.hll_sketch_agg(text, HLL_LG_K).alias(f"hll__{i}"))
        if c in numeric:
            x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
            aggs += [F.count(x).alias(f"n__{i}"), F.avg(x).alias(f"mean__{i}"), (F.var_pop(x) * F.count(x)).alias(f"m2__{i}"),
                     F.min(x).alias(f"min__{i}"), F.max(x).alias(f"max__{i}"), F.kll_sketch_agg_double(x, KLL_K).alias(f"kll__{i}")]
        else:
            aggs.append(F.count(F.col(c)).alias(f"n__{i}"))
    wide = df.groupBy(*by).agg(*aggs)
    none = F.lit(None)
    rows = F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"n__{i}").alias("n"),
        *[(F.col(f"{f}__{i}") if c in numeric else none.cast("double")).alias(f) for f in ("mean", "m2", "min", "max")],
        (F.col(f"kll__{i}") if c in numeric else none.cast("binary")).alias("kll"), F.col(f"hll__{i}").alias("hll"))
        for i, c in enumerate(every)]))
    return wide.select(*by, rows)


def merged_describe(sketches: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """D5 / D6 of a span: ``sketches`` filtered to it, merged by column (and ``groups``)."""
    groups = [*groups, "column_name"]
    some = sketches.filter(F.col("kll").isNotNull() & (F.col("n") > 0))
    total = F.sum("n")
    mean = F.sum(F.col("n") * F.col("mean")) / total
    out = some.groupBy(*groups).agg(
        total.alias("count"), mean.alias("mean"), F.sum(F.col("m2") + F.col("n") * F.col("mean") * F.col("mean")).alias("__sq"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.kll_merge_agg_double("kll").alias("__kll"))
    squares = F.greatest(F.lit(0.0), F.col("__sq") - F.col("count") * F.col("mean") * F.col("mean"))
    at = lambda p: F.kll_sketch_get_quantile_double("__kll", F.lit(p))
    return out.select(*groups, "count", "mean", F.sqrt(F.try_divide(squares, F.col("count") - 1)).alias("std"), "min",
                      at(0.25).alias("p25"), at(0.5).alias("p50"), at(0.75).alias("p75"), "max")


def merged_distinct(sketches: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """D7 of a span: about how many distinct non-NULL values each column has."""
    merged = sketches.groupBy(*groups, "column_name").agg(F.hll_union_agg("hll").alias("__hll"))
    return merged.select(*groups, "column_name", F.hll_sketch_estimate("__hll").alias("n_unique"))
