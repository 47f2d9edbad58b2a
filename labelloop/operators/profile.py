"""Dataset profiling.

Each profile is one aggregation pass over the table (column statistics are
computed side by side in a single ``agg``), then unpivoted with ``stack`` so
the result has one row per column; no per-column job loop on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _unpivot(wide: DataFrame, names: Sequence[str], fields: Sequence[str],
             name_col: str = "column_name") -> DataFrame:
    """wide has columns ``{field}__{i}`` for every column i; one row per column out."""
    structs = [F.struct(F.lit(n).alias(name_col), *[F.col(f"{f}__{i}").alias(f) for f in fields])
               for i, n in enumerate(names)]
    return wide.select(F.inline(F.array(*structs)))


def missing_rate(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """% of NULL per column, sorted descending (then by name)."""
    cols = list(columns or df.columns)
    wide = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100.0).alias(f"missing_pct__{i}")
                    for i, c in enumerate(cols)])
    return _unpivot(wide, cols, ["missing_pct"]).orderBy(F.col("missing_pct").desc(), "column_name")


def null_patterns(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of (a is NULL, b is NULL) combinations."""
    return df.groupBy(F.col(a).isNull().alias(f"{a}_missing"), F.col(b).isNull().alias(f"{b}_missing")) \
        .agg(F.count(F.lit(1)).alias("n"))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """D3: rows per non-NULL class."""
    return df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_share(df: DataFrame, label: str) -> DataFrame:
    """% of rows per non-NULL class (a window over the per-class rows only)."""
    counts = class_counts(df, label)
    from pyspark.sql import Window
    total = F.sum("n").over(Window.partitionBy())
    return counts.select(label, (F.col("n") * 100.0 / total).alias("share_pct"))


STATS = ("count", "mean", "std", "min", "p25", "p50", "p75", "max")
QUARTILES = (0.25, 0.5, 0.75)


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float] = QUARTILES,
                    groups: Sequence[str] = (), names: Sequence[str] | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (position p·(n−1)), distributed.

    Values are counted per distinct value (hot values collapse map-side),
    distributed prefix sums give every distinct value its position range, and
    one conditional aggregate picks the values around each target position —
    no per-task buffer of all values, no single-task sort.
    """
    from labelloop.operators.ordering import prefix_sums
    groups = list(groups)
    names = list(names or [f"p{int(round(p * 100))}" for p in probs])
    x = df.select(*groups, F.col(column).cast("double").alias("__v"))
    x = x.filter(F.col("__v").isNotNull() & ~F.isnan("__v"))
    d = x.groupBy(*groups, "__v").agg(F.count(F.lit(1)).alias("__c"))
    d = prefix_sums(d, ["__v"], ["__c"], groups, suffix="_before")
    if groups:
        totals = d.groupBy(*groups).agg(F.sum("__c").alias("__n"))
        d = d.join(totals, on=groups, how="inner")
        n = F.col("__n")
    else:
        d = d.withColumn("__n", x.select(F.count(F.lit(1))).scalar())
        n = F.col("__n")
    start, end = F.col("__c_before"), F.col("__c_before") + F.col("__c")
    exprs = []
    for p, name in zip(probs, names):
        pos = (n - 1).cast("double") * F.lit(float(p))
        lo, hi = F.floor(pos), F.ceil(pos)
        exprs += [F.max(F.when((start <= lo) & (lo < end), F.col("__v"))).alias(f"{name}__lo"),
                  F.max(F.when((start <= hi) & (hi < end), F.col("__v"))).alias(f"{name}__hi"),
                  F.max(pos - lo).alias(f"{name}__f")]
    agg = d.groupBy(*groups).agg(*exprs)
    return agg.select(*groups, *[(F.col(f"{m}__lo") + F.col(f"{m}__f") * (F.col(f"{m}__hi") - F.col(f"{m}__lo")))
                                 .alias(m) for m in names])


def _stat_exprs(c: str, i: int, exact: bool, accuracy: int) -> list[Column]:
    """Single-pass statistics with approximate quartiles (the cluster-scale switch)."""
    x = F.col(c).cast("double")
    q = [F.percentile_approx(x, p, accuracy).cast("double") for p in QUARTILES]
    return [F.count(x).cast("bigint").alias(f"count__{i}"), F.avg(x).alias(f"mean__{i}"),
            F.stddev_samp(x).alias(f"std__{i}"), F.min(x).alias(f"min__{i}"),
            q[0].alias(f"p25__{i}"), q[1].alias(f"p50__{i}"), q[2].alias(f"p75__{i}"),
            F.max(x).alias(f"max__{i}")]


def _moments(c: str, i: int) -> list[Column]:
    x = F.col(c).cast("double")
    return [F.count(x).cast("bigint").alias(f"count__{i}"), F.avg(x).alias(f"mean__{i}"),
            F.stddev_samp(x).alias(f"std__{i}"), F.min(x).alias(f"min__{i}"), F.max(x).alias(f"max__{i}")]


def describe(df: DataFrame, columns: Sequence[str], exact: bool = True,
             accuracy: int = 10000) -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear interpolation), max.

    Exact quartiles come from :func:`exact_quantiles` over the unpivoted
    (column, value) rows, one distributed pipeline for all columns;
    ``exact=False`` uses ``percentile_approx`` inside the single aggregation
    pass instead.
    """
    cols = list(columns)
    if not exact:
        exprs = [e for i, c in enumerate(cols) for e in _stat_exprs(c, i, False, accuracy)]
        return _unpivot(df.agg(*exprs), cols, STATS)
    moments = _unpivot(df.agg(*[e for i, c in enumerate(cols) for e in _moments(c, i)]), cols,
                       ("count", "mean", "std", "min", "max"))
    # all columns' quartiles in one pipeline: (column_name, value) rows grouped by column
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                 F.col(c).cast("double").alias("value")) for c in cols])))
    q = exact_quantiles(long, "value", groups=["column_name"])
    out = moments.join(q, on="column_name", how="left")
    return out.select("column_name", *STATS)


def grouped_describe(df: DataFrame, by: str, column: str, exact: bool = True,
                     accuracy: int = 10000) -> DataFrame:
    """Describe of one column per group (quartiles per group, distributed)."""
    if not exact:
        out = df.groupBy(by).agg(*_stat_exprs(column, 0, False, accuracy))
        return out.select(by, *[F.col(f"{s}__0").alias(s) for s in STATS])
    m = df.groupBy(by).agg(*_moments(column, 0))
    q = exact_quantiles(df, column, groups=[by])
    out = m.join(q, on=by, how="left")
    return out.select(by, *[F.col(f"{s}__0").alias(s) if s not in ("p25", "p50", "p75") else F.col(s)
                            for s in STATS])


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True,
                    rsd: float = 0.01) -> DataFrame:
    """Distinct non-NULL values per column, sorted descending."""
    cols = list(columns or df.columns)
    fn = (lambda c: F.count_distinct(F.col(c))) if exact else \
        (lambda c: F.approx_count_distinct(F.col(c), rsd))
    wide = df.agg(*[fn(c).cast("bigint").alias(f"n_unique__{i}") for i, c in enumerate(cols)])
    return _unpivot(wide, cols, ["n_unique"]).orderBy(F.col("n_unique").desc(), "column_name")


def table_info(df: DataFrame) -> DataFrame:
    """Column, Spark type, non-NULL count and total rows (one pass)."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.count(F.col(c)).alias(f"non_null__{i}") for i, c in enumerate(cols)])
    dtypes = dict(df.dtypes)
    structs = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"),
                        F.lit(dtypes[c]).alias("dtype"), F.col(f"non_null__{i}").alias("non_null"),
                        F.col("__rows").alias("n_rows")) for i, c in enumerate(cols)]
    return wide.select(F.inline(F.array(*structs)))


def null_counts_by(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """NULL count per column per split."""
    return df.groupBy(by).agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(f"{c}_nulls")
                                for c in columns])


def max_value(df: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    """The horizon, e.g. the latest history date (one row)."""
    return df.agg(F.max(column).alias(alias or f"max_{column}"))


def accounting_columns(tag: str = "source", history: str = "history", added: str = "added") -> list[Column]:
    """The counts of D11, for an aggregate or an ``Observation`` of a job that passes over the rows anyway."""
    return [F.count(F.when(F.col(tag) == history, 1)).cast("bigint").alias("historical_rows"),
            F.count(F.when(F.col(tag) == added, 1)).cast("bigint").alias("added_rows"),
            F.count(F.lit(1)).cast("bigint").alias("total_rows")]


def row_accounting(tagged: DataFrame, tag: str = "source", history: str = "history",
                   added: str = "added") -> DataFrame:
    """Historical / added / total rows from one pass over the tagged union."""
    return tagged.agg(*accounting_columns(tag, history, added))
