"""Feature engineering.

Imputation statistics and scales are fitted with one aggregation pass over
the training rows and applied as literals (or a tiny broadcast table for
per-split statistics), so transforming never re-reads the training set.
Pipelines use Spark ML stages where Spark has them (Imputer, StringIndexer,
OneHotEncoder, VectorAssembler, SQLTransformer).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer, OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values ----------------------------------------------------------
CYCLIC_PERIODS = {"Dayofyear": 365, "Month": 12}
# ---------------------------------------------------------------------------


def fit_means(train: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """H1 fit: column means over the training rows (NaN counts as missing)."""
    row = train.agg(*[F.avg(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))).alias(c)
                      for c in columns]).first()
    return {c: row[c] for c in columns}


def _modes(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by…, column, mode): the most frequent value of each column, ties → smallest.

    Values are counted by (by…, column, value) first, combined before the
    shuffle, so no task holds all values of a column."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    counts = df.select(*by, pairs.alias("p")).select(*by, "p.column", "p.value").dropna(subset=["value"]) \
        .groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*by, "column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))


def fit_modes(train: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """H2 fit: most frequent value per column, ties → smallest; None where all are missing."""
    columns = list(columns)
    found = {r["column"]: r["mode"] for r in _modes(train, columns).collect()} if columns else {}   # a row per column
    return {c: found.get(c) for c in columns}


def fill(df: DataFrame, values: dict) -> DataFrame:
    """Apply fitted fill values (NULL and, for doubles, NaN are replaced)."""
    cols = {}
    for c, v in values.items():
        if v is None:
            continue
        col = F.col(c)
        if isinstance(v, float):
            col = F.nanvl(col.cast("double"), F.lit(None).cast("double"))
        cols[c] = F.coalesce(col, F.lit(v))
    return df.withColumns(cols) if cols else df


def mean_imputer(columns: Sequence[str], suffix: str = "") -> Imputer:
    """H1 as a Spark ML stage (fills NULL and NaN with the training mean)."""
    return Imputer(strategy="mean", inputCols=list(columns),
                   outputCols=[f"{c}{suffix}" for c in columns])


def impute_per_split(df: DataFrame, split: str, numeric: Sequence[str] = (),
                     categorical: Sequence[str] = ()) -> DataFrame:
    """H3: each split filled from its own mean / mode (the reference's leaky
    exploration variant).  Statistics come from one grouped aggregate whose
    size is the number of splits, joined back on the split key."""
    stats = df.groupBy(split).agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.avg(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))).alias(f"__m_{c}") for c in numeric])
    if categorical:
        modes = _modes(df, list(categorical), [split]).groupBy(F.col(split).alias("__s")).agg(
            *[F.max(F.when(F.col("column") == c, F.col("mode"))).alias(f"__m_{c}") for c in categorical])
        stats = stats.join(modes, F.col(split).eqNullSafe(F.col("__s")), "left").drop("__s")
    stats = stats.drop("__rows")
    out = df.join(stats.withColumnRenamed(split, "__split"),
                  on=F.col(split).eqNullSafe(F.col("__split")), how="left").drop("__split")
    out = out.withColumns({c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")),
                                         F.col(f"__m_{c}")) for c in numeric})
    out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"__m_{c}")) for c in categorical})
    return out.drop(*[f"__m_{c}" for c in list(numeric) + list(categorical)])


def one_hot_stages(columns: Sequence[str]) -> list:
    """H4: alphabetical indexing with an extra slot for unseen values, one-hot
    with that last slot dropped — an unseen category encodes as all zeros and
    every known level keeps its own slot."""
    idx = StringIndexer(inputCols=list(columns), outputCols=[f"{c}_idx" for c in columns],
                        handleInvalid="keep", stringOrderType="alphabetAsc")
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in columns], outputCols=[f"{c}_ohe" for c in columns],
                        dropLast=True)
    return [idx, ohe]


def cyclic_stage(periods: dict[str, int] = CYCLIC_PERIODS) -> SQLTransformer:
    """H5: sin / cos of 2πx/period as native SQL inside the pipeline."""
    parts = []
    for c, p in periods.items():
        # D suffix: a bare 365.0 would be a DECIMAL literal in Spark SQL
        parts.append(f"sin(CAST({c} AS DOUBLE) / {float(p)}D * 2.0D * pi()) AS {c}_sin")
        parts.append(f"cos(CAST({c} AS DOUBLE) / {float(p)}D * 2.0D * pi()) AS {c}_cos")
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def preprocessing_pipeline(categorical: Sequence[str], numeric: Sequence[str],
                           periods: dict[str, int] = CYCLIC_PERIODS, output: str = "features") -> Pipeline:
    """H1 + H4 + H5 + H6: mean-impute numerics, one-hot categoricals (imputed
    beforehand with :func:`fit_modes`), cyclic calendar columns, assemble;
    other columns are dropped from the vector (remainder = drop)."""
    stages = []
    num_out = [f"{c}_imp" for c in numeric]
    if numeric:
        stages.append(mean_imputer(numeric, "_imp"))
    if categorical:
        stages += one_hot_stages(categorical)
    stages.append(cyclic_stage(periods))
    cyc = [f"{c}_{f}" for c in periods for f in ("sin", "cos")]
    stages.append(VectorAssembler(inputCols=[f"{c}_ohe" for c in categorical] + num_out + cyc,
                                  outputCol=output, handleInvalid="keep"))
    return Pipeline(stages=stages)


def fit_scale(train: DataFrame, columns: Sequence[str], population: bool = True) -> dict[str, float]:
    """H7 fit: per-column standard deviation (population by default, as the
    reference's scaler); a zero or undefined deviation scales by 1."""
    fn = F.stddev_pop if population else F.stddev_samp
    row = train.agg(*[fn(F.col(c).cast("double")).alias(c) for c in columns]).first()
    out = {}
    for c in columns:
        s = row[c]
        out[c] = 1.0 if s is None or s == 0 or math.isnan(s) else float(s)
    return out


def scale(df: DataFrame, scales: dict[str, float], means: dict[str, float] | None = None) -> DataFrame:
    """H7 transform: x / std, or (x − mean) / std for the centred variant."""
    cols = {}
    for c, s in scales.items():
        x = F.col(c).cast("double")
        if means is not None:
            x = x - F.lit(means[c])
        cols[c] = x / F.lit(s)
    return df.withColumns(cols)


def balanced_weights(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """weight = n / (k · n_class); the class-count table (k rows) is broadcast, so the rows stay where they are
    (a join by a label of two values would put them into two tasks)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    from pyspark.sql import Window
    whole = Window.partitionBy()
    counts = counts.withColumn("__w", F.sum("__nc").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("__nc")))
    return df.join(F.broadcast(counts.select(F.col(label).alias("__lab"), "__w")),
                   on=F.col(label).eqNullSafe(F.col("__lab")), how="left") \
        .withColumn(weight_col, F.col("__w").cast("double")).drop("__lab", "__w")
