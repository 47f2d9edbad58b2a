"""Key → code dimension lookup (A10).

The reference keeps its station table as a 36-entry dict; here it is a
DataFrame joined on the key.  No broadcast hint is forced: the planner sees
the dimension's size (and AQE its runtime size) and broadcasts it when it is
under ``spark.sql.autoBroadcastJoinThreshold`` — the size check lives there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_dimension(df: DataFrame, dim: DataFrame, key: str, value: str,
                     flag: str = "is_known") -> DataFrame:
    """Left join on ``key``; unknown keys keep their row with ``value`` NULL and ``flag`` false.

    ``dim`` must be unique on ``key`` (a dimension), so the join never multiplies rows.
    """
    d = dim.select(F.col(key).alias("__dk"), F.col(value).alias(value))
    out = df.join(d, on=F.col(key) == F.col("__dk"), how="left")
    return out.withColumn(flag, F.col("__dk").isNotNull()).drop("__dk")
