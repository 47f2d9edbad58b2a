"""History and truth stored for joins that move only the new rows.

A table is written partitioned by month (B18) and, inside a month, bucketed and
sorted by its key.  A join of new rows with it reads only the months that the new
rows have, and reads the table in its buckets: the new rows are shuffled to them,
the table is not shuffled at all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloop.functions.dates import month_key


class KeyedTable:
    """A Parquet table in ``path`` under a name of the session's catalog; opening an existing one needs its schema and buckets."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], date_col: str, buckets: int = 16):
        self.spark, self.path, self.schema, self.keys, self.date_col, self.buckets = spark, path, schema, list(keys), date_col, buckets
        self.name = "keyed_" + hashlib.md5(path.encode()).hexdigest()
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        names = ", ".join(f"`{k}`" for k in self.keys)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, month STRING) USING parquet PARTITIONED BY (month) "
                  f"CLUSTERED BY ({names}) SORTED BY ({names}) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            spark.catalog.recoverPartitions(self.name)

    def append(self, rows: DataFrame) -> None:
        """Add rows; one task writes one bucket, of all months."""
        out = rows.select(*self.schema.fieldNames(), F.coalesce(month_key(F.col(self.date_col)), F.lit("none")).alias("month"))
        (out.repartition(self.buckets, *self.keys).write.format("parquet").mode("append").partitionBy("month")
         .bucketBy(self.buckets, *self.keys).sortBy(*self.keys).option("path", self.path).saveAsTable(self.name))

    def for_dates(self, rows: DataFrame, date_col: str) -> DataFrame:
        """The table's rows of the months in which ``rows`` have dates (one value a month comes to the driver)."""
        months = [r[0] for r in rows.select(month_key(F.col(date_col)).alias("m")).where("m is not null").distinct().collect()]
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name).where(F.col("month").isin(months)).drop("month")
