"""Keyed tables for micro-batches: Parquet folders with one live row per key.

A table is split by the month of its key's date and, inside a month, into hash
buckets of the key.  A batch rewrites only the parts its keys fall into, each as
a new version beside the old one (``month=…/bucket=…/version=n``), so readers
never meet a folder that is being written.  The version follows from what lies in
the table, not from the batch's number, so a table can be continued by any query;
merging a batch again after a failure gives the same rows.  Readers list the
folders and read the newest version of each part; of the older ones all but the
last are deleted, so work depends on the parts a batch touches and not on the history.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloop.functions.dates import month_key
from labelloop.operators.dedup import last_per_key

BUCKETS = 4     # of a month


def part_of(keys: Sequence[str], schema: T.StructType, buckets: int) -> list[Column]:
    """``month`` (of the first date among the keys) and ``bucket`` of a row."""
    dates = [k for k in keys if isinstance(schema[k].dataType, T.DateType)]
    month = F.coalesce(month_key(F.col(dates[0])), F.lit("none")) if dates else F.lit("all")
    return [month.alias("month"), F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket")]


def versions(spark: SparkSession, table: str) -> dict[tuple[str, int], list[tuple[int, str]]]:
    """(version, folder) of each (month, bucket), the oldest first; empty for a table that was never written."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/month=*/bucket=*/version=*")
    found: dict[tuple[str, int], list[tuple[int, str]]] = {}
    for status in pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or ():
        path = status.getPath().toString()
        month, bucket, version = re.search(r"month=([^/]*)/bucket=(\d+)/version=(\d+)$", path).groups()
        found.setdefault((month, int(bucket)), []).append((int(version), path))
    return {part: sorted(v) for part, v in found.items()}


def live(spark: SparkSession, table: str, schema: T.StructType, only: set[tuple[str, int]] | None = None) -> DataFrame:
    """The live rows (of the parts ``only``)."""
    newest = [v[-1][1] for part, v in sorted(versions(spark, table).items()) if only is None or part in only]
    return spark.read.schema(schema).parquet(*newest) if newest else spark.createDataFrame([], schema)


def upsert(batch: DataFrame, table: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str] = (),
           buckets: int = BUCKETS) -> set[tuple[str, int]]:
    """Merge ``batch`` into the table: per key the last row by ``order`` stays, or the
    batch's own row where no order is given.  Returns the parts that were rewritten."""
    spark = batch.sparkSession
    rows = batch.select(*schema.fieldNames())
    touched = {(r["month"], r["bucket"]) for r in rows.select(*part_of(keys, schema, buckets)).distinct().collect()}  # months x buckets
    if not touched:
        return touched
    before = versions(spark, table)
    version = 1 + max([v[-1][0] for v in before.values()], default=-1)
    old = live(spark, table, schema, touched)
    if order:
        merged = last_per_key(old.unionByName(rows), list(keys), list(order))
    else:
        same = reduce(Column.__and__, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys])
        merged = old.alias("o").join(rows.alias("n"), same, "left_anti").unionByName(rows)
    month, bucket = part_of(keys, schema, buckets)
    merged = merged.select("*", month, bucket, F.lit(version).alias("version"))
    merged.repartition("month", "bucket").write.mode("append").partitionBy("month", "bucket", "version").parquet(table)
    for part in touched:
        for _, path in before.get(part, [])[:-1]:   # the last one before this may still be read
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return touched
