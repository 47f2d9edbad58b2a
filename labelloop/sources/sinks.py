"""Sinks (A5–A9).

Nothing is ever read and overwritten at the same path in one job: a retrain
set is written to a fresh staged path and the caller swaps pointers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.errors import AnalysisException


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> str:
    """Parquet write (full overwrite by default, optional partition columns)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A5: read back what :func:`write_table` wrote."""
    return spark.read.parquet(path)


def append_log(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Append-only log; each batch adds files, earlier files are never touched."""
    return write_table(df, path, mode="append", partition_by=partition_by)


def write_document(doc: DataFrame, path: str) -> str:
    """A one-row metrics document as JSON (one file: the row count is one)."""
    doc.coalesce(1).write.mode("overwrite").json(path)
    return path


def read_document(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A7 tolerant reader: explicit schema; a missing path gives one all-NULL
    row, a corrupt file gives NULL fields instead of failing."""
    try:
        return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):   # anything else is an error of the caller's
            raise
        return spark.createDataFrame([tuple(None for _ in schema.fields)], schema)


def write_ranked_csv(df: DataFrame, path: str, order: Sequence, header: bool = True, one_file: bool = False) -> str:
    """Ranked report as header CSV, ranking first.

    The rows are sorted by ranges and written by all tasks, as files whose names sort in
    rank order.  A caller that knows the report to be small can ask for ``one_file``."""
    ranked = df.orderBy(*order)
    (ranked.coalesce(1) if one_file else ranked).write.mode("overwrite").option("header", header).csv(path)
    return path


def read_ranked_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.option("header", "true").schema(schema).csv(path)
