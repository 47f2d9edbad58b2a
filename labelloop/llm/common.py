"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloop.session import scratch_path, share_code


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared checkpoint folder and read again.

    Cuts the lineage: later jobs read the files, which every executor can reach,
    so a lost executor costs a re-read of its part and never a recomputation.
    """
    share_code(df.sparkSession)
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def range_of(key: Column, bounds: np.ndarray) -> Column:
    """Index of the range of ``key``: how many of the sorted ``bounds`` are <= key.

    ``bounds`` travels with the task; its length is fixed by the caller's
    number of ranges, never by the number of rows.
    """
    edges = np.asarray(bounds, dtype=np.int64)

    @F.pandas_udf(T.IntegerType())
    def place(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, k.to_numpy(np.int64), side="right").astype(np.int32))

    return place(key)


def held_out(doc_id: Column) -> Column:
    """True for the documents whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def one_label(labels: DataFrame, label_col: str, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, y): one label per document; null ids and labels are left out, the
    largest label wins where a document has several."""
    return (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y"))
            .where("doc_id is not null and y is not null").groupBy("doc_id").agg(F.max("y").alias("y")))


def text_groups(texts: list[str], most: int = 4 << 20) -> Iterator[tuple[int, list[str]]]:
    """Runs of consecutive texts of at most ``most`` characters (or one longer text)."""
    first, n = 0, 0
    for i, t in enumerate(texts):
        if n and n + len(t) > most:
            yield first, texts[first:i]
            first, n = i, 0
        n += len(t)
    if first < len(texts):
        yield first, texts[first:]


def mixed(x: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit integers, one to one."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(words: list[str]) -> np.ndarray:
    """64-bit hashes of words, the same in every worker."""
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.frombuffer("\n".join([*words, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    heads = np.cumsum(lengths) - lengths
    place = (np.arange(len(codes)) - np.repeat(heads, lengths)).astype(np.uint64)
    return mixed(np.add.reduceat(mixed(codes + (place << np.uint64(32))), heads))
