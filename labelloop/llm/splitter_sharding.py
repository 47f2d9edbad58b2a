"""Sharding by sampled splitters: near-equal bytes per shard.

Records are ordered by a 64-bit key whose upper bits hash the text and whose
lower bits hash the row, so equal texts lie next to each other and yet a group
of copies of any size can be cut inside.  A size-weighted sample of keys gives
quantile boundaries; records are range-partitioned on them, the ranges are
measured exactly, and ranges that came out overfull are subdivided with a
denser sample of their own.  Running sums inside the (bounded) ranges plus the
exact totals of the ranges before them give every row its byte position, and
the byte position gives the shard.  The sample only decides how the work is
dealt out; the result does not depend on it.

Defined cases: a null text has no bytes (size 16, CRC 0); repeated rows each
get a slot of their own; an empty table gives an empty result; a null id is an
id like any other; one document larger than a shard makes that shard larger
(documents are not cut).  Columns of the input other than the id and the text
are neither read nor returned, so their names cannot clash.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloop.llm.common import range_of, stored

ROW_BITS = 20  # low bits of the key: places inside a group of equal texts


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text plus 16 for the record itself."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(16).cast("long")


def sort_key(doc_id: Column, text: Column) -> Column:
    low = (1 << ROW_BITS) - 1
    return F.xxhash64(text).bitwiseAND(F.lit(~low)).bitwiseOR(F.xxhash64(doc_id, F.lit("row")).bitwiseAND(F.lit(low)))


def _splitters(rows: DataFrame, n_ranges: int, total: int, per_range: int, salt: int) -> np.ndarray:
    """Quantile boundaries from a size-weighted key sample of about ``n_ranges * per_range`` rows."""
    rate = n_ranges * per_range / max(total, 1)
    draw = F.xxhash64("key", "doc_id", F.lit(salt)).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))
    sample = rows.where(draw < F.col("size") * F.lit(rate)).select("key", "size").toPandas().sort_values("key")
    if not len(sample):
        return np.empty(0, np.int64)
    weight = np.maximum(sample["size"].to_numpy(float), 1 / rate).cumsum()
    marks = np.arange(1, n_ranges) * weight[-1] / n_ranges
    return np.unique(sample["key"].to_numpy(np.int64)[np.searchsorted(weight, marks)])


def _ranges(rows: DataFrame, n_ranges: int, total: int, count: int, per_range: int, rounds: int):
    """Boundaries after subdividing overfull ranges, and the exact (bytes, rows) of each range."""
    bounds = _splitters(rows, n_ranges, total, per_range, 0)
    for salt in range(1, rounds + 1):
        sizes = (rows.groupBy(range_of(F.col("key"), bounds).alias("rng"))
                 .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).toPandas().sort_values("rng"))
        share = np.maximum(sizes["bytes"] / max(total, 1), sizes["n"] / max(count, 1)) * n_ranges
        over = sizes[share > 2]
        if salt == rounds or not len(over):
            return bounds, sizes
        ids, extra = over["rng"].tolist(), int(math.ceil(share[share > 2].sum()))
        inside = rows.where(range_of(F.col("key"), bounds).isin(ids))
        more = np.unique(np.concatenate([bounds, _splitters(inside, extra, int(over["bytes"].sum()), per_range, salt)]))
        if len(more) == len(bounds):
            return bounds, sizes
        bounds = more


def shard_by_bytes(df: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", per_range: int = 64,
                   range_rows: int = 250_000, rounds: int = 4, align: float = 0.01) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): every row in one of ``n_shards`` shards of near-equal bytes.

    ``range_rows`` bounds the rows of one range (the number of ranges grows with
    the table), ``per_range`` the sampled keys per range, ``rounds`` how often
    overfull ranges are subdivided.  A group of equal texts that a shard edge
    would cut is moved whole to one side where it is at most ``align`` of a
    shard; larger groups are cut.
    """
    spark = df.sparkSession
    text = F.col(text_col)
    rows = stored(df.select(
        F.col(id_col).alias("doc_id"), record_size(text).alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        sort_key(F.col(id_col), text).alias("key")), "shard-keys")
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    n_ranges = max(4 * n_shards, math.ceil(count / range_rows))
    bounds, sizes = _ranges(rows, n_ranges, total, count, per_range, rounds)
    before = [(int(r), int(b), int(n)) for r, b, n in zip(
        sizes["rng"], sizes["bytes"].cumsum() - sizes["bytes"], sizes["n"].cumsum() - sizes["n"], strict=True)]
    offsets = spark.createDataFrame(before, "rng int, bytes_before long, rows_before long")
    inside = Window.partitionBy("rng").orderBy("key", "doc_id", "size", "text_crc32")
    placed = (rows.withColumn("rng", range_of(F.col("key"), bounds))
              .withColumn("run", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
              .withColumn("pos", F.row_number().over(inside) - F.lit(1))
              .join(offsets, "rng")
              .select("doc_id", "size", "text_crc32", F.shiftright("key", ROW_BITS).alias("same"),
                      (F.col("bytes_before") + F.col("run")).alias("at"), (F.col("rows_before") + F.col("pos")).alias("pos")))
    scale = max(2 * total, 1)
    by_middle = lambda at, size: F.least(
        F.lit(n_shards - 1), F.floor((at * 2 + size) * n_shards / F.lit(scale)).cast("int"))
    placed = stored(placed.withColumn("shard", by_middle(F.col("at"), F.col("size"))), "shard-places")
    # Groups lie in one stretch, so at most n_shards - 1 of them can be cut by an edge.
    cut = (placed.groupBy("same").agg(F.min("shard").alias("a"), F.max("shard").alias("b"),
                                      F.sum("size").alias("bytes"), F.min("at").alias("start"))
           .where((F.col("a") != F.col("b")) & (F.col("bytes") <= F.lit(align * total / n_shards)))
           .select("same", by_middle(F.col("start"), F.col("bytes")).alias("shard")).collect())
    if cut:
        moved = F.create_map(*[F.lit(x) for r in cut for x in (r["same"], r["shard"])])
        placed = placed.withColumn("shard", F.coalesce(F.element_at(moved, F.col("same")), F.col("shard")))
    first = placed.groupBy("shard").agg(F.min("pos").alias("first"))
    return placed.join(first, "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("pos") - F.col("first")).cast("long").alias("slot"))


def write_shards(df: DataFrame, places: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the whole rows of ``df`` as one folder per shard, in slot order.

    Rows are matched with ``places`` by id, text CRC and occurrence, so repeated
    rows keep one place each.
    """
    crc = F.coalesce(F.crc32(F.col(text_col).cast("binary")), F.lit(0)).cast("long")
    nth = lambda d, order: d.withColumn("__nth", F.row_number().over(
        Window.partitionBy("__id", "__crc").orderBy(order)))
    left = nth(df.withColumn("__id", F.xxhash64(F.col(id_col))).withColumn("__crc", crc), F.col("__crc"))
    right = nth(places.select(F.xxhash64("doc_id").alias("__id"), F.col("text_crc32").alias("__crc"),
                              F.col("shard").alias("__shard"), F.col("slot").alias("__slot")), F.col("__slot"))
    (left.join(right, ["__id", "__crc", "__nth"]).drop("__id", "__crc", "__nth")
     .repartitionByRange("__shard", "__slot").sortWithinPartitions("__shard", "__slot")
     .drop("__slot").withColumnRenamed("__shard", "shard").write.partitionBy("shard").parquet(path))
