"""Exact global ranks without a one-partition window.

``row_number() OVER (PARTITION BY g ORDER BY k)`` puts every row of a group in
one task; with two label classes that is two tasks for the whole table.  The
rank here is computed the way a distributed sort does it:

1. range-partition on ``(g, k)`` and sort within partitions (one shuffle,
   partitions are balanced by sampling, a hot group spans many partitions);
2. tag each row with its position inside its partition
   (``monotonically_increasing_id`` packs partition id and row index);
3. aggregate a tiny table — one row per (partition, group) — holding the
   row count and the first position, and turn it into "rows of this group in
   earlier partitions" with a window over that tiny table;
4. join it back: ``rank = before + (position − first) + 1``.

The tiny table has at most ``partitions + groups`` rows, so it is small
whenever the number of groups is.  The placed rows are checkpointed (written
once to the shared checkpoint directory) before both branches read them, so
positions and offsets always come from the same placement.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelloop.session import cut_lineage

_ROW_BITS = 33  # layout of monotonically_increasing_id: partition << 33 | row


def _join_on_part(big: DataFrame, small: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Join on partition id and (null-safe) group keys; ``small`` keeps its own names."""
    ren = small.select(*[F.col(c).alias(f"__g_{c}") if c in group_cols else
                         F.col(c).alias("__p2") if c == "__pid" else F.col(c) for c in small.columns])
    cond = [F.col("__pid") == F.col("__p2")] + \
        [F.col(c).eqNullSafe(F.col(f"__g_{c}")) for c in group_cols]
    return big.join(ren, on=cond, how="inner").drop("__p2", *[f"__g_{c}" for c in group_cols])


def global_rank(df: DataFrame, order_cols: Sequence[str], group_cols: Sequence[str] = (),
                rank_col: str = "rank", num_partitions: int | None = None,
                bucket=None) -> DataFrame:
    """Add ``rank_col`` = 1-based position within ``group_cols`` by ``order_cols``.

    ``group_cols + order_cols`` must identify a row uniquely.  ``bucket`` is an
    optional integer Column, non-decreasing in the order and evenly spread
    (e.g. leading digits of a hash key): rows are then hash-partitioned on
    (group, bucket) with no range sampling and no checkpoint, because the
    placement is a pure function of each row.
    """
    group_cols, order_cols = list(group_cols), list(order_cols)
    keys = group_cols + order_cols
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if bucket is not None:
        return _bucket_rank(df.withColumn("__b", bucket), order_cols, group_cols, rank_col, n)
    placed = (df.repartitionByRange(n, *keys)
              .sortWithinPartitions(*keys)
              .withColumn("__mid", F.monotonically_increasing_id())
              .withColumn("__pid", F.shiftright("__mid", _ROW_BITS))
              .withColumn("__pos", F.col("__mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))))
    # Positions are read by two branches (the offsets table and the rows);
    # a reliable checkpoint makes both see one placement, also after a lost
    # executor or if the planner does not reuse the range exchange.
    placed = cut_lineage(placed)
    per_part = placed.groupBy("__pid", *group_cols).agg(
        F.count(F.lit(1)).alias("__n"), F.min("__pos").alias("__first"))
    earlier = Window.partitionBy(*group_cols).orderBy("__pid") \
        .rowsBetween(Window.unboundedPreceding, -1)
    per_part = per_part.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    ranked = _join_on_part(placed, per_part.drop("__n"), group_cols)
    return ranked.withColumn(
        rank_col, F.col("__before") + F.col("__pos") - F.col("__first") + F.lit(1)
    ).drop("__mid", "__pid", "__pos", "__first", "__before")


def _bucket_rank(df: DataFrame, order_cols: list[str], group_cols: list[str], rank_col: str,
                 n: int) -> DataFrame:
    """Rank by (group, bucket, order): every (group, bucket) lives in one hash
    partition, contiguous after the sort; offsets are sums over earlier buckets
    of the group, from a table of groups × buckets rows."""
    placed = (df.repartition(n, *group_cols, "__b")
              .sortWithinPartitions(*group_cols, "__b", *order_cols)
              .withColumn("__mid", F.monotonically_increasing_id())
              .withColumn("__pos", F.col("__mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))))
    per = placed.groupBy(*group_cols, "__b").agg(F.count(F.lit(1)).alias("__n"), F.min("__pos").alias("__first"))
    earlier = Window.partitionBy(*group_cols).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    ren = per.select(*[F.col(c).alias(f"__g_{c}") for c in group_cols], F.col("__b").alias("__b2"),
                     "__first", "__before")
    cond = [F.col("__b") == F.col("__b2")] + [F.col(c).eqNullSafe(F.col(f"__g_{c}")) for c in group_cols]
    ranked = placed.join(ren, on=cond, how="inner")
    return ranked.withColumn(rank_col, F.col("__before") + F.col("__pos") - F.col("__first") + F.lit(1)) \
        .drop("__b", "__b2", "__mid", "__pos", "__first", "__before", *[f"__g_{c}" for c in group_cols])


def prefix_sums(df: DataFrame, order_cols: Sequence[str], sum_cols: Sequence[str],
                group_cols: Sequence[str] = (), suffix: str = "_before",
                num_partitions: int | None = None) -> DataFrame:
    """Exclusive running sums of ``sum_cols`` within ``group_cols`` by ``order_cols``.

    ``group_cols + order_cols`` must be unique (aggregate to distinct keys
    first).  Range partitions are summed locally (a window per partition id;
    partitions are balanced, so no task holds a whole group), then shifted by
    the totals of earlier partitions from a table of ``partitions × groups`` rows.
    """
    group_cols, order_cols, sum_cols = list(group_cols), list(order_cols), list(sum_cols)
    keys = group_cols + order_cols
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut_lineage(df.repartitionByRange(n, *keys).withColumn("__pid", F.spark_partition_id()))
    inside = Window.partitionBy("__pid", *group_cols).orderBy(*order_cols) \
        .rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumns({f"__in_{c}": F.coalesce(F.sum(c).over(inside), F.lit(0))
                                for c in sum_cols})
    totals = placed.groupBy("__pid", *group_cols).agg(*[F.sum(c).alias(f"__tot_{c}") for c in sum_cols])
    earlier = Window.partitionBy(*group_cols).orderBy("__pid") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__pid", *group_cols, *[
        F.coalesce(F.sum(f"__tot_{c}").over(earlier), F.lit(0)).alias(f"__off_{c}") for c in sum_cols])
    out = _join_on_part(local, offsets, group_cols)
    out = out.withColumns({f"{c}{suffix}": F.col(f"__in_{c}") + F.col(f"__off_{c}") for c in sum_cols})
    return out.drop("__pid", *[f"__in_{c}" for c in sum_cols], *[f"__off_{c}" for c in sum_cols])
