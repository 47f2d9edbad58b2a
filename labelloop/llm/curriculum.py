"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight and a schedule: how strongly it is drawn at each
moment of training, as a piecewise-linear curve over [0, 1].  The weights give
each source a target of words; the integral of its schedule, scaled to that
target, is its cumulative demand.  The documents of a source stand in a fixed
pseudo-random order, so each starts at a known word of its source's stream, and
inverting the cumulative demand at that word gives the moment of training at
which the document is read.  A target above the size of the source starts a
second pass over the same order.  Sorting by moment by ranges puts the whole
corpus into training order.

Defined cases: a null or empty text has size 0 and is never taken; a null
source is a source of its own, after all others; a null id is an id like any
other; repeated rows are separate documents; an empty table gives an empty
result; no weight above zero gives targets of zero.  Columns other than id,
text and source are neither read nor returned by ``mix``; ``training_order`` returns all of them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloop.llm.common import stored
from labelloop.operators.ordering import global_rank

WORD = r"[^\x20\x09-\x0D]++"
EXACT = "decimal(38,0)"

#: Schedules by turn, as (moment, strength) knots: heavy sources fade, light ones grow.
FADE, LEVEL, GROW = ((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 0.75), (1.0, 2.0))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def moment_of(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """The moment at which the integral of the schedule reaches ``share`` of its whole."""
    pieces, area = [], 0.0
    for (t0, a), (t1, b) in zip(knots, knots[1:], strict=False):
        pieces.append((t0, t1, a, b, area))
        area += (t1 - t0) * (a + b) / 2
    want, out = share * F.lit(area), F.lit(float(knots[-1][0]))
    for t0, t1, a, b, done in reversed(pieces):
        left, slope = want - F.lit(done), (b - a) / (t1 - t0)
        step = left / F.lit(a) if slope == 0 else (
            F.sqrt(F.greatest(F.lit(0.0), F.lit(a * a) + left * F.lit(2 * slope))) - F.lit(a)) / F.lit(slope)
        end = done + (t1 - t0) * (a + b) / 2
        out = F.when(want < F.lit(end), F.lit(t0) + step).otherwise(out)
    return out


def source_targets(sizes: DataFrame, weights: Sequence[int], share: tuple[int, int], cap: int) -> DataFrame:
    """(skey, source_size, target, words, turn) from (skey, source_size).

    Targets split ``share`` (a fraction) of all sizes by weight; what a source
    cannot use beyond ``cap`` times its size goes to the others by weight, until
    none is above.  Each round is one aggregate over the sources; exact integers
    throughout, one division at the end.
    """
    ranked = stored(global_rank(sizes, ["skey"]), "mix-sources")
    turn = ((F.col("rank") - 1) % len(weights)).cast("int")
    table = ranked.withColumn("turn", turn).withColumn(
        "w", F.element_at(F.array(*[F.lit(int(x)) for x in weights]), F.col("turn") + 1).cast(EXACT)) \
        .withColumn("most", F.col("source_size").cast(EXACT) * cap)
    up, down = share
    every = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    capped, free, last = 0, None, None
    while True:
        full = F.lit(False) if free is None else F.col("most") * F.lit(down * free) < F.lit(up * every - down * capped) * F.col("w")
        row = table.agg(F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("w")))).first()
        capped, free = int(row[0] or 0), int(row[1] or 0)
        if (capped, free) == last or not free:
            break
        last = (capped, free)
    left = up * every - down * capped
    if not free:
        return table.select("skey", "source_size", F.col("most").cast("double").alias("target"),
                            F.col("most").cast("long").alias("words"), "turn")
    full = F.col("most") * F.lit(down * free) < F.lit(left) * F.col("w")
    part = F.lit(left) * F.col("w").cast("long")
    return table.withColumn("part", part).select(
        "skey", "source_size",
        F.when(full, F.col("most").cast("double")).otherwise(F.col("part").cast("double") / F.lit(float(down * free))).alias("target"),
        F.when(full, F.col("most").cast("long")).otherwise(F.expr(f"part div {down * free}")).alias("words"), "turn")


def streams(rows: DataFrame, sums: DataFrame, targets: DataFrame, schedules, cap: int) -> DataFrame:
    """``rows`` with their source's target and words and when they are read, from their ``__`` columns.

    A document's place in its source's stream is the words of the buckets before its
    own (``sums``) and, inside the bucket, of the documents before it.
    """
    ahead = Window.partitionBy("__skey").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("__skey", "__b", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("__ahead")).join(
        targets.select(F.col("skey").alias("__skey"), *[F.col(c).alias(f"__{c}") for c in ("source_size", "target", "words", "turn")]), "__skey")
    inside = Window.partitionBy("__skey", "__b").orderBy("__h", "__id", "__size").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("__run", F.sum("__size").over(inside) - F.col("__size")).join(offsets, ["__skey", "__b"])
    first = F.col("__ahead") + F.col("__run")

    def taken(first):
        return F.greatest(F.lit(0), F.least(F.col("__size"), F.col("__words") - first)).cast("long")

    def moment(first):
        at = F.lit(None).cast("double")
        for turn, knots in enumerate(schedules):
            at = F.when(F.col("__turn") == turn, moment_of(first / F.col("__words"), knots)).otherwise(at)
        return F.when(taken(first) > 0, at)

    again = first + F.col("__source_size")
    return placed.withColumns({
        "__taken": taken(first) + (taken(again) if cap > 1 else F.lit(0).cast("long")), "__position": moment(first),
        "__second": moment(again) if cap > 1 else F.lit(None).cast("double")})


def keyed(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``df`` with ``__id``, ``__size``, ``__h`` (its place in the order) and ``__skey`` (its source)."""
    source = F.col(source_col).cast("string")
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).cast("binary"))
    return df.withColumns({"__id": F.col(id_col), "__size": word_count(F.col(text_col)), "__h": digest,
                           "__skey": F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))})


def prepared(rows: DataFrame, weights, share: tuple[int, int], cap: int, bucket_rows: int) -> tuple[Column, DataFrame, DataFrame]:
    """(bucket of a row, words per bucket, targets) from stored (__id, __size, __h, __skey)."""
    sizes = rows.groupBy(F.col("__skey").alias("skey")).agg(F.sum("__size").alias("source_size"))
    targets = stored(source_targets(sizes, weights, share, cap), "mix-targets")
    buckets = 1 << math.ceil(math.log2(max(256, rows.count() / bucket_rows)))
    # The first 32 bits of the hash, scaled to the buckets.
    bucket = F.shiftright(F.conv(F.substring("__h", 1, 8), 16, 10).cast("long") * F.lit(buckets).cast("long"), 32)
    sums = rows.groupBy("__skey", bucket.alias("__b")).agg(F.sum("__size").alias("n"))
    return bucket, stored(sums, "mix-buckets"), targets


def mix(df: DataFrame, weights: Sequence[int] = (5, 2, 1), schedules=(FADE, LEVEL, GROW), share: tuple[int, int] = (3, 2),
        cap: int = 2, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        bucket_rows: int = 50_000) -> DataFrame:
    """One row per document: its size, its source's size and target, the words taken
    and the moments of its first and second reading (null: not read), range-sorted by
    the moment of the first reading (unread documents last).

    ``share`` is a fraction of all sizes, ``cap`` (1 or 2) how often a source may be
    read.  ``bucket_rows`` is the mean number of rows of one window group; the
    number of groups grows with the table, also inside one source.
    """
    narrow = ["__id", "__size", "__h", "__skey"]
    rows = stored(keyed(df, id_col, text_col, source_col).select(*narrow), "mix-rows")
    bucket, sums, targets = prepared(rows, weights, share, cap, bucket_rows)
    order = F.col("__position").asc_nulls_last(), F.col("__id").asc_nulls_last()
    placed = streams(rows.withColumn("__b", bucket), sums, targets, schedules, cap).repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.select(
        F.col("__id").alias("doc_id"), F.when(F.col("__skey") != "1", F.expr("substring(__skey, 2)")).alias("source"),
        F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
        F.col("__taken").alias("taken"), F.col("__position").alias("position"), F.col("__second").alias("second_position"))


def training_order(df: DataFrame, weights: Sequence[int] = (5, 2, 1), schedules=(FADE, LEVEL, GROW), share: tuple[int, int] = (3, 2),
                   cap: int = 2, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                   bucket_rows: int = 50_000) -> DataFrame:
    """The rows of ``df`` as training reads them: once per reading that ``mix`` gives them, range-sorted by moment.

    Every row goes through the streams itself, so repeated and null ids are rows like
    any other.  Columns of ``df`` are returned unchanged.
    """
    full = keyed(df, id_col, text_col, source_col)
    rows = stored(full.select("__id", "__size", "__h", "__skey"), "mix-rows")
    bucket, sums, targets = prepared(rows, weights, share, cap, bucket_rows)
    placed = streams(full.withColumn("__b", bucket), sums, targets, schedules, cap)
    reads = placed.withColumn("__at", F.explode(F.array_compact(F.array("__position", "__second"))))
    return reads.select(*df.columns, "__at", "__id").repartitionByRange("__at", "__id").sortWithinPartitions("__at", "__id").select(*df.columns)
