"""Hard negatives by slots of scores.

An anchor's positives are its highest-scoring rows of the same label.  Each
positive asks for the highest-scoring rows of other labels inside its own window
of scores.  Windows of one anchor overlap, so a window is not searched by itself:
the upper limits of an anchor's positives, sorted, cut the scores into disjoint
slots, and a row of another label falls into the slot of the smallest upper limit
that is not below its score.  Every task keeps the first ``k`` rows of each slot
(anchors x slots x k rows, however many rows it saw), the same combination runs
over all tasks, and a merge from the lowest slot upwards gives the first ``k`` rows
below each upper limit.  A window's lower limit only cuts the end of that list, so
the list answers the window exactly.

Rows and anchors are dealt to blocks, and a pair of blocks is one matrix product
in one task; rows are copied once per block of anchors and the other way round.
Vectors are integers (``floor(256 * x)``), so scores are exact.

Defined cases: rows with a null id, label or vector or with a null or non-finite
component take no part; of several rows of one id the one with the smallest
(label, vector) does; vectors of different lengths are filled up with zeros; an
anchor without positives, and a window without rows, give nothing; a window whose
lower limit is above its upper one (negative positive scores) is empty; scores
must fit in 64 bits; an empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloop.llm.common import stored

SCALE, EXACT = 256, 2.0 ** 53


def prepared(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, v) of the rows that take part: one per id, relabelled, ``v`` whole numbers as doubles."""
    x = F.col("x")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                     F.transform(F.col(vector_col), lambda c: c.cast("double")).alias("x"))
    fine = F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))))  # NaN counts as above infinity
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & fine)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("row")).select("vec_id", "row.label", "row.x")
    return one.select("vec_id", label.alias("label"), F.transform("x", lambda c: F.floor(c * SCALE).cast("double")).alias("v"))


def matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def products(a: pd.DataFrame, b: pd.DataFrame) -> np.ndarray:
    """All inner products as int64, exact."""
    width = max(1, max(map(len, a["v"]), default=0), max(map(len, b["v"]), default=0))
    x, y = matrix(a["v"], width), matrix(b["v"], width)
    if np.abs(x).max(initial=0) * np.abs(y).max(initial=0) * width < EXACT:
        return (x @ y.T).astype(np.int64)
    whole = [[int(c) for c in v] for v in y]
    return np.array([[sum(int(c) * d for c, d in zip(u, v, strict=True)) for v in whole] for u in x], np.int64)


def first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by smaller id, in that order."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
        return at[np.lexsort((ids[at], -scores[at]))[:k]]
    return np.lexsort((ids, -scores))


def upper_limit(score: int, share: int = 90) -> int:
    """Largest whole number s with 100 s <= share * score."""
    return (share * score) // 100


def lower_limit(score: int, share: int = 30) -> int:
    """Smallest whole number s with 100 s >= share * score."""
    return -((-share * score) // 100)


def upper_limits(scores) -> np.ndarray:
    """The distinct upper limits of an anchor's windows, ascending: slot i holds the scores above limit i - 1 up to limit i."""
    return np.array(sorted({upper_limit(int(p)) for p in scores}), np.int64)


def dealt(rows: DataFrame, anchor_every: int, row_block: int, anchor_block: int) -> tuple[DataFrame, DataFrame, int, int]:
    """(anchors with their block ``ab``, rows with their block ``rb``, numbers of blocks)."""
    n, a = rows.agg(F.count(F.lit(1)), F.count_if(F.col("vec_id") % anchor_every == 0)).first()
    nr, na = max(1, math.ceil(n / row_block)), max(1, math.ceil(a / anchor_block))
    of = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    anchors = rows.where(F.col("vec_id") % anchor_every == 0).withColumn("ab", of(na, 1))
    return anchors, rows.withColumn("rb", of(nr, 2)), nr, na


def every(n: int, name: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)


def first_positives(anchors: DataFrame, blocks: DataFrame, nr: int, na: int, count: int) -> DataFrame:
    """(anchor_id, positive_id, positive_score): each anchor's first ``count`` other rows of its label."""

    def best(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(b):
            s, ids, labels = products(a, b), b["vec_id"].to_numpy(), b["label"].to_numpy()
            for i, (anchor, label) in enumerate(zip(a["vec_id"], a["label"], strict=True)):
                at = np.flatnonzero((labels == label) & (ids != anchor))
                at = at[first(ids[at], s[i, at], count)]
                out.append(pd.DataFrame({"anchor_id": anchor, "positive_id": ids[at], "positive_score": s[i, at]}))
        return pd.concat(out) if out else pd.DataFrame({"anchor_id": [], "positive_id": [], "positive_score": []})

    found = (anchors.select("*", every(nr, "rb")).groupBy("ab", "rb").cogroup(blocks.select("*", every(na, "ab")).groupBy("ab", "rb"))
             .applyInPandas(best, "anchor_id long, positive_id long, positive_score long"))
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= count).drop("place")


def slot_tops(anchors: DataFrame, blocks: DataFrame, nr: int, na: int, k: int) -> DataFrame:
    """(ab, anchor_id, slot, negative_id, negative_score): the first ``k`` rows of other labels in each slot.

    ``anchors`` carries ``asked``, the scores of its positives.
    """

    def best(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(b):
            s, ids, labels = products(a, b), b["vec_id"].to_numpy(), b["label"].to_numpy()
            for i, (anchor, block, label, asked) in enumerate(a[["vec_id", "ab", "label", "asked"]].itertuples(index=False)):
                uppers, least = upper_limits(asked), min(lower_limit(int(p)) for p in asked)
                at = np.flatnonzero((labels != label) & (s[i] >= least) & (s[i] <= uppers[-1]))
                slots = np.searchsorted(uppers, s[i, at], side="left")
                for slot in np.unique(slots):
                    own = at[slots == slot]
                    own = own[first(ids[own], s[i, own], k)]
                    out.append(pd.DataFrame({"ab": block, "anchor_id": anchor, "slot": slot, "negative_id": ids[own], "negative_score": s[i, own]}))
        return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("ab", "anchor_id", "slot", "negative_id", "negative_score")})

    found = (anchors.select("*", every(nr, "rb")).groupBy("ab", "rb").cogroup(blocks.select("*", every(na, "ab")).groupBy("ab", "rb"))
             .applyInPandas(best, "ab int, anchor_id long, slot int, negative_id long, negative_score long"))
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")


def merged(slots: dict[int, list[tuple[int, int]]], n: int, k: int) -> list[list[tuple[int, int]]]:
    """For each slot the first ``k`` of it and all lower ones: (score, id) lists, each slot's own list being sorted."""
    below: list[tuple[int, int]] = []
    out = []
    for slot in range(n):
        below = sorted([*slots.get(slot, []), *below], key=lambda x: (-x[0], x[1]))[:k]
        out.append(below)
    return out


def hard_negatives(df: DataFrame, positives: int = 5, k: int = 10, anchor_every: int = 100, row_block: int = 8192,
                   anchor_block: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    rows = stored(prepared(df, id_col, vector_col, label_col), "quantised")
    anchors, blocks, nr, na = dealt(rows, anchor_every, row_block, anchor_block)
    pairs = stored(first_positives(anchors, blocks, nr, na, positives), "positives")
    limits = pairs.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_score", "positive_id")).alias("windows"))
    asked = stored(anchors.join(limits.select("vec_id", F.col("windows.positive_score").alias("asked")), "vec_id"), "asked")
    tops = slot_tops(asked, blocks, nr, na, k)

    def answer(wanted: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        own = {anchor: g for anchor, g in found.groupby("anchor_id")}
        out = []
        for anchor, windows in wanted[["vec_id", "windows"]].itertuples(index=False):
            if anchor not in own:
                continue
            slots: dict[int, list[tuple[int, int]]] = {}
            for slot, negative, score in own[anchor][["slot", "negative_id", "negative_score"]].itertuples(index=False):
                slots.setdefault(int(slot), []).append((int(score), int(negative)))
            uppers = upper_limits(w["positive_score"] for w in windows)
            lists = merged(slots, len(uppers), k)
            for w in windows:
                score = int(w["positive_score"])
                least = lower_limit(score)
                under = lists[int(np.searchsorted(uppers, upper_limit(score)))]
                out += [(anchor, w["positive_id"], rank, negative, score, s)
                        for rank, (s, negative) in enumerate((x for x in under if x[0] >= least), 1)]
        return pd.DataFrame(out, columns=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    windows = limits.join(anchors.select("vec_id", "ab"), "vec_id")
    return windows.groupBy("ab").cogroup(tops.groupBy("ab")).applyInPandas(
        answer, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
