"""Quality classifier: histogram gradient-boosted trees over document statistics.

One pass over the texts turns each whole document into a fixed row of
statistics (character classes, word and line shapes, repetition).  Trees are
grown in numpy on a bounded, hash-chosen sample of labelled rows: features are
binned to quantile histograms, each level is split by gradient sums, leaves get
Newton steps.  The forest is flattened into three arrays (feature, threshold,
leaf value; complete trees, children of node i at 2i+1 and 2i+2), and scoring
walks all documents of a batch down all trees with array indexing.

Defined cases: null and empty texts have all-zero statistics and are scored;
without usable labels every score is 0.5, with labels of one class the score is
that class's smoothed share; repeated rows are scored alike; other columns are
kept as they are by ``with_score``, except that a column of the name of the new
score is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloop.llm.common import held_out, one_label, stored

#: Byte classes whose share of a text is a statistic.
CLASSES = {
    "letters_lower": range(97, 123), "letters_upper": range(65, 91), "digits": range(48, 58), "spaces": (32,),
    "breaks": (10, 13), "sentence_marks": b".!?", "commas": b",;:", "quotes": b"'\"`", "brackets": b"()[]{}<>",
    "signs": b"#$%&*+=@^_|~\\/", "bars": b"|", "hyphens": b"-", "beyond_ascii": range(128, 256), "controls": [*range(9), 127],
}
OTHERS = ("log_words", "word_length", "distinct_words", "repeated_next", "long_words", "signed_words", "one_letter_words",
          "marked_words", "line_words", "distinct_lines", "short_lines", "ended_lines", "top_byte", "byte_entropy")
STATISTICS = (*CLASSES, *OTHERS)
_SIGNED = re.compile(r"[#$%&*+=@^_|~\\/<>{}]")


def statistics(texts) -> np.ndarray:
    """(texts x STATISTICS) float32; every statistic but ``log_words`` is a share or a mean."""
    out = np.zeros((len(texts), len(STATISTICS)), np.float32)
    classes = np.zeros((256, len(CLASSES)))
    for j, members in enumerate(CLASSES.values()):
        classes[list(members), j] = 1
    for i, t in enumerate(texts):
        if not t:
            continue
        seen = np.bincount(np.frombuffer(t.encode("utf-8", "replace"), np.uint8), minlength=256)
        share = seen / seen.sum()
        words, lines = t.split(), [x for x in t.split("\n") if x.strip()]
        n, m = max(len(words), 1), max(len(lines), 1)
        shape = np.fromiter(map(len, words), np.int64, len(words))
        some = share[share > 0]
        out[i, :len(CLASSES)] = share @ classes
        out[i, len(CLASSES):] = (
            np.log1p(len(words)), shape.mean() if len(words) else 0, len(set(words)) / n, sum(map(eq, words, words[1:])) / n,
            (shape > 18).mean() if len(words) else 0, len(_SIGNED.findall(t)) / n, (shape == 1).mean() if len(words) else 0,
            sum(t.count(c) for c in (". ", ", ", ".\n")) / n, len(words) / m, len(set(lines)) / m,
            sum(len(x) < 30 for x in lines) / m, sum(x[-1] in ".!?:" for x in map(str.rstrip, lines)) / m, share.max(),
            -(some * np.log(some)).sum())
    return out


@dataclass
class Trees:
    """Complete trees of one depth as flat arrays: node tables (trees x inner nodes), leaf table (trees x leaves)."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    start: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        if not len(self.leaf):
            return out
        trees, inner = np.arange(len(self.leaf))[None, :], self.feature.shape[1]
        for a in range(0, len(x), 4096):
            part = x[a:a + 4096]
            rows, node = np.arange(len(part))[:, None], np.zeros((len(part), len(self.leaf)), np.int64)
            while inner and node[0, 0] < inner:
                right = part[rows, self.feature[trees, node]] > self.threshold[trees, node]
                node = 2 * node + 1 + right
            out[a:a + 4096] += self.leaf[trees, node - inner].sum(1)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.2, bins: int = 64,
              smooth: float = 2.0, least: float = 1.0) -> Trees:
    """Boosted trees for log loss.  ``smooth`` is added to every leaf's curvature, ``least`` the curvature a side needs."""
    inner, leaves = 2 ** depth - 1, 2 ** depth
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    start = float(np.log(share / (1 - share)))
    none = Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), start)
    if not len(y) or y.min() == y.max():
        return none
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    flat = binned + np.arange(x.shape[1]) * bins
    raw, table = np.full(len(y), start), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        grad, curve = y - p, np.maximum(p * (1 - p), 1e-12)
        feature, threshold, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            cell = ((node - first)[:, None] * (x.shape[1] * bins) + flat).ravel()
            size = width * x.shape[1] * bins
            g, h = (np.bincount(cell, np.repeat(v, x.shape[1]), size).reshape(width, x.shape[1], bins) for v in (grad, curve))
            gl, hl = g.cumsum(2)[:, :, :-1], h.cumsum(2)[:, :, :-1]
            ga, ha = g.sum(2, keepdims=True), h.sum(2, keepdims=True)
            gain = gl ** 2 / (hl + smooth) + (ga - gl) ** 2 / (ha - hl + smooth) - ga ** 2 / (ha + smooth)
            gain[(hl < least) | (ha - hl < least)] = 0
            best = gain.reshape(width, -1).argmax(1)
            for k in range(width):
                j, b = divmod(int(best[k]), bins - 1)
                if gain[k, j, b] > 1e-9 and b < len(edges[j]):
                    feature[first + k], threshold[first + k] = j, edges[j][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        at = node - inner
        step = rate * np.bincount(at, grad, leaves) / (np.bincount(at, curve, leaves) + smooth)
        raw += step[at]
        table.append((feature, threshold, step))
    return Trees(*(np.array([t[k] for t in table]) for k in range(3)), start)


def document_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, stats array<float>) of every row, in one pass over the whole texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"),
                                "stats": list(statistics([t or "" for t in batch["text"]]))})

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .mapInPandas(run, "doc_id long, stats array<float>")


def train(stats: DataFrame, labels: DataFrame, label_col: str = "quality", max_rows: int = 20_000) -> Trees:
    """Trees from at most ``max_rows`` labelled rows that are not held out, chosen by a hash of the id."""
    known = stats.where(~held_out(F.col("doc_id"))).join(one_label(labels, label_col), "doc_id")
    n = known.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = known.withColumn("draw", draw).where(F.col("draw") < min(1.0, max_rows / max(n, 1)))
    rows = drawn.orderBy("draw", "doc_id").limit(max_rows).select("doc_id", "y", "stats").toPandas()
    x = np.stack(rows["stats"].to_numpy()) if len(rows) else np.zeros((0, len(STATISTICS)))
    return fit_trees(x.astype(float), (rows["y"].to_numpy() > 0).astype(float))


def scorer(model: Trees, of_text: bool = True):
    """A Pandas UDF giving the score of a text, or of its statistics."""

    @F.pandas_udf(T.DoubleType())
    def score(v: pd.Series) -> pd.Series:
        if not len(v):
            return pd.Series([], dtype=float)
        x = statistics([t or "" for t in v]) if of_text else np.stack(v.to_numpy())
        return pd.Series(model.score(x.astype(float)))

    return score


def quality_scores(df: DataFrame, labels: DataFrame, label_col: str = "quality", threshold: float = 0.7,
                   max_rows: int = 20_000) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; the texts are read once."""
    stats = stored(document_statistics(df), "quality-stats")
    model = train(stats, labels, label_col, max_rows)
    score = scorer(model, of_text=False)(F.col("stats"))
    return stats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score")) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(df: DataFrame, labels: DataFrame, threshold: float = 0.7, max_rows: int = 20_000) -> DataFrame:
    """The rows of ``df``, all columns unchanged, whose score reaches the threshold.

    The trees are learnt from the statistics of labelled documents only, so
    other rows are read once, to be scored.
    """
    known = one_label(labels, "quality").where(~held_out(F.col("doc_id")))
    n = known.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sample = known.where(draw < min(1.0, max_rows / max(n, 1))).select("doc_id").limit(2 * max_rows)
    chosen = df.join(F.broadcast(sample), "doc_id", "left_semi")  # at most 2 * max_rows ids
    model = train(stored(document_statistics(chosen), "quality-sample"), labels, "quality", max_rows)
    return df.where(scorer(model)(F.col("text")) >= F.lit(threshold))
