"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its hashed character n-grams (the word itself with its
ends marked, and every n-gram of it), so a misspelling shares most of its
vectors with the word it stands for.  A document is the average of the vectors
of all its subwords; a linear softmax over the average gives the two class
probabilities.  Embeddings and softmax are trained jointly in numpy (mini-batch
Adagrad) on a bounded, hash-chosen sample of labelled documents.

After training, the difference of the two logits is linear in the subwords, so
the model is one number per hash bucket.  A document is read as spans of
``span`` words, because a few words out of twenty thousand would vanish in an
average over all of them: its score is that of its most toxic span, and every
word belongs to some span.

Defined cases: null and empty texts score as a span without words (the bias
alone, no evidence); without usable labels every score is 0.5 and with labels
of one class that class's smoothed share; repeated rows are scored alike; other
columns are kept by ``accepted``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloop.llm.common import held_out, one_label, stored, text_groups

MARKS = ".,;:!?\"'()[]{}<>#$%&*|-_"
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    """Lower-case words with the marks around them taken off; white space parts them."""
    return [w for w in [c.strip(MARKS) for c in text.lower().split()] if w]


def subwords(words: list[str], buckets: int, shortest: int = 3, longest: int = 5, at_once: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of every word's subwords: the n-grams of the word between its
    end marks, and the marked word as a whole.  Returns (buckets, owner): owner is
    the word's place in ``words``, ascending.  ``at_once`` words are worked on
    together, which bounds the memory used besides the result.
    """
    parts = [_subwords(words[a:a + at_once], buckets, shortest, longest) for a in range(0, len(words), at_once)]
    if not parts:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] + i * at_once for i, p in enumerate(parts)])


def _subwords(words: list[str], buckets: int, shortest: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    marked = [f"<{w}>" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
    room = np.repeat(ends, lengths) - np.arange(len(codes))
    place = np.arange(len(codes)) - np.repeat(ends - lengths, lengths)
    mixed = (codes + np.uint64(1)) * MULTIPLIER
    whole = np.add.reduceat(mixed * (2 * place + 1).astype(np.uint64) ** 3, ends - lengths)
    found, of, h = [(whole ^ (whole >> np.uint64(31))) * MULTIPLIER], [np.arange(len(words), dtype=np.int32)], np.zeros_like(codes)
    for n in range(1, min(longest, len(codes)) + 1):
        h[:len(codes) - n + 1] = h[:len(codes) - n + 1] * np.uint64(0x100000001B3) + mixed[n - 1:]
        if n >= shortest:
            fits = np.flatnonzero(room >= n)
            found.append((h[fits] ^ (h[fits] >> np.uint64(29)) ^ np.uint64(n)) * MULTIPLIER)
            of.append(owner[fits])
    index, of = np.concatenate(found) >> np.uint64(40), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return (index % np.uint64(buckets)).astype(np.int32)[order], of[order]


def spans_of(n: int, span: int) -> list[int]:
    """First words of the spans of a document of ``n`` words; a short rest joins the span before it."""
    starts = list(range(0, n, span)) or [0]
    if len(starts) > 1 and n - starts[-1] < span // 2:
        starts.pop()
    return starts


def span_words(texts: list[str], span: int):
    """Distinct words of a batch, and per span the places of its distinct words.

    Returns (vocabulary, word places, span of each, words per span, spans per text).
    A word repeated inside a span counts once there; the span keeps its length.
    """
    docs = [words_of(t) for t in texts]
    vocabulary = {w: i for i, w in enumerate(set().union(*docs))}
    lengths, per = [], []
    for d in docs:
        starts = spans_of(len(d), span)
        per.append(len(starts))
        lengths += np.diff([*starts, len(d)]).tolist()
    lengths = np.array(lengths, np.int64)
    get = vocabulary.__getitem__
    flat = np.fromiter((i for d in docs for i in map(get, d)), np.int64, int(lengths.sum()))
    key = np.unique(np.repeat(np.arange(len(lengths)), lengths) * max(len(vocabulary), 1) + flat)
    at, of = (key % max(len(vocabulary), 1)).astype(np.int32), (key // max(len(vocabulary), 1)).astype(np.int32)
    return list(vocabulary), at, of, lengths, np.array(per, np.int64)


@dataclass
class Subwords:
    """Trained model: ``gain`` per bucket is its vector's effect on the logit difference."""

    gain: np.ndarray
    bias: float
    span: int = 32

    def logits(self, texts: list[str]) -> np.ndarray:
        """The logit of the most toxic span of each text."""
        words, at, of, lengths, per = span_words(texts, self.span)
        if not len(per):
            return np.zeros(0)
        index, owner = subwords(words, len(self.gain))
        mean = np.bincount(owner, self.gain[index], len(words)) / np.maximum(np.bincount(owner, minlength=len(words)), 1)
        spans = self.bias + np.bincount(of, mean[at], len(lengths)) / np.maximum(lengths, self.span)
        return np.maximum.reduceat(spans, np.cumsum(per) - per)

    def score(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -500, 500)))


def fit(texts: list[str], y: np.ndarray, buckets: int = 1 << 18, dim: int = 8, span: int = 32, epochs: int = 8,
        rate: float = 0.3, batch: int = 64, scale: float = 32.0, decay: float = 1e-4, seed: int = 7) -> Subwords:
    """Embeddings and softmax trained jointly.

    Only the span that now looks most toxic stands for its document in a step,
    so a toxic document teaches by the words that make it so, and a clean one
    holds every one of its spans down.  A span's vector is the mean over its words
    of the mean over the word's subwords, times ``scale``.  Embeddings start at
    zero, so a subword never seen says nothing.
    """
    share1 = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    if not len(y) or y.min() == y.max():
        return Subwords(np.zeros(buckets, np.float32), float(np.log(share1 / (1 - share1))), span)
    rng = np.random.default_rng(seed)
    words, at, of, lengths, per = span_words(texts, span)
    index, owner = subwords(words, buckets)
    first = np.searchsorted(owner, np.arange(len(words) + 1))
    span_first, doc_first = np.searchsorted(of, np.arange(len(lengths) + 1)), np.append(0, np.cumsum(per))
    long = np.maximum(lengths, span)
    e = np.zeros((buckets, dim), np.float32)
    w = rng.normal(0, 0.5, (dim, 2)).astype(np.float32)
    c, e2 = np.zeros(2, np.float32), np.full(buckets, 1e-8, np.float32)
    w2, c2 = np.full((dim, 2), 1e-2, np.float32), np.full(2, 1e-2, np.float32)

    def stretch(starts, sizes):
        """Concatenated ranges, and which range each element is of."""
        which = np.repeat(np.arange(len(starts)), sizes)
        return np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[which], which

    for epoch in range(epochs):
        gain = (e @ (w[:, 1] - w[:, 0])).astype(np.float32)
        mean = np.bincount(owner, gain[index], len(words)) / np.maximum(np.diff(first), 1)
        level = np.bincount(of, mean[at], len(lengths)) / long + rng.random(len(lengths)) * 1e-9
        best = np.lexsort((-level, np.repeat(np.arange(len(per)), per)))[doc_first[:-1]]
        for part in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
            # In the first round nothing is known yet: every span stands for its document.
            spans, doc = stretch(doc_first[part], per[part]) if not epoch else (best[part], np.arange(len(part)))
            k, of_span = stretch(span_first[spans], np.diff(span_first)[spans])
            j, of_word = stretch(first[at[k]], np.diff(first)[at[k]])
            if not len(j):
                continue
            seg = of_span[of_word]
            by = (scale / long[spans[seg]] / np.diff(first)[at[k]][of_word]).astype(np.float32)
            rows = index[j]
            h = np.stack([np.bincount(seg, e[rows, x] * by, len(spans)) for x in range(dim)], 1).astype(np.float32)
            z = h @ w + c
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(spans)), y[part][doc].astype(int)] -= 1
            p /= len(spans)
            gw, gc, gh = h.T @ p, p.sum(0), p @ w.T
            touched, where = np.unique(rows, return_inverse=True)
            ge = np.stack([np.bincount(where, gh[seg, x] * by, len(touched)) for x in range(dim)], 1) + decay / len(y) * e[touched]
            e2[touched] += (ge ** 2).mean(1)
            e[touched] -= (rate * ge / np.sqrt(e2[touched])[:, None]).astype(np.float32)
            w2 += gw ** 2
            w -= rate * 0.1 * gw / np.sqrt(w2)
            c2 += gc ** 2
            c -= rate * gc / np.sqrt(c2)
    return Subwords((scale * (e @ (w[:, 1] - w[:, 0]))).astype(np.float32), float(c[1] - c[0]), span)


def training_sample(df: DataFrame, labels: DataFrame, label_col: str, per_class: int, class_words: int) -> DataFrame:
    """(doc_id, y, text) of about ``per_class`` documents of each class that are not held out, in the order of a hash of
    the id, as long as they have ``class_words`` words together.

    The texts are whole; of the rows of one id that with the smallest text is learnt from.
    """
    known = stored(one_label(labels, label_col).where(~held_out(F.col("doc_id"))), "toxic-labels")
    n = {int(r[0]): r[1] for r in known.select((F.col("y") > 0).cast("int").alias("y")).groupBy("y").count().collect()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    most = F.when(F.col("y") > 0, F.lit(per_class / max(n.get(1, 1), 1))).otherwise(F.lit(per_class / max(n.get(0, 1), 1)))
    picked = known.where(draw < most).limit(4 * per_class)
    rows = (df.join(F.broadcast(picked), "doc_id")  # at most 4 * per_class ids
            .groupBy("doc_id", "y").agg(F.min(F.coalesce(F.col("text"), F.lit(""))).alias("text")))
    order = Window.partitionBy(F.col("y") > 0).orderBy(draw, "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.size(F.split("text", r"\s+"))).over(order), F.lit(0))
    return rows.withColumn("before", before).where(F.col("before") < class_words).drop("before")


def train(df: DataFrame, labels: DataFrame, label_col: str = "toxic", per_class: int = 3000,
          class_words: int = 600_000) -> Subwords:
    """The model, fitted in one task on the bounded sample; only its numbers come to the driver."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "text"])
        model = fit(rows["text"].tolist(), (rows["y"].to_numpy() > 0).astype(float))
        return pd.DataFrame({"gain": [model.gain.tobytes()], "bias": [model.bias], "span": [model.span]})

    sample = training_sample(df.select("doc_id", "text"), labels, label_col, per_class, class_words)
    row = sample.withColumn("all", F.lit(1)).groupBy("all").applyInPandas(run, "gain binary, bias double, span int").first()
    return Subwords(np.frombuffer(row["gain"], np.float32), row["bias"], row["span"]) if row else fit([], np.zeros(0))


def scorer(model: Subwords):
    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for v in batches:
            texts = [t or "" for t in v]
            yield pd.Series(np.concatenate([np.zeros(0), *(model.score(part) for _, part in text_groups(texts))]))

    return score


def toxicity_scores(df: DataFrame, labels: DataFrame, label_col: str = "toxic", threshold: float = 0.3,
                    per_class: int = 3000) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document, from its whole text."""
    score = scorer(train(df, labels, label_col, per_class))
    return df.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text")).alias("score")) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(df: DataFrame, labels: DataFrame, threshold: float = 0.3, per_class: int = 3000) -> DataFrame:
    """The rows of ``df``, all columns unchanged, that score below the threshold."""
    return df.where(scorer(train(df, labels, "toxic", per_class))(F.col("text")) < F.lit(threshold))
