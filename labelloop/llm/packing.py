"""Packing by non-negative least squares over a histogram of piece lengths.

Documents are tokenised once.  Each is cut at every full window, so only its
last piece is shorter than a window, and the CRC of every piece is known in the
same pass; the token ids are not kept.  The driver sees one histogram of at
most ``window`` lengths.  It enumerates shallow combinations (up to three
pieces) that fill a window, solves for how often to repeat each so that the
histogram is used up (non-negative least squares, active sets), rounds down and
packs what remains greedily.  The resulting plan is a few thousand rows that
depend on the window, not on the corpus: which ranks of which length bucket go
to which sequence.  Pieces get their rank inside their bucket from two-level
counts and look their sequence up.

Defined cases: a null or empty text is a document of the end token alone;
repeated rows are separate documents; an empty table gives an empty result;
null ids are ids like any other.  Columns other than id and text are neither
read nor returned.
"""

from __future__ import annotations

import math
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelloop.llm.common import stored, text_groups

END = 2  # id closing every document
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


#: White space as Unicode defines it: what the tokenizer's ``\\s`` drops.
CHUNK = re.compile(r"[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
ODD_SPACES = "\x1c\x1d\x1e\x1f"  # str.split() breaks at these too
#: Fixed value: the pattern with which this tokenizer cuts a chunk into words.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Chunks of these letters need no normalising but lower case.
PLAIN = re.compile("[!-~\xa1-\u012f\u0131-\u024f]+")


def byte_letters() -> dict[int, int]:
    """How byte-level vocabularies write bytes: printable ones as themselves, the others from 256 on."""
    odd = [b for b in range(256) if not (33 <= b < 127 or 161 <= b < 173 or b >= 174)]
    return {b: 256 + i for i, b in enumerate(odd)}


class WordIds:
    """Token ids of whole texts, encoded once per distinct white-space-delimited chunk.

    For tokenizers that drop white space and cut chunks by ``WORDS``.  Words of
    plain letters go straight to the merges; any other chunk through the whole
    tokenizer.  At most ``keep`` chunks are remembered, which bounds the memory.
    """

    def __init__(self, path: str, keep: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.whole, self.keep, self.ids = Tokenizer.from_file(path), keep, {}
        self.merges = Tokenizer(self.whole.model)
        self.merges.pre_tokenizer = pre_tokenizers.Split("\n", "removed")
        self.letters = {b: c for b, c in byte_letters().items() if b != 10}  # line breaks part the words
        size = self.whole.get_vocab_size()
        self.closes = np.array([(self.whole.id_to_token(i) or "").endswith("</w>") for i in range(size)])

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of lower-case words, each a word of its own to the merges; sorts ``words``."""
        if not words:
            return []
        words.sort(key=str.isascii)
        n = next((i for i, w in enumerate(words) if w.isascii()), len(words))
        text = "\n".join(words[:n]).encode().decode("latin1").translate(self.letters) + "\n" + "\n".join(words[n:])
        ids = np.array(self.merges.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.closes[ids]) + 1
        raw, ends = ids.tobytes(), (4 * ends).tolist()
        assert len(ends) == len(words)
        return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _learn(self, new: list[str]) -> None:
        plain = [w for w in new if PLAIN.fullmatch(w) and "<|" not in w]
        parts = [(w.lower(),) if w.isalpha() else (w[:-1].lower(), w[-1]) if w[-1] in ",." and w[:-1].isalpha()
                 else WORDS.findall(w.lower()) for w in plain]
        words = list({x for p in parts for x in p})
        ids = self._encode_words(words)
        known = dict(zip(words, ids, strict=True))
        for w, p in zip(plain, parts, strict=True):
            self.ids[w] = b"".join([known[x] for x in p]) if len(p) != 1 else known[p[0]]
        other = list(set(new).difference(plain))
        for w, e in zip(other, self.whole.encode_batch(other, add_special_tokens=False), strict=True):
            self.ids[w] = np.array(e.ids, "<u4").tobytes()

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        chunks = [CHUNK.findall(t) if any(c in t for c in ODD_SPACES) else t.split() for t in texts]
        new = set().union(*chunks).difference(self.ids)
        if len(self.ids) + len(new) > self.keep:
            self.ids = {}
            new = set().union(*chunks)
        self._learn(list(new))
        get = self.ids.__getitem__
        return [np.frombuffer(b"".join(map(get, c)), "<u4") for c in chunks]


_KNOWN: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One ``WordIds`` for all tasks of a Python worker."""
    if path not in _KNOWN:
        _KNOWN[path] = WordIds(path)
    return _KNOWN[path]


def cut_pieces(df: DataFrame, tokenizer: str, window: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``PIECES``: every document's ids with the end id, cut at each full window."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = word_ids(tokenizer)
        for batch in batches:
            ids, texts = batch["doc_id"].tolist(), batch["text"].tolist()
            for first, part in text_groups(texts):
                rows = []
                for doc, tokens in zip(ids[first:first + len(part)], words(part), strict=True):
                    raw = tokens.tobytes() + np.array([END], "<u4").tobytes()
                    n = len(raw) // 4
                    rows += [(doc, a, min(window, n - a), zlib.crc32(raw[4 * a:4 * (a + window)]), n)
                             for a in range(0, n, window)]
                out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInPandas(run, PIECES)


def length_edges(window: int, per_octave: int = 64) -> np.ndarray:
    """Upper edges of the length buckets: every length up to ``per_octave``, then so many per doubling."""
    edges, step, at = [], 1, 0
    while at < window:
        for _ in range(per_octave):
            at = min(window, at + step)
            edges.append(at)
            if at == window:
                break
        step = max(1, at // per_octave)
    return np.array(edges)


def combinations(edges: np.ndarray, window: int, grid: int = 64) -> list[tuple[int, ...]]:
    """Combinations of one to three buckets that fill the window as far as the buckets allow.

    The last bucket is always the largest that still fits; of three, the middle
    one is taken from about ``grid`` evenly spread buckets.
    """
    fit = lambda room: int(np.searchsorted(edges, room, side="right")) - 1
    out = {(len(edges) - 1,)}
    for a in range(len(edges) - 1):
        b = fit(window - edges[a])
        if 0 <= b <= a:
            out.add((a, b))
        if edges[a] * 3 < window:
            continue
        top = min(a, fit(window - edges[a] - 1))
        for b in sorted({int(x) for x in np.linspace(0, top, grid)}) if top >= 0 else ():
            c = fit(window - edges[a] - edges[b])
            if 0 <= c <= b:
                out.add((a, b, c))
    return sorted(out)


def nnls(columns: list[tuple[int, ...]], target: np.ndarray, rounds: int = 600, tol: float = 1e-9) -> np.ndarray:
    """x >= 0 minimising |A x - target|, A having a count per bucket in each column (active sets)."""
    width = max(map(len, columns))
    index = np.array([c + (len(target),) * (width - len(c)) for c in columns])
    a = np.zeros((len(target) + 1, len(columns)))
    np.add.at(a, (index, np.arange(len(columns))[:, None]), 1.0)
    a = a[:-1]
    x, passive = np.zeros(len(columns)), []
    for _ in range(rounds):
        slope = np.append(target - a[:, passive] @ x[passive], 0.0)[index].sum(1)
        slope[passive] = -np.inf
        j = int(slope.argmax())
        if slope[j] <= tol:
            break
        passive.append(j)
        while True:
            p = a[:, passive]
            try:
                s = np.linalg.solve(p.T @ p + 1e-12 * np.eye(len(passive)), p.T @ target)
            except np.linalg.LinAlgError:
                s = np.linalg.lstsq(p, target, rcond=None)[0]
            if s.min() > 0:
                x[:] = 0
                x[passive] = s
                break
            old = x[passive]
            low = s <= 0
            step = float(np.min(old[low] / np.maximum(old[low] - s[low], 1e-300)))
            new = old + step * (s - old)
            keep = [k for k, v in enumerate(new) if v > 1e-14]
            x[:] = 0
            x[[passive[k] for k in keep]] = new[keep]
            passive = [passive[k] for k in keep]
            if not passive:
                break
    return x


def pack_histogram(counts: np.ndarray, edges: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """(buckets of a sequence, repeats) that together use every count exactly."""
    left, plan = counts.astype(np.int64).copy(), []
    if not left.sum():
        return plan
    left[-1], whole = 0, int(left[-1])
    if whole:
        plan.append(((len(edges) - 1,), whole))
    usable = [c for c in combinations(edges, window) if all(left[list(c)] > 0)]
    if usable and left.sum():
        share = nnls(usable, left / left.sum())
        for j in np.argsort(-share):
            times = int(share[j] * counts[:-1].sum())
            need = np.bincount(usable[j], minlength=len(left))
            times = min(times, *(left[b] // need[b] for b in set(usable[j])))
            if times > 0:
                plan.append((usable[j], int(times)))
                left -= times * need
    while left.any():
        room, pattern, rest = window, [], left.copy()
        while True:
            fits = np.flatnonzero((rest > 0) & (edges <= room))
            if not len(fits):
                break
            b = int(fits[-1])
            n = int(min(rest[b], room // edges[b]))
            pattern += [b] * n
            rest[b] -= n
            room -= n * int(edges[b])
        need = np.bincount(pattern, minlength=len(left))
        times = int((left[need > 0] // need[need > 0]).min())
        plan.append((tuple(pattern), times))
        left -= times * need
    return plan


def _layout(plan) -> pd.DataFrame:
    """(bucket, from_rank, per, sequence, slot): ranks from ``from_rank`` on go, ``per`` at a time, to sequences from ``sequence`` on."""
    rows, used, sequence = [], {}, 0
    for pattern, times in plan:
        slot = 0
        for b in sorted(set(pattern), reverse=True):
            per = pattern.count(b)
            rows.append((b, used.get(b, 0), per, sequence, slot))
            used[b] = used.get(b, 0) + per * times
            slot += per
        sequence += times
    return pd.DataFrame(rows, columns=["bucket", "from_rank", "per", "sequence", "slot"])


def pack(df: DataFrame, tokenizer: str, window: int = 4096, id_col: str = "doc_id", text_col: str = "text",
         group_rows: int = 50_000) -> DataFrame:
    """``PIECES`` plus sequence_id and offset: every piece at its place in a sequence of at most ``window`` ids.

    ``group_rows`` is the mean number of pieces whose ranks are counted together;
    the number of groups grows with the corpus.
    """
    spark = df.sparkSession
    edges = length_edges(window)
    pieces = stored(cut_pieces(df, tokenizer, window, id_col, text_col), "pieces")
    lengths = pieces.groupBy("length").count().toPandas()  # at most ``window`` rows
    bucket_of = np.searchsorted(edges, np.arange(window + 1))
    counts = np.bincount(bucket_of[lengths["length"].to_numpy(int)], lengths["count"].to_numpy(float), len(edges))
    layout = _layout(pack_histogram(counts, edges, window))
    subs = max(8, math.ceil(float(counts.sum()) / group_rows))
    table = F.array(*[F.lit(int(b)) for b in bucket_of])
    ranked = (pieces.withColumn("bucket", F.element_at(table, F.col("length").cast("int") + 1))
              .withColumn("sub", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(subs))))
    ahead = Window.partitionBy("bucket").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranked.groupBy("bucket", "sub").agg(F.count(F.lit(1)).alias("n"))
               .select("bucket", "sub", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead")))
    inside = Window.partitionBy("bucket", "sub").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = (ranked.withColumn("pos", F.row_number().over(inside) - 1).join(offsets, ["bucket", "sub"])
              .withColumn("rank", F.col("ahead") + F.col("pos")).drop("ahead", "pos", "sub"))
    starts = {int(b): g.drop(columns="bucket").to_numpy(np.int64) for b, g in layout.groupby("bucket")}

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rank, bucket = batch.pop("rank").to_numpy(np.int64), batch.pop("bucket").to_numpy()
            seq, slot = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for b in np.unique(bucket):
                at, rows = np.flatnonzero(bucket == b), starts[int(b)]
                row = rows[np.searchsorted(rows[:, 0], rank[at], side="right") - 1]
                nth = rank[at] - row[:, 0]
                seq[at], slot[at] = row[:, 2] + nth // row[:, 1], row[:, 3] + nth % row[:, 1]
            yield batch.assign(sequence_id=seq, slot=slot)

    seated = ranked.mapInPandas(place, f"{PIECES}, sequence_id long, slot long")
    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    return seated.withColumn("offset", F.sum("length").over(before) - F.col("length")).drop("slot")
