"""Document fingerprints from prefix polynomial hashes.

For a text of code points c, the array P[i] = sum of c[j] * B^j for j < i,
modulo the Mersenne prime 2^31 - 1, answers whether any two spans are equal
(compare P[a+n]-P[a] shifted by powers of B) and so locates longest common
extensions by binary search.  From the same array come the hashes of all spans
of ``width`` code points at once; the fingerprint holds the text's length, its
hash under two bases and the smallest span hashes.  The share of smallest
hashes two fingerprints have in common estimates how much text they share.

``neighbour_fingerprints`` compares each document with the next one and with
its edited text.  Documents are dealt to ranges of ids of bounded size, each
together with the first document of the range after it, so one task holds a few
megabytes of text however long the table is.

Defined cases: null texts are empty; two empty texts are equal (likeness 1), an
empty and another text have likeness 0; a text shorter than ``width`` is one
span; documents of one id stand in the order of their texts, null ids last; the
document after the last is the first, which for a table of one row is itself.
Columns other than id and text are neither read nor returned.
"""

from __future__ import annotations

import hashlib
import math
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloop.llm.common import stored
from labelloop.llm.splitter_sharding import _splitters

PRIME = (1 << 31) - 1
BASES = (1_103_515_245, 69_069_069)
WIDTH, KEPT = 24, 64

_powers: dict[int, np.ndarray] = {}


def _mod(x: np.ndarray) -> np.ndarray:
    """x mod PRIME for 0 <= x < 2^63."""
    x = (x & PRIME) + (x >> 31)
    x = (x & PRIME) + (x >> 31)
    x -= PRIME * (x >= PRIME)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) and on; the table is kept and doubled as longer texts come."""
    table = _powers.get(base)
    if table is None or len(table) < n:
        table = np.ones(1, np.int64) if table is None else table
        while len(table) < n:
            table = np.concatenate([table, _mod(table * pow(base, len(table), PRIME))])
        _powers[base] = table
    return table


@cache
def inverse(base: int) -> int:
    return pow(base, PRIME - 2, PRIME)


class PrefixHash:
    """Modular prefix arrays of one text."""

    def __init__(self, text: str, base: int = BASES[0]):
        self.codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1
        self.base, self.n = base, len(self.codes)
        self.prefix = self._prefix(base)

    def _prefix(self, base: int) -> np.ndarray:
        out = np.zeros(self.n + 1, np.int64)
        np.cumsum(_mod(self.codes * powers(base, self.n)[:self.n]), out=out[1:])
        return _mod(out)

    def digest(self) -> int:
        """The whole text under both bases."""
        other = int(_mod(self.codes * powers(BASES[1], self.n)[:self.n]).sum()) % PRIME
        return int(self.prefix[-1]) << 31 | other

    def span(self, start: int, n: int) -> int:
        """Hash of a span, whatever its place in the text."""
        diff = int(self.prefix[start + n] - self.prefix[start]) % PRIME
        return diff * int(powers(inverse(self.base), start + 1)[start]) % PRIME

    def same(self, start: int, other: PrefixHash, at: int, n: int) -> bool:
        return self.span(start, n) == other.span(at, n)

    def common(self, start: int, other: PrefixHash, at: int) -> int:
        """Length of the longest common extension to the right of both places."""
        low, high = 0, min(self.n - start, other.n - at)
        step = 1
        while low < high and step < high:  # doubling first: most extensions are short
            if not self.same(start, other, at, step):
                high = step - 1
                break
            low, step = step, 2 * step
        while low < high:
            middle = (low + high + 1) // 2
            if self.same(start + low, other, at + low, middle - low):
                low = middle
            else:
                high = middle - 1
        return low

    def spans(self, width: int = WIDTH) -> np.ndarray:
        """Hashes of all spans of ``width`` code points (of the whole text, if shorter)."""
        width = min(width, self.n)
        if not width:
            return np.zeros(0, np.int64)
        diff = self.prefix[width:] - self.prefix[:-width]
        return _mod(np.where(diff < 0, diff + PRIME, diff) * powers(inverse(self.base), len(diff))[:len(diff)])


def smallest(hashes: np.ndarray, kept: int = KEPT) -> np.ndarray:
    """The ``kept`` smallest distinct values."""
    if len(hashes) > 8 * kept:
        few = np.unique(hashes[hashes < PRIME * (4 * kept / len(hashes))])
        if len(few) >= kept:
            return few[:kept]
    return np.unique(hashes)[:kept]


def written(n: int, digest: int, sketch: np.ndarray) -> str:
    return f"{n:x}.{digest:016x}.{sketch.astype('>u4').tobytes().hex()}"


def likeness(a: str, b: str, kept: int = KEPT) -> float:
    """How much text two fingerprints share, 0 to 1; 1 only for equal fingerprints."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(bytes.fromhex(f.rpartition(".")[2]), ">u4") for f in (a, b))
    return shared(x, y, kept)


def shared(x: np.ndarray, y: np.ndarray, kept: int = KEPT) -> float:
    """Twice the shared over the summed spans (Dice), estimated from the smallest hashes; below 1."""
    if not len(x) or not len(y):
        return 0.0
    both, n = np.unique(np.concatenate([x, y]), return_counts=True)
    j = float((n[:kept] == 2).mean())
    return min(2 * j / (1 + j), 1 - 1 / (4 * kept))


def fingerprint(text: str) -> str:
    p = PrefixHash(text)
    return written(p.n, p.digest(), smallest(p.spans()))


def _compare(docs: pd.DataFrame, last: tuple[str, PrefixHash, np.ndarray]) -> list[tuple]:
    """Result rows of documents in order; ``last`` stands after the last of them."""
    rows, (next_text, next_hash, next_spans) = [], last
    next_sketch = smallest(next_spans)
    next_print = written(next_hash.n, next_hash.digest(), next_sketch)
    for doc_id, text in zip(docs["doc_id"].tolist()[::-1], docs["text"].tolist()[::-1], strict=True):
        p = PrefixHash(text)
        spans = p.spans()
        sketch = smallest(spans)
        own = written(p.n, p.digest(), sketch)
        tail, kept = p.n // 2, p.n - p.n // 2
        taken = min(tail, next_hash.n)
        edited = text[:kept] + next_text[:tail]
        if len(edited) <= WIDTH:
            e = PrefixHash(edited)
            edited_spans, edited_digest = e.spans(), e.digest()
        else:
            seam = PrefixHash(text[max(0, kept - WIDTH + 1):kept] + next_text[:min(taken, WIDTH - 1)])
            edited_spans = np.concatenate([
                spans[:max(0, kept - WIDTH + 1)] if p.n >= WIDTH else spans[:0],
                seam.spans() if seam.n >= WIDTH else spans[:0],
                next_spans[:max(0, taken - WIDTH + 1)] if next_hash.n >= WIDTH else spans[:0]])
            whole = int(p.prefix[kept]) + int(next_hash.prefix[taken]) * pow(BASES[0], kept, PRIME)
            shift = pow(BASES[1], kept, PRIME)
            part = lambda q, n: int(_mod(q.codes[:n] * powers(BASES[1], n)[:n]).sum())
            edited_digest = (whole % PRIME) << 31 | (part(p, kept) + part(next_hash, taken) * shift) % PRIME
        edited_sketch = smallest(edited_spans)
        edited_print = written(len(edited), edited_digest, edited_sketch)
        rows.append((doc_id, p.n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own, edited_print,
                     1.0 if own == edited_print else shared(sketch, edited_sketch),
                     1.0 if own == next_print else shared(sketch, next_sketch),
                     kept + min(taken, p.common(kept, next_hash, 0)), p.common(0, next_hash, 0)))
        next_text, next_hash, next_spans, next_sketch, next_print = text, p, spans, sketch, own
    return rows


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
          "near_next double, edited_common_prefix long, next_common_prefix long")


def neighbour_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_bytes: int = 8 << 20) -> DataFrame:
    """``RESULT`` rows: every document's fingerprint, compared with the edited text's and the next document's.

    ``range_bytes`` is the text one task holds at a time (or one longer document).
    """
    top = (1 << 63) - 1
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    light = stored(rows.select(F.coalesce("doc_id", F.lit(top)).alias("key"), "doc_id",
                               (F.octet_length("text") + 16).cast("long").alias("size")), "print-keys")
    total = light.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    bounds = _splitters(light, max(1, math.ceil(total / range_bytes)), total, 32, 0)
    place = lambda k: np.searchsorted(bounds, k, side="right")

    @F.pandas_udf(T.IntegerType())
    def range_id(key: pd.Series) -> pd.Series:
        return pd.Series(place(key.to_numpy(np.int64)).astype(np.int32))

    firsts = light.groupBy(range_id("key").alias("rng")).agg(F.min("key").alias("first")).toPandas().sort_values("rng")
    heads, before = firsts["first"].to_numpy(np.int64), np.roll(firsts["rng"].to_numpy(np.int32), 1)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def targets(key: pd.Series) -> pd.Series:
        k = key.to_numpy(np.int64)
        at = np.searchsorted(heads, k)
        own = place(k).tolist()
        return pd.Series([[r, int(before[i])] if i < len(heads) and heads[i] == x else [r]
                          for r, i, x in zip(own, at.tolist(), k.tolist(), strict=True)])

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["key", "text"], kind="stable")
        own, after = group[group["pos"] == 0], group[group["pos"] > 0]
        names = [f.split()[0] for f in RESULT.split(", ")]
        if not len(own):
            return pd.DataFrame(columns=names)
        text = after["text"].iloc[0]
        p = PrefixHash(text)
        out = pd.DataFrame(_compare(own, (text, p, p.spans())), columns=names)
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    keyed = rows.withColumn("key", F.coalesce("doc_id", F.lit(top)))
    dealt = keyed.select("doc_id", "text", "key", F.posexplode(targets("key")).alias("pos", "rng"))
    return dealt.groupBy("rng").applyInPandas(run, RESULT)
