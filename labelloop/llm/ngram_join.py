"""Similarity join on word n-grams by chosen paths.

Texts are sets of hashed 5-word shingles, each set embedded as 128 min-hashes:
two sets agree in a coordinate with the probability of their Jaccard
similarity.  A run starts by splitting all sets on one coordinate.  A bucket of
few sets is compared pair by pair; a larger one is split again on coordinates
drawn by the hash of its path (five quarters of a coordinate on average, so a
pair at the threshold keeps one path in expectation), and its sets are compared
with the bucket's leader, the first by one order of all sets, so that the buckets
of a large group share few leaders.  Runs with other first coordinates are repeated until
a pair at the threshold is missed with less than ``1 - recall``.  Whatever
meets is checked on its min-hashes and then on the exact shingle sets.

Equal texts are one set from the start.  Large groups of near copies never
produce all pairs as rows: their buckets stay large, give one pair per set with
each of a few leaders, and connect through them.  Where a bucket is still large at
the last level, its sets that the leaders did not connect are compared with all
others by their min-hashes, block by block, and a block returns at most one pair
for each two groups that it connects.

What may be similar by its min-hashes is connected to families, and inside a
family every pair of different texts is compared exactly, once: a family is dealt
to blocks of sets, and one task compares a block with a block (a tile).  A tile
returns how many documents each of its sets is linked with, and a spanning forest
of the links, never all pairs.  Classes are the connected components of these
links; ``n_links`` counts all documents that a document is linked with or equals.
The comparisons (not the rows) grow with the square of a family.

Defined cases: a text of fewer than five words is one shingle; texts without
words join only equal texts; null texts are empty texts; a null id is carried
through (its class has the smallest id present, or null); repeated rows are
equal texts; an empty table gives an empty result.  Only id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloop.llm.common import mixed, stored, text_groups, word_hashes

N, HASHES = 5, 128
_rng = np.random.default_rng(20)
FACTORS = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
TERMS = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def shingles(texts: list[str], n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts one after the other, and how many each text has."""
    docs = [t.lower().split() for t in texts]
    vocabulary = {w: i for i, w in enumerate(set().union(*docs))}
    get = vocabulary.__getitem__
    words = word_hashes(list(vocabulary))[np.fromiter((i for d in docs for i in map(get, d)), np.int64)]
    lengths = np.fromiter(map(len, docs), np.int64, len(docs))
    counts = np.where(lengths >= n, lengths - n + 1, np.minimum(lengths, 1))
    firsts = np.repeat(np.cumsum(lengths) - lengths - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    have = np.repeat(np.minimum(lengths, n), counts)
    h = np.zeros(len(firsts), np.uint64)
    for k in range(n):
        inside = have > k
        part = words[np.where(inside, firsts + k, 0)] if len(words) else h
        h = h * np.uint64(0x9E3779B97F4A7C15) + np.where(inside, part, np.uint64(0x51ED27))
    return mixed(h), counts


def min_hashes(found: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(texts x HASHES) uint32; rows of texts without shingles are undefined."""
    out = np.zeros((len(counts), HASHES), np.uint32)
    full = counts > 0
    if full.any():
        heads = (np.cumsum(counts) - counts)[full]
        for k in range(HASHES):
            out[full, k] = np.minimum.reduceat(((found * FACTORS[k] + TERMS[k]) >> np.uint64(32)).astype(np.uint32), heads)
    return out


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def signatures(rows: DataFrame) -> DataFrame:
    """(m, wide, narrow) from (m, text): one row per distinct text with words; four bytes and one byte a min-hash."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = batch["m"].tolist()
            for first, part in text_groups(batch["text"].tolist(), 2 << 20):
                found, counts = shingles(part)
                sig = min_hashes(found, counts)
                at = np.flatnonzero(counts)
                yield pd.DataFrame({"m": [keys[first + i] for i in at], "wide": [sig[i].tobytes() for i in at],
                                    "narrow": [sig[i].astype(np.uint8).tobytes() for i in at]})

    every = rows.mapInPandas(run, "m binary, wide binary, narrow binary")
    return every.groupBy("m").agg(F.first("wide").alias("wide"), F.first("narrow").alias("narrow"))


def first_paths(sigs: DataFrame, runs: int) -> DataFrame:
    """(path, m): every set in one bucket of each run."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sig = np.frombuffer(b"".join(batch["wide"]), np.uint32).reshape(-1, HASHES)[:, :runs].astype(np.uint64)
            path = mixed(sig + (np.arange(runs, dtype=np.uint64) << np.uint64(40)))
            yield pd.DataFrame({"path": path.ravel().view(np.int64), "m": np.repeat(batch["m"].to_numpy(), runs)})

    return sigs.select("wide", "m").mapInPandas(run, "path long, m binary")


def longer_paths(nodes: DataFrame, sigs: DataFrame, level: int) -> DataFrame:
    """(path, m) one level down: each bucket splits on one coordinate, or on two in one of four buckets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sig = np.frombuffer(b"".join(batch["wide"]), np.uint32).reshape(-1, HASHES)
            path, m = batch["path"].to_numpy(np.int64).view(np.uint64), batch["m"].to_numpy()
            for k in range(2):
                draw = mixed(path + np.uint64(1000 * level + k))
                use = np.arange(len(path)) if k == 0 else np.flatnonzero((draw >> np.uint64(60)) < 4)
                at = (draw[use] % np.uint64(HASHES)).astype(np.int64)
                down = mixed(draw[use] ^ mixed(sig[use, at].astype(np.uint64)))
                yield pd.DataFrame({"path": down.view(np.int64), "m": m[use]})

    return nodes.join(sigs.select("m", "wide"), "m").mapInPandas(run, "path long, m binary")


def runs_for(threshold: float, recall: float, levels: int) -> int:
    """Runs after which a pair at the threshold, split at every level, is found with probability ``recall``."""
    meet = threshold
    for _ in range(levels - 1):  # one child in three of four buckets, two in the others
        meet = threshold * (0.75 * meet + 0.25 * (1 - (1 - meet) ** 2))
    return min(HASHES, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


@F.pandas_udf(T.DoubleType())
def _agreement(a: pd.Series, b: pd.Series) -> pd.Series:
    x, y = (np.frombuffer(b"".join(s), np.uint8).reshape(-1, HASHES) for s in (a, b))
    return pd.Series((x == y).mean(1))


def promising(pairs: DataFrame, sigs: DataFrame, least: float) -> DataFrame:
    """Distinct (a, b) whose min-hashes agree in a share of ``least``."""
    narrow = sigs.select("m", "narrow")
    return (pairs.distinct()
            .join(narrow.select(F.col("m").alias("a"), F.col("narrow").alias("na")), "a")
            .join(narrow.select(F.col("m").alias("b"), F.col("narrow").alias("nb")), "b")
            .where(_agreement("na", "nb") >= F.lit(least)).select("a", "b"))


def apart(deep: DataFrame, sigs: DataFrame, families: DataFrame, least: float, block: int = 512) -> DataFrame:
    """(a, b): pairs that connect sets of different families in the buckets ``deep`` (path, m).

    The sets outside a bucket's largest family are compared with all sets of the
    bucket, a block with a block in a task, by the share of equal min-hashes.
    """
    placed = stored(deep.join(families, "m", "left").select("path", "m", F.coalesce("label", "m").alias("label")), "deep")
    per = placed.groupBy("path", "label").agg(F.count(F.lit(1)).alias("n"))
    sizes = per.groupBy("path").agg(F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("main")).where("n > main.n").select(
        "path", F.col("main.label").alias("main"), F.ceil((F.col("n") - F.col("main.n")) / block).cast("int").alias("odd"),
        F.ceil(F.col("n") / block).cast("int").alias("every"))
    found = placed.join(stored(sizes, "deep-sizes"), "path").join(sigs.select("m", "narrow"), "m")
    part = lambda c: F.pmod(F.xxhash64("m", F.lit("deep")), F.col(c)).cast("int")
    all_of = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    own = ["path", "m", "label", "narrow"]
    tiles = found.where("label != main").select(*own, F.lit(True).alias("odd_one"), part("odd").alias("i"), all_of("every").alias("j")).unionByName(
        found.select(*own, F.lit(False).alias("odd_one"), part("every").alias("j"), all_of("odd").alias("i")))

    def compare(tile: pd.DataFrame) -> pd.DataFrame:
        x, y = tile[tile["odd_one"]], tile[~tile["odd_one"]]
        out = []
        if len(x) and len(y):
            one, two = (np.frombuffer(b"".join(t["narrow"]), np.uint8).reshape(-1, HASHES) for t in (x, y))
            names, label = np.unique(np.concatenate([x["label"].to_numpy(), y["label"].to_numpy()]), return_inverse=True)
            left, right = label[:len(x)], label[len(x):]
            row, col = [], []
            for first in range(0, len(x), 64):
                alike = (one[first:first + 64, None, :] == two[None]).mean(2) >= least
                i, j = np.nonzero(alike & (left[first:first + 64, None] != right[None]))
                row.append(i + first)
                col.append(j)
            row, col = np.concatenate(row), np.concatenate(col)
            _, at = np.unique(np.minimum(left[row], right[col]) * len(names) + np.maximum(left[row], right[col]), return_index=True)
            keys_x, keys_y = x["m"].to_numpy(), y["m"].to_numpy()
            out = [(keys_x[row[k]], keys_y[col[k]]) for k in joining([(int(left[row[k]]), int(right[col[k]])) for k in at], at)]
        return pd.DataFrame(out, columns=["a", "b"])

    return tiles.groupBy("path", "i", "j").applyInPandas(compare, "a binary, b binary")


def joining(edges: list[tuple[int, int]], names) -> list:
    """The names of those edges that join what was apart, in order."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.get(x, x) != x:
            up[x] = up.get(up[x], up[x])
            x = up[x]
        return x

    kept = []
    for (a, b), name in zip(edges, names, strict=True):
        a, b = top(a), top(b)
        if a != b:
            up[a] = b
            kept.append(name)
    return kept


def components(links: DataFrame) -> DataFrame:
    """(m, label): the smallest member of each connected component, for every linked set.

    First the links of each ``b`` are drawn to the smallest ``a`` that it has: (b, smallest) and
    (a, smallest) connect the same, and the many sets that share leaders leave one link each.
    Then each step takes the smallest label around and then the label of the label, so
    the number of steps grows with the logarithm of a component's extent.
    """
    drawn = stored(links.withColumn("low", F.min("a").over(Window.partitionBy("b"))), "links")
    links = drawn.select(F.col("low").alias("a"), "b").unionByName(drawn.where("a != low").select(F.col("low").alias("a"), F.col("a").alias("b")))
    links = links.distinct()
    both = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = both.groupBy(F.col("a").alias("m")).agg(F.least(F.col("m"), F.min("b")).alias("label"))
    labels = stored(labels, "labels")
    while not labels.isEmpty():
        around = both.join(labels.select(F.col("m").alias("b"), "label"), "b").groupBy(F.col("a").alias("m")).agg(
            F.min("label").alias("near"))
        step = labels.join(around, "m").select("m", "label", F.least("label", "near").alias("next"))
        of = labels.select(F.col("m").alias("next"), F.col("label").alias("further"))
        step = stored(step.join(of, "next", "left").select(
            "m", "label", F.least("next", "further").alias("next")), "labels")
        moved = step.where("label != next").limit(1).count()
        labels = step.select("m", F.col("next").alias("label"))
        if not moved:
            break
    return labels


def similarity_classes(df: DataFrame, threshold: float = 0.8, recall: float = 0.999, small: int = 32, levels: int = 5,
                       slack: float = 0.15, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, m, label, class_id, n_links) of every row; ``m`` keys the text, ``label`` the class.

    ``small`` is the largest bucket compared pair by pair, ``levels`` how deep
    larger ones are split, ``slack`` how far below the threshold the min-hashes of
    a pair may agree that is still checked exactly.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                     text_key(F.col(text_col)).alias("m"))
    members = stored(rows.select("doc_id", "m"), "join-members")
    sigs = stored(signatures(rows.select("m", "text")), "signatures")
    nodes = stored(first_paths(sigs, runs_for(threshold, recall, levels)), "paths")
    pairs, deep = None, None
    for level in range(1, levels + 1):
        counts = nodes.groupBy("path").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("m"), F.col("m").alias("lead"))).alias("first")
        ).where("n > 1").select("path", "n", F.col("first.lead").alias("lead"))
        # Stored, both sides of the join are shuffled for it alone, so that a hot path can be split.
        found = stored(nodes.join(stored(counts, "bucket-sizes"), "path"), "buckets")
        few, many = found.where(F.col("n") <= small), found.where(F.col("n") > small)
        got = few.select("path", F.col("m").alias("a")).join(few.select("path", F.col("m").alias("b")), "path").where("a < b") \
            .select("a", "b").unionByName(many.where("m != lead").select(F.col("lead").alias("a"), F.col("m").alias("b")))
        got = stored(got.distinct(), "met")
        pairs = got if pairs is None else pairs.unionByName(got)
        deep = many.select("path", "m")
        if level < levels:
            nodes = stored(longer_paths(deep, sigs, level), "paths")
            if nodes.isEmpty():
                deep = deep.limit(0)
                break
    near = stored(promising(pairs, sigs, threshold - slack), "near")
    families = components(near)
    more = stored(apart(deep, sigs, families, threshold - slack), "apart")
    if not more.isEmpty():
        families = components(near.unionByName(more))
    copies = stored(members.groupBy("m").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least_id")), "copies")
    needed = families.select("m")
    texts = stored(rows.join(needed.hint("merge"), "m", "left_semi").groupBy("m").agg(F.first("text").alias("text")), "texts")
    compared = stored(family_links(families.join(copies, "m").select("m", "label", "copies"), texts, threshold), "compared")
    labels = components(compared.where("b is not null").select(F.col("m").alias("a"), "b"))
    linked = compared.groupBy("m").agg(F.sum("others").alias("others"))
    classes = copies.join(labels, "m", "left").join(linked, "m", "left").select(
        "m", F.coalesce("label", "m").alias("label"), "least_id",
        (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).cast("long").alias("n_links"))
    classes = stored(classes, "classes")
    heads = stored(classes.groupBy("label").agg(F.min("least_id").alias("class_id")), "class-heads")
    named = stored(classes.join(heads, "label"), "classes")
    return members.join(named, "m").select("doc_id", "m", "label", "class_id", "n_links")


def shared_shingles(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """(left x right) numbers of common shingles; each set is an array of distinct hashes."""
    out = np.zeros((len(left), len(right)), np.int64)
    every, place = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in [*left, *right]])
    # Only shingles that both sides have count; they are taken in slices of a fixed width.
    split = sum(map(len, left))
    both = np.zeros((2, len(every)), bool)
    both[0, place[:split]], both[1, place[split:]] = True, True
    common = both.all(0)
    column = np.cumsum(common) - 1
    use = common[place]
    row, column = row[use], column[place[use]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for first in range(0, int(common.sum()), columns):
        a, b = np.searchsorted(column, (first, first + columns))
        has = np.zeros((len(left) + len(right), columns), np.float32)
        has[row[a:b], column[a:b] - first] = 1
        out += (has[:len(left)] @ has[len(left):].T).astype(np.int64)  # whole numbers up to ``columns``: exact
    return out


def forest(link: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric boolean matrix."""
    left, out = np.ones(len(link), bool), []
    for start in range(len(link)):
        if not left[start]:
            continue
        left[start], ahead = False, [start]
        while ahead:
            at = ahead.pop()
            new = np.flatnonzero(link[at] & left)
            left[new] = False
            out += [(at, int(k)) for k in new]
            ahead += new.tolist()
    return out


def family_links(families: DataFrame, texts: DataFrame, threshold: float, block: int = 256, block_bytes: int = 16 << 20) -> DataFrame:
    """(m, others, b) from (m, label, copies) and (m, text): rows without ``b`` say with how many documents of other texts
    set ``m`` is linked in a tile; rows with ``b`` are links that span what a tile connects.

    A family of k sets is dealt to blocks of about ``block`` sets or ``block_bytes`` of
    text, and each pair of blocks is one task; families of one block share tasks.
    """
    families = stored(families.join(texts.select("m", F.octet_length("text").cast("long").alias("size")), "m"), "family-sets")
    of = families.groupBy("label").agg(F.count(F.lit(1)).alias("k"), F.sum("size").alias("bytes")).where("k > 1").select(
        "label", "k", "bytes", F.greatest(F.ceil(F.col("k") / block), F.ceil(F.col("bytes") / block_bytes)).cast("int").alias("n"))
    of = stored(of, "family-sizes")
    alone = of.where("n = 1").agg(F.sum("k").alias("k"), F.sum("bytes").alias("bytes")).first()
    packs = max(1, math.ceil((alone.k or 0) / block), math.ceil((alone.bytes or 0) / block_bytes))
    part = F.when(F.col("n") == 1, F.pmod(F.xxhash64("label", F.lit("pack")), F.lit(packs))).otherwise(F.xxhash64("label"))
    dealt = families.join(of, "label").select(
        "m", "label", "copies", part.alias("part"), F.pmod(F.xxhash64("m", F.lit("block")), F.col("n")).cast("int").alias("i"), "n")
    tiles = dealt.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select(
        "m", "label", "copies", "part", "i", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"))
    tiles = stored(tiles, "tiles")

    def count(group: pd.DataFrame) -> pd.DataFrame:
        lo, hi, m, others, b = int(group["lo"].iloc[0]), int(group["hi"].iloc[0]), [], [], []
        sets = []
        for _, some in text_groups(group["text"].tolist(), 1 << 20):
            found, counts = shingles(some)
            sets += [np.unique(x) for x in np.split(found, np.cumsum(counts)[:-1])]
        place = np.arange(len(group))
        for _, rows in pd.Series(place).groupby(group["label"].to_numpy()):
            own = rows.to_numpy()
            at, keys, copies = (group[c].to_numpy()[own] for c in ("i", "m", "copies"))
            size = np.array([len(sets[x]) for x in own])
            left, right = np.flatnonzero(at == lo), np.flatnonzero(at == hi)
            if not len(left) or not len(right):
                continue
            c = shared_shingles([sets[own[x]] for x in left], [sets[own[x]] for x in right])
            link = c >= threshold * (size[left][:, None] + size[right][None, :] - c) - 1e-9
            if lo == hi:
                np.fill_diagonal(link, False)
                whole = link
            else:
                whole = np.zeros((len(left) + len(right),) * 2, bool)
                whole[:len(left), len(left):], whole[len(left):, :len(left)] = link, link.T
                m, others, b = [*m, *keys[right]], [*others, *(link.T @ copies[left])], [*b, *[None] * len(right)]
            m, others, b = [*m, *keys[left]], [*others, *(link @ copies[right])], [*b, *[None] * len(left)]
            names = keys[left] if lo == hi else np.concatenate([keys[left], keys[right]])
            edges = forest(whole)
            m, others, b = [*m, *(names[x] for x, _ in edges)], [*others, *[None] * len(edges)], [*b, *(names[y] for _, y in edges)]
        return pd.DataFrame({"m": pd.Series(m, dtype=object), "others": pd.array(others, "Int64"), "b": pd.Series(b, dtype=object)})

    return tiles.join(texts, "m").groupBy("part", "lo", "hi").applyInPandas(count, "m binary, others long, b binary")


def similarity_links(df: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, class_id, n_links) of every row; ``n_links`` counts all documents of its class it is linked with or equals."""
    return similarity_classes(df, threshold, id_col=id_col, text_col=text_col, **options).select("doc_id", "class_id", "n_links")


def one_of_each(df: DataFrame, threshold: float = 0.8, **options) -> DataFrame:
    """The rows of ``df``, all columns unchanged, of one document per class: that of the smallest id."""
    classes = similarity_classes(df, threshold, **options)
    best = classes.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "m")).alias("b")).select(
        F.col("b.doc_id").alias("__id"), F.col("b.m").alias("__m"))
    keyed = df.withColumn("__m", text_key(F.col("text")))
    kept = keyed.join(best, (keyed["__m"] == best["__m"]) & keyed["doc_id"].eqNullSafe(best["__id"])).drop(best["__m"])
    return kept.dropDuplicates(["doc_id", "__m"]).select(*df.columns)  # repeated rows are one document
