"""Ranked lexical search over posting lists cut into blocks of similar documents.

Scores are whole numbers: a term's weight times a saturated term frequency, summed
over the terms of an item.  The terms of an item are put in one fixed order, rarest
first, and a document is looked for in the list of its first term of the item; from
there on only this term and those after it can add to its score.  So the list of a
term needs, of each document, the coordinates that come at or after the term in some
item, and what is found there is the document's whole score for every item whose
first term it is, and a part of it (never more) for the others.

* One pass over the texts counts the terms that items ask for.  The vocabulary
  travels with the task in slices of a fixed size; more terms take more passes.
* A first lower limit of each item's k-th best score comes from scoring the
  documents with the k largest contributions of each of its terms.
* The whole list of a term has a summary, its largest contribution.  A list is only
  needed where the sum of the summaries from its term on reaches an item's limit.
* Documents are put in order of a min-hash of their terms, so that similar ones lie
  together, and dealt by ranges, which no frequent term or group of copies can fill.
  Each run of documents makes the part of every needed list that lies in it: the
  list's documents are clustered around leaders into blocks of at most ``block``
  documents, stored with the largest value of every coordinate.
* Each task first visits the block with the best bound for each item, which raises
  the limits.  Then all blocks are passed once more, and a block is left out for an
  item only if the sum of its maxima over the item's coordinates is below the item's
  limit.  The documents of visited blocks are scored from their own terms.  Bounds and
  limits are exact whole numbers, so the result is exact.

Defined cases: a null or empty text has no term and counts for nothing; rows of one
item id are one item with all their terms; an item without terms, or whose terms are
nowhere, has no rows; every row of the documents is a document, also with a repeated
or null id; equal scores go by id, null last; an empty table on either side gives an
empty result.  Only ids and texts are read, whatever other columns are called.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloop.llm.common import stored, word_hashes

#: The bytes of a UTF-8 text with A to Z lower-cased and what parts terms made blank; bytes from 128 on belong to terms.
FOLD = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, term): the terms of each item, once each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [sorted(set(terms(t))) for t in batch["text"]]
            yield pd.DataFrame({"item_id": batch["item_id"].repeat([len(f) for f in found]), "term": [t for f in found for t in f]})

    rows = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, f"item_id {rows.schema['item_id'].dataType.simpleString()}, term binary").distinct()


def counted(docs: DataFrame, vocabulary: list[DataFrame]) -> DataFrame:
    """(place, doc_id, n, sig, ts, tfs): number of terms, and the asked ones with their frequencies and a min-hash of
    them, of every text with a term."""
    rows = docs.select(F.monotonically_increasing_id().alias("place"), "doc_id", "text")
    schema = f"place long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, sig long, ts array<long>, tfs array<long>"

    def one(known: dict[bytes, int]) -> DataFrame:
        shuffled = dict(zip(known, (word_hashes([t.decode() for t in known]) >> np.uint64(1)).tolist(), strict=True))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                n, sig, ts, tfs = [], [], [], []
                for text in batch["text"]:
                    all_ = terms(text)
                    got = Counter(filter(known.__contains__, all_))
                    n.append(len(all_))
                    ts.append([known[t] for t in got])
                    sig.append(min((shuffled[t] for t in got), default=0))
                    tfs.append(list(got.values()))
                out = pd.DataFrame({"place": batch["place"], "doc_id": batch["doc_id"], "n": n, "sig": sig, "ts": ts, "tfs": tfs})
                yield out[out["n"] > 0]

        return rows.mapInPandas(run, schema)

    parts = [one({bytes(r.term): r.t for r in part.select("term", "t").toLocalIterator()}) for part in vocabulary]
    if len(parts) == 1:
        return parts[0]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("place").agg(F.first("doc_id").alias("doc_id"), F.first("n").alias("n"),
                                      F.min("sig").alias("sig"), F.flatten(F.collect_list("ts")).alias("ts"),
                                      F.flatten(F.collect_list("tfs")).alias("tfs"))


def slices(df: DataFrame, key: str, entries: int, most: int) -> list[DataFrame]:
    """``df`` by its ``key`` in parts of about ``most`` of its ``entries``."""
    n = max(1, math.ceil(entries / most))
    return [df] if n == 1 else [df.where(F.pmod(F.xxhash64(key, F.lit("slice")), F.lit(n)) == i) for i in range(n)]


def saturation(tf: Column, n: Column, docs: int, words: int) -> Column:
    """What a term's weight is multiplied with in a text of ``n`` terms, of ``docs`` texts with ``words`` terms in all."""
    return F.expr(f"1000000000 * {tf} div (1000 * {tf} + 8 * (10 + (90 * {n} * {docs}L) div {words}L))")


class Lists:
    """What tasks have to know of one slice of the needed lists: their items, coordinates and limits."""

    def __init__(self, needed: pd.DataFrame, weights: dict[int, int], docs: int, words: int):
        self.docs, self.words = docs, words
        self.names = np.unique(np.concatenate([np.zeros(0, np.int64), *needed["tail"]]).astype(np.int64))
        self.weights = np.array([weights[t] for t in self.names.tolist()], np.int64)
        self.items = needed["q"].to_numpy(np.int64)
        self.limits = needed["floor"].to_numpy(np.int64)
        own = np.searchsorted(self.names, needed["t"].to_numpy(np.int64))
        self.columns = [np.searchsorted(self.names, np.asarray(t, np.int64)) for t in needed["tail"]]
        self.of: dict[int, list[int]] = {}
        for i, t in enumerate(own.tolist()):
            self.of.setdefault(t, []).append(i)
        #: The coordinates of each needed list: those at or after its term in some item.
        self.coordinates = {t: np.unique(np.concatenate([self.columns[i] for i in of])) for t, of in self.of.items()}

    def values(self, part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, column, value) of the texts' terms that are known here."""
        lengths = part["ts"].map(len).to_numpy(np.int64)
        ts, tfs = (np.concatenate([np.zeros(0, np.int64), *part[c]]).astype(np.int64) for c in ("ts", "tfs"))
        row = np.repeat(np.arange(len(part)), lengths)
        column = np.minimum(np.searchsorted(self.names, ts), len(self.names) - 1)
        use = self.names[column] == ts
        row, column, tfs = row[use], column[use], tfs[use]
        n = part["n"].to_numpy(np.int64)[row]
        return row, column, self.weights[column] * (1000000000 * tfs // (1000 * tfs + 8 * (10 + 90 * n * self.docs // self.words)))

    def runs(self, batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Consecutive rows, so many that their dense values stay small."""
        step = int(min(2048, max(64, 8_000_000 // len(self.names))))
        for first in range(0, len(batch), step):
            yield batch.iloc[first:first + step]

    def tops(self, columns: np.ndarray, maxima: np.ndarray, of: list[int]) -> np.ndarray:
        """Sum of the block's maxima over the coordinates of each of the items ``of``."""
        asked = [self.columns[i] for i in of]
        every = np.concatenate(asked)
        at = np.minimum(np.searchsorted(columns, every), len(columns) - 1)
        sums = np.where(columns[at] == every, maxima[at], 0)
        heads = np.cumsum([0, *map(len, asked)])[:-1]
        return np.add.reduceat(sums, heads)


def clusters(x: np.ndarray, block: int) -> list[np.ndarray]:
    """The rows of ``x``, in similarity order already, as blocks of at most ``block`` similar rows."""
    m = len(x)
    if m <= 4:
        return [np.arange(m)]
    y = x.astype(np.float32)
    y /= np.linalg.norm(y, axis=1, keepdims=True) + 1e-9
    leaders = np.unique(np.linspace(0, m - 1, max(2, math.ceil(2 * m / block))).astype(np.int64))
    group = (y @ y[leaders].T).argmax(1)
    order = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.diff(group[order])) + 1
    return [run[a:a + block] for run in np.split(order, cuts) for a in range(0, len(run), block)]


def blocks(counts: DataFrame, lists: Lists, block: int) -> DataFrame:
    """(t, cols, tops, places): similar documents of one list, with the largest value of each coordinate."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place_of = np.full(len(lists.names), -1, np.int64)
        for batch in batches:
            out = []
            for part in lists.runs(batch):
                row, column, value = lists.values(part)
                names, at = np.unique(column, return_inverse=True)
                x = np.zeros((len(part), len(names)), np.int64)
                x[row, at] = value
                place_of[:] = -1
                place_of[names] = np.arange(len(names))
                places = part["place"].to_numpy(np.int64)
                order = np.argsort(at, kind="stable")
                ends = np.cumsum(np.bincount(at, minlength=len(names)))
                for j, t in enumerate(names.tolist()):
                    if t not in lists.of:
                        continue
                    rows = row[order[ends[j - 1] if j else 0:ends[j]]]
                    cols = place_of[lists.coordinates[t]]
                    cols = cols[cols >= 0]
                    own = x[rows[:, None], cols]
                    for members in clusters(own, block):
                        tops = own[members].max(0)
                        some = np.flatnonzero(tops)
                        out.append((t, names[cols[some]].astype(np.int32).tobytes(), tops[some].tobytes(), places[rows[members]].tobytes()))
            yield pd.DataFrame(out, columns=["t", "cols", "tops", "places"])

    return counts.mapInPandas(run, "t int, cols binary, tops binary, places binary")


def visit(built: DataFrame, lists: Lists, best_only: bool) -> DataFrame:
    """(i, place, visited, left): documents of visited blocks for the ``i``-th needed (item, list).

    With ``best_only`` each batch visits the block of the best bound of each item, else all
    blocks whose bound reaches the limit.  One row per batch, without ``i``, has how many
    (block, item) pairs were visited and left out.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bounds, left = [], 0
            for b, (t, cols, tops) in enumerate(zip(batch["t"], batch["cols"], batch["tops"], strict=True)):
                of = lists.of[t]
                most = lists.tops(np.frombuffer(cols, np.int32), np.frombuffer(tops, np.int64), of)
                reach = np.flatnonzero(most >= np.maximum(lists.limits[of], 1))
                left += len(of) - len(reach)
                bounds += [(int(most[x]), b, of[x]) for x in reach]
            if best_only:
                first: dict[int, tuple[int, int, int]] = {}
                for x in bounds:
                    q = lists.items[x[2]]
                    first[q] = max(first.get(q, x), x)
                bounds = list(first.values())
            found = [np.frombuffer(batch["places"].iloc[b], np.int64) for _, b, _ in bounds]
            yield pd.DataFrame({"i": np.repeat([x[2] for x in bounds], [len(f) for f in found]).astype(np.int64),
                                "place": np.concatenate([np.zeros(0, np.int64), *found])}).assign(visited=None, left=None)
            yield pd.DataFrame({"i": [None], "place": [None], "visited": [len(bounds)], "left": [left]}, dtype=object)

    return built.mapInPandas(run, "i int, place long, visited long, left long")


def scores(found: DataFrame, counts: DataFrame, lists: Lists) -> DataFrame:
    """(q, place, doc_id, score): what visited documents have of their items, where it reaches the limit."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in lists.runs(batch):
                row, column, value = lists.values(part)
                x = np.zeros((len(part), len(lists.names)), np.int64)
                x[row, column] = value
                who = np.repeat(np.arange(len(part)), part["of"].map(len))
                every = np.concatenate(part["of"].to_numpy())
                for first in range(0, len(every), 50_000):
                    of, at = every[first:first + 50_000], who[first:first + 50_000]
                    asked = [lists.columns[i] for i in of]
                    lengths = np.array([len(a) for a in asked], np.int64)
                    score = np.add.reduceat(x[np.repeat(at, lengths), np.concatenate(asked)], np.cumsum(lengths) - lengths)
                    good = np.flatnonzero(score >= np.maximum(lists.limits[of], 1))
                    yield pd.DataFrame({"q": lists.items[of[good]], "place": part["place"].to_numpy()[at[good]],
                                        "doc_id": part["doc_id"].to_numpy()[at[good]], "score": score[good]})

    kind = counts.schema["doc_id"].dataType.simpleString()
    asked = found.where("i is not null").groupBy("place").agg(F.collect_list("i").alias("of"))   # at most the items' terms
    rows = counts.join(asked.hint("merge"), "place").select("place", "doc_id", "n", "ts", "tfs", "of")
    return rows.mapInPandas(run, f"q long, place long, doc_id {kind}, score long")


def kth_best(scored: DataFrame, k: int) -> DataFrame:
    """(q, floor): the k-th best score of each item that has so many documents."""
    order = Window.partitionBy("q").orderBy(F.desc("score"), "place")
    one = scored.groupBy("q", "place").agg(F.max("score").alias("score"))
    return one.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).select("q", F.col("score").alias("floor"))


def width(spark, rows: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / 50_000))


def top_documents(docs: DataFrame, items: DataFrame, k: int = 10, block: int = 32, vocabulary: int = 100_000, entries: int = 2_000_000,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  report: dict | None = None) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item.

    ``vocabulary`` is how many terms travel with a task, ``entries`` how many (term, term) pairs of
    items; more of either take further passes.  ``report`` gets the numbers of visited and left pairs.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = stored(item_terms(items, item_col, item_text_col), "item-terms")
    numbers = stored(found.select("item_id").distinct().select("item_id", F.monotonically_increasing_id().alias("q")), "items")
    names = stored(found.select("term").distinct().select("term", F.monotonically_increasing_id().alias("t")), "item-vocabulary")
    asked = found.join(numbers, found["item_id"].eqNullSafe(numbers["item_id"])).select("q", "term").join(names, "term").select("q", "t")
    counts = stored(counted(docs, slices(names, "t", names.count(), vocabulary)), "term-counts")
    n_docs, n_words = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
    n_words = max(1, n_words or 0)
    # Each document once in each list: how many, and the k largest contributions but for the term's weight.
    single = counts.select("place", "n", F.explode(F.arrays_zip("ts", "tfs")).alias("p")).select("place", "n", "p.ts", "p.tfs").select(
        "place", F.col("ts").alias("t"), saturation("tfs", "n", n_docs, n_words).alias("part"))
    of = single.groupBy("t").agg(F.count(F.lit(1)).alias("df"), F.max("part").alias("most"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    of = stored(of.select("t", "df", weight.alias("w"), (weight * F.col("most")).alias("most")), "list-summaries")
    largest = Window.partitionBy("t").orderBy(F.desc("part"), "place")
    heads = stored(single.withColumn("r", F.row_number().over(largest)).where(F.col("r") <= k).select("t", "place"), "list-heads")
    asked = stored(asked.join(of, "t"), "asked-terms")
    # The first limits.
    seeds = asked.select("q", "t").join(heads, "t").select("q", "place").distinct()
    texts = counts.join(heads.select("place").distinct(), "place", "left_semi")
    parts = texts.select("place", "n", F.explode(F.arrays_zip("ts", "tfs")).alias("p")).select("place", "n", "p.ts", "p.tfs").select(
        "place", F.col("ts").alias("t"), saturation("tfs", "n", n_docs, n_words).alias("part"))
    scored = seeds.join(asked.select("q", "t", "w"), "q").join(parts, ["place", "t"]).groupBy("q", "place").agg(
        F.sum(F.col("w") * F.col("part")).alias("score"))
    floors = kth_best(scored, k)
    # Lists that can matter: the sum of the summaries from the term on reaches the limit.
    after = Window.partitionBy("q").orderBy(F.desc("df"), F.desc("t"))
    needed = asked.join(floors, "q", "left").withColumns({"tail": F.collect_list("t").over(after), "reach": F.sum("most").over(after)})
    needed = needed.where((F.col("reach") > 0) & (F.col("reach") >= F.coalesce("floor", F.lit(1))))
    needed = stored(needed.select("q", "t", "df", F.coalesce("floor", F.lit(1)).alias("floor"), "tail"), "needed-lists")
    size = needed.agg(F.sum(F.size("tail"))).first()[0]
    answers = spark.createDataFrame([], f"q long, place long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long")
    ordered = counts.repartitionByRange(width(spark, n_docs), "sig", "place").sortWithinPartitions("sig", "place")
    for part in slices(needed, "t", size or 0, entries) if size else []:
        rows = part.toPandas()  # at most about ``entries`` numbers
        if not len(rows):
            continue
        known = spark.createDataFrame([(int(t),) for t in np.unique(np.concatenate(rows["tail"].to_numpy()))], "t long")
        weights = {r.t: r.w for r in of.join(known, "t").select("t", "w").toLocalIterator()}
        lists = Lists(rows, weights, n_docs, n_words)
        built = stored(blocks(ordered, lists, block), "blocks")
        better = {r.q: r.floor for r in kth_best(scores(visit(built, lists, True), counts, lists), k).toLocalIterator()}
        lists.limits = np.maximum(lists.limits, np.array([better.get(q, 0) for q in lists.items.tolist()], np.int64))
        found = stored(visit(built, lists, False), "visited")
        if report is not None:
            for name in ("visited", "left"):
                report[name] = report.get(name, 0) + (found.agg(F.sum(name)).first()[0] or 0)
        answers = answers.unionByName(stored(scores(found, counts, lists), "scored"))
    whole = answers.groupBy("q", "place").agg(F.max("score").alias("score"), F.first("doc_id").alias("doc_id"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = whole.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(numbers, "q").select("item_id", "rank", "doc_id", "score")
