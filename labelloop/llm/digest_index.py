"""Exact deduplication against a persistent index of digests.

The index is a Parquet table of one row per distinct text ever seen: its SHA-256
digest and the row that stays.  It lies in a folder of the caller's, bucketed and
sorted by the digest, so that a later batch is joined with it bucket by bucket
and only the batch is shuffled.  A batch is reduced to one row per digest
(partial aggregates run before the shuffle, so a text that holds a third of the
rows is one row per task), what the index already has falls out in a sort-merge
anti-join, and the rest is appended.  Adding a batch again appends nothing.

Texts are equal when identical after lower-casing A to Z only.  What is in the
index stays: among rows of one batch that are equal, the one with the largest id
does.  ``duplicates`` therefore adds a table from its largest ids downwards, in
batches, which makes the largest id of the whole table stay.

Everything is DataFrame and SQL functions.  Defined cases: a null text is the
empty text; a row without an id stays only if no equal row has one; of repeated
rows (one id, one text) exactly one stays; an empty table gives an empty result;
only the id and the text are read, whatever other columns are called.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloop.llm.common import stored
from labelloop.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """``text`` with A to Z lower-cased and nothing else; null is empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # In a text of one byte a character, lower() can meet no letter but A to Z.
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, origin, place) of every row, stored; ``origin`` and ``place`` tell repeated rows apart."""
    return stored(df.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(normalised(F.col(text_col)), 256)).alias("digest"),
                            F.lit(uuid.uuid4().hex).alias("origin"), F.monotonically_increasing_id().alias("place")), "digests")


class DigestIndex:
    """An index in ``path``; opening an existing one needs the number of buckets that it was made with."""

    def __init__(self, spark: SparkSession, path: str, id_type: T.DataType | str = "long", buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = "digests_" + hashlib.md5(path.encode()).hexdigest()
        kind = id_type if isinstance(id_type, str) else id_type.simpleString()
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id {kind}, keep_origin STRING, keep_place BIGINT) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {int(buckets)} BUCKETS LOCATION '{path}'")

    def table(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def unseen(self, batch: DataFrame) -> DataFrame:
        """(digest, keep_id, keep_origin, keep_place): one row for each digest of ``batch`` that the index lacks."""
        heads = batch.groupBy("digest").agg(F.max(F.struct("doc_id", "origin", "place")).alias("keep")).select(
            "digest", F.col("keep.doc_id").alias("keep_id"), F.col("keep.origin").alias("keep_origin"),
            F.col("keep.place").alias("keep_place"))
        # Stored, the batch has no partitioning of its own left, so that it is shuffled to the index's buckets and never the
        # other way round.  It has one row per digest by now, so no bucket is hot.
        return stored(heads, "digest-heads").join(self.table().select("digest").hint("merge"), "digest", "left_anti")

    def add(self, batch: DataFrame) -> None:
        """Append what ``batch`` (doc_id, digest, origin, place) has and the index lacks."""
        (self.unseen(batch).repartition(self.buckets, "digest").write.format("parquet").mode("append")
         .bucketBy(self.buckets, "digest").sortBy("digest").option("path", self.path).saveAsTable(self.name))

    def close(self) -> None:
        """Forget the table's name; the files stay and can be opened again."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def new_rows(df: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns unchanged, whose text the index did not have; they are added to it.

    Of equal rows of ``df`` that with the largest id is returned.
    """
    rows = df.withColumns({"__digest": F.unhex(F.sha2(normalised(F.col(text_col)), 256)), "__origin": F.lit(uuid.uuid4().hex),
                           "__place": F.monotonically_increasing_id()})
    rows = stored(rows, "new-rows")
    batch = rows.select(F.col(id_col).alias("doc_id"), F.col("__digest").alias("digest"), F.col("__origin").alias("origin"),
                        F.col("__place").alias("place"))
    index.add(batch)
    stay = index.table().select(F.col("digest").alias("__digest"), F.col("keep_origin").alias("__origin"),
                                F.col("keep_place").alias("__place"))
    return rows.join(stay, ["__digest", "__origin", "__place"], "left_semi").select(*df.columns)


def duplicates(df: DataFrame, index: DigestIndex | None = None, batches: int = 2, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of ``df``.

    ``index`` must be empty or hold only rows of larger ids; without one, one is
    made in the scratch folder.  ``batches`` cuts the ids at approximate quantiles.
    """
    spark = df.sparkSession
    rows = digests(df, id_col, text_col)
    if index is None:
        index = DigestIndex(spark, scratch_path(spark, "digest-index"), rows.schema["doc_id"].dataType)
    shares = [i / batches for i in range(1, batches)]
    cuts = rows.select(F.percentile_approx("doc_id", shares, 10000)).first()[0] if shares else None
    edges = sorted(set(cuts or []), reverse=True)
    for above, below in zip([None, *edges], [*edges, None], strict=True):
        part = F.lit(True) if above is None else F.coalesce(F.col("doc_id") < F.lit(above), F.lit(True))  # no id: the last batch
        index.add(rows.where(part & (F.lit(True) if below is None else F.col("doc_id") >= F.lit(below))))
    sizes = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    groups = stored(sizes.join(index.table(), "digest"), "digest-groups")
    out = rows.join(groups, "digest").select(
        "doc_id", "keep_id", "group_size", ((F.col("place") == F.col("keep_place")) & (F.col("origin") == F.col("keep_origin"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
    index.close()
    return out
