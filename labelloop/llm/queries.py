"""Queries over the whole tables, one per training-data operator, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloop.llm import (block_search, curriculum, digest_index, hard_negatives, hnsw, link_trust, ngram_join, packing, quality_trees, span_fingerprints, splitter_sharding,
                           template_removal, toxicity)
from labelloop.llm.common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_trust.judge_urls(table(spark, sf_dir, "pages"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_links(table(spark, sf_dir, "documents"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_removal.main_text(table(spark, sf_dir, "pages"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_fingerprints.neighbour_fingerprints(table(spark, sf_dir, "documents"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = splitter_sharding.shard_by_bytes(table(spark, sf_dir, "documents"), 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf_dir, "embeddings"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = curriculum.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.round("position", 9).alias("position"),
                        F.round("second_position", 9).alias("second_position"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_trees.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_search.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_index.duplicates(table(spark, sf_dir, "documents"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_link_trust": op1, "op2_ngram_join": op2, "op3_main_text": op3, "op4_span_fingerprints": op4, "op5_splitter_sharding": op5,
    "op6_nearest_vectors": op6, "op7_curriculum_mix": op7, "op8_toxicity": op8, "op9_packing": op9, "op10_quality": op10,
    "op11_block_search": op11, "op12_digest_index": op12, "op13_hard_negatives": op13,
}

_HOST = r"translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _moment(s: str) -> str:
    """Where the integral of a source's schedule (by its weight 5, 2 or 1) reaches the share ``s``."""
    return (f"CASE w WHEN 5 THEN CASE WHEN {s} < 1 THEN (sqrt(greatest(0, 2.25e0 + {s} * -2e0)) - 1.5e0) / -1e0 ELSE 1 END "
            f"WHEN 2 THEN CASE WHEN {s} < 1 THEN {s} ELSE 1 END "
            f"ELSE CASE WHEN {s} < 0.3125e0 THEN (sqrt(greatest(0, 0.25e0 + {s} * 1e0)) - 0.5e0) / 0.5e0 "
            f"WHEN {s} < 1 THEN 0.5e0 + (sqrt(greatest(0, 0.5625e0 + ({s} - 0.3125e0) * 5e0)) - 0.75e0) / 2.5e0 ELSE 1 END END")


ORACLE = {
    # The SQL sums words with the same order of documents and shares the excess in order of each source's ratio of cap to weight.
    "op7_curriculum_mix": r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT source, source_size, 2 * source_size AS most,
         CASE (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM s),
t AS (SELECT CAST(sum(source_size) AS BIGINT) AS every FROM s),
r AS (
  SELECT *, coalesce(sum(most) OVER o, 0) AS before,
         sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS rest
  FROM w
  WINDOW o AS (ORDER BY most / CAST(w AS DOUBLE), source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT r.*, most * 2 * rest < (3 * every - 2 * before) * w AS full_ FROM r, t),
c AS (SELECT coalesce(sum(most) FILTER (WHERE full_), 0) AS capped, coalesce(sum(w) FILTER (WHERE NOT full_), 0) AS free FROM f),
g AS (
  SELECT source, source_size,
         CASE WHEN full_ THEN CAST(most AS DOUBLE)
              ELSE CAST((3 * every - 2 * capped) * w AS DOUBLE) / CAST(2 * free AS DOUBLE) END AS target,
         CAST(CASE WHEN full_ THEN most ELSE ((3 * every - 2 * capped) * w) // (2 * free) END AS BIGINT) AS words, w
  FROM f, t, c),
p AS (
  SELECT d.doc_id, d.size, d.source,
         sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start
  FROM d),
m AS (
  SELECT p.doc_id, p.size, g.source_size, g.target, g.w,
         CAST(greatest(0, least(p.size, g.words - p.start)) AS BIGINT) AS once,
         CAST(greatest(0, least(p.size, g.words - p.start - g.source_size)) AS BIGINT) AS twice,
         p.start / CAST(g.words AS DOUBLE) AS s1, (p.start + g.source_size) / CAST(g.words AS DOUBLE) AS s2
  FROM p JOIN g ON p.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, once + twice AS taken,
       round(CASE WHEN once > 0 THEN {first} END, 9) AS position, round(CASE WHEN twice > 0 THEN {second} END, 9) AS second_position
FROM m
""".format(first=_moment("s1"), second=_moment("s2")),
    "op11_block_search": r"""
WITH w AS (
  SELECT row_number() OVER () AS place, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
d AS (SELECT place, doc_id, CAST(len(ts) AS BIGINT) AS n, ts FROM w WHERE len(ts) > 0),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM d),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
p AS (
  SELECT place, term, count(*) AS tf FROM (SELECT place, unnest(ts) AS term FROM d)
  WHERE term IN (SELECT term FROM i) GROUP BY place, term),
t AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM p, s GROUP BY term, docs),
r AS (
  SELECT item_id, d.place, d.doc_id,
         CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // words)))) AS BIGINT) AS score
  FROM i JOIN p USING (term) JOIN t USING (term) JOIN d ON d.place = p.place, s
  GROUP BY item_id, d.place, d.doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM r WHERE score > 0
QUALIFY rank <= 10
""",
    "op12_digest_index": r"""
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM d
""",
    "op13_hard_negatives": r"""
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM r AS a JOIN r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
       s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
""",
}
