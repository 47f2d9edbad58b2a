"""Sampled splitters and the curriculum against plain Python."""

import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from labelloop.llm import curriculum, queries, splitter_sharding


def plain_size(text):
    return len((text or "").encode()) + 16


def check_shards(rows, texts, n_shards):
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in rows) == sorted(
        (d is None, d or 0, plain_size(t), zlib.crc32((t or "").encode())) for d, t in texts)
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < n_shards
        slots[r.shard].append(r.slot)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))


def test_every_row_has_a_place_and_shards_are_near_equal(spark, sf_dir, read):
    rows = queries.QUERIES["op5_splitter_sharding"](spark, sf_dir).collect()
    texts = [(r.doc_id, r.text) for r in read("documents").collect()]
    check_shards(rows, texts, 40)
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    total, largest = sum(r.size for r in rows), max(r.size for r in rows)
    per = defaultdict(int)
    for r in rows:
        per[r.shard] += r.size
    assert all(abs(per[s] - total / 40) <= largest + total / 40 * 0.02 for s in range(40))


def test_small_groups_stay_together_and_hot_groups_are_cut(make_docs):
    copies = [(i, "copied text " * 20) for i in range(700)]
    pairs = [(1000 + i, f"pair {i // 2} " * 10) for i in range(1400)]
    rows = splitter_sharding.shard_by_bytes(make_docs(copies + pairs), 10, per_range=16, range_rows=100).collect()
    check_shards(rows, copies + pairs, 10)
    per = defaultdict(int)
    shards = defaultdict(set)
    for r in rows:
        per[r.shard] += r.size
        shards[r.text_crc32].add(r.shard)
    assert max(per.values()) < 1.15 * sum(per.values()) / 10
    assert len(shards[zlib.crc32(copies[0][1].encode())]) > 1
    assert sum(len(s) > 1 for s in shards.values()) == 1


def test_sharding_of_odd_and_empty_tables(odd_docs, no_docs):
    texts = [(r.doc_id, r.text) for r in odd_docs.collect()]
    check_shards(splitter_sharding.shard_by_bytes(odd_docs, 3).collect(), texts, 3)
    assert splitter_sharding.shard_by_bytes(no_docs, 3).collect() == []


def test_overfull_ranges_are_subdivided_and_the_sample_does_not_matter(read):
    docs = read("documents")
    a = splitter_sharding.shard_by_bytes(docs, 7, per_range=1, range_rows=20).collect()
    b = splitter_sharding.shard_by_bytes(docs, 7, per_range=200).collect()
    assert sorted(a) == sorted(b)


def test_shards_are_written_whole(spark, odd_docs, tmp_path):
    docs = odd_docs.drop("shard", "slot")
    splitter_sharding.write_shards(docs, splitter_sharding.shard_by_bytes(docs, 3), str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(map(str, back.drop("shard").select(*docs.columns).collect())) == sorted(map(str, docs.collect()))


def plain_targets(sizes, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(2 * sizes[s] for s in capped)
        target = {s: 2 * sizes[s] for s in capped} | {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if target[s] > 2 * sizes[s]}
        if not over:
            return target
        capped |= over


@pytest.mark.parametrize("which", ["table", "odd"])
def test_mix_meets_targets(spark, sf_dir, odd_docs, which):
    df = curriculum.mix(spark.read.parquet(f"{sf_dir}/documents.parquet") if which == "table" else odd_docs, bucket_rows=5)
    rows = df.collect()
    sizes, taken, targets = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        targets[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
        for p in (r.position, r.second_position):
            assert p is None or 0 <= p <= 1
        assert (r.position is not None) == (r.taken > 0)
        assert r.second_position is None or r.second_position > r.position
    want = plain_targets(sizes)
    for s in sizes:
        assert targets[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= 1
    assert sum(1 for r in rows) == df.count()


def test_mix_equals_its_sql(spark, sf_dir):
    name = "op7_curriculum_mix"
    rows = queries.QUERIES[name](spark, sf_dir).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    assert sorted(map(tuple, rows)) == sorted(con.execute(queries.ORACLE[name]).fetchall())


def test_mix_is_in_training_order(spark, sf_dir, odd_docs):
    for found in (curriculum.mix(odd_docs).collect(), queries.QUERIES["op7_curriculum_mix"](spark, sf_dir).collect()):
        at = [(r.position is None, r.position or 0) for r in found]
        assert at == sorted(at) and len({p for _, p in at}) > 2


def test_mix_of_an_empty_table(no_docs):
    assert curriculum.mix(no_docs).collect() == []


def test_training_order_follows_the_schedules(make_docs):
    docs = make_docs([(i, "w " * (5 + i % 7), f"s{i % 3}") for i in range(300)])
    mixed = curriculum.mix(docs, bucket_rows=10)
    ordered = [r.doc_id for r in curriculum.training_order(docs, bucket_rows=10).collect()]
    reads = sorted((p, r.doc_id) for r in mixed.collect() for p in (r.position, r.second_position) if p is not None)
    assert ordered == [d for _, d in reads]
    where = [p for p, d in reads if d % 3 == 0]  # weight 5 fades: more of it is read early
    assert sum(p < 0.5 for p in where) > len(where) * 0.55


def test_training_order_of_repeated_and_null_ids(make_docs):
    """Every row is read as often as the mix takes it, whatever ids it shares."""
    rows = [(7, "w " * (3 + i % 5), "s0") for i in range(40)] + [(None, f"v{i % 3} " * 4, "s1") for i in range(40)]
    rows += [(100 + i, "x " * 6, f"s{i % 3}") for i in range(20)] + [(5, None, "s0"), (5, "", None)]
    docs = make_docs(rows)
    mixed = curriculum.mix(docs).collect()
    ordered = curriculum.training_order(docs)
    assert ordered.columns == docs.columns
    read = ordered.collect()
    reads = sum(p is not None for r in mixed for p in (r.position, r.second_position))
    assert len(read) == reads < 2 * len(rows)
    words = sum(len((r.text or "").split()) for r in read)
    taken = sum(r.taken for r in mixed)
    assert taken <= words <= taken + 6 * 6      # at most one document of each source is cut off in each pass
    assert Counter((r.doc_id, len((r.text or "").split())) for r in read) == Counter(
        (r.doc_id, r.size) for r in mixed for p in (r.position, r.second_position) if p is not None)


def test_moment_inverts_the_integral(spark):
    from pyspark.sql import functions as F
    knots = ((0.0, 0.5), (0.5, 0.75), (1.0, 2.0))
    rows = spark.range(101).select((F.col("id") / 100).alias("q")).select("q", curriculum.moment_of(F.col("q"), knots).alias("t")).collect()

    def area(t):
        total = 0.0
        for (t0, a), (t1, b) in zip(knots, knots[1:], strict=False):
            x = min(max(t - t0, 0), t1 - t0)
            total += a * x + (b - a) / (t1 - t0) * x * x / 2
        return total
    for r in rows:
        assert area(r.t) == pytest.approx(r.q * area(1.0), abs=1e-9)
