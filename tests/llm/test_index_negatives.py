"""The digest index and the hard-negative search, against brute force and on odd tables."""

from collections import Counter, defaultdict

import numpy as np
import pytest

from labelloop.llm import digest_index, hard_negatives
from labelloop.session import scratch_path

UPPER = {c: c + 32 for c in range(65, 91)}


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(UPPER)].append(doc_id)
    out = Counter()
    for ids in groups.values():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            out[(i, keep, len(ids))] += 1
    return out, len(groups)


ODD = [(1, None), (2, ""), (2, ""), (3, "One two"), (3, "one TWO"), (4, "one two"), (None, "one two"), (None, "alone"), (None, "alone"),
       (5, "É"), (6, "é"), (7, "É"), (8, "long " * 50_000), (9, "LONG " * 50_000), (10, "İK"), (11, "İk")]


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_duplicates_of_odd_rows(make_docs, batches):
    out = digest_index.duplicates(make_docs(ODD), batches=batches).collect()
    want, groups = expected(ODD)
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in out) == want
    assert sum(r.kept for r in out) == groups
    assert all(r.doc_id == r.keep_id for r in out if r.kept)
    assert len({r.text_sha256 for r in out}) == groups


def test_duplicates_of_no_rows(no_docs):
    assert digest_index.duplicates(no_docs).count() == 0


def test_a_group_of_a_third_of_all_rows(make_docs):
    rows = [(i, "the same" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    out = digest_index.duplicates(make_docs(rows)).where("group_size > 1").collect()
    assert len(out) == 1000 and {r.keep_id for r in out} == {2997} and [r.doc_id for r in out if r.kept] == [2997]


def test_index_persists_and_replays_append_nothing(spark, make_docs):
    path = scratch_path(spark, "test-index")
    index = digest_index.DigestIndex(spark, path, buckets=4)
    first = digest_index.digests(make_docs([(1, "a"), (2, "A"), (3, "b")]))
    index.add(first)
    index.add(first)
    assert {(r.keep_id) for r in index.table().collect()} == {2, 3} and index.table().count() == 2
    index.close()
    again = digest_index.DigestIndex(spark, path, buckets=4)
    kept = digest_index.new_rows(make_docs([(9, "B"), (10, "c"), (11, "C"), (12, None)]), again)
    assert kept.columns == make_docs([(1, "a")]).columns
    assert sorted(r.doc_id for r in kept.collect()) == [11, 12]
    assert sorted(r.keep_id for r in again.table().collect()) == [2, 3, 11, 12]
    # A row of another table whose place in its table is that of an indexed row is not the row that stays.
    out = digest_index.duplicates(make_docs([(0, "a")]), again).collect()
    assert [(r.keep_id, r.kept) for r in out] == [(2, False)]


def test_index_side_is_not_shuffled(spark, make_docs):
    index = digest_index.DigestIndex(spark, scratch_path(spark, "test-index"), buckets=4)
    index.add(digest_index.digests(make_docs([(i, f"text {i}") for i in range(100)])))
    plan = index.unseen(digest_index.digests(make_docs([(i, f"text {i}") for i in range(50, 150)])))._jdf.queryExecution().executedPlan().toString()
    index_side = plan[plan.index("SortMergeJoin"):].rpartition("FileScan parquet spark_catalog")[0]
    assert "Bucketed: true" in plan and index_side.count("Exchange") == plan.count("Exchange")
    assert "LeftAnti" in plan and "Python" not in plan


def brute(rows, positives=5, k=10, every=100):
    q = {}
    for vec_id, v, label in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[2] is None, r[2] or 0)):
        if vec_id in q or v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q[vec_id] = ([int(np.floor(256 * float(np.float32(x)))) for x in v], (label + 1) % 10 if vec_id % 7 == 0 else label)
    out = set()
    for a, (u, label) in q.items():
        if a % every:
            continue
        s = sorted((-sum(x * y for x, y in zip(u, v, strict=False)), i) for i, (v, _) in q.items() if i != a)
        for ps, p in [(-x, i) for x, i in s if q[i][1] == label][:positives]:
            window = [(-x, i) for x, i in s if q[i][1] != label and 30 * ps <= -100 * x <= 90 * ps][:k]
            out |= {(a, p, rank, i, ps, n) for rank, (n, i) in enumerate(window, 1)}
    return out


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return df.selectExpr("*", "'x' as score", "'x' as slot", "'x' as rb", "'x' as v")


@pytest.mark.parametrize("blocks", [(8192, 1024), (70, 2)])
def test_negatives_equal_brute_force(spark, blocks):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(6, 8))
    rows = [(i, [float(np.float32(x)) for x in base[i % 6] + 0.6 * rng.normal(size=8)], int(rng.integers(0, 4))) for i in range(400)]
    rows += [(400 + i, rows[i][1], rows[i][2]) for i in range(100)]                       # ties between copies
    rows += [(600, None, 1), (601, [1.0] * 8, None), (602, [float("nan")] * 8, 1), (603, [float("inf")] + [0.0] * 7, 1),
             (604, [None] + [1.0] * 7, 1), (None, [1.0] * 8, 1), (500, [0.0] * 8, 2), (501, [0.0] * 8, 2)]
    rows += [(3, rows[3][1], 9), (700, [-1.0] * 8, 3), (701, [1.0] * 8, 2)]               # a repeated id; negative scores
    out = {tuple(r) for r in hard_negatives.hard_negatives(table(spark, rows), row_block=blocks[0], anchor_block=blocks[1]).collect()}
    want = brute(rows)
    assert out == want and len(want) > 100


def test_one_group_of_copies_and_no_rows(spark):
    rows = [(i, [1.0, 0.5], 1 if i % 3 else 2) for i in range(300)]
    assert {tuple(r) for r in hard_negatives.hard_negatives(table(spark, rows), row_block=50).collect()} == brute(rows)
    assert hard_negatives.hard_negatives(table(spark, rows[:0])).count() == 0


def test_products_beyond_doubles_are_exact():
    import pandas as pd
    a, b = pd.DataFrame({"v": [[2.0 ** 30 + 1, 3.0]]}), pd.DataFrame({"v": [[2.0 ** 30 + 1, 1.0], [5.0]]})
    assert hard_negatives.products(a, b).tolist() == [[(2 ** 30 + 1) ** 2 + 3, 5 * (2 ** 30 + 1)]]


def test_slots_merge_downwards():
    lists = hard_negatives.merged({0: [(5, 1), (4, 2)], 2: [(9, 7)]}, 3, 2)
    assert lists == [[(5, 1), (4, 2)], [(5, 1), (4, 2)], [(9, 7), (5, 1)]]
