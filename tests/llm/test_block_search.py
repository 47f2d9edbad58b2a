"""The block search against a plain ranking of every document, and its parts."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from labelloop.llm import block_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def plain(docs, items, k=10):
    """{item: [(rank, doc_id, score)]} by scoring every document."""
    texts = [(i, Counter(TERM.findall((t or "").translate(UPPER)))) for i, t in docs]
    texts = [(i, c) for i, c in texts if c]
    n_docs, words = len(texts), sum(sum(c.values()) for _, c in texts)
    df = Counter(t for _, c in texts for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(TERM.findall((t or "").translate(UPPER)))
    out = {}
    for item, terms in asked.items():
        scored = []
        for i, c in texts:
            m = 10 + 90 * sum(c.values()) * n_docs // words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in terms if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out[item] = [(r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return {i: rows for i, rows in out.items() if rows}


def answers(found):
    out = {}
    for r in found.collect():
        out.setdefault(r.item_id, []).append((r.rank, r.doc_id, r.score))
    return {i: sorted(rows) for i, rows in out.items()}


def corpus(seed, n=1500, words=400, families=30):
    """Documents of families that share words, with copies, and items from their words."""
    rng = np.random.default_rng(seed)
    names = [f"w{i}" for i in range(words)]
    own = [rng.choice(words, 40, replace=False) for _ in range(families)]
    docs = []
    for i in range(n):
        f = own[int(rng.integers(families))]
        picks = np.concatenate([rng.choice(f, int(rng.integers(1, 40))), (rng.pareto(1.0, int(rng.integers(1, 60))) * 3).astype(int) % words])
        docs.append((i, " ".join(names[j] for j in picks)))
    docs += [(n + i, docs[i % 7][1]) for i in range(200)]
    items = [(q, " ".join(names[j] for j in rng.choice(own[q % families], 12)) + " w0 w1 w2") for q in range(40)]
    return docs, items


@pytest.fixture(scope="module")
def make_items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "'x' as q", "'x' as t", "'x' as term")


@pytest.mark.parametrize("options", [{}, {"vocabulary": 60, "entries": 900}, {"block": 4}])
def test_search_equals_scoring_everything(make_docs, make_items, options):
    docs, items = corpus(1)
    report = {}
    found = answers(block_search.top_documents(make_docs(docs), make_items(items), report=report, **options))
    assert found == plain(docs, items)
    assert report["visited"] > 0 and report["left"] > 0      # some blocks are ruled out by their bounds


def test_odd_rows(odd_docs, make_docs, make_items, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    items = [(1, "one TWO three"), (2, None), (3, ""), (4, "nowhere"), (5, "same text"), (5, "first second"), (None, "word1 and3"),
             (6, "no id at all"), (7, "é" * 50), (8, "... \n"), (5, "same text")]
    assert answers(block_search.top_documents(odd_docs, make_items(items))) == plain(docs, items)
    assert block_search.top_documents(no_docs, make_items(items)).count() == 0
    assert block_search.top_documents(odd_docs, make_items([])).count() == 0


def test_ties_and_letters(make_docs, make_items):
    docs = [(i, "alpha beta") for i in range(50, 0, -1)] + [(None, "alpha beta"), (100, "ÀB_c1 x"), (101, "Àb c1 x"), (102, "gamma")]
    items = [(1, "ALPHA"), (2, "àb c1"), (3, "Àb C1"), (4, "c1 x"), (5, "gamma alpha")]
    found = answers(block_search.top_documents(make_docs(docs), make_items(items)))
    assert found == plain(docs, items)
    assert [d for _, d, _ in found[1]] == list(range(1, 11))


def test_terms_are_the_matches_of_the_pattern():
    every = "".join(map(chr, range(0x250))) + "  \U0001f600x ſK İ"
    assert [t.decode() for t in block_search.terms(every)] == TERM.findall(every.translate(UPPER))
    assert block_search.terms(None) == [] == block_search.terms("")


def test_blocks_hold_every_row_once_and_similar_rows_together():
    rng = np.random.default_rng(0)
    x = np.zeros((300, 30), np.int64)
    for i in range(300):
        x[i, (i // 100) * 10:(i // 100) * 10 + 10] = rng.integers(50, 100, 10)
    made = block_search.clusters(x, 64)
    assert sorted(np.concatenate(made)) == list(range(300)) and max(map(len, made)) <= 64
    assert all(len({int(i) // 100 for i in b}) == 1 for b in made)


def test_table_query_equals_plain_ranking(spark, read, sf_dir):
    from labelloop.llm.queries import QUERIES
    docs = [(r.doc_id, r.text) for r in read("documents").select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in read("benchmark").select("item_id", "text").collect()]
    assert answers(QUERIES["op11_block_search"](spark, sf_dir)) == plain(docs, items)
