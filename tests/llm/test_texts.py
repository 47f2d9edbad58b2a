"""Fingerprints, main text, packing and the two classifiers against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from labelloop.llm import packing, quality_trees, queries, span_fingerprints, template_removal, toxicity
from labelloop.llm.queries import tokenizer_path


# ---------------------------------------------------------------- fingerprints
def check_fingerprints(rows, docs):
    docs = sorted(docs, key=lambda d: (d[0] is None, d[0] or 0, d[1] or ""))
    texts = [t or "" for _, t in docs]
    want = []
    for i, (doc_id, _) in enumerate(docs):
        text, after = texts[i], texts[(i + 1) % len(texts)]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, b, c = map(span_fingerprints.fingerprint, (text, edited, after))
        want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b,
                     span_fingerprints.likeness(a, b), span_fingerprints.likeness(a, c)))
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3], r[4], round(r[5], 6), round(r[6], 6))
    got = sorted((tuple(r)[:7] for r in rows), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, sorted(want, key=key), strict=True):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:])


def test_fingerprints_of_the_table(spark, sf_dir, read):
    rows = queries.QUERIES["op4_span_fingerprints"](spark, sf_dir).collect()
    check_fingerprints(rows, [(r.doc_id, r.text) for r in read("documents").collect()])
    assert 0.3 < np.mean([r.near_edited for r in rows]) < 0.7 and np.mean([r.near_next for r in rows]) < 0.1


def test_fingerprints_over_many_ranges(read):
    docs = read("documents")
    rows = span_fingerprints.neighbour_fingerprints(docs, range_bytes=20_000).collect()
    check_fingerprints(rows, [(r.doc_id, r.text) for r in docs.collect()])


def test_fingerprints_of_odd_and_empty_tables(odd_docs, no_docs, make_docs):
    check_fingerprints(span_fingerprints.neighbour_fingerprints(odd_docs).collect(), [(r.doc_id, r.text) for r in odd_docs.collect()])
    assert span_fingerprints.neighbour_fingerprints(no_docs).collect() == []
    only = span_fingerprints.neighbour_fingerprints(make_docs([(1, "just one document")])).first()
    assert only.near_next == 1.0


def test_prefix_arrays_answer_span_equality_and_extensions():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ("".join(rng.choice("abé😀") for _ in range(rng.randint(1, 60))) for _ in range(2))
        p, q = span_fingerprints.PrefixHash(a), span_fingerprints.PrefixHash(b)
        i, j = rng.randrange(len(a)), rng.randrange(len(b))
        n = rng.randint(0, min(len(a) - i, len(b) - j))
        assert p.same(i, q, j, n) == (a[i:i + n] == b[j:j + n])
        k = 0
        while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
            k += 1
        assert p.common(i, q, j) == k


def test_likeness_follows_the_shared_text():
    rng = random.Random(5)
    text = " ".join(str(rng.random()) for _ in range(600))
    mild = text[:5000] + "an edit" + text[5000:]
    f = span_fingerprints.fingerprint
    assert f(text) == f(str(text)) and f(text) != f(mild) and span_fingerprints.likeness(f(text), f(mild)) > 0.9
    assert span_fingerprints.likeness(f(""), f("")) == 1 and span_fingerprints.likeness(f(""), f(text)) == 0


# ---------------------------------------------------------------- main text
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<nav><ul><li><a href="/a">Home</a></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>A &amp; B</h1><p>one <b>two<br>three<p>four &eacute; &#x41;<script>var t = "</p>";</script> five
<form><input value="x"><p>search</p></form><aside>side</aside>
<section class="comments"><article class="comment"><p>first!</p></article></section></article>
<footer>&copy; x</footer></body></html>"""


def text_of(html):
    return [t for t, _ in template_removal.blocks(html)[0]]


@pytest.mark.parametrize(("html", "want"), [
    (PAGE, ["A & B", "one two three", "four é A five"]),
    ("", []), ("plain", ["plain"]), ("a<!-- <p>x</p> -->b", ["ab"]), ("<p>x<p>y", ["x", "y"]),
    ("<ul><li>a<li>b</ul>c", ["a", "b", "c"]), ("<article><p title='a>b'>q</article>rest", ["q"]),
    ("<div>&nbsp; a \n b&nbsp;</div>", ["a b"]), ("<main>m</main><div>d</div>", ["m"]), ("<", ["<"]), ("a < b", ["a < b"]),
    ("<article><p>&lt;p&gt;</p></article>", ["<p>"]), ("<script>if (a<b) x</script>t<script>", ["t"]),
    ("<div class=sidebar>s</div><p>t", ["t"]), ("<div role='navigation'>s</div><p>t", ["t"]), ("<p hidden>s</p><p>t", ["t"]),
])
def test_main_text_of_a_page(html, want):
    assert text_of(html) == want


@pytest.mark.parametrize(("html", "want"), [
    ('<body><div style="overflow:hidden">text</div>', "text"), ('<body><p title="hidden gems">text</p>', "text"),
    ('<body><div data-hidden="false">text</div>', "text"), ('<body><div data-class="ad">text</div>', "text"),
    ('<div class="site has-sidebar"><article><p>text</p></article></div>', "text"), ('<body><div class="no-sidebar">text</div>', "text"),
    ('<article class="post comments-open"><p>text</p></article>', "text"), ('<body><section id="related-work">text</section>', "text"),
    ('<article><h2 id="share-prices">prices</h2><p>text</p></article>', "prices\n\ntext"), ('<body><p hidden>no</p>text', "text"),
    ('<body><div class="top ad-box">no</div><div class="site-nav">no</div><div class=cmt>no</div>text', "text"),
    ('<body><div class="x  related-links">no</div><p id=cookie-notice>no</p>text', "text"), ('<body><p aria-hidden="false">text</p>', "text"),
    ('<div class="modal"><article><p>text</p></article></div>', "text"), ('<nav><article>no</article></nav><body><p>text</p>', "text"),
    ('<body><a title="a > b" class="menu">no</a>text', "text")])
def test_words_delete_only_what_they_name(html, want):
    assert "\n\n".join(text_of(html)) == want


def test_deep_and_long_pages():
    assert text_of("<div>" * 3000 + "deep") == ["deep"]
    assert text_of("<article>" + "<p>x y</p>" * 20_000)[-1] == "x y"


def test_recurring_subtrees_of_a_host_go(spark):
    def page(i, host):
        note = "<div id=u1><p>Read our other stories</p></div>" if host == "a.org" else f"<div id=u1><p>note {i}</p></div>"
        return f"<body><div>{note}<p>own words {i}</p><p>shared passage</p></div></body>"
    rows = [(i, f"http://{h}/p{i}", page(i, h)) for i in range(30) for h in ("a.org", "b.org")] + [(99, None, None), (98, "x", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = defaultdict(list)
    for r in template_removal.main_text(pages).collect():
        got[(r.page_id, r.url)].append(r.text)
        assert r.n_chars == len(r.text)
    for i in range(30):
        assert got[(i, f"http://a.org/p{i}")] == [f"own words {i}"]
        assert got[(i, f"http://b.org/p{i}")] == [f"note {i}\n\nown words {i}"]
    assert got[(99, None)] == [""] and got[(98, "x")] == [""]


def test_a_template_of_one_section_of_a_large_host_goes(spark):
    rows = [(i, f"http://a.org/{i}", f"<body><div>{'<div>section menu</div>' if i < 60 else ''}<p>own {i}</p></div></body>")
            for i in range(1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in template_removal.main_text(pages).collect()} == {i: f"own {i}" for i in range(1000)}


def test_an_article_keeps_what_recurs_in_it(spark):
    rows = [(i, f"http://a.org/{i % 50}", f"<div>menu</div><article><h1>t{i % 50}</h1><p>quoted passage</p></article>") for i in range(100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in template_removal.main_text(pages).collect()} == {f"t{i}\n\nquoted passage" for i in range(50)}


def test_notices_side_by_side_in_an_article_go(spark):
    def page(i):
        own = [f"<p>own {i} {k}</p>" for k in range(3 + i % 7)]
        own[i % 3:i % 3] = ["<p>quote one</p>", "<p>quote two</p>"] if i % 2 else ["<p>quoted alone</p>"]
        return f"<article><h1>t{i}</h1>{''.join(own)}<p>Read on with us</p><p>Write to us</p></article>"
    pages = spark.createDataFrame([(i, f"http://a.org/{i}", page(i)) for i in range(24)], "page_id long, url string, html string")
    for r in template_removal.main_text(pages).collect():
        i, lines = r.page_id, r.text.split("\n\n")
        assert lines[0] == f"t{i}" and {f"own {i} {k}" for k in range(3 + i % 7)} <= set(lines)
        assert ("quote two" in lines and "quote one" in lines) if i % 2 else "quoted alone" in lines
        assert "Read on with us" not in lines and "Write to us" not in lines


def test_near_copies_of_an_article_keep_its_text(spark):
    rows = [(i, f"http://a.org/{i}", f"<article><h1>t</h1><p>one</p><p>two</p><p>three</p><p>edit {i}</p></article>") for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in template_removal.main_text(pages).collect()} == {
        i: f"t\n\none\n\ntwo\n\nthree\n\nedit {i}" for i in range(20)}


def test_main_text_of_the_table(spark, sf_dir, read):
    rows = queries.QUERIES["op3_main_text"](spark, sf_dir).collect()
    assert sorted(r.page_id for r in rows) == sorted(r.page_id for r in read("pages").collect())
    assert all("<" not in r.text and r.n_chars == len(r.text) for r in rows) and sum(bool(r.text) for r in rows) == len(rows)


def test_main_text_of_an_empty_table(spark):
    assert template_removal.main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


# ---------------------------------------------------------------- packing
@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(tokenizer_path())


def check_packed(rows, docs, whole, window=4096):
    want = defaultdict(list)
    for doc_id, text in docs:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 2]
        want[doc_id].append(ids)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
        assert 0 < r.length <= window
    assert set(pieces) == set(want)
    for doc_id, texts in want.items():
        expected = sorted((a, min(window, len(ids) - a), zlib.crc32(np.array(ids[a:a + window], "<u4").tobytes()), len(ids))
                          for ids in texts for a in range(0, len(ids), window))
        assert sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces[doc_id]) == expected
    for seats in sequences.values():
        at = 0
        for offset, length in sorted(seats):
            assert offset == at
            at += length
        assert at <= window
    assert sorted(sequences) == list(range(len(sequences)))


def test_packing_of_the_table(spark, sf_dir, read, whole):
    rows = queries.QUERIES["op9_packing"](spark, sf_dir).collect()
    check_packed(rows, [(r.doc_id, r.text) for r in read("documents").collect()], whole)
    n = len({r.sequence_id for r in rows})
    assert sum(r.length for r in rows) / (4096 * n) > 0.95


def test_packing_of_odd_and_empty_tables(odd_docs, no_docs, whole):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    check_packed(packing.pack(odd_docs, tokenizer_path(), 64, group_rows=3).collect(), docs, whole, 64)
    assert packing.pack(no_docs, tokenizer_path()).collect() == []


def test_word_ids_equal_the_whole_tokenizer(whole):
    rng, words = random.Random(1), packing.WordIds(tokenizer_path(), keep=500)
    letters = "ab Zé'sStl2³ªİΣσς.,#<|>\x1c\x85\xa0\u0301ẛ̣한글\u200b\u3000\n\x7f\x80½ǅ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    texts += ["a<|endoftext|>b <|startoftext|>", "don't I'LL x's", ""]
    for a in range(0, len(texts), 100):
        part = texts[a:a + 100]
        assert [x.tolist() for x in words(part)] == [whole.encode(t, add_special_tokens=False).ids for t in part]


def test_plan_uses_every_count_and_fills_windows():
    rng = np.random.default_rng(2)
    edges = packing.length_edges(1024, 16)
    assert edges[-1] == 1024 and (np.diff(edges) > 0).all()
    for shape in (300, 40, 900):
        lengths = np.clip(rng.gamma(2, shape / 2, 5000).astype(int), 1, 1024)
        counts = np.bincount(np.searchsorted(edges, lengths), minlength=len(edges)).astype(float)
        plan = packing.pack_histogram(counts, edges, 1024)
        used = np.zeros(len(edges))
        for pattern, times in plan:
            assert times > 0 and edges[list(pattern)].sum() <= 1024
            np.add.at(used, list(pattern), times)
        assert (used == counts).all()
        assert (counts * edges).sum() / (1024 * sum(t for _, t in plan)) > 0.95


def test_least_squares_is_non_negative_and_optimal():
    rng = np.random.default_rng(4)
    columns = [tuple(rng.integers(0, 8, rng.integers(1, 4)).tolist()) for _ in range(30)]
    target = rng.random(8)
    x = packing.nnls(columns, target)
    a = np.zeros((8, 30))
    for j, c in enumerate(columns):
        np.add.at(a[:, j], list(c), 1)
    slope = a.T @ (target - a @ x)
    assert (x >= 0).all() and slope.max() < 1e-6 and np.abs(slope[x > 0]).max() < 1e-6


# ---------------------------------------------------------------- classifiers
def check_scores(rows, docs, threshold):
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(d.doc_id) for d in docs)
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def held_out_accuracy(rows, labels, column):
    got = {r.doc_id: r.predicted for r in rows if r.held_out}
    pairs = [(got[r.doc_id], int(r[column] > 0)) for r in labels.collect() if r.doc_id in got]
    return np.mean([a == b for a, b in pairs]), len(pairs)


def test_quality_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op10_quality"](spark, sf_dir).collect()
    check_scores(rows, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").collect(), 0.7)
    accuracy, n = held_out_accuracy(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality")
    assert n > 50 and accuracy > 0.95


def test_toxicity_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = queries.QUERIES["op8_toxicity"](spark, sf_dir).collect()
    check_scores(rows, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").collect(), 0.3)
    accuracy, n = held_out_accuracy(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"), "toxic")
    assert n > 500 and accuracy > 0.95  # some 300 toxic examples to learn from; 0.998 with 1,600


@pytest.mark.parametrize(("scores", "threshold", "accepted"), [
    (quality_trees.quality_scores, 0.7, quality_trees.accepted), (toxicity.toxicity_scores, 0.3, toxicity.accepted)])
def test_classifiers_on_odd_and_empty_tables(spark, odd_docs, no_docs, no_labels, scores, threshold, accepted):
    labels = spark.createDataFrame([(3, 1, 1), (3, 0, 0), (4, 0, 1), (5, 1, 0), (6, None, None), (None, 1, 1), (77, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    for known in (labels, no_labels):
        check_scores(scores(odd_docs, known).collect(), odd_docs.collect(), threshold)
        kept = accepted(odd_docs, known)
        assert kept.columns == odd_docs.columns and kept.count() <= odd_docs.count()
    assert scores(no_docs, labels).collect() == [] and accepted(no_docs, labels).collect() == []


def test_trees_learn_and_flat_arrays_agree_with_walking():
    rng = np.random.default_rng(6)
    x = rng.random((2000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    model = quality_trees.fit_trees(x, y, trees=30, depth=3)
    assert ((model.score(x) > 0.5) == y).mean() > 0.97
    for i in range(20):
        total = model.start
        for f, t, leaf in zip(model.feature, model.threshold, model.leaf, strict=True):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + int(x[i, f[node]] > t[node])
            total += leaf[node - len(f)]
        assert model.raw(x[i:i + 1])[0] == pytest.approx(total)


def test_trees_of_one_class_and_of_none():
    assert quality_trees.fit_trees(np.zeros((3, 2)), np.ones(3)).score(np.zeros((1, 2)))[0] > 0.5
    assert quality_trees.fit_trees(np.zeros((0, 2)), np.zeros(0)).score(np.zeros((1, 2)))[0] == 0.5


def test_misspellings_share_subwords():
    rng = random.Random(8)
    clean = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    texts, y = [], []
    for i in range(800):
        words = [rng.choice(clean) for _ in range(rng.randint(5, 120))]
        if i % 2:
            words[rng.randrange(len(words))] = rng.choice(["worthless", "disgusting"])
        texts.append(" ".join(words))
        y.append(i % 2)
    model = toxicity.fit(texts, np.array(y, float), epochs=8)
    base = " ".join(clean[:40])
    score = lambda t: float(model.score([t])[0])
    assert score(base) < 0.1 and min(score(base + " w0rthless"), score(base + " disgustin")) > max(0.2, 5 * score(base))
    assert score(" ".join(clean * 20) + " worthless") > 0.3  # whole text, however long


def test_subword_hashes_do_not_depend_on_the_batch():
    a, of_a = toxicity.subwords(["stupid", "x", "über"], 1 << 16)
    b, of_b = toxicity.subwords(["x"], 1 << 16)
    assert a[of_a == 1].tolist() == b.tolist() and (np.diff(of_a) >= 0).all()
