"""Link trust, chosen-path join, graph search and the pipeline against brute force."""

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from labelloop.llm import hnsw, link_trust, ngram_join, queries


# ---------------------------------------------------------------- n-gram join
def shingle_set(text, n=5):
    w = text.lower().split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute_classes(docs, threshold=0.8):
    texts = defaultdict(list)
    for d, t in docs:
        texts[t or ""].append(d)
    names = list(texts)
    sets = [shingle_set(t) for t in names]
    up = list(range(len(names)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    links = set()
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    seen = {p for h in holders.values() for p in combinations(h, 2)}
    for i, j in seen:
        c = len(sets[i] & sets[j])
        if c >= threshold * len(sets[i] | sets[j]):
            links.add((i, j))
            up[find(i)] = find(j)
    groups = defaultdict(list)
    for i, t in enumerate(names):
        groups[find(i)] += texts[t]
    return sorted(sorted(g, key=str) for g in groups.values()), links, names, texts


def found_classes(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r.class_id].append(r.doc_id)
    return sorted(sorted(g, key=str) for g in groups.values())


def words(rng, n):
    return [f"w{rng.randrange(2000)}" for _ in range(n)]


def test_join_of_the_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op2_ngram_join"](spark, sf_dir).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want, links, names, texts = brute_classes(docs)
    assert found_classes(rows) == want
    count = defaultdict(int)
    for i, j in links:
        for d in texts[names[i]]:
            count[d] += len(texts[names[j]])
        for d in texts[names[j]]:
            count[d] += len(texts[names[i]])
    for t in texts.values():
        for d in t:
            count[d] += len(t) - 1
    assert {r.doc_id: r.n_links for r in rows} == {d: count[d] for d, _ in docs}
    for r in rows:
        assert r.class_id <= r.doc_id


def test_large_groups_of_near_copies_connect_without_all_pairs(make_docs):
    rng = random.Random(9)
    base, docs = words(rng, 120), []
    for i in range(400):  # edits of one text, about 0.8 alike among themselves
        w = list(base)
        w[rng.randrange(len(w))] = f"edit{i}"
        docs.append((i, " ".join(w)))
    passage = words(rng, 60)
    for i in range(300):  # a passage in different texts
        docs.append((1000 + i, " ".join(words(rng, 150) + passage + words(rng, 150))))
    docs += [(5000, " ".join(base[:60] + words(rng, 60)))]
    rows = ngram_join.similarity_classes(make_docs(docs), small=16).collect()
    assert found_classes(rows) == brute_classes(docs)[0]
    names = dict(docs)
    sets = {d: shingle_set(names[d]) for d in range(400)}
    linked = sum(len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for i, j in combinations(range(400), 2))
    assert sum(r.n_links for r in rows if r.doc_id < 400) == 2 * linked


def test_large_groups_have_all_their_links(spark, make_docs, tmp_path):
    rng = random.Random(9)
    base, docs = words(rng, 120), []
    for i in range(400):  # two edits of one text: some pairs are links, some are not
        w = list(base)
        for _ in range(2):
            w[rng.randrange(len(w))] = f"edit{i}"
        docs += [(i, " ".join(w))] * (1 + (i % 7 == 0))
    docs += [(1000, None), (1001, ""), (1002, "one two"), (1003, "one two")]
    make_docs(docs).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.QUERIES["op2_ngram_join"](spark, str(tmp_path)).collect()
    _, links, names, texts = brute_classes(docs)
    count = {t: len(d) - 1 for t, d in texts.items()}
    for i, j in links:
        count[names[i]] += len(texts[names[j]])
        count[names[j]] += len(texts[names[i]])
    want = sorted((d, count[t or ""]) for d, t in docs)
    assert sorted((r.doc_id, r.n_links) for r in rows) == want
    assert max(count.values()) > 100


def test_chain_at_the_edge_of_a_large_group_is_not_lost(make_docs):
    rng = random.Random(11)
    base, docs = words(rng, 200), []
    for i in range(120):
        w = list(base)
        w[rng.randrange(20)] = f"e{i}"
        docs.append((i, " ".join(w)))
    far = list(base)
    for k in range(1, 10):  # each a little further from the group
        far = list(far)
        far[60 + 12 * k] = f"far{k}"
        docs.append((500 + k, " ".join(far)))
    rows = ngram_join.similarity_classes(make_docs(docs), small=8, levels=3).collect()
    assert found_classes(rows) == brute_classes(docs)[0]


def test_join_of_odd_and_empty_tables(odd_docs, no_docs):
    rows = ngram_join.similarity_classes(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = defaultdict(set)
    for r in rows:
        by[r.doc_id].add(r.class_id)
    assert by[5] == by[6] == {5} and by[1] == by[2] == by[10] == {1} and by[9] == {9} and by[None] == {None}
    kept = ngram_join.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "3", "None", "4", "5", "7", "8", "9", "9"])
    assert ngram_join.similarity_classes(no_docs).collect() == [] and ngram_join.one_of_each(no_docs).collect() == []


def test_shingles_do_not_depend_on_the_batch():
    texts = ["a b c d e f g", "", "a b", "x a b c d e", "A  b\nC d e"]
    found, counts = ngram_join.shingles(texts)
    assert counts.tolist() == [3, 0, 1, 2, 1]
    parts = np.split(found, np.cumsum(counts)[:-1])
    assert parts[0][0] == parts[3][1] == parts[4][0]
    for t, p in zip(texts, parts, strict=True):
        assert ngram_join.shingles([t])[0].tolist() == p.tolist()


# ---------------------------------------------------------------- link trust
def test_hosts_paths_and_rules(spark):
    cases = [("http://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
             ("https://z.example.net", "z.example.net", "", None, "allow"), ("https://example.net/fr/", "example.net", "/fr/", "net/", "block"),
             ("x://example.com/de/1", "example.com", "/de/1", "example.com/de/", "block"),
             ("x://notexample.com/de/1", "notexample.com", "/de/1", None, "allow"), ("x://a.org?u=://b.net/", "a.org", "", None, "allow"),
             ("http://b.org/fr/é?x", "b.org", "/fr/é", "org/fr/", "allow"), ("no scheme.net/", "", "", None, "allow"),
             (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("http://É.net/\n/x", "É.net", "/\n/x", "net/", "block"),
             ("://net/", "net", "/", "net/", "block"), ("http:///en/", "", "/en/", None, "allow")]
    pages = spark.createDataFrame([(i, c[0], None) for i, c in enumerate(cases)], "page_id long, url string, html string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in link_trust.judge_urls(pages).collect()}
    assert got == {i: tuple(c[1:]) for i, c in enumerate(cases)}


def test_trust_and_distrust_flow(spark):
    edges = {("good.a", "x"): 3, ("x", "y"): 1, ("good.a", "y"): 1, ("z", "bad.b"): 4, ("v", "z"): 1, ("v", "good.a"): 1}
    seeds = {"good.a": (1.0, 0.0), "bad.b": (0.0, 1.0), "lonely": (0.5, 0.0)}
    got = {r.host: (r.trust, r.distrust) for r in link_trust.propagate(
        spark.createDataFrame([(h, *s) for h, s in seeds.items()], "host string, allowed double, blocked double"),
        spark.createDataFrame([(*e, w) for e, w in edges.items()], "src string, dst string, w long"), steps=50, tolerance=1e-9).collect()}
    out = defaultdict(int)
    for (s, _), w in edges.items():
        out[s] += w
    hosts = {h for e in edges for h in e} | set(seeds)
    t, r, d = ({h: seeds.get(h, (0, 0))[0] * 0.15 for h in hosts}, dict.fromkeys(hosts, 0.15),
               {h: seeds.get(h, (0, 0))[1] for h in hosts})
    t0, r0, d0 = dict(t), dict(r), dict(d)
    for _ in range(60):
        t, r = ({h: start[h] + 0.85 * sum(w / out[s] * now[s] for (s, x), w in edges.items() if x == h) for h in hosts} for now, start in ((t, t0), (r, r0)))
        d = {h: max(d0[h], 0.15 * d0[h] + 0.85 * sum(w / out[h] * d[x] for (s, x), w in edges.items() if s == h)) for h in hosts}
    assert set(got) == hosts
    for h in hosts:
        assert got[h] == pytest.approx((t[h] / r[h], d[h]), abs=1e-6)
        assert 0 <= got[h][0] <= 1 and 0 <= got[h][1] <= 1


def test_distrust_runs_to_its_end_in_rings_and_chains(spark):
    edges = [(f"r{i}", f"r{(i + 1) % 3}", 1) for i in range(3)] + [(f"c{i}", f"c{i + 1}", 2) for i in range(20)]
    seeds = [(f"r{i}", 0.0, 0.08) for i in range(3)] + [("c20", 0.0, 1.0)]
    args = spark.createDataFrame(seeds, "host string, allowed double, blocked double"), spark.createDataFrame(
        edges, "src string, dst string, w long")
    got = {r.host: r.distrust for r in link_trust.propagate(*args).collect()}
    assert [got[f"r{i}"] for i in range(3)] == pytest.approx([0.08] * 3, abs=1e-3)   # a ring has what its pages have, not more
    assert [got[f"c{i}"] for i in range(21)] == pytest.approx([0.85 ** (20 - i) for i in range(21)], abs=1e-3)
    with pytest.raises(RuntimeError):
        link_trust.propagate(*args, steps=2)


def test_links_decide_where_no_rule_does(spark):
    link = '<p><a class=x href="http://spam.net/a">s</a> <A HREF=//user@Spam.net:80?x>s</A> <a href="/own">o</a></p>'
    rows = [(1, "http://farm.io/", link), (2, "http://clean.io/", "<a href='https://news.example.net/en/'>n</a>"),
            (3, "http://spam.net/a", None), (4, "http://news.example.net/en/", ""), (5, "http://alone.io/x", "<a href='#top'>t</a>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' host", "1 trust", "2 verdict")
    got = {r.page_id: r.verdict for r in link_trust.judge_urls(pages).collect()}
    assert got == {1: "block", 2: "allow", 3: "block", 4: "allow", 5: "allow"}
    assert link_trust.judge_urls(pages.limit(0)).collect() == []


def test_hosts_without_pages_are_judged_by_the_links_to_them(spark):
    link = "<a href='{}'>s</a>".format
    rows = [(1, "http://farm.io/", link("http://spam.net/") + link("//u@a.Spam.net:80/x?y")),
            (2, "http://half.io/", link("http://example.com/de/1") + link("http://example.com/en/1")),
            (3, "http://good.io/", link("http://b.org/fr/1")), (4, "http://plain.io/", link("http://example.com.au/de/1"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.verdict, r.trust, r.distrust) for r in link_trust.judge_urls(pages).collect()}
    assert got[1] == ("block", 0.0, pytest.approx(0.85)) and got[2] == ("allow", 0.0, pytest.approx(0.425))
    assert got[3][0] == got[4][0] == "allow" and got[3][2] == got[4][2] == 0.0


def test_bought_links_ports_and_unseen_links(spark):
    link = "<a href='{}'>s</a>".format
    unseen = "<!-- " + link("//spam.net/") + " --><script>'" + link("//spam.net/") + "'</script><textarea>" + link("//spam.net/") + \
        "</textarea><a data-href='//spam.net/'>x</a>"
    rows = [(1, "http://buyer.io/", link("//spam.net/")), (2, "http://hidden.io/", unseen), (3, "http://hub.io/", link("http://shop.io:8080/")),
            (4, "http://shop.io:8080/", link("//spam.net/")), (5, "http://shop.io/x", "")]
    rows += [(10 + i, f"http://a{i}.b.org/fr/1", link("http://buyer.io/")) for i in range(29)]       # allowed pages that link to the buyer
    rows += [(100 + i, f"http://ring{i // 50}.io/", link(f"http://ring{1 - i // 50}.io/") + (link("//spam.net/") if i % 50 < 4 else "")) for i in range(100)]
    got = {r.page_id: r for r in link_trust.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1].verdict == "block" and got[1].trust > 0.9
    assert got[2].verdict == "allow" and got[2].distrust == 0
    assert got[3].distrust == pytest.approx(0.85 ** 2) and got[3].verdict == "block"     # what it links to is known by its host, without the port
    assert got[4].host == "shop.io:8080" and got[4].verdict == got[5].verdict == "block" and got[5].distrust == pytest.approx(0.85)
    assert all(got[100 + i].verdict == "allow" for i in range(100))                       # 8 % of links to blocked hosts do not add up


def test_linked_pages_are_judged_as_by_hand(spark):
    """Verdicts of a random web of pages against the same walks over dictionaries."""
    rng = random.Random(4)
    hosts = [f"h{i}.io" for i in range(30)] + ["b.org", "x.net", "y.net"]
    pages = []
    for i in range(400):
        h = rng.choice(hosts)
        to = [rng.choice(hosts[-2:] if h.startswith("h1") else hosts[20:-2] if rng.random() < 0.9 else hosts) for _ in range(rng.randrange(1, 4))]
        path = rng.choice(["/fr/1", "/en/2", "/x"])
        pages.append((i, f"http://{h}{path}", " ".join(f"<a href='//{x}{rng.choice(['/fr/', '/en/', ''])}'>l</a>" for x in to), h, path, to))
    rows = link_trust.judge_urls(spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string")).collect()
    own, edges = defaultdict(list), defaultdict(int)
    for _, _, _, h, path, to in pages:
        fits = [(len(n + p), v) for v, n, p in link_trust.RULES if (h == n or h.endswith("." + n)) and path.startswith(p)]
        own[h].append(max(fits, default=(0, None))[1])
        for x in to:
            edges[h, x] += x != h
    out = defaultdict(int)
    for (s, _), w in edges.items():
        out[s] += w
    share = {h: [v.count(k) / len(v) for k in ("allow", "block")] for h, v in own.items()}
    t0 = {h: 0.15 * share[h][0] for h in own}
    r0, d0 = dict.fromkeys(own, 0.15), {h: share[h][1] for h in own}
    t, r, d = dict(t0), dict(r0), dict(d0)
    for _ in range(200):
        t, r = ({h: z[h] + 0.85 * sum(w / out[s] * v[s] for (s, x), w in edges.items() if x == h and w) for h in own} for v, z in ((t, t0), (r, r0)))
        d = {h: max(d0[h], 0.15 * d0[h] + 0.85 * sum(w / out[h] * d[x] for (s, x), w in edges.items() if s == h and w)) for h in own}
    assert set(own) == set(hosts)
    verdicts = set()
    for row in rows:
        h = row.host
        assert (row.trust, row.distrust) == pytest.approx((t[h] / r[h], d[h]), abs=2e-3)
        if row.rule is None and abs(d[h] - 0.5 * (1 + t[h] / r[h] / 2)) > 0.01:
            assert row.verdict == ("block" if d[h] >= 0.5 * (1 + t[h] / r[h] / 2) else "allow")
            verdicts.add(row.verdict)
    assert verdicts == {"block", "allow"}


def test_urls_of_the_table(spark, sf_dir, read):
    rows = queries.QUERIES["op1_link_trust"](spark, sf_dir).collect()
    assert sorted(r.page_id for r in rows) == sorted(r.page_id for r in read("pages").collect())
    for r in rows:
        fits = [(h + p, v) for v, h, p in link_trust.RULES if (r.host == h or r.host.endswith("." + h)) and r.path.startswith(p)]
        rule = max(fits, key=lambda f: len(f[0]), default=(None, "allow"))
        assert r.rule == rule[0] and (rule[0] is None or r.verdict == rule[1])


# ---------------------------------------------------------------- nearest vectors
def check_nearest(rows, df, count=20, least=0.9):
    want = dict(hnsw.exact(df, count))
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.score, r.vec_id))
        assert r.rank == len(got[r.query_id])
    assert set(got) == {q for q, w in want.items() if w}
    hits = total = 0
    for q, pairs in want.items():
        assert len(got[q]) == len(pairs) and got[q] == sorted(got[q], key=lambda p: (-p[0], p[1]))
        hits += len({v for _, v in pairs} & {v for _, v in got[q]})
        total += len(pairs)
    assert hits >= least * total


def test_nearest_of_the_table(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = queries.QUERIES["op6_nearest_vectors"](spark, sf_dir).collect()
    check_nearest(rows, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def test_copies_ties_lengths_and_unusable_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(size=4) * rng.uniform(0.1, 5)]) for i in range(300)]
    rows += [(1000 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(100)]
    rows += [(2000, None), (2020, [0.0] * 4), (2040, [1.0, None, 0.0, 1.0]), (2060, [float("nan")] * 4), (2080, [float("inf"), 0.0, 0.0, 1.0]),
             (2100, [1.0, 2.0]), (None, [1.0] * 4), (20, [5.0, 5.0, 5.0, 5.0]), (40, rows[40][1]), (2120, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 label", "2 score", "3 rank", "4 v")
    got = hnsw.nearest(df, shards=3, block_rows=7).collect()
    own = defaultdict(list)
    for r in got:
        own[r.query_id].append(r.vec_id)
    assert not {2000, 2020, 2040, 2060, 2080, 2100, 2120} & (set(own) | {v for x in own.values() for v in x})
    assert own[1000] == [1000 + i for i in range(1, 21)] or 20 in own[1000]
    single = df.where("vec_id is null or vec_id not in (20, 40)")
    check_nearest(hnsw.nearest(single, shards=3, block_rows=7).collect(), single, least=0.99)


def test_recall_holds_in_shards_filled_to_the_limit(spark):
    v = np.random.default_rng(5).normal(size=(16_384, 64))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = defaultdict(set)
    for r in hnsw.nearest(df, shards=1, every=100).collect():
        got[r.query_id].add(r.vec_id)
    want = dict(hnsw.exact(df, every=100))
    assert sum(len({i for _, i in w} & got[q]) for q, w in want.items()) >= 0.92 * 20 * len(want)


@pytest.mark.parametrize(("n", "sigma", "outliers"), [(8192, 0.3, 0), (8192, 1.0, 0), (16384, 0.3, 0), (8192, 0.0, 3)])
def test_recall_holds_for_vectors_of_uneven_length(spark, n, sigma, outliers):
    rng = np.random.default_rng(int(sigma * 10) + outliers)
    v = rng.normal(size=(n, 64))
    v *= (rng.lognormal(0, sigma, n) / np.linalg.norm(v, axis=1))[:, None]
    v[:outliers] *= 1e4
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(n), "embedding": v.astype(np.float32).tolist()}),
                               "vec_id long, embedding array<float>")
    check_nearest(hnsw.nearest(df).collect(), df)


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (20, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in hnsw.nearest(df).orderBy("query_id", "rank").collect()] == [
        (0, 1, 20, 1.0), (0, 2, 1, 0.0), (20, 1, 0, 1.0), (20, 2, 1, 1.0)]
    assert hnsw.nearest(df.limit(0)).collect() == []


# ---------------------------------------------------------------- pipeline
def test_pipeline_stages(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    before, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, sf_dir)
        seen[name] = after.cache() if name != "packing" else after
        if name != "packing":
            assert after.columns == docs.columns
            before = seen[name]
    ids = {k: [r.doc_id for r in v.collect()] for k, v in seen.items()}
    clean = [d for d, r in labels.items() if r.quality == 1 and r.toxic == 0]
    assert len(set(clean) & set(ids["quality"])) > 0.98 * len(clean)
    assert len(set(clean) & set(ids["toxicity"])) > 0.97 * len(clean)
    bad = [d for d, r in labels.items() if r.quality == 0 or r.toxic == 1]
    assert len(set(bad) & set(ids["toxicity"])) < 0.1 * len(bad)
    kept = {r.doc_id: r.text for r in seen["toxicity"].collect()}
    groups = brute_classes(list(kept.items()))[0]
    assert sorted(ids["near duplicates"]) == sorted(min(g) for g in groups)
    assert set(ids["mixing"]) <= set(ids["near duplicates"]) and max(ids["mixing"].count(d) for d in set(ids["mixing"])) <= 2
    assert set(ids["packing"]) == set(ids["mixing"])


def test_pipeline_runs_whole(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0 and corpus_pipeline.ORACLE_SQL is None
