"""Similarity joins, near vectors, components and URL groups against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cdcmart.llm import components, jaccard, links, neardup, urlfilter
from cdcmart.llm.common import run_folder

SMALL = "/root/testdata/sf0.001"
_WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")


def groups_of(nodes, pairs):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def brute_jaccard(rows):
    """n_links and class of every row (id, text); ids are distinct and not null."""
    sets = {}
    for i, text in rows:
        w = _WORD.findall((text or "").lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    ids = sorted(sets)
    pairs = []
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                pairs.append((a, b))
    group = groups_of(ids, pairs)
    count = dict.fromkeys(ids, 0)
    for a, b in pairs:
        count[a] += 1
        count[b] += 1
    return {i: (count[i], group[i]) for i in ids}


def near_texts(seed=5):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    base = [rnd.choice(vocabulary) for _ in range(120)]
    out = [None, "", "!?", "one two", "One  TWO", "one two three"]
    for changes in (0, 0, 1, 1, 2, 2, 3, 3, 4, 4, 5, 6, 8, 10) * 3:
        words = list(base)
        for _ in range(changes):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        out.append(" ".join(words))
    for _ in range(30):
        out.append(" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 60))))
    shared = " ".join(base[:60])
    out += [f"{shared} {' '.join(rnd.choice(vocabulary) for _ in range(80))}" for _ in range(20)]
    return list(enumerate(out))


@pytest.mark.parametrize("tile, bucket", [(1024, 256), (4, 6)])
def test_join_equals_brute_force(spark, monkeypatch, tile, bucket):
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "BUCKET", bucket)
    rows = near_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_links", F.lit("clash"))
    got = {r.doc_id: (r.n_links, r.class_id) for r in jaccard.join_similar(docs).collect()}
    assert got == brute_jaccard(rows)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in got.items() if c == i}


def test_join_over_the_given_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: (r.n_links, r.class_id) for r in jaccard.join_similar(docs).collect()}
    assert got == brute_jaccard(rows)


def test_join_edges(spark):
    text = "one two three four five six seven eight"
    rows = [(2, text), (2, text), (1, text.upper()), (None, text), (None, None), (5, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(jaccard.join_similar(docs).collect(), key=str)
    linked = [r for r in got if r.n_links]
    assert len(linked) == 4 and {(r.class_id, r.n_links) for r in linked} == {(1, 3)}
    assert [r.kept for r in got].count(True) == 4
    assert sorted((r.doc_id is None, r.doc_id, r.text) for r in jaccard.one_of_each(docs).collect() if r.text)[0][1] == 1
    assert jaccard.one_of_each(docs.where("doc_id = 2")).count() == 1
    assert jaccard.one_of_each(docs.limit(0)).count() == jaccard.join_similar(docs.limit(0)).count() == 0


def test_long_sets_are_compared_in_runs():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(30)] + [np.zeros(0, np.uint64)]
    for limit in (1, 50, 10**6):
        got = jaccard.linked_sets(sets, sets, 0.5, limit)
        want = [[len(np.intersect1d(x, y)) >= 0.5 * len(np.union1d(x, y)) > 0 for y in sets] for x in sets]
        # A set and itself are no pair.
        assert ((got == np.array(want)) | np.eye(31, dtype=bool)).all()
        assert (jaccard.linked_sets(sets[:7], sets[9:], 0.5, limit) == np.array(want)[:7, 9:]).all()


def test_runs_follow_from_the_recall():
    assert jaccard.runs_for(0.8, 0.9) < jaccard.runs_for(0.8, 0.9999)
    rng = np.random.default_rng(3)
    tokens = rng.integers(0, 1 << 32, (400, jaccard.TOKENS), dtype=np.uint64).astype(np.uint32)
    other = np.where(rng.random(tokens.shape) < 0.8, tokens, tokens + 1).astype(np.uint32)
    runs = jaccard.runs_for(0.8, 0.99, jaccard.LEAST_DEPTH)
    one, two = ({*zip(*map(np.ndarray.tolist, jaccard.first_nodes(t, runs, 0.8)))} for t in (tokens, other))
    assert len({row for row, _ in one & two}) / 400 > 0.97


def test_components_of_random_graphs(spark):
    rnd = random.Random(2)
    for n, m in ((40, 25), (60, 90), (30, 0)):
        pairs = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)] + [(k, k + 1) for k in range(100, 130)]
        edges = spark.createDataFrame([*pairs, (7, 7), (None, 3), (500, None)], "a long, b long")
        got = {r.node: r.component for r in components.components(edges, run_folder(spark, "test")).collect()}
        real = [(a, b) for a, b in pairs if a != b]
        want = groups_of({x for p in real for x in p}, real)
        assert got == want
    none = spark.createDataFrame([], "a string, b string")
    assert components.components(none, run_folder(spark, "test")).collect() == []


def test_local_groups():
    rnd = random.Random(4)
    pairs = [(rnd.randrange(50), rnd.randrange(50)) for _ in range(40)]
    found = dict(links.local_groups(*map(np.array, zip(*pairs))))
    want = groups_of({x for p in pairs for x in p}, pairs)
    assert {(a, b): found[a] == found[b] for a in found for b in found} == {
        (a, b): want[a] == want[b] for a in want for b in want}


def brute_vectors(rows, threshold):
    unit = {i: np.array(v, float) / np.linalg.norm(v) for i, v in rows}
    ids = sorted(unit)
    pairs = [
        (a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold
    ]
    group, count = groups_of(ids, pairs), dict.fromkeys(ids, 0)
    for p in pairs:
        for x in p:
            count[x] += 1
    return {i: (count[i], group[i], group[i] == i) for i in ids}


@pytest.mark.parametrize("block, width", [(8192, 40), (16, 40), (16, 3), (8, 1)])
def test_near_vectors_equal_brute_force(spark, block, width):
    rng = np.random.default_rng(width)
    base = rng.normal(size=(30, width))
    data = np.concatenate([base, base[:10] + 0.3 * rng.normal(size=(10, width)), base[:5] * 7, np.repeat(base[:1], 12, 0)])
    data = np.concatenate([data, base[:1] + 0.05 * rng.normal(size=(20, width))]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(data)] + [(900, [1.0] * (width + 2)), (901, [2.0] * (width + 2))]
    odd = [(1000, None), (1001, []), (1002, [0.0] * width), (1003, [float("nan")] * width), (1004, [float("inf")] * width),
           (1005, [None] * width), (1006, [1e-30] * width)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("n_links", F.lit(0))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in neardup.near_duplicates(frame, block=block).collect()}
    for i, _ in odd[:-1]:
        assert got.pop(i) == (0, i, True)
    assert got == brute_vectors(rows + odd[-1:], 0.9)


def test_near_vectors_edges(spark):
    frame = spark.createDataFrame([(3, [1.0, 2.0]), (3, [1.0, 2.0]), (None, [1.0, 2.0]), (1, [2.0, 4.0])], "vec_id long, embedding array<double>")
    got = neardup.near_duplicates(frame).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(3, 1)} and [r.kept for r in got].count(True) == 1
    assert neardup.near_duplicates(frame.limit(0)).count() == 0


def test_close_pairs_give_up_early_but_never_wrongly():
    rng = np.random.default_rng(8)
    fit = neardup.Fit(rng.normal(size=(200, 50)) * np.linspace(3, 0.1, 50), 8)
    data = rng.normal(size=(150, 50)) * np.linspace(3, 0.1, 50)
    turned = fit.turned(data)
    assert np.allclose(turned @ turned.T, neardup.normed(data) @ neardup.normed(data).T)
    got = {*zip(*map(np.ndarray.tolist, neardup.close_pairs(turned, turned, 0.6)))}
    assert got == {*zip(*map(np.ndarray.tolist, np.nonzero(turned @ turned.T >= 0.6)))}
    leaf = fit.leaf(turned)
    boxes = np.array([[*turned[leaf == k, :8].min(0), *turned[leaf == k, :8].max(0),
                       np.linalg.norm(turned[leaf == k, 8:], axis=1).max()] for k in sorted(set(leaf.tolist()))])
    number = {k: n for n, k in enumerate(sorted(set(leaf.tolist())))}
    for i, j in got:
        assert number[leaf[j]] in neardup.reachable(boxes, number[leaf[i]], 0.6)


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def test_rules_hosts_and_paths(spark):
    urls = {
        1: "http://A.Example.NET/en/1?x#y", 2: "http://example.net/de/", 3: "https://notexample.net/en/", 4: "http://x.example.com/de/a",
        5: "http://x.example.com/d", 6: "http://a.org/fr/", 7: None, 8: "no scheme/de/", 9: "http://net", 10: "http://net?/", 11: "http://e.org#/fr/",
        12: "http://example.com:80/de/", 13: "", 14: "://",
    }
    pages = spark.createDataFrame([(i, u, None) for i, u in urls.items()] + [(1, urls[1], "")], "page_id long, url string, html string")
    got = [r for r in urlfilter.judge(pages.withColumn("rule", F.lit(1)).withColumn("form", F.lit(2)), RULES).collect()]
    assert len(got) == 15
    by = {r.page_id: r for r in got}
    assert (by[1].host, by[1].path, by[1].rule, by[1].verdict) == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert [(by[i].rule, by[i].verdict) for i in (2, 3, 4, 6)] == [
        ("net/", "block"), ("net/", "block"), ("example.com/de/", "block"), ("org/fr/", "allow")]
    for i in (5, 7, 8, 9, 10, 11, 12, 13, 14):
        assert (by[i].rule, by[i].verdict) == (None, "allow"), i
    assert (by[7].host, by[7].path, by[8].host, by[10].path) == ("", "", "", "")
    assert urlfilter.judge(pages.limit(0), RULES).count() == 0


def test_decisions_reach_aliases(spark):
    link = '<html><LINK href="{}" rel=canonical><p>'
    refresh = "<meta content='0; url={}' http-equiv='refresh'>"
    pages = [
        (1, "http://bad.net/x", None), (2, "http://a.io/1", link.format("http://bad.net/x")), (3, "https://a.io/1/?utm_source=f#top", ""),
        (4, "http://b.io/2", refresh.format("http://a.io/1")), (5, "http://c.io/", link.format("http://ok.org/fr/")), (6, "http://ok.org/fr/", ""),
        (7, "http://d.io/7", link.format("/8")), (8, "http://d.io/8", link.format("//bad.net/x")),
        (9, "http://e.io", link.format("http://bad.net/x") + refresh.format("http://ok.org/fr/")), (10, "http://f.io/", link.format("relative")),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in urlfilter.judge(frame.where("page_id <> 9"), RULES).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "block", 8: "block", 10: "allow"}
    # An explicit allow among the equivalents comes before their blocks; a rule of one's own before both.
    got = {r.page_id: r.verdict for r in urlfilter.judge(frame, RULES).collect()}
    assert got[1] == "block" and got[2] == got[9] == "allow"
    more = spark.createDataFrame([("http://f.io/", "http://bad.net/x"), (None, "http://f.io/")], "a string, b string")
    assert {r.page_id: r.verdict for r in urlfilter.judge(frame.where("page_id <> 9"), RULES, more).collect()}[10] == "block"


def test_relative_links_lead_to_their_pages(spark, tmp_path):
    """Each page links to the blocked one by another form of its url; the SQL of the query agrees."""
    duckdb = pytest.importorskip("duckdb")
    from cdcmart.llm.queries import QUERIES, SQL

    link = "<link rel='canonical' href='{}'>"
    bad = "http://x.example.com/de/bad"
    to = {
        "http://x.example.com/de/a": "bad", "http://x.example.com/fr/a": "../de/bad", "http://x.example.com/fr/b/c/": "../../../de/./bad",
        "http://x.example.com": "de/bad", "http://x.example.com/es/q": "/es/../de/bad", "http://y.io/a?b": "//x.example.com/de/bad",
        "http://x.example.com/../a": "../../../de/bad", "http://x.example.com/it/a/b": "..", "http://x.example.com/it/": "./z/../../de/bad#top",
        "http://z.io/1": "http://x.example.com/de/bad/", "http://z.io/2": "mailto:http", "http://z.io/3": "#de", "http://z.io/4": "de/bad?u=http://a.b",
        "http://x.example.com/nl/p?x": "?p=1&amp;q=2", "http://x.example.com/nl/r": "/nl/p?p=1&#38;q=2",
    }
    pages = [(0, bad, "")] + [(i, url, link.format(t)) for i, (url, t) in enumerate(to.items(), 1)]
    pages += [(90, "http://x.example.com/nl/p?p=1&q=2", link.format("/de/bad")), (91, "http://x.example.com/it", None), (92, None, link.format("x"))]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: r.verdict for r in QUERIES["op9_url_filter"](spark, str(tmp_path)).collect()}
    left = {i for i, verdict in got.items() if verdict == "allow"}
    ids = {url: i for i, (url, _) in enumerate(to.items(), 1)}
    assert left == {ids[u] for u in ("http://z.io/2", "http://z.io/3", "http://z.io/4")} | {92}
    db = duckdb.connect()
    db.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    want = db.execute(SQL["op9_url_filter"])
    columns = [d[0] for d in want.description]
    found = QUERIES["op9_url_filter"](spark, str(tmp_path)).select(*columns).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want.fetchall()))


def test_the_vectors_of_the_query_against_brute_force(spark, tmp_path):
    """Every vector of the given table, and turned copies of a fifth of them, by double precision."""
    from cdcmart.llm.queries import QUERIES

    rng = np.random.default_rng(7)
    given = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    for i, vector in given[::5]:
        for k in range(1, 4):
            noise = rng.normal(size=len(vector)) * np.linalg.norm(vector) / len(vector) ** 0.5
            given.append((10_000 * k + i, [float(x) for x in np.array(vector) + rng.choice([0.1, 0.35, 0.48]) * noise]))
    spark.createDataFrame(given, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    rows = spark.read.parquet(f"{tmp_path}/embeddings.parquet").collect()
    data = np.array([r.embedding for r in rows], np.float64)
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    near = data @ data.T >= 0.9
    ids = np.array([r.vec_id for r in rows])
    component = ids.copy()
    while True:
        least = np.where(near, component[None, :], component.max()).min(axis=1)
        if (least == component).all():
            break
        component = least
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in QUERIES["op7_near_vectors"](spark, str(tmp_path)).collect()}
    want = {int(i): (int(n) - 1, int(c), int(i) == int(c)) for i, n, c in zip(ids, near.sum(axis=1), component)}
    assert got == want and len({n for n, _, _ in want.values()}) > 2
