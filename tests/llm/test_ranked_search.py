"""Ranked search against brute force over all documents; bounds; odd rows."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cdcmart.llm import lexical
from cdcmart.llm.words import words_of

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"
_TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def terms(text):
    return _TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    held = [(doc_id, terms(text)) for doc_id, text in docs]
    held = [(doc_id, own) for doc_id, own in held if own]
    documents, total = len(held), sum(len(own) for _, own in held)
    df = {}
    for _, own in held:
        for t in set(own):
            df[t] = df.get(t, 0) + 1
    out = []
    for item in {i for i, _ in items}:
        wanted = [t for text in {x for i, x in items if i == item} for t in terms(text)]
        scores = []
        for doc_id, own in held:
            m = 100 - 75 + (75 * len(own) * documents) // total
            score = 0
            for t in wanted:
                tf = own.count(t)
                if tf:
                    score += math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * ((10**9 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is not None, doc_id or 0, doc_id))
        scores.sort(key=lambda s: s[:3])
        out += [(item, n, s[3], -s[0]) for n, s in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


def made(seed, documents=120, items=12):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["é", "ÀB", "x-y", "Z"]
    text = lambda n: " ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=n))
    docs = [(i, text(rng.choice([1, 5, 30, 200]))) for i in range(documents)]
    return docs, [(i, text(rng.randint(1, 20))) for i in range(items)]


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_results_equal_brute_force(spark, seed):
    docs, items = made(seed)
    docs += [docs[3], docs[3], (None, docs[4][1]), (None, docs[4][1]), (900, None), (901, ""), (902, "-!-"), (903, "w1 " * 20_000)]
    docs += [(1000 + i, "w50 w51 W52 é") for i in range(200, 0, -1)]
    items += [(None, "w5 w7"), (50, None), (51, ""), (52, "nowhere"), (53, "W52 é é"), items[0], (1, "w3 w4")]
    frame = spark.createDataFrame(docs, DOCS).repartition(3).withColumn("score", F.lit(1)).withColumn("a.b", F.lit(1))
    wanted = spark.createDataFrame(items, ITEMS).withColumn("key", F.lit(1)).withColumn("a.b", F.lit(1))
    assert result(lexical.report(frame, wanted)) == brute(docs, items)


def test_passes_do_not_change_the_result(spark):
    docs, items = made(9, 60, 10)
    frames = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    want = brute(docs, items, 3)
    assert result(lexical.search(*frames, k=3, pass_terms=20)) == want == result(lexical.search(*frames, k=3))


def test_empty_tables(spark):
    docs, items = made(1, 5, 3)
    docs, items = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.where("1 = 0"), items.where("1 = 0"))):
        found = lexical.report(d, i)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


def test_bounds_are_never_below_the_score(monkeypatch):
    # Few slots: many false bits, which may raise a bound and must not lower one.
    monkeypatch.setattr(lexical, "SLOTS", 2)
    monkeypatch.setattr(lexical, "_AT_ONCE", 7)
    docs, items = made(3, 80, 9)
    texts = [t.encode() for _, t in docs]
    (_, _, words), = words_of(texts)
    counted = [lexical.term_counts(t) for t in texts]
    documents, total = len(docs), sum(c.total() for c in counted)
    asked = []
    for _, text in items:
        own = sorted(lexical.term_counts(text.encode()).items())
        hashes = [int(w.hashes.view(np.int64)[0]) for t, _ in own for _, _, w in words_of([t])]
        asked.append((hashes, [7 * n for _, n in own], own))
    wanted = lexical.Wanted([(h, w) for h, w, _ in asked])
    seen = 0
    for some, n, most, size, bits in lexical._blocks(words):
        block = {"keys": some.tolist(), "n": n.tolist(), "most": most.tolist(), "slots": size, "bits": bits}
        for begin, bounds in wanted.bounds(block, documents, total):
            for i, row in enumerate(bounds):
                for column, doc in enumerate(some):
                    m = lexical.length_factor(counted[doc].total(), documents, total)
                    exact = sum(7 * times * lexical.share(counted[doc][t], m) for t, times in asked[begin + i][2] if t in counted[doc])
                    assert row[column] >= exact
                    seen += 1
    assert seen == len(docs) * len(items)


def test_most_documents_are_excluded(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(lexical, "saved", lambda df, folder, name, real=lexical.saved: sizes.append((name, out := real(df, folder, name))) or out)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    assert lexical.report(docs, items).count() == 10 * items.count()
    left = dict(sizes)["left-0"].count()
    assert left < 0.1 * docs.count() * items.count(), left
