"""Runs against brute force, whatever the sizes in which words are appended; texts, odd rows and the query."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cdcmart.llm import runs
from cdcmart.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def brute(words, exponent=4, least=6):
    """Every period tried at every place; a stretch is told by its smallest period."""
    n, found = len(words), {}
    for p in range(1, n // exponent + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and words[j] == words[j + p]:
                j += 1
            if j > i and j - i + p >= max(least, exponent * p):
                found.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted(((a, b - a, p) for (a, b), p in found.items()), key=lambda r: (r[0], r[2]))


def repetitive(rng, n):
    words = []
    while len(words) < n:
        if rng.random() < 0.5:
            words += [rng.randrange(3) for _ in range(rng.randint(1, 9))] * rng.randint(1, 9)
        elif words:
            words += words[-rng.randint(1, min(len(words), 30)) :] * rng.randint(1, 5)
        else:
            words.append(rng.randrange(5))
    return words[:n]


@pytest.mark.parametrize("seed", range(40))
def test_any_sizes_of_append_report_the_same_runs(seed):
    rng = random.Random(seed)
    words = repetitive(rng, rng.randint(0, 300))
    exponent, least = rng.choice([(2, 2), (2, 7), (3, 1), (4, 6)])
    catchers, found, at = runs.SquareCatchers(exponent, least), [], 0
    while at < len(words):
        size = rng.randint(1, rng.choice([1, 4, 200]))
        found += catchers.append(np.array(words[at : at + size]))
        at += size
    found += catchers.finish()
    assert sorted(found, key=lambda r: (r[0], r[2])) == brute(words, exponent, least)


@given(st.lists(st.integers(0, 2), max_size=60))
@settings(max_examples=200, deadline=None)
def test_short_words_of_few_letters(words):
    assert runs.runs_of([np.array(words, np.int64)], 2, 2) == [brute(words, 2, 2)]


def test_runs_are_reported_as_soon_as_nothing_can_change_them():
    catchers = runs.SquareCatchers()
    assert catchers.append(np.array([1, 2] * 10)) == []
    assert catchers.append(np.arange(100, 200)) == [(0, 20, 2)]
    assert catchers.finish() == []


def test_colliding_hashes_cost_time_only(monkeypatch):
    rng = random.Random(5)
    texts = [np.array(repetitive(rng, 120)) for _ in range(20)]
    want = [brute(t.tolist()) for t in texts]
    monkeypatch.setattr(runs, "mixed", lambda h: h % np.uint64(2))
    assert runs.runs_of(texts) == want


def test_no_run_leaves_its_text():
    texts = [np.zeros(n, np.int64) for n in (5, 6, 7, 0, 6)]
    assert runs.runs_of(texts) == [[], [(0, 6, 1)], [(0, 7, 1)], [], [(0, 6, 1)]]


ROWS = [
    (1, "a b " * 4 + "c"), (2, None), (3, ""), (4, " \t\n\x0b\f\r"), (5, "x y " * 8), (6, "\x1cé\x1c " * 6),
    (None, "z " * 6), (1, "a b " * 4 + "c"), (7, "only once"), (8, "w " * 300_000 + "end"), (9, "ab\x00 " * 7),
]


def test_odd_rows_and_clashing_names(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("runs", F.lit("kept"))
    found = runs.find_runs(docs)
    assert found.columns == ["doc_id", "text", "runs", "n_words", "runs_", "collapsed"]
    got = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs_], r.collapsed) for r in found.collect())
    want = []
    for doc_id, text in ROWS:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        found = [(0, 300_000, 1)] if doc_id == 8 else brute(words)
        dropped = {i for s, n, p in found for i in range(s + p, s + n)}
        want.append((doc_id or 0, len(words), found, " ".join(w for i, w in enumerate(words) if i not in dropped)))
    assert got == sorted(want)
    assert runs.find_runs(docs.limit(0)).count() == 0 and runs.report(docs.limit(0)).count() == 0
    dotted = docs.withColumnRenamed("runs", "a.b")
    assert runs.find_runs(dotted, keep=["a.b"]).columns == ["a.b", "n_words", "runs", "collapsed"]
    assert runs.find_runs(dotted).count() == len(ROWS)


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute(words)
    best = None
    for s, m, p in found:
        if best is None or m * best[2] > best[1] * p:
            best = (s, m, p)
    dropped = {i for s, m, p in found for i in range(s + p, s + m)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{m},{p}\n" for s, m, p in found)),
        sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_the_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = QUERIES["op12_periodic_runs"](spark, SMALL)
    assert got.columns == COLUMNS
    # Brute force takes the square of the words: the whole result is compared, but for texts beyond 2,000 words.
    short = {i for i, t in docs if len((t or "").split()) <= 2000}
    want = {i: expected(i, t) for i, t in docs if i in short}
    rows = {r.doc_id: tuple(r) for r in got.collect()}
    assert len(rows) == len(docs) and len(short) > 0.9 * len(docs)
    assert {i: rows[i] for i in short} == want
    assert sum(r[1] > 0 for r in want.values()) > 5


def test_odd_rows_of_the_query(spark):
    rows = [r for r in ROWS if r[0] != 8] + [(i, "p q r s t u v w " * (i % 5 + 1)) for i in range(100, 160)]
    got = runs.report(spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_runs", F.lit("x")))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(expected(*r)) for r in rows)
