"""BPE, id files, decontamination and language ID against the libraries and brute force."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cdcmart.llm import bpe, decontam, idfile, langid, words
from cdcmart.llm.queries import tokenizer_file

SMALL = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "\n", "a  b\n\n c  ", "it's we'LL don't", "<|endoftext|>x <|endoftext|><|endoft", "日本語 123 ١٢٣",
    "x\x1c y\x85 z q", "é é 🎉🎉", "1234567890" * 30, "!?" * 200, "aAbB" * 300, " " * 500 + "x", "ab " * 3000,
    "İstanbul ΑΣ. ΑΣ x", "A. B, c.", "ԙԱ ՙ",
]


@pytest.fixture(scope="module")
def texts(spark):
    given = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()]
    return ODD + given


def docs_of(spark, texts, **more):
    rows = [(i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({k: F.lit(v) for k, v in more.items()})


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file(name))


def test_bpe_equals_the_library(spark, texts):
    path, own = tokenizer_file("byte_bpe_50k.json"), library("byte_bpe_50k.json")
    coded = bpe.encode(docs_of(spark, texts, ids="clash", Decoded=1), path)
    assert coded.columns == ["doc_id", "text", "ids", "Decoded", "ids_"]
    back = bpe.decode(coded, path, "ids_")
    assert back.columns[-1] == "decoded_"
    for row in back.collect():
        want = own.encode(row.text or "", add_special_tokens=False).ids
        assert row.ids_ == want
        assert row.decoded_ == own.decode(want, skip_special_tokens=False)


def test_bpe_digests_and_edges(spark):
    path = tokenizer_file("byte_bpe_50k.json")
    rows = bpe.digests(docs_of(spark, [None, "", "a"]).union(docs_of(spark, ["x"])), path).collect()
    nothing = hashlib.sha256(b"").hexdigest()
    assert sorted((r.doc_id, r.n_tokens) for r in rows) == [(0, 0), (0, 1), (1, 0), (2, 1)]
    assert {r.ids_sha256 for r in rows if r.n_tokens == 0} == {nothing}
    assert bpe.digests(docs_of(spark, ["x"]).limit(0), path).count() == 0
    odd = spark.createDataFrame([([None, -1, 10**9, 64],), (None,)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(odd, path).collect()] == ["a", ""]


def test_words_share_the_work_of_their_prefixes():
    vocabulary = bpe.Vocabulary(tokenizer_file("byte_bpe_50k.json"))
    given = sorted({w.encode() for w in ("in", "int", "inter", "internal", "internet", "other", "others", " the")})
    for word, found in zip(given, vocabulary.encode_sorted(given)):
        assert found == vocabulary.merged(word)[0]


def test_bpe_takes_long_texts_in_pieces(monkeypatch):
    path, own = tokenizer_file("byte_bpe_50k.json"), library("byte_bpe_50k.json")
    monkeypatch.setattr(bpe, "_PIECE", 10)
    text = "some words  and   gaps \n\n of " + "unbroken" * 9 + " and more"
    (found,) = bpe.Encoder(path).encode_batch([text])
    assert np.frombuffer(found, np.int32).tolist() == own.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("unit", ["byte", "bit"])
def test_planes_round_trip(unit):
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 9, 1000):
        values = rng.integers(0, 50_000, n).astype("<u4")
        if n:
            planes = idfile.to_planes(values, unit)
            assert len(planes) == (32 if unit == "bit" else 4)
            assert (idfile.from_planes(planes, n, "<u4", unit) == values).all()
        packed = idfile.Segment.pack({"part": 3}, {"ids": values, "none": values[:0]}, unit, block=64) + idfile.END
        head, columns, after = idfile.Segment.unpack(memoryview(packed), 0)
        assert (columns["ids"] == values).all() and len(columns["none"]) == 0 and after == len(packed)
    with pytest.raises(ValueError):
        idfile.Segment.unpack(memoryview(packed[:-9]), 0)
    with pytest.raises(ValueError):
        idfile.Segment.unpack(memoryview(packed), 1)


def test_id_files_read_back(spark, texts, tmp_path, monkeypatch):
    monkeypatch.setattr(idfile, "SEGMENT", 100)
    own, path = library("word_bpe_49k.json"), tokenizer_file("word_bpe_49k.json")
    given = docs_of(spark, texts[:60], part=9).union(docs_of(spark, ["twice"], part=9))
    given = given.union(spark.createDataFrame([(None, "no id", 9)], given.schema))
    idfile.write_ids(given.repartition(3), str(tmp_path / "ids"), path, files=3)
    found = idfile.with_starts(idfile.read_ids(spark, str(tmp_path / "ids"), with_ids=True)).collect()
    order = sorted(given.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
    at = 0
    for want, got in zip(order, sorted(found, key=lambda r: r.start)):
        ids = own.encode(want.text or "", add_special_tokens=False).ids + [2]
        assert (got.key, got.start, got.n_tokens, got.ids) == (want.doc_id, at, len(ids), ids)
        assert got.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert len(found) == len(order)
    idfile.write_ids(given.limit(0), str(tmp_path / "none"), path)
    assert idfile.with_starts(idfile.read_ids(spark, str(tmp_path / "none"))).count() == 0


def test_a_hot_key_is_spread_over_ranges_and_files(spark, texts, tmp_path, monkeypatch):
    monkeypatch.setattr(idfile, "SEGMENT", 100)
    monkeypatch.setattr(idfile, "FILE_ROWS", 3)
    own, path = library("word_bpe_49k.json"), tokenizer_file("word_bpe_49k.json")
    hot = [t for t in texts[:60] if t] + ["same " * 20] * 30 + ["long " * 1000, None]
    rows = [(7, t) for t in hot] + [(None, t) for t in hot] + [(8, "last")]
    given = spark.createDataFrame(rows, "doc_id long, text string")
    idfile.write_ids(given, str(tmp_path / "ids"), path, files=4)
    read = idfile.read_ids(spark, str(tmp_path / "ids"), with_ids=True)
    parts = {r.part for r in read.where("key = 7").collect()}
    assert len({p >> 32 for p in parts}) > 1 and len(parts) > len({p >> 32 for p in parts})
    at = 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    found = sorted(idfile.with_starts(read).collect(), key=lambda r: r.start)
    assert len(found) == len(order)
    for (key, text), got in zip(order, found):
        ids = own.encode(text or "", add_special_tokens=False).ids + [2]
        assert (got.key, got.start, got.n_tokens, got.ids) == (key, at, len(ids), ids)
        at += len(ids)
    for file in (tmp_path / "ids").glob("part-*"):
        data, at, written = memoryview(file.read_bytes()), 0, set()
        while at < len(data):
            head, _, at = idfile.Segment.unpack(data, at)
            written.add(head["row"])
        assert len(written) <= 3


def test_chunks_equal_whole_texts(texts):
    own = library("word_bpe_49k.json")
    odd = ["A.", "..", "a,.", "É.", "it's DON'T. I'll,", "<|endoftext|>. <|startoftext|>,x", "1,2.3. 12", "'s 's. '", "a.b,c."]
    given = [t or "" for t in texts] + odd
    for text, found in zip(given, idfile.ChunkEncoder(tokenizer_file("word_bpe_49k.json")).encode_batch(given)):
        assert np.frombuffer(found, "<u4").tolist() == own.encode(text, add_special_tokens=False).ids


_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return _WORD.findall((text or "").translate(_FOLD))


def test_words_and_their_hashes(texts):
    seen, hashes = {}, set()
    raw = [None if t is None else t.encode() for t in texts]
    for i, j, found in words.words_of(raw, 5000):
        for n in range(j - i):
            own = plain_words(texts[i + n])
            begin, end = found.bounds[n], found.bounds[n + 1]
            got = [found.data[a:b].tobytes().decode() for a, b in zip(found.starts[begin:end], found.ends[begin:end])]
            assert got == own
            for w, h in zip(own, found.hashes[begin:end].tolist()):
                assert seen.setdefault(w, h) == h
    hashes.update(seen.values())
    assert len(hashes) == len(seen)


def test_one_very_long_word_and_slices(monkeypatch):
    monkeypatch.setattr(words, "_SLICE", 16)
    given = [b"ab " * 30 + b"x" * 100 + b" ab", b"ab"]
    ((_, _, found),) = words.words_of(given)
    assert len(set(found.hashes.tolist())) == 2 and found.bounds.tolist() == [0, 32, 33]


def brute_leaks(text, items):
    w, hit, found = plain_words(text), set(), set()
    for item, other in items:
        o = plain_words(other)
        m = min(10, len(o))
        windows = {tuple(o[k : k + m]) for k in range(len(o) - m + 1)} if m else set()
        for k in range(len(w) - m + 1 if m else 0):
            if tuple(w[k : k + m]) in windows:
                hit.update(range(k, k + m))
                found.add(item)
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("pass_chars", [10**6, 400])
def test_decontamination_equals_brute_force(spark, pass_chars):
    base = "one two three four five six seven eight nine ten eleven twelve"
    items = [
        (1, base), (1, "Zebra"), (2, base[4:] + " x"), (3, ""), (4, None), (5, "é É"), (None, "two"), (7, "a a a a a a a a a a a"),
        (8, "q " * 300), (9, "the the the"),
    ]
    docs = [
        None, "", "nothing here", f"Well, {base.upper()}!", base[:30], "zebra", "é É", "a " * 25, "x " + base[4:] + " x " + base, "the the",
        " ".join(["pad"] * 600 + [base] + ["pad"] * 600), "q " * 5000,
    ]
    given = docs_of(spark, docs, n_words="clash", items=0)
    frame = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.find_leaks(given, frame, pass_chars=pass_chars)
    assert found.columns[-3:] == ["n_words_", "hit_spans", "items_"]
    real = [(i, t) for i, t in items if i is not None]
    for row in found.withColumn("n_hit", decontam.n_hit("hit_spans")).collect():
        assert (row.n_words_, row.n_hit, row.items_) == brute_leaks(row.text, real), row.doc_id
    assert decontam.find_leaks(given, frame.limit(0)).where(F.size("items_") > 0).count() == 0
    assert decontam.report(given.limit(0), frame).count() == 0


def test_documents_without_leaks_keep_their_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("hit_spans", F.lit(1))
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    kept = decontam.without_leaks(docs, bench)
    assert kept.columns == docs.columns
    clean = {r.doc_id for r in docs.collect() if not brute_leaks(r.text, items)[2]}
    assert {r.doc_id for r in kept.collect()} == clean


def test_gradients_are_those_of_the_loss():
    network = langid.Network.fresh(["a", "b"], 4)
    windows, _ = langid.windows_of([b"hello there you", b"was ist das denn" * 5])
    wanted = np.array([0, 1, 1])
    _, slopes = network.gradients(windows, wanted)
    for weight, slope in zip(network.weights, slopes):
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        kept, step = weight[at], 1e-2
        losses = []
        for moved in (kept + step, kept - step):
            weight[at] = moved
            losses.append(network.gradients(windows, wanted)[0])
        weight[at] = kept
        assert abs((losses[0] - losses[1]) / (2 * step) - slope[at]) < 0.02 * abs(slope[at]) + 1e-4


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
    held = [r for r in found if r.held_out]
    assert len(held) > 200 and sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97


def test_language_edges(spark):
    rows = [(i, t, lang, 1) for i, (t, lang) in enumerate([("the cat " * 40, "en"), ("die katze und " * 40, "de")] * 8)]
    rows += [(100, None, "en", 1), (101, "", None, 1), (102, "123 !?", "en", 1), (None, "the cat", "en", 1), (100, "the cat the", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    found = {(r.doc_id, r.text): r for r in langid.predict(docs, langid.fit(docs)).collect()}
    for key in ((100, None), (101, ""), (102, "123 !?")):
        assert found[key].lang_pred == "und" and found[key].score_ == 0
    assert found[None, "the cat"].lang_pred == "en" and found[100, "the cat the"].lang_pred == "en"
    assert langid.known_only(docs).columns == docs.columns
    assert langid.report(docs.limit(0)).count() == 0
    unknown = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.report(unknown).collect()} == {"und"}


def test_the_tokens_of_the_query_equal_the_library(spark):
    import hashlib

    from cdcmart.llm.queries import QUERIES

    own = library("byte_bpe_50k.json")
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    got = QUERIES["op1_bpe"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(docs)
    for r in got:
        ids = own.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), sha(",".join(map(str, ids))), sha(own.decode(ids, skip_special_tokens=False)))
