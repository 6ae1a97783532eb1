"""WARC, chat and secrets against round trips and brute force; the pipeline; the package without these operators."""

import random
import re
import shutil
import subprocess
import sys
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cdcmart.llm import chat, secretscan, warc
from cdcmart.llm.queries import QUERIES, SQL

duckdb = pytest.importorskip("duckdb")
SMALL = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()
PAGES = "page_id long, url string, html string"


@pytest.mark.parametrize("members", [True, False])
def test_archives_round_trip(spark, tmp_path, members):
    rows = [
        (3, "http://a/", "same"), (1, "http://b/\r\nX: y", "same"), (2, None, "same"), (4, "u", None), (5, "u", ""), (6, "é", "WARC/1.1\r\n\r\n"),
        (None, "n", "same"), (1, "again", "same"), (7, "long", "é" * 100_000), (8, "gzip", "\x1f\u008b"),
    ]
    pages = spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit("clash"))
    folder = str(tmp_path / "w")
    warc.write_archives(pages, folder, members=members)
    found = warc.read_archives(spark, folder, "part-*").collect()
    assert all(r.gap_bytes is None for r in found) and len(found) == len(rows)
    page = "<urn:page:{}>".format
    want = [
        (page(1), "response", None, 4), (page(1), "response", None, 4), (page(2), "revisit", page(1), 4),
        (page(3), "revisit", page(1), 4), (page(""), "revisit", page(1), 4), (page(4), "response", None, 0),
        (page(5), "revisit", page(4), 0), (page(6), "response", None, 12), (page(7), "response", None, 200_000),
        (page(8), "response", None, 3),
    ]
    got = [(r.record_id, r.record_type, r.refers_to, r.payload_bytes) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)
    payloads = {r.record_id: bytes(r.payload) for r in found if r.payload is not None}
    assert payloads[page(7)] == ("é" * 100_000).encode() and payloads[page(6)] == b"WARC/1.1\r\n\r\n"
    warc.write_archives(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none"), "part-*").count() == 0


@pytest.mark.parametrize("members", [True, False])
def test_long_urls_round_trip(spark, tmp_path, members):
    urls = ["http://a/" + "x" * 70_000, "http://b/" + "漢" * 12_000, "http://c/?" + "WARC/1.1 " * 9000, "http://d/"]
    pages = spark.createDataFrame([(i, u, f"page {i}") for i, u in enumerate(urls)], PAGES)
    warc.write_archives(pages, str(tmp_path / "w"), members=members)
    found = warc.read_archives(spark, str(tmp_path / "w"), "part-*").collect()
    assert all(r.gap_bytes is None for r in found)
    assert sorted(r.url for r in found) == sorted(warc._header_safe(u) for u in urls)
    assert warc.report(pages).count() == len(urls)


def test_headers_of_foreign_archives_may_be_long():
    one, two, three = records(3)
    many = two.replace(b"\r\n", b"\r\n" + b"X-Note: WARC/1.1\r\n" * 9000, 1)
    found = list(warc.read(one + many + three))
    assert ids(found) == [f"<urn:page:{i}>" for i in range(3)] and len(found) == 3
    found = list(warc.read(one + many[: 10 + 18 * 8000] + three))
    assert ids(found) == ["<urn:page:0>", "<urn:page:2>"]
    assert [(g.offset, g.length) for g in found if isinstance(g, warc.Gap)] == [(len(one), 10 + 18 * 8000)]


def test_small_payloads_are_all_responses(spark, tmp_path):
    pages = spark.createDataFrame([(1, "a", "xx"), (2, "b", "xx"), (3, "c", "long"), (4, "d", "long")], PAGES)
    warc.write_archives(pages, str(tmp_path / "w"), least_bytes=3)
    found = warc.read_archives(spark, str(tmp_path / "w"), "part-*")
    assert sorted(r.record_type for r in found.collect()) == ["response"] * 3 + ["revisit"]


def records(n=6):
    return [warc.record(i, f"http://x/{i}", f"payload {i} ".encode() * 50, None, False) + b"\r\n\r\n" for i in range(n)]


def ids(found):
    return [r.headers["warc-record-id"] for r in found if isinstance(r, warc.Record)]


@pytest.mark.parametrize("members", [True, False])
def test_damage_is_passed_by_and_listed(members):
    parts = [warc.member(r) if members else r for r in records()]
    broken = bytearray(parts[2])
    broken[len(broken) // 2] ^= 0xFF
    data = b"junk" + parts[0] + parts[1] + bytes(broken) + parts[3] + b"\x00" * 9 + parts[4] + parts[5][: len(parts[5]) // 2]
    found = list(warc.read(data))
    assert ids(found) == [f"<urn:page:{i}>" for i in (0, 1, 3, 4)]
    gaps = [(g.offset, g.length) for g in found if isinstance(g, warc.Gap)]
    at3 = data.index(parts[3])
    assert gaps == [(0, 4), (at3 - len(parts[2]), len(parts[2])), (at3 + len(parts[3]), 9), (data.index(parts[4]) + len(parts[4]), len(parts[5]) // 2)]
    assert list(warc.read(b"")) == [] and [type(x) for x in warc.read(b"no archive")] == [warc.Gap]


def test_a_wrong_length_or_digest_is_damage():
    one, two, three = records(3)
    for bad in (re.sub(rb"Content-Length: (\d)", rb"Content-Length: 9\1", two, count=1), two.replace(b"payload 1", b"payload X", 1),
                two.replace(b"Content-Length", b"Content Length", 1), re.sub(rb"(\r\nContent-Length: )\d+", rb"\g<1>" + b"9" * 30, two, count=1)):
        assert ids(warc.read(one + bad + three)) == ["<urn:page:0>", "<urn:page:2>"]
        inside = list(warc.read(warc.member(one + bad + three)))
        assert ids(inside) == ["<urn:page:0>", "<urn:page:2>"] and any(isinstance(x, warc.Gap) for x in inside)


@pytest.mark.parametrize("seed", range(30))
def test_records_and_gaps_cover_the_file(seed):
    rng = random.Random(seed)
    parts = []
    for n in range(rng.randint(0, 6)):
        some = b"".join(records(rng.randint(1, 3)))
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(some))
            some = some[:at] + bytes([rng.randrange(256)]) * rng.randint(0, 40) + some[at + rng.randint(0, 40) :]
        parts.append(warc.member(some) if rng.random() < 0.6 else some)
        if rng.random() < 0.3:
            parts.append(rng.randbytes(rng.randint(1, 50)))
    data = b"".join(parts)
    if data and rng.random() < 0.3:
        at = rng.randrange(len(data))
        data = data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :]
    seen, found = 0, list(warc.read(data))
    for x in sorted({(x.offset, x.length) for x in found if x.length}):
        assert x[0] == seen
        seen += x[1]
    assert seen == len(data)
    for gap in found:
        if isinstance(gap, warc.Gap):
            assert (gap.length == 0) <= (gap.inside is not None) and (gap.inside is None or gap.inside[0] < gap.inside[1])


def test_a_gap_inside_a_member_has_its_inner_span(spark, tmp_path):
    one, two, three = records(3)
    broken = two.replace(b"payload 1", b"payload X", 1)
    whole, lost = warc.member(one + broken + three), warc.member(broken)
    (tmp_path / "a.warc.gz").write_bytes(whole + lost)
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    gaps = [(r.offset, r.length, r.gap_bytes, r.gap_from, r.gap_to) for r in rows if r.gap_bytes is not None]
    assert gaps == [(0, 0, 0, len(one), len(one + broken)), (len(whole), len(lost), len(lost), 0, len(broken))]
    assert [(r.offset, r.length) for r in rows if r.gap_bytes is None] == [(0, len(whole))] * 2


def test_mixed_archives_and_empty_members():
    one, two, three = records(3)
    assert len(ids(warc.read(one + warc.member(two) + warc._EMPTY_MEMBER + three))) == 3


CONV = "conv_id long, turn long, role string, text string"


def test_preferences_share_their_prompt(spark):
    turn = lambda role, text: (role, text)
    pairs = [
        (1, [turn("user", "hi"), turn("assistant", "yo"), turn("user", "x"), turn("assistant", "good")],
         [turn("user", "hi"), turn("assistant", "yo"), turn("user", "x"), turn("assistant", "bad"), turn("user", "é")]),
        (2, [turn("user", "same")], [turn("user", "same")]), (3, None, [turn("assistant", "a")]), (4, [], []),
        (5, [turn("user", "a")], [turn("assistant", "a")]),
    ]
    frame = spark.createDataFrame(
        [(i, i, -i, c, r, "clash") for i, c, r in pairs],
        "pair_id long, chosen_id long, rejected_id long, chosen array<struct<role:string,text:string>>,"
        "rejected array<struct<role:string,text:string>>, prompt string")
    got = {r.pair_id: r for r in chat.format_pairs(frame).collect()}
    assert got[1].n_prompt_turns == 3 and got[1].prompt == "<|user|>\nhi\n<|assistant|>\nyo\n<|user|>\nx\n"
    assert got[1].chosen_text == "<|assistant|>\ngood\n" and got[1].rejected_text == "<|assistant|>\nbad\n<|user|>\né\n"
    ((a, b),) = got[1].chosen_spans
    assert got[1].chosen_text[a:b] == "good\n"
    ((a, b),) = got[1].rejected_spans
    assert got[1].rejected_text[a:b] == "bad\n"
    assert (got[2].n_prompt_turns, got[2].chosen_text, got[2].chosen_spans) == (1, "", [])
    assert (got[3].n_prompt_turns, got[3].prompt, got[3].chosen_text) == (0, "", "")
    assert got[4].rejected_text == "" and got[5].n_prompt_turns == 0
    assert chat.format_pairs(frame.limit(0)).count() == 0


def test_replies_are_swapped_between_partners(spark):
    rows = [
        (0, 0, "user", "q0"), (0, 1, "assistant", "a0"), (0, 1, "assistant", "a0"), (0, 2, "user", "bye"), (1, 0, "user", "q1"), (1, 1, "assistant", "a1"),
        (2, 0, "user", "alone"), (2, 1, "assistant", "a2"), (4, None, None, None), (4, 0, "user", None), (5, 0, "assistant", "a5"), (None, 0, "user", "x"),
    ]
    frame = spark.createDataFrame(rows, CONV).withColumn("turns", F.lit(1)).withColumn("at", F.lit(1))
    got = {r.pair_id: r for r in chat.report(frame).collect()}
    assert sorted(got) == [0, 1, 2, 4, 5]
    assert (got[0].prompt, got[0].chosen_text, got[0].rejected_text) == (
        "<|user|>\nq0\n", "<|assistant|>\na0\n<|user|>\nbye\n", "<|assistant|>\na1\n<|user|>\nbye\n")
    assert got[0].chosen_spans == "14:17" and got[2].rejected_text == "" and got[2].chosen_spans == "14:17"
    assert got[4].n_prompt_turns == 2 and got[4].chosen_text == ""
    assert got[5].n_prompt_turns == 0 and got[5].rejected_text == ""
    assert chat.report(frame.limit(0)).count() == 0


_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute_spans(text):
    found = [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text or "") if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), m[0]) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return sorted(found)


ODD = [
    None, "", "password: token: secretvalue", 'é🎉 API_KEY = "abc123def456ghi789"', "tokeN=ab", "secret=token=abcdefgh", "AKIAAKIA" + "B" * 15 + "AKIA" + "C" * 9,
    "0" * 23 + "g" + "a" * 24 + "AKIA" + "1" * 16, "passwd='" + "f" * 40 + "'", "AKIA" + "Z" * 16 + "a" * 30, "x" * 5000 + " token=" + "deadbeef" * 5,
]


def test_spans_equal_brute_force(spark):
    given = ODD + [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    docs = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    for r in docs.select("text", secretscan.base_spans(F.col("text")).alias("s")).collect():
        assert [(x.start, x.kind, x.end, x.value) for x in r.s] == brute_spans(r.text)


def test_many_matches_in_one_text(spark):
    rng = random.Random(1)
    for count in (255, 256, 257, 100_000):
        parts = [rng.choice(["token=abcdef ", "é", "x secret: abcdefg1\n"]) for _ in range(count)]
        text = "".join(parts)
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        begin = time.perf_counter()
        (row,) = docs.select(secretscan.base_spans(F.col("text")).alias("s")).collect()
        assert [(x.start, x.kind, x.end, x.value) for x in row.s] == brute_spans(text)
        assert time.perf_counter() - begin < 60


def test_owners_tell_live_secrets_from_examples(spark):
    copied, own, word = "AKIA" + "EXAMPLE1" * 2, "abc123def456ghi789", "abcdefghijklmnopqrs"
    rows = [(i, f"é key {copied}", f"s{i % 3}") for i in range(6)] + [
        (10, f"token={own}", "s1"), (11, f"token = {own} secret={word}", "s1"), (12, f"token={own}x", None), (12, f"token={own}x", None), (None, "", "s2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("spans", F.lit(1))
    found = secretscan.find_secrets(docs)
    assert found.columns == [*docs.columns, "spans_"] and found.count() == len(rows)
    for r in found.collect():
        live = [r.text[s.start : s.end] for s in r.spans_ if s.kind == 3]
        assert live == ([own] if r.doc_id in (10, 11) else [own + "x"] if r.doc_id == 12 else []), r
    masked = secretscan.masked(docs.withColumn("n_chars", F.length("text").cast("long")))
    by = {(r.doc_id, r.source): r for r in masked.collect()}
    assert by[0, "s0"].text == "é key [secret]" and by[0, "s0"].n_chars == 14
    assert by[11, "s1"].text == "[secret] [secret]"
    assert secretscan.report(docs.limit(0)).count() == 0 and secretscan.masked(docs.limit(0)).count() == 0


def test_the_stage_masks_by_ownership(spark):
    copied, own = "AKIA" + "EXAMPLE1" * 2, "abc123def456ghi789"
    texts = [f"key {copied} token: something"] * 3 + [f"é token={own}, {copied}!", "password=hunterhunter", None, "clean"]
    rows = [(i, "en", t, f"s{i}", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string, source string, n_chars long").withColumn("spans", F.lit(1))
    stage = dict(corpus_pipeline.STAGES)["secrets"]
    got = {r.doc_id: r for r in stage(spark, docs, SMALL).collect()}
    assert [got[i].text for i in range(7)] == texts[:3] + [f"é [secret], {copied}!", "[secret]", None, "clean"]
    assert all(r.n_chars == len(r.text or "") and r.spans == 1 for r in got.values())


def test_repositories_count_for_a_hot_owner(spark):
    copied, own = "AKIA" + "EXAMPLE1" * 2, "abc123def456ghi789"
    rows = [(i, f"key {copied}", "hot", 24) for i in range(secretscan.MAX_REPOSITORIES + 1)]
    rows += [(1000 + i, f"token={own}", "hot", 24) for i in range(secretscan.MAX_REPOSITORIES)]
    rows += [(1000, f"token={own}", "hot", 24)] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    live = {(r.doc_id >= 1000, any(s.kind == 3 for s in r.spans)) for r in secretscan.find_secrets(docs).collect()}
    assert live == {(False, False), (True, True)}
    assert {(r.doc_id >= 1000, r.n_live) for r in secretscan.report(docs).collect()} == {(False, 0), (True, 1)}
    texts = {(r.doc_id >= 1000, r.text) for r in secretscan.masked(docs, keep_copied=True).collect()}
    assert texts == {(False, f"key {copied}"), (True, "[secret]")}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, db, name):
    got = QUERIES[name](spark, SMALL)
    want = db.execute(SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    rows = sorted(repr(r) for r in want.fetchall())
    assert rows and sorted(repr(tuple(r)) for r in got.select(*columns).collect()) == rows


def test_pages_of_the_query(spark, tmp_path):
    # The given pages differ from each other, so a third is repeated under other ids, smaller ones too.
    given = spark.read.parquet(f"{SMALL}/pages.parquet")
    again = given.where("page_id % 3 = 0").withColumn("page_id", F.col("page_id") * 7 - 20)
    given.unionByName(again.where("page_id < 0 or page_id > 1000 or page_id % 7 <> 0")).dropDuplicates(["page_id"]).write.parquet(f"{tmp_path}/pages.parquet")
    got = QUERIES["op5_warc"](spark, str(tmp_path)).collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"{tmp_path}/pages.parquet").collect()}
    assert len(got) == len(pages)
    first = {}
    for i in sorted(pages):
        first.setdefault((pages[i].html or "").encode(), i)
    for r in got:
        payload = (pages[r.page_id].html or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(payload), warc.base32_sha1(payload))
        want = ("response", None) if first[payload] == r.page_id else ("revisit", first[payload])
        assert (r.record_type, r.refers_to) == want
    assert len(first) < len(pages)


def test_the_pipeline_stage_by_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = [(9001, None, "en", "s", 0, 1), (9002, "", None, None, None, 1), (9003, "123", "en", "s", 3, 1)]
    docs = docs.withColumn("tokens", F.lit(1)).unionByName(spark.createDataFrame(odd, docs.withColumn("tokens", F.lit(1)).schema))
    columns = docs.columns
    seen = [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append(docs.count())
        if k < 4:
            assert docs.columns == columns, name
        if name == "language":
            assert docs.where("doc_id > 9000").count() == 0 and seen[-1] >= 0.97 * (seen[0] - 3)
        if name == "secrets":
            assert not [r for r in docs.collect() if any(s[1] == 0 for s in brute_spans(r.text))]
            assert docs.where("n_chars <> char_length(text)").count() == 0
    assert seen[1] > seen[2] > seen[3] == seen[4] == seen[5] > 0
    empty = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        found = stage(spark, empty, SMALL)
        assert found.count() == 0
        empty = found


def test_the_rest_works_without_these_operators(tmp_path):
    root = Path(corpus_pipeline.__file__).parent
    shutil.copytree(root / "cdcmart", tmp_path / "cdcmart", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert e.queries() and not any(n.startswith('op') for n in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin:/bin"}, check=True)
