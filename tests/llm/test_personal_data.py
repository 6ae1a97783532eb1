"""Identifiers against the plain patterns; disguises and where they stand; odd rows and the query."""

import hashlib
import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cdcmart.llm import personal
from cdcmart.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
KINDS = ("email", "ip", "card", "phone")
PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == 0:
        return True
    if kind == 1:
        return all(int(p) <= 255 for p in found.split("."))
    if kind == 2:
        total = sum(int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return 9 <= len(digits) <= 15


def brute(text):
    return sorted(
        (m.start(), m.end(), kind)
        for kind, pattern in enumerate(PATTERNS)
        for m in re.finditer(pattern, text)
        if passes(kind, m[0])
    )


@given(st.text("ab.@-_+ (1902é\n", max_size=60))
@settings(max_examples=1500, deadline=None)
def test_base_spans_are_those_of_the_patterns(text):
    assert personal.plain_spans(text) == brute(text)


def test_base_spans_of_made_identifiers():
    rng = random.Random(4)
    parts = ["a.b@c.de", "@", "x@y", "1.2.3.4", "300.1.1.1.2.3.4", "001.02.3.0004", "4111 1111 1111 1111", "4111-1111--1111", "+1 (555) 555-1234", "+", " ", ",", "5500005555555559", "_d@e.f", "7", "."]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 8)))
        assert personal.plain_spans(text) == brute(text), text


DISGUISES = [
    ("mail john.doe at example dot com now", "john.doe at example dot com", 0, "john.doe@example.com"),
    ("mail JOHN AT EXAMPLE DOT CO DOT UK.", "JOHN AT EXAMPLE DOT CO DOT UK", 0, "JOHN@EXAMPLE.CO.UK"),
    ("x john dot doe at mail dot org", "john dot doe at mail dot org", 0, "john.doe@mail.org"),
    ("jo[at]ex[dot]com", "jo[at]ex[dot]com", 0, "jo@ex.com"),
    ("jo (at) ex.com", "jo (at) ex.com", 0, "jo@ex.com"),
    ("jo@ex (dot) com,", "jo@ex (dot) com", 0, "jo@ex.com"),
    ("é jo {at} sub.ex [.] com", "jo {at} sub.ex [.] com", 0, "jo@sub.ex.com"),
    ("ana arroba correo punto es", "ana arroba correo punto es", 0, "ana@correo.es"),
    ("luc arobase poste point fr", "luc arobase poste point fr", 0, "luc@poste.fr"),
    ("to jоhn@exаmple.com!", "jоhn@exаmple.com", 0, "john@example.com"),
    ("to jo​hn@example.com!", "jo​hn@example.com", 0, "john@example.com"),
    ("ｊｏ＠ｅｘ．ｃｏｍ", "ｊｏ＠ｅｘ．ｃｏｍ", 0, "jo@ex.com"),
    ("ip 192[.]168[.]0[.]1 up", "192[.]168[.]0[.]1", 1, "192.168.0.1"),
    ("ip 10 dot 0 dot 0 dot 1 up", "10 dot 0 dot 0 dot 1", 1, "10.0.0.1"),
    ("one zero dot two dot three dot four", "one zero dot two dot three dot four", 1, "10.2.3.4"),
    ("ip 1O.2.3.l0", "1O.2.3.l0", 1, "10.2.3.10"),
    ("card ４１１１ １１１１ １１１１ １１１１", "４１１１ １１１１ １１１１ １１１１", 2, "4111 1111 1111 1111"),
    ("card four one one one one one one one one one one one one one one one.", "four one one one one one one one one one one one one one one one", 2, "4111111111111111"),
    ("card four one one one 1111 triple one one 1111", "four one one one 1111 triple one one 1111", 2, "4111 1111 1111 1111"),
    ("card 4lll-l1ll-1111 I111", "4lll-l1ll-1111 I111", 2, "4111-1111-1111 1111"),
    ("karte vier eins eins eins eins eins eins eins eins eins eins eins eins eins eins eins", "vier eins eins eins eins eins eins eins eins eins eins eins eins eins eins eins", 2, "4111111111111111"),
    ("call plus one five five five oh one two three four five", "plus one five five five oh one two three four five", 3, "+1555012345"),
    ("call +1 five-five-five zero-one-two three four five", "+1 five-five-five zero-one-two three four five", 3, "+15550123 45"),
    ("call +one (five five five) 555-one two three four.", "+one (five five five) 555-one two three four", 3, "+1555555-1234"),
    ("one nine two.one six eight.zero.one is up", "one nine two.one six eight.zero.one", 1, "192.168.0.1"),
    ("ask hein.19 at mail5.example.com or", "hein.19 at mail5.example.com", 0, "hein.19@mail5.example.com"),
    ("ask hein.19 at mail5 dot example dot com or", "hein.19 at mail5 dot example dot com", 0, "hein.19@mail5.example.com"),
    ("ℎ.①@ⅿail.ex", "ℎ.①@ⅿail.ex", 0, "h.1@mail.ex"),
    ("call ＋1 (555)‑555‐1234", "＋1 (555)‑555‐1234", 3, "+1 (555)-555-1234"),
    ("call +1 (555) 555‒l2O4", "+1 (555) 555‒l2O4", 3, "+1 (555) 555-1204"),
]


@pytest.mark.parametrize("text,stretch,kind,value", DISGUISES)
def test_disguises_are_found_where_they_stand(text, stretch, kind, value):
    found = [s for s in personal.personal_spans(text) if s[4]]
    assert [(text[a:b], k) for a, b, k, _, _ in found] == [(stretch, kind)]
    plain = lambda x: x.replace(" ", "").replace("-", "")
    assert plain(found[0][3]) == plain(value)
    # The same place behind other text, and base spans as they would be without the method.
    moved = "né 𝔘 one two @ " + text
    assert (moved.index(stretch), moved.index(stretch) + len(stretch), kind) in [s[:3] for s in personal.personal_spans(moved)]
    assert [s[:3] for s in personal.personal_spans(text) if not s[4]] == brute(text)


@pytest.mark.parametrize("text", [
    "look at this point in time", "we met at noon", "see foo@bar.com dot dot", "he works at example.com today", "mail a@b.de at once",
    "worked at the dot com", "one two three four five", "plus one", "lo Il 10 Oo", "été naïve œuvre Straße 12 345", "один два три", "at dot at dot",
    "v1.2.3 of 2020", "he.is at leosrm.25@mail4.example.com", "room 12 at a.b", "x2 at work.", "he2 at 1.2.3", "from 10 to 20 dot", "seven at one point five", "foo@bar.com point two",
])
def test_plain_prose_has_no_disguise(text):
    assert [s for s in personal.personal_spans(text) if s[4]] == []


def test_edits_lead_back_to_their_source():
    rng = random.Random(2)
    for _ in range(500):
        text = "".join(rng.choices("abc", k=rng.randint(1, 30)))
        owner, edits, at, out = [], [], 0, ""
        while at < len(text):
            if rng.random() < 0.3:
                end = min(len(text), at + rng.randint(1, 3))
                new = rng.choice(["", "X", "YY"])
                edits.append((at, end, new))
                owner += [(at, end)] * len(new)
                out, at = out + new, end
            else:
                owner.append((at, at + 1))
                out, at = out + text[at], at + 1
        made = personal.Rewritten(text, edits)
        assert made.text == out
        for _ in range(5):
            if out:
                a = rng.randrange(len(out))
                b = rng.randint(a + 1, len(out))
                assert made.back(a, b) == (owner[a][0], owner[b - 1][1])


def test_the_tables_of_look_alikes_fit():
    assert len(personal._ALIKE) == len(personal._LATIN) == len(set(personal._ALIKE))
    assert all(not c.isascii() and (v == "" or len(v) == 1 and v.isascii()) for c, v in personal.look_alikes().items())
    assert not set("áàâäéèêëíïîñóôöúùûüßçœæø") & set(personal.look_alikes())


@pytest.mark.parametrize("unit", ["a", "1", "1.", "@", "+", "+1", "a@", "a@b.", "1 ", "O1", " at ", "x at y dot ", "one ", "one-", "plus ", "1 dot ", "（", "а", "[at]", " dot ", "1,"])
def test_long_texts_take_linear_time(unit):
    begin = time.perf_counter()
    personal.personal_spans(unit * (300_000 // len(unit)))
    assert time.perf_counter() - begin < 10


ROWS = [(1, "a@b.de " * 3), (2, None), (3, ""), (None, "+1 (555) 555-1234"), (1, "a@b.de " * 3), (4, "jo at ex dot com 1.2.3.4"), (5, "🎉 1.2.3.4")]


def test_odd_rows_and_clashing_names(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("spans", F.lit(1)).withColumn("a.b", F.lit(2))
    found = personal.find_personal(docs)
    assert found.columns == [*docs.columns, "spans_"]
    rows = found.collect()
    for r in rows:
        assert [(s.start, s.end, s.kind, s.value, s.disguised) for s in r.spans_] == personal.personal_spans(r.text or "")
    assert sorted(map(repr, ((r.doc_id, r.text) for r in rows))) == sorted(map(repr, ROWS))
    masked = personal.masked(docs)
    assert masked.columns == docs.columns
    assert sorted(r.text or "" for r in masked.collect()) == sorted(["[email] " * 3] * 2 + ["", "", "[phone]", "[email] [ip]", "🎉 [ip]"])
    for made in (personal.find_personal(docs.limit(0)), personal.masked(docs.limit(0)), personal.report(docs.limit(0))):
        assert made.count() == 0


def test_the_query_against_the_patterns(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = QUERIES["op11_personal_data"](spark, SMALL).collect()
    assert len(got) == len(docs) and sum(r.n_email + r.n_phone + r.n_card + r.n_ip > 0 for r in got) > 5
    for r in got:
        base = sorted(brute(docs[r.doc_id]), key=lambda s: (s[0], s[2]))
        listed = ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in base)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == k for s in base) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        # The invented prose holds no disguises.
        assert r.spans == listed and r.n_added == 0
