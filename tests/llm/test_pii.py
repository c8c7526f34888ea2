"""PII: base spans against Python's patterns, disclosure on a fixture."""

from __future__ import annotations

import hashlib
import random
import re
import time

from quarry.llm.pii import KINDS, find_spans, op9_pii, sanitise, sanitise_spans

SF = "/root/testdata/sf0.01"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        worth = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(w - 9 * (w > 9) for w in worth) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k in KINDS for m in re.finditer(PLAIN[k], text or "") if _passes(k, m.group())]


def _told(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_query_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op9_pii(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(_told(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in want) for k in KINDS]
        assert r.spans == _told(want) or r.spans.startswith(_told(want) + ",term:")


HARD = [
    (1, "a@b.c@d.e x@y.z_d@e.f 1.2.3.4.5 001.02.003.0255 256.1.1.1 1.2.3.256 é\U0001f600 +1 (234) 555-1234 4111 1111 1111 1111 4111-1111-1111-1112"),
    (2, None), (3, ""), (4, "1." * 20_000 + "1"), (5, "+1 " + "(" * 3000 + "2"), (None, "x@y.zz"), (None, "x@y.zz"), (7, "9" * 100_000), (7, "other a@b.cc"),
    (8, "5555 5555 5555 4444 0000000000000000 +49-30-1234567 +1 2 3 +12345678901234567"), (9, "a." * 30_000 + "@x.y" + ".z" * 30_000),
]


def test_hard_texts(spark):
    df = spark.createDataFrame([(*h, 1) for h in HARD], "doc_id bigint, text string, spans int")
    got = sorted(((r.id or 0), _told((s.kind, s.start, s.end) for s in r.spans)) for r in sanitise_spans(df).collect())
    assert got == sorted((i or 0, _told(brute(t))) for i, t in HARD)
    clean = sanitise(df)
    assert clean.columns == df.columns and clean.count() == len(HARD)
    texts = sorted((r.doc_id or 0, r.text or "") for r in clean.collect())
    assert texts[0] == (0, "[EMAIL]") and texts[1] == (0, "[EMAIL]")
    assert (7, "other [EMAIL]") in texts and (3, "") in texts
    # nothing personal is left where spans do not touch each other
    assert all(not brute(t) for i, t in texts if i not in (1, 4, 9))
    assert sanitise(df.limit(0)).count() == 0


def test_terms_that_give_an_entity_away(spark):
    rows = [(i, f"note{i} ask Zyxagent at +1 (234) 555-1230 about case {'abcdefgh'[i] * 5}") for i in range(8)]
    rows += [(100 + i, f"ask about the case and note {'qrstuvw'[i % 7] * 4}") for i in range(80)]
    # one document copied many times is one observation
    rows += [(300 + i, "wonderful Mirabella writes from me@mail.example every day") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    spans = {r.id: [(t.start, t.end, t.value) for t in r.terms] for r in sanitise_spans(df).collect()}
    text = dict(rows)
    assert all("Zyxagent" in {text[i][a:b] for a, b, _ in spans[i]} for i in range(8))
    assert not any(spans[i] for i in spans if i >= 100)
    clean = {r.doc_id: r.text for r in sanitise(df).collect()}
    assert all("Zyxagent" not in clean[i] and "[PHONE]" in clean[i] and "ask" in clean[i] for i in range(8))
    assert clean[300] == "wonderful Mirabella writes from [EMAIL] every day"


def test_copies_do_not_hide_a_term_that_gives_an_entity_away(spark):
    rows = [(i, f"note ask Zyxagent at +1 (234) 555-1230 about case {'abc'[i] * 5}") for i in range(3)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]
    rows += [(100 + i, f"ask about the case and note {chr(97 + i // 26) * 3}{chr(97 + i % 26) * 3}") for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    clean = {r.doc_id: r.text for r in sanitise(df).collect()}
    assert not any("Zyxagent" in t for t in clean.values())
    assert all("ask" in t and "case" in t for t in clean.values())


def test_terms_far_from_the_entity(spark):
    far = "one of many plain lines that say nothing of note " * 4
    rows = [(i, f"Zyxagent heads {'abcd'[i] * 5}. {far} write to me@mail.example, says zyxagent; {far} Zyxagent") for i in range(4)]
    rows += [(100 + i, f"{far} write about {chr(97 + i // 26) * 3}{chr(97 + i % 26) * 3} heads") for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    clean = {r.doc_id: r.text for r in sanitise(df).collect()}
    for i, t in rows:
        want = t.replace("me@mail.example", "[EMAIL]")
        # "says" has one context only, the same words in every document
        assert clean[i] == (want.replace("Zyxagent", "").replace("zyxagent", "") if i < 100 else want)


def test_random_texts_have_the_plain_patterns_spans(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice("a1@._ -+é(9") for _ in range(rng.randrange(0, 40))) for _ in range(4000)]
    texts += ["a@b.c_d@e.f", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "1.2.3.4a5.6.7.8", "x@y.z@", "@a@b.c"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r.id: _told((s.kind, s.start, s.end) for s in r.spans) for r in find_spans(df).collect()}
    assert got == {i: _told(brute(t)) for i, t in enumerate(texts)}


def test_time_grows_with_the_text_not_its_square(spark):
    """Runs that never become a match, and long documents that share an entity."""
    runs = [(1, "a" * 1_000_000 + " x@"), (2, "1" * 1_000_000 + ".1.1 @"), (3, ("b" * 500_000 + " ") * 2 + "q@r.st")]
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    longs = [(10 + k, " ".join(word() for _ in range(20_000)) + f" hidden{'abc'[k % 3]} joe@corp.example " + " ".join(word() for _ in range(20_000))) for k in range(4)]
    df = spark.createDataFrame(runs + longs, "doc_id bigint, text string")
    began = time.time()
    got = {r.id: _told((s.kind, s.start, s.end) for s in r.spans) for r in sanitise_spans(df).collect()}
    assert time.time() - began < 120
    # the plain patterns take quadratic time on such runs
    assert got == {i: _told(brute(t)) for i, t in longs} | {1: "", 2: "", 3: "email:1000002:1000008"}


def test_copies_of_a_text_are_dealt_and_get_the_same_terms(spark):
    give_away = [(k, f"{a} zebulon {b} joe@corp.example {c}") for k, (a, b, c) in enumerate([("one two", "met", "today"), ("why not", "saw", "there"), ("so then", "rang", "again")])]
    rows = give_away + [(100 + k, give_away[0][1]) for k in range(60)] + [(500 + k, f"plain words number {'abcdefgh'[k % 8] * 4}{'xyzw'[k % 4] * 3}") for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    spans = {r.id: r for r in sanitise_spans(df).collect()}
    assert len(spans) == len(rows) and [s.value for s in spans[0].terms] and all(spans[100 + k].terms == spans[0].terms for k in range(60))
