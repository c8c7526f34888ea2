"""Decontamination against plain dynamic programming."""

from __future__ import annotations

import random

from quarry.llm.decontamination import ItemBlock, decontaminate, find_leaks, item_blocks, myers, normalise, op1_decontamination, pieces

SF = "/root/testdata/sf0.01"


def _distance(pattern: str, text: str) -> int:
    """Smallest edit distance of pattern to a substring of text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        before, row = row, [i]
        for j, t in enumerate(text, 1):
            row.append(min(before[j - 1] + (p != t), before[j] + 1, row[j - 1] + 1))
    return min(row)


def _edited(rng: random.Random, text: str, edits: int) -> str:
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("abcdef ")
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, rng.choice("abcdef "))
    return "".join(out)


def test_myers_equals_dynamic_programming():
    rng = random.Random(3)
    for _ in range(200):
        pattern = "".join(rng.choice("abc") for _ in range(rng.randrange(4, 90)))
        text = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 120))) + _edited(rng, pattern, 2)
        want = _distance(pattern, text)
        got = myers(pattern, text, len(pattern))
        assert got is not None and got[0] == want
        assert myers(pattern, text, want - 1) is None


def test_pieces_cover_the_item():
    for n, k in ((50, 0), (50, 3), (7, 6), (3, 9)):
        cut = pieces("x" * n, k)
        assert "".join(p for _, p in cut) == "x" * n and len(cut) <= k + 1


def test_search_finds_every_item_within_its_budget():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9)))
    items = [(i, " ".join(word() for _ in range(rng.randrange(12, 40)))) for i in range(12)]
    block = ItemBlock(items, 0.05)
    for _ in range(60):
        ident, item = rng.choice(items)
        edits = rng.randrange(0, int(0.05 * len(item)) + 4)
        text = normalise(" ".join(word() for _ in range(20)) + " " + _edited(rng, item, edits) + " " + word())
        got = {i: d for i, d, _ in block.search(text)}
        for i, t in items:
            want = _distance(t, text)
            assert got.get(i) == (want if want <= int(0.05 * len(t)) else None)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = [(r.item_id, normalise(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id): r.distance for r in op1_decontamination(spark, SF).collect()}
    exact = {(d.doc_id, i) for d in docs for i, t in items if t in normalise(d.text)}
    assert exact and exact == {k for k, v in got.items() if v == 0}
    texts = {d.doc_id: normalise(d.text) for d in docs}
    by_id = dict(items)
    assert all(_distance(by_id[i], texts[d]) == v for (d, i), v in got.items() if v)


def test_edge_rows_and_blocks(spark):
    item = "the quick brown fox jumps over the lazy dog and runs far away"
    items = spark.createDataFrame([(1, item.upper()), (2, item.upper()), (3, None), (4, ""), (5, "short"), (6, item[::-1])], "item_id bigint, text string")
    rows = [(1, "x " + item.replace("quick", "quack") + " y"), (None, item), (2, None), (3, ""), (4, "z" * 100_000), (1, "x " + item.replace("  ", "\n"))]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id bigint, text string, item_id int")
    got = sorted((r.doc_id or 0, r.item_id, r.distance) for r in find_leaks(docs, items).collect())
    # items 1 and 2 have one text and are both told
    assert got == [(0, 1, 0), (0, 2, 0), (1, 1, 0), (1, 1, 1), (1, 2, 0), (1, 2, 1)]
    assert len(list(item_blocks(items, block_chars=10))) == 2  # the short one shares a block
    clean = decontaminate(docs, items)
    assert sorted((r.doc_id, r.item_id) for r in clean.collect()) == [(2, 5), (3, 5), (4, 5)]
    assert find_leaks(docs, items.limit(0)).count() == 0 and decontaminate(docs, items.limit(0)).count() == 6
    assert find_leaks(docs.limit(0), items).count() == 0


def test_short_items_match_verbatim_between_word_borders(spark):
    items = spark.createDataFrame([(1, "What is the capital of  France?"), (2, "art"), (3, "42"), (4, "-x"), (5, "Art"), (None, "solo item")], "item_id bigint, text string")
    texts = ["Q: what is the Capital of France? Paris", "what is the capital of francE", "start smart", "an art.", "1422 a42 42nd", "42", "y-x", "a -xx", "the solo item", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.item_id, r.distance) for r in find_leaks(docs, items).collect()), key=repr)
    assert got == [(0, 1, 0), (3, 2, 0), (3, 5, 0), (5, 3, 0), (6, 4, 0), (8, None, 0)]
    assert sorted(r.doc_id for r in decontaminate(docs, items).collect()) == [1, 2, 4, 7, 9]
