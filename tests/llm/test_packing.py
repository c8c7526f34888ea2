"""Packing: ids equal the tokenizer's, places gapless, near the lower bound."""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import combinations

import numpy as np
from tokenizers import Tokenizer

from quarry.llm.packing import CAPACITY, _SumIndex, _WordTokens, op6_best_fit_packing, pack_documents, plan_lengths, sequences, word_bpe_path

SF = "/root/testdata/sf0.01"


def _check(rows, capacity):
    by_seq: dict = {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_seq)


def test_query_against_the_tokenizer(spark):
    rows = op6_best_fit_packing(spark, SF).collect()
    t = Tokenizer.from_file(word_bpe_path())
    want = {}
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for (doc, _), e in zip(docs, t.encode_batch([x for _, x in docs], add_special_tokens=False)):
        ids = [*e.ids, 0]
        for piece, at in enumerate(range(0, len(ids), CAPACITY)):
            own = ids[at : at + CAPACITY]
            want[doc, piece] = (at, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    used = _check(rows, CAPACITY)
    assert used <= 1.01 * -(-sum(v[1] for v in want.values()) // CAPACITY) + 1


def test_word_by_word_encoding_equals_whole_texts():
    tokens = _WordTokens(word_bpe_path())
    t = Tokenizer.from_file(word_bpe_path())
    for text in ["hello <|endoftext|> world", "a<|endoftext|>b<|startoftext|>", "<|ENDOFTEXT|> <|endof text|>", "", " ", "it's they'll DON'T x'S", "a\x1cb \x85c\xa0d", "é é É́ ß ẞ İI", "ΣΑΣ", "12a3 ²½", "日本 語", "<|endoftext|> x", "%%% ###!!! a--b", "​ ﻿x"]:
        assert tokens.encode(text.encode().split()) == np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_plan_uses_every_piece_once_and_finds_exact_fills():
    rng = np.random.default_rng(1)
    for capacity, lengths in ((10, [9, 1, 5, 5, 4, 3, 3, 10, 7, 2, 1]), (100, rng.integers(1, 101, 3000)), (7, [4] * 5), (5, [5] * 3), (50, [])):
        counts = Counter(int(x) for x in lengths)
        plan = plan_lengths(dict(counts), capacity)
        used: Counter = Counter()
        for times, group in plan:
            assert sum(group) <= capacity
            for x in group:
                used[x] += times
        assert used == counts
        n = sum(times for times, _ in plan)
        assert n >= -(-sum(lengths) // capacity)
    # 9+1, 5+5, 4+3+3, 10, 7+2+1: five full sequences
    assert sum(t for t, _ in plan_lengths(Counter([9, 1, 5, 5, 4, 3, 3, 10, 7, 2, 1]), 10)) == 5


def test_edge_rows(spark):
    rows = [(1, "one two three"), (1, "one two three"), (None, None), (3, ""), (4, "word " * 100)]
    docs = spark.createDataFrame([(*r, 7, 8) for r in rows], "doc_id bigint, text string, length int, part int").repartition(3)
    packed = pack_documents(docs, word_bpe_path(), capacity=16, keep_ids=True)
    got = packed.collect()
    assert _check(got, 16) >= 1
    assert sorted((r.doc_id or 0, r.length) for r in got if r.doc_id != 4) == [(0, 1), (1, 4), (1, 4), (3, 1)]
    assert [r.length for r in sorted((r for r in got if r.doc_id == 4), key=lambda r: r.piece)] == [16] * 6 + [5]
    whole = sequences(packed).collect()
    assert sum(len(r.ids) for r in whole) == 4 * sum(r.length for r in got)
    assert pack_documents(docs.limit(0), word_bpe_path()).count() == 0


def test_sum_index_follows_the_counts_and_finds_every_fill():
    rng = np.random.default_rng(4)
    for capacity in (1, 2, 7, 12, 16):
        free = rng.integers(0, 4, capacity + 1) * (rng.random(capacity + 1) < 0.6)
        free[0] = 0
        index = _SumIndex(free)
        while True:
            again = _SumIndex(index.free)
            assert (index.pairs == again.pairs).all() and (index.triples == again.triples).all()
            pieces = [x for x in range(1, capacity + 1) for _ in range(index.free[x])]
            for length in set(pieces):
                rest = pieces.copy()
                rest.remove(length)
                own = {sum(c) for k in (1, 2, 3) for c in combinations(rest, k)}
                for gap in range(1, capacity):
                    found = index.fill(length, gap)
                    assert (found is not None) == (gap in own), (capacity, length, gap)
                    assert found is None or (sum(found) == gap and list(found) == sorted(found, reverse=True))
            if not pieces:
                break
            x = int(rng.choice(pieces))
            index.take(x, int(rng.integers(1, index.free[x] + 1)))
