"""The pipeline's stages against brute-force versions, and the components."""

from __future__ import annotations

import random

import corpus_pipeline as P
from quarry.llm.components import connected_components
from quarry.llm.decontamination import normalise
from tests.llm.test_near_dedup import brute as groups
from tests.llm.test_pii import brute as spans

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    language, near, leaks, pii, packing = (f for _, f in P.STAGES)
    kept = language(spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() == len(rows)

    want = {i for i, (_, c) in groups([(i, r.text) for i, r in rows.items()], 5, 80).items() if i == c}
    one = near(spark, docs, SF)
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == want and len(want) < len(rows)

    items = [normalise(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {r.doc_id for r in leaks(spark, docs, SF).collect()}
    assert left == {i for i, r in rows.items() if not any(t in normalise(r.text) for t in items)} and len(left) < len(rows)

    clean = pii(spark, docs, SF)
    assert clean.columns == docs.columns
    for r in clean.collect():
        if not spans(rows[r.doc_id].text):
            assert r.text == rows[r.doc_id].text
        else:
            assert not spans(r.text) and r.n_chars == len(r.text)

    packed = packing(spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == set(rows)


def test_repeated_rows_and_shared_ids_leave_one_of_a_group(spark):
    words = [f"word{k}" for k in range(60)]
    text, near = " ".join(words), " ".join([*words[:-1], "other"])
    alone = [" ".join(f"{p}{k}" for k in range(40)) for p in "abc"]
    rows = [(1, text), (1, text), (None, near), (None, text), (7, text), (7, alone[0]), (None, alone[1]), (None, alone[1]), (9, alone[2]), (9, ""), (9, ""), (12, None)]
    docs = spark.createDataFrame([(i, t, 5, 6) for i, t in rows], "doc_id bigint, text string, near_id int, shared int").repartition(4)
    left = P.near_dedup_stage(spark, docs, SF)
    assert left.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=repr)
    group = [r for r in got if r[1] in (text, near)]
    assert len(group) == 1
    assert sorted((r for r in got if r not in group), key=repr) == sorted([(7, alone[0]), (None, alone[1]), (9, alone[2]), (9, ""), (12, None)], key=repr)


def test_run_applies_all_stages(spark):
    assert [n for n, _ in P.STAGES] == ["language", "near_dedup", "decontamination", "pii", "packing"]
    out = P.run(spark, SF)
    ids = {r.doc_id for r in out.collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in P.STAGES[:3]:
        docs = stage(spark, docs, SF)
    assert ids == {r.doc_id for r in docs.collect()}


def test_edge_documents(spark, tmp_path):
    rows = [(1, "the words of one text and no other", None, 1), (2, None, "en", 1), (3, "", "en", 1), (4, "12345", "en", 1), (1, "the words of one text and no other", "en", 1), (None, "some words of the text", "en", 2)]
    docs = spark.createDataFrame([(i, t, lang, None, n, "v", 7) for i, t, lang, n in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, spans string, q_own int")
    spark.createDataFrame([(1, None), (2, "a test item that is nowhere in these documents at all")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for empty in (False, True):
        at = docs.limit(0) if empty else docs
        for name, stage in P.STAGES:
            before = at.columns
            at = spark.createDataFrame(stage(spark, at, str(tmp_path)).collect(), stage(spark, at, str(tmp_path)).schema)
            assert name == "packing" or at.columns == before
        assert at.select("doc_id").distinct().count() == (0 if empty else 2)


def test_components_equal_union_find(spark):
    rng = random.Random(12)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, 2000 + i) for i in range(200)] + [(5, 5)]
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in connected_components(spark.createDataFrame([*edges, (None, 3), *edges[:20]], "u bigint, v bigint")).collect()}
    assert got == {x: find(x) for x in root}
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_language_stage_rejects_foreign_and_random_texts(spark):
    rng = random.Random(5)
    scripts = [(0x3B1, 0x3C9), (0x430, 0x44F), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3), (0x627, 0x64A), (97, 122)]
    strange = [" ".join("".join(chr(rng.randint(*ab)) for _ in range(rng.randint(2, 9))) for _ in range(n)) for n in (30, 100, 300) for ab in scripts for _ in range(5)]
    strange += ["Это простое предложение на русском языке, в котором нет ничего особенного.", "Αυτή είναι μια απλή πρόταση στα ελληνικά χωρίς τίποτα ιδιαίτερο.", "To jest proste zdanie po polsku, w którym nie ma nic szczególnego."]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fixtures = spark.createDataFrame([(10**9 + i, t) for i, t in enumerate(strange)], "doc_id bigint, text string")
    kept = {r.doc_id for r in P.language_stage(spark, docs.unionByName(fixtures, allowMissingColumns=True), SF).select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.select("doc_id").collect()}
