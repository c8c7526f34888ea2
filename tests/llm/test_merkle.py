"""Merkle manifest against a tree built naively, and its DuckDB SQL."""

from __future__ import annotations

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from quarry.llm import merkle as M

SF = "/root/testdata/sf0.001"


def sha(*parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def canon(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes, fanout):
    """The root, and for every node its siblings (before, after) by level."""
    paths = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, i in enumerate(at):
            run = nodes[i - i % fanout : i - i % fanout + fanout]
            paths[leaf].append((run[: i % fanout], run[i % fanout + 1 :]))
        nodes = [sha(*nodes[k : k + fanout]) for k in range(0, len(nodes), fanout)]
        at = [i // fanout for i in at]
    return nodes[0], paths


def brute(docs, fanout=8):
    """doc rows are (doc_id, text, lang, source, n_chars)."""
    leaf = lambda i, x, lang, s, n: sha(*map(canon, (i, s, lang, n, x)))
    groups: dict = {}
    for row in docs:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        rows = sorted(groups[name], key=lambda r: (r[0] is None, r[0] or 0, leaf(*r)))
        trees[name] = (rows, *climb([leaf(*r) for r in rows], fanout))
    root, tops = climb([trees[n][1] for n in names], fanout)
    out = []
    for name, top in zip(names, tops):
        rows, subroot, paths = trees[name]
        for row, path in zip(rows, paths):
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[1] is not None
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1]) if tampered else row[1]
            folded = leaf(row[0], text, *row[2:])
            for before, after in path + top:
                folded = sha(*before, folded, *after)
            proof = sha(*(x for before, after in path + top for x in before + after))
            out.append((row[0], leaf(*row), subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


def _query(spark, docs, scratch_dir):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree int, digest string, path string"
    spark.createDataFrame([(*d, 1, "x", "y") for d in docs], schema).repartition(5).write.parquet(f"{scratch_dir}/documents.parquet")
    return M.op11_merkle_manifest(spark, scratch_dir)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_edge_rows_against_a_naive_tree(spark, scratch_dir):
    docs = [(i, f"Text {i} ÄB", ("en", "é", None, "de")[i % 4], None if i % 5 else "S", i) for i in range(140)]
    docs += [(500, None, "solo", None, None), (None, "No Id", "en", "S", 1), (None, "No Id", "en", "S", 1), (7, "", "en", None, 0)]
    docs += [(3, "Same ID", "de", "a", 1), (3, "other", "de", "b", 2), (9, "Long " * 60_000, "xx", "s", 5), (12, "lower", "", "s", 5)]
    docs += [(1000 + k, f"Many {k}", f"lang{k}", "s", k) for k in range(9)]  # two levels above the subroots
    want = brute(docs)
    assert _rows(_query(spark, docs, scratch_dir)) == want
    assert {r[-1] for r in want} == {True, False}


@pytest.mark.parametrize("docs", [[], [(4, "A", None, None, None)], [(i, "B", "en", None, i) for i in range(8)], [(i, "B", "en", None, i) for i in range(9)]])
def test_small_trees(spark, scratch_dir, docs):
    assert _rows(_query(spark, docs, scratch_dir)) == (brute(docs) if docs else [])


@pytest.mark.parametrize("fanout", [2, 3])
def test_other_fanouts(spark, fanout):
    docs = [(i, f"t{i}", "ab"[i % 2], "s", i) for i in range(23)]
    leaves = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    proven = M.manifest(leaves.select("doc_id", "lang", M.leaf_digest(*values).alias("leaf")), "doc_id", "lang", fanout=fanout)
    got = proven.select("doc_id", M.hex_text(F.col("root")).alias("root"), M.proof_digest(F.col("path")).alias("proof"), M.fold(F.col("leaf"), F.col("path")).alias("folded"))
    assert _rows(got) == [(r[0], r[3], r[4], r[3]) for r in sorted(brute(docs, fanout), key=lambda r: repr((r[0], r[3], r[4], r[3])))]
    with pytest.raises(ValueError):
        M.manifest(leaves, "doc_id", "lang", leaf="text", fanout=1)


def test_query_against_brute_force_and_sql(spark):
    docs = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = M.op11_merkle_manifest(spark, SF)
    assert _rows(got) == brute(docs)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    assert sorted(con.execute(M.OP11_SQL).fetchall(), key=repr) == brute(docs)
