"""Merkle manifest of a dataset, built level by level with sibling joins.

Rows are leaves of one tree per group; the trees' roots are the leaves of a
tree of their own, whose root stands for the dataset.  Positions within a tree
are dense, so the siblings of a node are known without looking at it: for
trees of two the index XOR 1, otherwise the other slots of its run.  On every
level each node sends its digest to the computed indices of its siblings, an
equijoin on (tree, index) brings them together, and the node in slot zero of a
run emits the parent.  Nodes shrink by the fan-out per level, so there are
about log(rows) levels; each is written to the shared folder before the next.

Proofs are handed down the same tree: a node's path is its siblings followed
by its parent's path.  Every join is on an index that no two nodes share, so a
hot group costs no more than many small ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.keys import assign_keys
from quarry.session import materialize

FANOUT = 8
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PATH = "array<struct<before:binary,after:binary>>"
_NODE = ["tree", "index"]


def canonical(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """SHA-256 (binary) of a row's canonical values."""
    return F.unhex(F.sha2(F.concat(*[canonical(v) for v in values]), 256))


def hex_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def node_digest(*digests: Column) -> Column:
    """SHA-256 (binary) of digests written one after the other as hex text."""
    return F.unhex(F.sha2(hex_text(F.concat(*digests)), 256))


def sibling_indices(index: Column, fanout: int) -> Column:
    """Indices of the other nodes of a run, whether they exist or not."""
    if fanout == 2:
        return F.array(index.bitwiseXOR(F.lit(1)))
    slot = index % fanout
    return F.transform(F.sequence(F.lit(1), F.lit(fanout - 1)), lambda d: index - slot + (slot + d) % fanout)


def _joined(digests: Column) -> Column:
    return F.aggregate(digests, F.lit(bytearray()), lambda done, d: F.concat(done, d["digest"]))


def _with_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` plus the digests of earlier and later siblings."""
    index, slot = F.col("index"), F.col("index") % fanout
    sent = (
        nodes.select("tree", "size", "digest", slot.alias("slot"), F.explode(sibling_indices(index, fanout)).alias("index"))
        .where("index < size")
        .groupBy(*_NODE)
        .agg(F.sort_array(F.collect_list(F.struct("slot", "digest"))).alias("others"))
    )
    met = nodes.join(sent, _NODE, "left").withColumn("others", F.coalesce("others", F.array().cast("array<struct<slot:bigint,digest:binary>>")))
    return met.select(
        *nodes.columns,
        _joined(F.filter("others", lambda o: o["slot"] < slot)).alias("before"),
        _joined(F.filter("others", lambda o: o["slot"] > slot)).alias("after"),
    )


def _parents(level: DataFrame, fanout: int) -> DataFrame:
    """The node in slot zero of every run emits the run's parent."""
    return level.where(F.col("index") % fanout == 0).select(
        "tree",
        (F.col("index") / fanout).cast("bigint").alias("index"),
        F.ceil(F.col("size") / fanout).cast("bigint").alias("size"),
        node_digest(F.col("digest"), F.col("after")).alias("digest"),
    )


def _climb(nodes: DataFrame, largest: int, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """All levels of all trees, nodes with their siblings, and one row per
    tree: its root digest and the ``depth`` at which it stood alone."""
    levels: list[DataFrame] = []
    alone = nodes.where("size = 1").select("tree", "digest", F.lit(0).alias("depth"))
    while largest > 1:
        level = materialize(_with_siblings(nodes.where("size > 1"), fanout), "merkle-level")
        levels.append(level)
        nodes = _parents(level, fanout)
        alone = alone.unionByName(nodes.where("size = 1").select("tree", "digest", F.lit(len(levels)).alias("depth")))
        largest = -(-largest // fanout)
    return levels, materialize(alone, "merkle-roots")


def _descend(levels: list[DataFrame], lone: DataFrame, tops: DataFrame, fanout: int) -> DataFrame:
    """The leaves with their ``path``.  ``tops`` has one row per tree: the
    depth of its root, the path from there on, and columns to hand down;
    ``lone`` are leaves that are roots themselves."""
    given = [c for c in tops.columns if c not in ("tree", "depth", "path")]
    above = None
    for k in reversed(range(len(levels))):
        roots = tops.where(F.col("depth") == k + 1).select("tree", F.lit(0).cast("bigint").alias("parent"), "path", *given)
        known = roots if above is None else above.select("tree", F.col("index").alias("parent"), "path", *given).unionByName(roots)
        own = F.array(F.struct("before", "after"))
        here = levels[k].withColumn("parent", (F.col("index") / fanout).cast("bigint")).join(known, ["tree", "parent"])
        carried = [c for c in levels[k].columns if c not in ("before", "after")]
        above = here.select(*carried, F.concat(own, F.col("path")).alias("path"), *given)
    ends = lone.join(tops.where("depth = 0").drop("depth"), "tree")
    return ends if above is None else above.unionByName(ends)


def _numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``rows`` with ``index`` (0, 1, ... in ``order`` within each tree) and
    ``size`` of the tree, and the size of the largest tree."""
    placed = assign_keys(rows, "position", order)
    trees = materialize(placed.groupBy("tree").agg(F.min("position").alias("first"), F.count(F.lit(1)).alias("size")), "merkle-trees")
    largest = trees.agg(F.max("size")).first()[0] or 0
    nodes = placed.join(trees, "tree").withColumn("index", F.col("position") - F.col("first")).drop("position", "first")
    return materialize(nodes, "merkle-leaves"), largest


def manifest(leaves: DataFrame, ident: str, group: str, leaf: str = "leaf", fanout: int = FANOUT) -> DataFrame:
    """One row per row of ``leaves``: its columns, and ``subroot`` (root of its
    group's tree), ``root`` (of the dataset) and ``path``, an array with the
    earlier and the later siblings' digests per level, leaf upwards.  All
    digests are binary.

    ``leaf`` holds each row's digest.  In a tree leaves ascend by ``ident``
    (null ids last), equal ids by digest, and rows that still tie are equal in
    what is hashed.  While a level has more than one node, every ``fanout``
    consecutive ones become their digest; a last run may be shorter, even one
    node.  Groups follow each other by their name's UTF-8 bytes, the null
    group first.  A single leaf is its tree's root, a single tree's root the
    dataset's; an empty input has no rows and no root.  Other columns may have
    any name that ``subroot``, ``root`` and ``path`` do not clash with."""
    if fanout < 2:
        raise ValueError("a run has at least two nodes")
    payload = [c for c in leaves.columns if c not in (ident, leaf)]
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    rows = leaves.select(tree.alias("tree"), F.col(ident).alias("ident"), F.col(leaf).alias("digest"), F.struct(F.lit(0).alias("none") if not payload else F.col(payload[0]), *payload[1:]).alias("row"))
    # written first: the range partitioner reads its input twice
    nodes, largest = _numbered(materialize(rows, "merkle-digests"), ["tree", "ident", "digest"])
    levels, roots = _climb(nodes, largest, fanout)

    subroots = roots.select(F.lit("").alias("tree"), F.col("tree").alias("member"), "digest")
    tops, most = _numbered(subroots, ["tree", "member"])
    top_levels, top = _climb(tops, most, fanout)
    whole = top.select("tree", "depth", F.array().cast(PATH).alias("path"), F.col("digest").alias("root"))
    of_tree = _descend(top_levels, tops, whole, fanout).select(F.col("member").alias("tree"), F.col("digest").alias("subroot"), "root", "path")
    of_tree = materialize(of_tree.join(roots.select("tree", "depth"), "tree"), "merkle-tops")

    proven = _descend(levels, nodes.where("size = 1"), of_tree, fanout)
    return proven.select(
        F.col("ident").alias(ident), F.col("digest").alias(leaf), *[F.col("row")[c].alias(c) for c in payload], "subroot", "root", "path"
    )


def fold(leaf: Column, path: Column) -> Column:
    """The root (hex text) that a leaf and its path's siblings lead to."""
    step = lambda done, p: F.sha2(F.concat(hex_text(p["before"]), done, hex_text(p["after"])), 256)
    return F.aggregate(path, hex_text(leaf), step)


def proof_digest(path: Column) -> Column:
    """Hex digest of all siblings of a path, level by level, left to right."""
    siblings = F.aggregate(path, F.lit(bytearray()), lambda done, p: F.concat(done, p["before"], p["after"]))
    return F.sha2(hex_text(siblings), 256)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, roots, proofs and verification of all ``documents``, one tree
    per language.  A row with a null id is never tampered with."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = leaf_digest(*values, F.translate("text", UPPER, UPPER.lower()))
    leaf = leaf_digest(*values, F.col("text"))
    leaves = docs.select("doc_id", F.col("lang").alias("lang"), leaf.alias("leaf"), F.when(chosen, lowered).alias("tampered"))
    proven = manifest(leaves, "doc_id", "lang")
    folded = fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return proven.select(
        "doc_id",
        hex_text(F.col("leaf")).alias("leaf"),
        hex_text(F.col("subroot")).alias("subroot"),
        hex_text(F.col("root")).alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == hex_text(F.col("root"))).alias("verified"),
    )


def _sql_levels(prefix: str, count: int) -> str:
    """Levels of ``<prefix>n0 (tree, i, d)`` and, along them, the proofs of
    ``<prefix>p0 (r, tree, i, proof, folded)``."""
    out = []
    for k in range(count):
        out.append(
            f"""{prefix}r{k} AS MATERIALIZED (
  SELECT tree, i // 8 AS run, string_agg(d, '' ORDER BY i) AS ds, SUM(COUNT(*)) OVER (PARTITION BY tree) AS size
  FROM {prefix}n{k} GROUP BY tree, i // 8
), {prefix}n{k + 1} AS MATERIALIZED (
  SELECT tree, run AS i, CASE WHEN size > 1 THEN sha256(ds) ELSE ds END AS d FROM {prefix}r{k}
), {prefix}p{k + 1} AS MATERIALIZED (
  SELECT r, p.tree, run AS i,
    proof || substring(ds, 1, 64 * (i % 8)) || substring(ds, 64 * (i % 8) + 65) AS proof,
    CASE WHEN size > 1 THEN sha256(substring(ds, 1, 64 * (i % 8)) || folded || substring(ds, 64 * (i % 8) + 65)) ELSE folded END AS folded
  FROM {prefix}p{k} p JOIN {prefix}r{k} s ON p.tree = s.tree AND p.i // 8 = s.run
)"""
        )
    return ", ".join(out)


_DEPTH = 9  # 8 ** 9 rows a language
_TOP = 3
_CANON = "COALESCE(strlen(CAST({0} AS VARCHAR)) || ':' || {0}, '-')"
_HEAD = " || ".join(_CANON.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
_LOWERED = f"translate(text, '{UPPER}', '{UPPER.lower()}')"
_BITS = "list_reduce(range(8), lambda a, k: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, xor(c, b))"
_CRC = f"""xor(list_reduce(list_transform(range(1, strlen(CAST(doc_id AS VARCHAR)) + 1),
  lambda j: CAST(ascii(substring(CAST(doc_id AS VARCHAR), j, 1)) AS BIGINT)), lambda c, b: {_BITS}, CAST(4294967295 AS BIGINT)), 4294967295)"""

OP11_SQL = f"""
WITH leaves AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, COALESCE('=' || lang, '-') AS tree,
    sha256({_HEAD} || {_CANON.format("text")}) AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {_CRC} % 3 = 0 THEN sha256({_HEAD} || {_CANON.format(_LOWERED)}) END AS tampered
  FROM documents
), placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS LAST, leaf) - 1 AS i FROM leaves
), n0 AS MATERIALIZED (SELECT tree, i, leaf AS d FROM placed),
p0 AS MATERIALIZED (SELECT r, tree, i, '' AS proof, COALESCE(tampered, leaf) AS folded FROM placed),
{_sql_levels("", _DEPTH)},
sub AS MATERIALIZED (SELECT tree AS name, d, row_number() OVER (ORDER BY tree) - 1 AS i FROM n{_DEPTH}),
tn0 AS MATERIALIZED (SELECT 0 AS tree, i, d FROM sub),
tp0 AS MATERIALIZED (SELECT r, 0 AS tree, sub.i, proof, folded FROM p{_DEPTH} p JOIN sub ON sub.name = p.tree),
{_sql_levels("t", _TOP)}
SELECT doc_id, leaf, sub.d AS subroot, t.d AS root, sha256(p.proof) AS proof_sha256, p.folded AS folded_root, p.folded = t.d AS verified
FROM placed JOIN tp{_TOP} p USING (r) JOIN sub ON sub.name = placed.tree CROSS JOIN tn{_TOP} t
"""
