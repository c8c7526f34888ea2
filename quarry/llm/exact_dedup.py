"""Exact deduplication with Patricia tries as the owners of texts.

Texts meet by length and content hash; what decides equality is a compressed
radix trie over the full byte strings of such a key, so no hash collision can
merge two texts.  A terminal node owns one text: how many rows hold it, and
the row that stays.

Every partition first builds the tries of its own rows, key after key in
sorted order, so a text that a third of all rows share leaves a partition
once, with a count.  These local classes are written; only those whose key
occurs in several partitions travel, and are inserted into tries again, which
merge their counts and owners.

Tries are small, as the strings of one key are nearly always one text.  Should
many different strings share a key, a trie above ``TRIE_BYTES`` spills by
subtree: the heaviest branch below its first fork is cut off, its strings and
all later ones of that branch are passed on, and the next round, partitioned by
the branch's prefix as well, inserts them into a trie of their own."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import materialize

TRIE_BYTES = 64 << 20
_OUT_ROWS = 4096
_OUT_BYTES = 8 << 20


class Node:
    """A node of a Patricia trie; ``label`` leads to it from its parent.
    ``held`` is the payload of a terminal, None elsewhere."""

    __slots__ = ("label", "children", "held", "spilled")

    def __init__(self, label: bytes):
        self.label = label
        self.children: dict[int, Node] = {}
        self.held: list | None = None
        self.spilled: bytes | None = None  # the prefix of a branch that was cut off


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differ = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    at = int(differ.argmax()) if n else 0
    return at if n and differ[at] else n


class Trie:
    """Byte strings as a compressed radix trie."""

    def __init__(self, most: int):
        self.root = Node(b"")
        self.most = most
        self.size = 0  # bytes of all labels
        self.terminals = 0

    def insert(self, key: bytes) -> Node:
        """The terminal node of ``key``, or the spilled node it falls under."""
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = Node(key[at:])
                self.size += len(child.label)
                node, at = child, len(key)
                break
            if child.spilled is not None:
                return child
            if key.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            n = _common(child.label, key[at:])
            fork = Node(child.label[:n])
            child.label = child.label[n:]
            fork.children[child.label[0]] = child
            node.children[key[at]] = fork
            node, at = fork, at + n
        if node.held is None:
            node.held = []
            self.terminals += 1
        return node

    def texts(self, node: Node | None = None, before: bytes = b"") -> Iterator[tuple[bytes, Node]]:
        """All strings below a node and their terminals."""
        stack = [(node or self.root, before)]
        while stack:
            top, prefix = stack.pop()
            text = prefix + top.label
            if top.held is not None:
                yield text, top
            stack += [(c, text) for c in top.children.values()]

    def full(self) -> bool:
        return self.size > self.most and self.terminals > 1

    def spill(self) -> tuple[bytes, list[tuple[bytes, list]]]:
        """Cut off the heaviest branch below the first fork that holds no
        branch cut off earlier (its strings went on under another prefix): its
        prefix, and its strings with what they hold.  For strings of one
        length, where only leaves are terminals."""
        node, before = self.root, b""
        while True:
            before += node.label
            live = {c: sum(len(n.label) + 1 for n in self._below(c)) for c in node.children.values() if any(True for _ in self.texts(c))}
            heavy = max(live, key=live.__getitem__)
            forked = len(node.children) > 1
            if forked and all(n.spilled is None for n in self._below(heavy)):
                break
            node = heavy
        gone = [(text, terminal.held) for text, terminal in self.texts(heavy, before)]
        self.size -= sum(len(n.label) for n in self._below(heavy))
        self.terminals -= len(gone)
        heavy.spilled, heavy.children, heavy.held = before + heavy.label[:1], {}, None
        return heavy.spilled, gone

    @staticmethod
    def _below(node: Node) -> Iterator[Node]:
        stack = [node]
        while stack:
            top = stack.pop()
            yield top
            stack += top.children.values()


def _best(rows: list[tuple], largest: bool) -> tuple:
    """Of (ident, row, ...) the row that stays: the largest (smallest) id, a
    null id last; of equal ids the smallest row number."""
    named = [r for r in rows if r[0] is not None] or rows
    if named[0][0] is None:
        return min(named, key=lambda r: r[1])
    wanted = (max if largest else min)(r[0] for r in named)
    return min((r for r in named if r[0] == wanted), key=lambda r: r[1])


def _keyed_runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Slices of sorted batches with one key each; a key may span slices."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        edge = np.zeros(n, dtype=bool)
        edge[0] = True
        for k in keys:
            column = batch.column(k)
            if pa.types.is_binary(column.type):
                v = column.to_pylist()
                edge[1:] |= np.fromiter((v[i] != v[i + 1] for i in range(n - 1)), bool, n - 1)
            else:
                v = column.to_numpy(zero_copy_only=False)
                edge[1:] |= v[1:] != v[:-1]
        cuts = [*np.flatnonzero(edge).tolist(), n]
        for lo, hi in zip(cuts, cuts[1:]):
            yield tuple(batch.column(k)[lo].as_py() for k in keys), batch.slice(lo, hi - lo)


class _Out:
    """Rows of a schema, handed out as batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.bytes = schema, [], 0

    def add(self, row: tuple, size: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.bytes += size
        if len(self.rows) >= _OUT_ROWS or self.bytes >= _OUT_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.rows), self.schema)], schema=self.schema)
        self.rows, self.bytes = [], 0


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _local_classes(docs: DataFrame, id_type: T.DataType, largest: bool, most: int) -> DataFrame:
    """Rows numbered and put into classes of equal texts of their partition.
    The class's row that stays carries its text, digest and size; a class is
    named after that row."""
    schema = T.StructType().add("row", "long").add("cls", "long").add("id", id_type).add("text", "binary")
    schema = schema.add("length", "long").add("hash", "long").add("n", "long").add("digest", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(_arrow(schema))
        row = TaskContext.get().partitionId() << 33
        trie, key = Trie(most), None

        def close(texts) -> Iterator[pa.RecordBatch]:
            for text, held in texts:
                best = _best(held, largest)
                digest = hashlib.sha256(text).hexdigest()
                for ident, number in held:
                    own = (text, *key, len(held), digest) if number == best[1] else (None,) * 5
                    yield from out.add((number, best[1], ident, *own), len(text) if number == best[1] else 0)

        for now, part in _keyed_runs(batches, ("length", "hash")):
            if now != key:
                yield from close((text, node.held) for text, node in trie.texts())
                trie, key = Trie(most), now
            for ident, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                node = trie.insert(text)
                if node.spilled is not None:
                    yield from close([(text, [(ident, row)])])
                else:
                    node.held.append((ident, row))
                row += 1
                while trie.full():
                    yield from close(trie.spill()[1])
        yield from close((text, node.held) for text, node in trie.texts())
        yield from out.flush()

    return docs.sortWithinPartitions("length", "hash").mapInArrow(run, schema)


def _merge(classes: DataFrame, id_type: T.DataType, largest: bool, most: int) -> DataFrame:
    """Local classes merged by the tries of their keys: ``keep_id, size,
    keep_row`` for every class, or, for a class of a spilled branch, the class
    again with the branch's prefix as ``subtree``."""
    classes = classes.select("cls", "id", "row", "text", "length", "hash", "n", "subtree")
    out_schema = T.StructType().add("cls", "long").add("keep_id", id_type).add("size", "long").add("keep_row", "long")
    for c in classes.schema:
        if c.name != "cls":
            out_schema = out_schema.add(c.name, c.dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(_arrow(out_schema))
        trie, key = Trie(most), None

        def close() -> Iterator[pa.RecordBatch]:
            for _, node in trie.texts():
                best = _best(node.held, largest)
                size = sum(h[3] for h in node.held)
                for h in node.held:
                    yield from out.add((h[2], best[0], size, best[1], *(None,) * 7))

        def pass_on(text: bytes, held: list, prefix: bytes) -> Iterator[pa.RecordBatch]:
            for ident, number, cls, n in held:
                yield from out.add((cls, None, None, None, ident, number, text, key[0], key[1], n, prefix), len(text))

        for now, part in _keyed_runs(batches, ("length", "hash", "subtree")):
            if now != key:
                yield from close()
                trie, key = Trie(most), now
            rows = zip(*(part.column(c).to_pylist() for c in ("id", "row", "cls", "n", "text")))
            for ident, number, cls, n, text in rows:
                node = trie.insert(text)
                if node.spilled is not None:
                    yield from pass_on(text, [(ident, number, cls, n)], node.spilled)
                else:
                    node.held.append((ident, number, cls, n))
                while trie.full():
                    prefix, gone = trie.spill()
                    for string, strings_rows in gone:
                        yield from pass_on(string, strings_rows, prefix)
        yield from close()
        yield from out.flush()

    keys = ["length", "hash", "subtree"]
    return classes.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, out_schema)


def exact_duplicates(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    keep: str = "largest",
    content_hash: Callable[[Column], Column] = F.xxhash64,
    trie_bytes: int = TRIE_BYTES,
) -> DataFrame:
    """``ident, keep_id, group_size, kept, text_sha256`` for every row.

    Texts (strings or binary; null counts as empty) are equal when their bytes
    are.  Of equal texts the row with the largest id stays (``keep="smallest"``:
    the smallest); a null id stays only where the text has no other id; of
    repeated rows with that id exactly one is ``kept``.  Texts of any length
    are inserted whole.  An empty table has no rows; other columns are ignored.

    A task holds the strings of one key at a time, above ``trie_bytes`` by
    subtree, and 16 bytes for each row of its partition that shares the key."""
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep must be 'largest' or 'smallest', not {keep!r}")
    id_type, largest = docs.schema[ident].dataType, keep == "largest"
    whole = F.coalesce(F.col(text).cast("binary"), F.lit(bytearray()))
    rows = docs.select(F.col(ident).alias("id"), whole.alias("text"))
    rows = rows.withColumn("length", F.octet_length("text").cast("bigint")).withColumn("hash", content_hash(F.col("text")).cast("bigint"))
    local = materialize(_local_classes(rows, id_type, largest, trie_bytes), "exact-classes", compression="zstd")

    classes = local.where("text IS NOT NULL").select("cls", "id", "row", "text", "length", "hash", "n")
    keys = classes.groupBy("length", "hash").agg(F.count(F.lit(1)).alias("classes"))
    met = classes.join(keys.where("classes > 1").drop("classes"), ["length", "hash"]).withColumn("subtree", F.lit(bytearray()))
    merged = None
    while True:
        out = materialize(_merge(met, id_type, largest, trie_bytes), "exact-merged")
        done = out.where("text IS NULL").select("cls", "keep_id", "size", "keep_row")
        merged = done if merged is None else merged.unionByName(done)
        met = out.where("text IS NOT NULL").drop("keep_id", "size", "keep_row")
        if met.isEmpty():
            break

    # a class that met no other one is complete as it is
    of_class = local.where("n IS NOT NULL").select("cls", "id", "n", "digest").join(merged, "cls", "left").select(
        "cls", "digest",
        F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("size", "n").alias("size"), F.coalesce("keep_row", "cls").alias("keep_row"),
    )
    found = local.select("row", "cls", "id").join(of_class, "cls")
    return found.select(
        F.col("id").alias(ident), "keep_id", F.col("size").alias("group_size"), (F.col("row") == F.col("keep_row")).alias("kept"), F.col("digest").alias("text_sha256")
    )


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts among all ``documents``; the largest id stays."""
    return exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = """
WITH t AS (SELECT doc_id, sha256(COALESCE(text, '')) AS text_sha256, COALESCE(text, '') AS text FROM documents),
g AS (
  SELECT doc_id, text_sha256, MAX(doc_id) OVER (PARTITION BY text) AS keep_id, COUNT(*) OVER (PARTITION BY text) AS group_size,
    ROW_NUMBER() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST) = 1 AS kept
  FROM t
)
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM g
"""
