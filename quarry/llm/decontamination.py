"""Benchmark decontamination by pigeonhole edit matching.

A test item of n characters may appear in a document with at most
``k = floor(rate * n)`` edits.  Cut into k + 1 pieces, at least one piece of
the item must then appear unchanged, so exact hits of pieces find every
candidate place; Myers' bit-parallel algorithm gives the smallest edit
distance of the item to any part of the text around them.

Items and texts are compared in lower case with white space collapsed.  Items
of fewer than ``SHORT_CHARS`` characters have no budget and must begin and end
at word borders.  The items are the smaller side but may be many: they are taken in blocks of a
bounded number of characters, and every document is searched for each block,
so no task holds more than one block's automaton."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Share of an item's characters that may be edited.
ERROR_RATE = 0.05
# Items shorter than this (normalised) match verbatim and as whole words only:
# with edits, or inside words, they would match by chance.
SHORT_CHARS = 40
# Characters of items in one block; bounds what is sent to each task.
BLOCK_CHARS = 8_000_000

SCHEMA = "doc_id bigint, item_id bigint, distance int, end bigint"


def normalise(text: str) -> str:
    return " ".join(text.lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` consecutive pieces (offset, text) that cover ``item``."""
    n, parts = len(item), budget + 1
    cuts = [n * i // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


def myers(pattern: str, text: str, budget: int) -> tuple[int, int] | None:
    """Smallest edit distance of ``pattern`` to any substring of ``text`` if
    at most ``budget``, with the end of the first such substring."""
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, ch in enumerate(pattern):
        masks[ch] = masks.get(ch, 0) | 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best: tuple[int, int] | None = None
    for at, ch in enumerate(text):
        eq = masks.get(ch, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & full)
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph, mh = (ph << 1) & full, (mh << 1) & full
        pv, mv = mh | (~(xv | ph) & full), ph & xv
        if score <= budget and (best is None or score < best[0]):
            best = (score, at + 1)
            if score == 0:
                break
    return best


def find_words(text: str, item: str) -> int:
    """The first place of ``item`` where no word of ``text`` goes on beyond
    its ends, or -1."""
    at = text.find(item)
    while at >= 0:
        end = at + len(item)
        open_left = at > 0 and text[at - 1].isalnum() and item[0].isalnum()
        open_right = end < len(text) and text[end].isalnum() and item[-1].isalnum()
        if not open_left and not open_right:
            return at
        at = text.find(item, at + 1)
    return -1


class ItemBlock:
    """The automaton of one block of items."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items = [(i, t, int(rate * len(t)) if len(t) >= SHORT_CHARS else 0) for i, t in items]
        found: dict[str, list[tuple[int, int]]] = {}
        for row, (_, text, budget) in enumerate(self.items):
            for offset, piece in pieces(text, budget):
                found.setdefault(piece, []).append((row, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in found.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()

    def search(self, text: str) -> list[tuple[int, int, int]]:
        """``(item_id, distance, end)`` of every item within its budget."""
        spans: dict[int, list[list[int]]] = {}
        for last, (size, uses) in self.automaton.iter(text):
            for row, offset in uses:
                _, item, budget = self.items[row]
                begin = last + 1 - size - offset - budget
                end = begin + len(item) + 2 * budget
                own = spans.setdefault(row, [])
                if own and begin <= own[-1][1]:
                    own[-1][0] = min(own[-1][0], begin)
                    own[-1][1] = max(own[-1][1], end)
                else:
                    own.append([begin, end])
        out = []
        for row, own in spans.items():
            ident, item, budget = self.items[row]
            best: tuple[int, int] | None = None
            exact = text.find(item) if len(item) >= SHORT_CHARS else find_words(text, item)
            if exact >= 0:
                best = (0, exact + len(item))
            elif len(item) >= SHORT_CHARS:
                for begin, end in own:
                    begin = max(0, begin)
                    got = myers(item, text[begin:end], budget)
                    if got and (best is None or (got[0], got[1] + begin) < best):
                        best = (got[0], got[1] + begin)
            if best:
                out.append((ident, *best))
        return out


def item_blocks(items: DataFrame, ident: str = "item_id", text: str = "text", block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """Normalised items in blocks of about ``block_chars`` characters, one
    block in memory at a time.  Equal texts are searched once, under their
    smallest id; null and empty items are left out."""
    block: list[tuple[int, str]] = []
    size = 0
    rows = items.where(F.col(text).isNotNull()).groupBy(F.col(text).alias("text")).agg(F.min(ident).alias("id")).orderBy("id")
    for r in rows.toLocalIterator():
        value = normalise(r["text"])
        if not value:
            continue
        block.append((r["id"], value))
        size += len(value)
        if size >= block_chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_leaks(
    docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE, ident: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``doc_id, item_id, distance, end``: each test item found in a document
    within its edit budget, with the smallest distance and where that match
    ends in the normalised text.  Items with equal texts are told each under
    their own id.  A null or empty text or item matches nothing, texts of any
    length are searched whole, repeated documents give repeated results, an
    empty benchmark gives no row.  Other columns are ignored."""
    spark = docs.sparkSession
    src = docs.select(F.col(ident).cast("bigint").alias("id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    found: DataFrame | None = None
    for block in item_blocks(items, item, item_text):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            automaton = ItemBlock(shared.value, rate)
            for batch in batches:
                rows = [(doc, *hit) for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)) for hit in automaton.search(normalise(value.as_py()))]
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int64())
                cols = list(zip(*rows)) if rows else [[], [], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["doc_id", "item_id", "distance", "end"])

        part = src.mapInArrow(run, SCHEMA)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], SCHEMA)
    # the other ids of texts that several items share
    own = items.where(F.col(item_text).isNotNull()).select(F.col(item_text).alias("text"), F.col(item).cast("bigint").alias("own"))
    shared = own.groupBy("text").agg(F.min("own").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("text", "first")
    others = own.join(shared, "text").select("first", "own").distinct()
    told = found.join(others, F.col("item_id").eqNullSafe(F.col("first")), "left")
    return told.select("doc_id", F.coalesce("own", "item_id").alias("item_id"), "distance", "end")


def decontaminate(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text holds a test item.  Rows are
    judged one by one, so ids may be null or repeated and other columns may
    have any name."""
    at = docs.columns.index(text)
    spark = docs.sparkSession
    for block in item_blocks(items, item, item_text):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            automaton = ItemBlock(shared.value, rate)
            for batch in batches:
                clean = [not (v.is_valid and automaton.search(normalise(v.as_py()))) for v in batch.column(at)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item of ``benchmark`` found in ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = find_leaks(docs, items)
    return leaks.withColumn("items_in_document", F.count(F.lit(1)).over(Window.partitionBy("doc_id")))
