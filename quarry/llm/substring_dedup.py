"""Substring deduplication with a count-min prefilter.

A window is ``width`` consecutive words of one document; a word goes if a
window over it also starts earlier.

Pass 1, sketches.  Inside a window the sub-window of ``SUB`` words with the
smallest hash is its anchor.  Equal windows have equal anchors at different
places, so the number of anchor places with one hash is at least the number
of windows that share it: a count-min sketch of anchor places overestimates
every window's count, with several times fewer entries than windows.  Tasks
fill sparse partition sketches, which are merged block by block in a shuffle;
of the merged counters one bit is kept, "two or more in this cell".

Pass 2, exact grouping.  Only windows whose cells say "two or more" in every
row of the sketch are grouped, by a 128-bit fingerprint of their words.  Each
task first keeps the earliest place per fingerprint, Spark keeps the earliest
of all.  A window estimated repeated that is not itself such a first place
starts earlier elsewhere; a window never estimated repeated is unique.  So
only first places travel back to the documents, where the candidate windows
are found again from the text: hot passages never meet in one task.

The sketch's width follows the size of the input up to ``MAX_CELLS``; beyond
it more unique windows reach the exact grouping, and no result changes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.textvec import Words, chunks, mix, sliding, window_hashes, word_hashes, words

WIDTH = 20
SUB = 10
ROWS = 2
MIN_CELLS = 1 << 16
MAX_CELLS = 1 << 31  # per row: bounds the merged sketch at 512 MB
BLOCK = 1 << 16
# Text bytes per anchor place, from which the sketch's width is chosen.
BYTES_PER_ANCHOR = 36
_FOLD_AT = 2_000_000

_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _anchors(w: Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word: the hash of the sub-window there, the anchor hash of the
    window that starts there, and whether such a window exists."""
    n = len(w.start)
    sub = min(SUB, width)
    room = w.row_end() - np.arange(n)
    values = window_hashes(word_hashes(w, 0), sub, 2)
    values[room < sub] = _NONE
    return values, sliding(values, width - sub + 1, np.minimum), room >= width


def _cells(values: np.ndarray, cells: int) -> list[np.ndarray]:
    """The cell of each value in every row of the sketch."""
    mask = np.uint64(cells - 1)
    return [(mix(values + np.uint64(0x9E37 + 7919 * r)) & mask) for r in range(ROWS)]


class _PartitionSketch:
    """Cells met once and cells met more often, sparse and sorted."""

    def __init__(self) -> None:
        self.once = np.zeros(0, dtype=np.uint64)
        self.more = np.zeros(0, dtype=np.uint64)
        self.new: list[np.ndarray] = []
        self.held = 0

    def add(self, cells: np.ndarray) -> None:
        self.new.append(cells)
        self.held += len(cells)
        if self.held > _FOLD_AT:
            self.fold()

    def fold(self) -> None:
        every = np.concatenate([*self.new, self.once, self.more, self.more])
        cells, counts = np.unique(every, return_counts=True)
        self.once, self.more = cells[counts == 1], cells[counts > 1]
        self.new, self.held = [], 0


_SKETCH = "block bigint, once binary, more binary"


def _blocks(sketch: _PartitionSketch) -> Iterator[pa.RecordBatch]:
    """The sketch as rows of 16-bit cell numbers by block."""
    sketch.fold()
    once_block, more_block = sketch.once // np.uint64(BLOCK), sketch.more // np.uint64(BLOCK)
    ids = np.union1d(once_block, more_block)
    low = np.uint64(BLOCK - 1)
    a = np.searchsorted(once_block, ids), np.searchsorted(once_block, ids, side="right")
    b = np.searchsorted(more_block, ids), np.searchsorted(more_block, ids, side="right")
    once, more = (sketch.once & low).astype("<u2"), (sketch.more & low).astype("<u2")
    for at in range(0, len(ids), 512):
        some = slice(at, at + 512)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids[some].astype(np.int64)),
                pa.array([once[x:y].tobytes() for x, y in zip(a[0][some], a[1][some])], pa.binary()),
                pa.array([more[x:y].tobytes() for x, y in zip(b[0][some], b[1][some])], pa.binary()),
            ],
            names=["block", "once", "more"],
        )


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block to one bitmap of cells with two or more each; two
    bitmaps in memory whatever the number of partition sketches."""
    block, seen, twice = None, None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([np.packbits(twice, bitorder="little").tobytes()], pa.binary())], names=["block", "bits"])

    for batch in batches:
        for b, once, more in zip(*(c.to_pylist() for c in batch.columns)):
            if b != block:
                if block is not None and twice.any():
                    yield done()
                block, seen, twice = b, np.zeros(BLOCK, dtype=bool), np.zeros(BLOCK, dtype=bool)
            one = np.frombuffer(once, "<u2")
            twice[one[seen[one]]] = True
            seen[one] = True
            twice[np.frombuffer(more, "<u2")] = True
            seen |= twice
    if block is not None and twice.any():
        yield done()


class RepeatSketch:
    """The merged sketch: one bit per cell and row."""

    def __init__(self, cells: int, blocks: list[tuple[int, bytes]]):
        self.cells = cells
        self.bits = np.zeros(ROWS * cells // 8, dtype=np.uint8)
        for block, bits in blocks:
            self.bits[block * BLOCK // 8 : (block + 1) * BLOCK // 8] = np.frombuffer(bits, np.uint8)

    def repeated(self, values: np.ndarray) -> np.ndarray:
        """True where a value's count is estimated at two or more."""
        out = np.ones(len(values), dtype=bool)
        for r, cell in enumerate(_cells(values, self.cells)):
            at = cell + np.uint64(r * self.cells)
            out &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def build_sketch(docs: DataFrame, width: int = WIDTH) -> Broadcast:
    """Partition sketches of all texts, merged and broadcast."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = MIN_CELLS
    while cells < min(MAX_CELLS, 3 * size // BYTES_PER_ANCHOR):
        cells *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = _PartitionSketch()
        for batch in batches:
            for part in chunks(batch):
                w = words(part.column("text"))
                values, anchor, valid = _anchors(w, width)
                if not valid.any():
                    continue
                # a sub-window is an anchor place if it is the smallest of some window over it
                wanted = np.where(valid, anchor, np.uint64(0))
                reach = width - min(SUB, width) + 1
                top = sliding(wanted[::-1], reach, np.maximum)[::-1]
                picked = values[(top == values) & (values != _NONE)]
                sketch.add(np.concatenate([c + np.uint64(r * cells) for r, c in enumerate(_cells(picked, cells))]))
        yield from _blocks(sketch)

    merged = docs.select("text").mapInArrow(run, _SKETCH).repartition("block").sortWithinPartitions("block").mapInArrow(_merge, "block bigint, bits binary")
    return spark.sparkContext.broadcast(RepeatSketch(cells, [(r["block"], bytes(r["bits"])) for r in merged.collect()]))


def _candidates(w: Words, sketch: RepeatSketch, width: int) -> np.ndarray:
    """Word positions where a window estimated repeated starts."""
    _, anchor, valid = _anchors(w, width)
    starts = np.flatnonzero(valid)
    return starts[sketch.repeated(anchor[starts])]


def first_places(docs: DataFrame, sketch: Broadcast, width: int = WIDTH) -> DataFrame:
    """``doc, key, start``: the earliest place of every distinct window that
    is estimated repeated, by exact grouping on 128-bit fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for part in chunks(batch):
                w = words(part.column("text"))
                at = _candidates(w, sketch.value, width)
                if not len(at):
                    continue
                row = np.searchsorted(w.rows, at, side="right") - 1
                doc, key = part.column("doc").to_numpy()[row], part.column("key").to_numpy()[row]
                f1 = window_hashes(word_hashes(w, 0), width, 3)[at]
                f2 = window_hashes(word_hashes(w, 1), width, 2)[at]
                held.append((f1.view(np.int64), f2.view(np.int64), doc, key, at - w.rows[row]))
            if not held:
                continue
            f1, f2, doc, key, start = (np.concatenate(c) for c in zip(*held))
            order = np.lexsort((start, key, doc, f2, f1))
            f1, f2 = f1[order], f2[order]
            first = np.ones(len(order), dtype=bool)
            first[1:] = (f1[1:] != f1[:-1]) | (f2[1:] != f2[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(f1[first]), pa.array(f2[first]), *(pa.array(c[order][first]) for c in (doc, key)), pa.array(start[order][first].astype(np.int32))],
                names=["f1", "f2", "doc", "key", "start"],
            )

    rows = docs.mapInArrow(run, "f1 bigint, f2 bigint, doc bigint, key bigint, start int")
    return rows.groupBy("f1", "f2").agg(F.min(F.struct("doc", "key", "start")).alias("p")).select("p.doc", "p.key", "p.start")


def dedup_substrings(docs: DataFrame, width: int = WIDTH, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``ident, n_words, n_removed, kept`` for every row of ``docs``: ``kept``
    is the text without the words of windows that start earlier elsewhere,
    joined by one space.

    A null or empty text has no words; a text shorter than a window loses
    none.  A null id comes after all others.  Rows that share an id, or have
    none, follow each other by a 64-bit hash of their text; rows equal in both
    are copies of one document, neither earlier than the other.  Texts of any
    length are read whole; other columns are ignored."""
    none = (1 << 63) - 1
    value = F.coalesce(F.col(text), F.lit(""))
    src = docs.select(F.coalesce(F.col(ident).cast("bigint"), F.lit(none)).alias("doc"), F.xxhash64(value).alias("key"), value.alias("text"))
    sketch = build_sketch(src, width)
    firsts = first_places(src, sketch, width)
    by_doc = firsts.groupBy("doc", "key").agg(F.collect_list("start").alias("firsts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                w = words(part.column("text"))
                n = len(w.start)
                repeated = np.zeros(n, dtype=bool)
                repeated[_candidates(w, sketch.value, width)] = True
                lists = part.column("firsts")
                sizes = np.where(np.asarray(lists.is_null()), 0, np.asarray(lists.value_lengths().fill_null(0)))
                places = lists.flatten().to_numpy() + np.repeat(w.rows[:-1], sizes)
                repeated[places[places < np.repeat(w.rows[1:], sizes)]] = False
                edges = np.zeros(n + width + 1, dtype=np.int64)
                at = np.flatnonzero(repeated)
                edges[at] += 1
                edges[at + width] -= 1
                keep = np.cumsum(edges[:n]) == 0
                kept = []
                raw = w.raw.tobytes()
                for r in range(part.num_rows):
                    own = np.arange(w.rows[r], w.rows[r + 1])[keep[w.rows[r] : w.rows[r + 1]]]
                    kept.append(b" ".join([raw[a:b] for a, b in zip(w.start[own].tolist(), w.end[own].tolist())]).decode())
                count = np.diff(w.rows)
                left = np.concatenate([[0], np.cumsum(keep)])
                gone = count - (left[w.rows[1:]] - left[w.rows[:-1]])
                yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(count), pa.array(gone), pa.array(kept, pa.string())], names=["doc", "n_words", "n_removed", "kept"])

    joined = src.join(by_doc, ["doc", "key"], "left").select("doc", "text", "firsts")
    out = joined.mapInArrow(run, "doc bigint, n_words bigint, n_removed bigint, kept string")
    return out.select(F.when(F.col("doc") != none, F.col("doc")).alias(ident), "n_words", "n_removed", "kept")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 20-word windows removed from all ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = dedup_substrings(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT doc_id, words, UNNEST(range(1, len(words) - 18)) AS pos FROM w WHERE len(words) >= 20
), f AS (
  SELECT doc_id, pos, first_value(struct_pack(d := doc_id, a := pos)) OVER (PARTITION BY words[pos:pos + 19] ORDER BY doc_id, pos) AS first FROM s
), gone AS (
  SELECT DISTINCT doc_id, pos + k AS pos FROM (SELECT doc_id, pos, UNNEST(range(0, 20)) AS k FROM f WHERE first.d <> doc_id OR first.a <> pos)
), kept AS (
  SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.pos) AS text, COUNT(*) AS n
  FROM (SELECT doc_id, UNNEST(words) AS word, generate_subscripts(words, 1) AS pos FROM w) e
  LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.pos = e.pos
  WHERE g.pos IS NULL GROUP BY e.doc_id
)
SELECT w.doc_id, len(w.words) AS n_words, CAST(len(w.words) - COALESCE(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(COALESCE(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""
