"""Best-fit packing by exact complements, planned on the length histogram.

1. Documents become token pieces (Arrow batches in tasks): token ids, then id
   0; only documents longer than a sequence are cut.
2. The plan is made on the histogram of piece lengths, at most ``capacity``
   numbers whatever the corpus size: for each length, longest first, the gap
   it leaves is looked up in an index of available lengths and their pair and
   triple sums and filled exactly, as many at once as the counts allow; lengths with no exact complement go to the residue, which is packed
   best fit, longest first, again by counts.
3. A piece learns its place from its rank among pieces of its length.  Ranks
   are a local number inside the task that made the piece plus the counts of
   earlier tasks, so nothing is sorted globally and a length that holds most
   rows stays spread over tasks.

The number of plan steps depends on the number of different lengths, not on
the number of pieces."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import materialize

CAPACITY = 2048
# Distinct words and letter runs whose token ids a Python worker remembers.
CACHE_WORDS = 300_000
CACHE_RUNS = 500_000

PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, local_rank bigint"


# Characters whose words are split here: ASCII and the precomposed Latin-1
# letters, which normalisation changes by case only.
_SIMPLE = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
# The tokenizer's own splitting rule, for those characters.
_RUNS = re.compile("'(?:s|t|re|ve|m|ll|d)|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")


def _byte_characters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class _WordTokens(dict):
    """Token ids of white-space separated words as little-endian uint32 bytes.

    The tokenizer drops white space and never joins across it, so a text's
    ids are its words' ids in order.  Invented and inflected words share most
    of their letter runs, so runs are remembered too and only new runs reach
    the tokenizer's model; words with other characters, or with one of the
    tokenizer's added tokens, are encoded whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        # strings of the tokenizer that stand for one id wherever they occur
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.alphabet = _byte_characters()
        self.runs: dict[str, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        text = word.decode()
        if _SIMPLE.fullmatch(text) and not any(t in text or t in text.lower() for t in self.added):
            ids = b"".join([self.runs.get(r) or self._run(r) for r in _RUNS.findall(text.lower())])
        else:
            ids = _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
        self[word] = ids
        return ids

    def _run(self, run: str) -> bytes:
        if len(self.runs) >= CACHE_RUNS:
            self.runs.clear()
        letters = run.encode().decode("latin-1").translate(self.alphabet)
        ids = self.runs[run] = _bytes([t.id for t in self.model.tokenize(letters)])
        return ids

    def encode(self, words: list[bytes]) -> bytes:
        return b"".join(map(self.__getitem__, words))


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


# Python workers are kept between tasks, and so is what they have encoded.
_ENCODERS: dict[str, _WordTokens] = {}


def _encoder(path: str) -> _WordTokens:
    if path not in _ENCODERS:
        _ENCODERS[path] = _WordTokens(path)
    return _ENCODERS[path]


def token_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, ident: str = "doc_id", text: str = "text", keep_ids: bool = False
) -> DataFrame:
    """Pieces of every document: ``doc_id, piece, start, length, ids_crc32``
    (and ``ids`` as little-endian uint32 bytes with ``keep_ids``), plus the
    task number and the piece's rank among the task's pieces of its length.

    A null or empty text is one piece holding only the closing id 0; repeated
    rows are packed as often as they occur; a null id stays null.  Other
    columns are ignored."""
    schema = PIECE_SCHEMA + (", ids binary" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        cache = _encoder(tokenizer_path)
        seen = np.zeros(capacity + 1, dtype=np.int64)
        width = 4 * capacity
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = b"" if not value.is_valid else value.as_buffer().to_pybytes()
                ids = cache.encode(raw.split()) + b"\0\0\0\0"
                for piece, at in enumerate(range(0, len(ids), width)):
                    own = ids[at : at + width]
                    n = len(own) // 4
                    for col, v in zip(out, (doc, piece, at // 4, n, zlib.crc32(own), part, int(seen[n]), own)):
                        col.append(v)
                    seen[n] += 1
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "local_rank", "ids"]
            k = 8 if keep_ids else 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out[:k], types[:k])], names=names[:k])

    return docs.select(F.col(ident).cast("bigint"), F.col(text)).mapInArrow(run, schema)


class _Plan:
    """Groups of equal sequences: how many, and the lengths in each."""

    def __init__(self) -> None:
        self.groups: list[tuple[int, tuple[int, ...]]] = []

    def add(self, times: int, lengths: tuple[int, ...]) -> None:
        if times:
            self.groups.append((times, lengths))


class _SumIndex:
    """Available lengths with their pair and triple sums up to the capacity.

    ``free`` counts each length, ``pairs[s]`` the pairs of available lengths
    with sum s (a length with itself needs two), ``triples[s]`` the available
    lengths that leave a pair sum of s.  Lengths only ever run out, so each sum
    is struck once, and all updates together cost about capacity ** 2 steps."""

    def __init__(self, free: np.ndarray):
        n = len(free)
        self.free = free.copy()
        have = (free > 0).astype(np.int64)
        doubles = np.zeros(n, dtype=np.int64)
        doubles[::2] = have[: (n + 1) // 2]
        self.pairs = (np.convolve(have, have)[:n] + doubles) // 2
        for x in np.flatnonzero(free[: (n + 1) // 2] == 1):
            self.pairs[2 * x] -= 1
        self.triples = np.convolve(have, (self.pairs > 0).astype(np.int64))[:n]

    def take(self, length: int, times: int) -> None:
        """Use up ``times`` pieces of ``length``."""
        before = int(self.free[length])
        after = before - times
        if before > 1 >= after:
            self._strike(np.array([2 * length]))
        self.free[length] = after
        if before > 0 == after:
            sums = np.flatnonzero(self.pairs[: len(self.free) - length])
            self.triples[sums + length] -= 1
            self._strike(np.flatnonzero(self.free) + length)

    def _strike(self, sums: np.ndarray) -> None:
        """One pair less for each of ``sums``; a sum without pairs leaves the triples."""
        sums = sums[sums < len(self.free)]
        self.pairs[sums] -= 1
        lengths = np.flatnonzero(self.free)
        for s in sums[self.pairs[sums] == 0]:
            self.triples[lengths[lengths < len(self.free) - s] + s] -= 1

    def _enough(self, parts: tuple[int, ...]) -> bool:
        return all(self.free[x] >= parts.count(x) for x in parts)

    def fill(self, length: int, gap: int) -> tuple[int, ...] | None:
        """One, two or three lengths, larger first, that sum to ``gap`` and are
        available beside one piece of ``length``."""
        if self._enough((length, gap)):
            return (gap,)
        if self.pairs[gap]:
            low = np.arange(1, gap // 2 + 1)
            for b in low[(self.free[low] > 0) & (self.free[gap - low] > 0)].tolist():
                if self._enough((length, gap - b, b)):
                    return (gap - b, b)
        if self.triples[gap]:
            first = np.arange(gap - 1, 0, -1)
            for a in first[(self.free[first] > 0) & (self.pairs[gap - first] > 0)].tolist():
                rest = gap - a
                b = np.arange(min(a, rest - 1), (rest - 1) // 2, -1)
                for y in b[(self.free[b] > 0) & (self.free[rest - b] > 0)].tolist():
                    if self._enough((length, a, y, rest - y)):
                        return (a, y, rest - y)
        return None


def plan_lengths(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """Groups ``(times, lengths)`` that use up the histogram ``counts``."""
    free = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        free[length] = n
    plan = _Plan()
    plan.add(int(free[capacity]), (capacity,))
    free[capacity] = 0
    residue = np.zeros_like(free)
    index = _SumIndex(free)
    for length in range(capacity - 1, 0, -1):
        while left := int(index.free[length]):
            fill = index.fill(length, capacity - length)
            if fill is None:
                residue[length] += left
                index.take(length, left)
                break
            whole = (length, *fill)
            times = min(int(index.free[x]) // whole.count(x) for x in set(whole))
            for x in set(whole):
                index.take(x, times * whole.count(x))
            plan.add(times, whole)
    _best_fit(residue, capacity, plan)
    return plan.groups


def _best_fit(residue: np.ndarray, capacity: int, plan: _Plan) -> None:
    """Best fit by counts: equal open sequences are one entry."""
    open_by_gap: dict[int, list[list]] = {}
    gaps = np.zeros(capacity + 1, dtype=np.int64)
    for length in range(capacity, 0, -1):
        left = int(residue[length])
        while left:
            fitting = np.flatnonzero(gaps[length:])
            if len(fitting):
                gap = length + int(fitting[0])
                entry = open_by_gap[gap].pop()
                times = min(left, entry[0])
                if entry[0] > times:
                    open_by_gap[gap].append([entry[0] - times, entry[1]])
                gaps[gap] -= times
                lengths, after = (*entry[1], length), gap - length
            else:
                # a new sequence takes this length as often as it fits
                k = min(left, capacity // length)
                times = left // k
                lengths, after = (length,) * k, capacity - k * length
            left -= times * (len(lengths) if not len(fitting) else 1)
            if after:
                open_by_gap.setdefault(after, []).append([times, lengths])
                gaps[after] += times
            else:
                plan.add(times, lengths)
    for entries in open_by_gap.values():
        for times, lengths in entries:
            plan.add(times, lengths)


def _places(groups: list[tuple[int, tuple[int, ...]]]) -> pd.DataFrame:
    """For each length, ranges of ranks and the sequences and offset they get."""
    rows, used, first = [], {}, 0
    for times, lengths in groups:
        offset = 0
        for length in lengths:
            rank = used.get(length, 0)
            rows.append((length, rank, rank + times, first - rank, offset))
            used[length] = rank + times
            offset += length
        first += times
    return pd.DataFrame(rows, columns=["length", "rank_from", "rank_to", "shift", "offset"])


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to written pieces (``part`` and
    ``local_rank`` must not change between reads, so pass a materialised
    frame).  The histogram, at most ``capacity`` rows, is planned on the
    driver; the places come back as a lookup by (length, range of ranks)."""
    spark = pieces.sparkSession
    per_part = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    per_part = materialize(per_part, "lengths")
    counts = {int(r["length"]): int(r["n"]) for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = _places(plan_lengths(counts, capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_part.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["part", "length"]).withColumn("rank", F.col("base") + F.col("local_rank"))
    return _look_up(spark, ranked, places).drop("part", "local_rank", "base", "rank")


def _look_up(spark: SparkSession, ranked: DataFrame, places: pd.DataFrame) -> DataFrame:
    """Find each rank's range by binary search in a broadcast table of a few
    rows per length."""
    table = {
        int(length): tuple(g[c].to_numpy(np.int64) for c in ("rank_from", "shift", "offset"))
        for length, g in places.sort_values(["length", "rank_from"]).groupby("length")
    }
    shared = spark.sparkContext.broadcast(table)
    names = ranked.columns
    schema = ranked.schema.simpleString()[len("struct<") : -1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(names.index("length")).to_numpy()
            rank = batch.column(names.index("rank")).to_numpy()
            seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for value in np.unique(length):
                own = length == value
                start, shift, offset = shared.value[int(value)]
                at = np.searchsorted(start, rank[own], side="right") - 1
                seq[own], off[own] = rank[own] + shift[at], offset[at]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(seq), pa.array(off)], names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(run, schema + ",sequence_id:bigint,offset:bigint")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, ``sequence_id, ids`` (uint32 bytes,
    pieces in order of offset), from packed pieces that kept their ids."""
    rows = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    joined = F.aggregate("p", F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["ids"]))
    return rows.select("sequence_id", joined.alias("ids"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack ``docs (doc_id, text)``."""
    return pack(materialize(token_pieces(docs, tokenizer_path, capacity, keep_ids=keep_ids), "pieces"), capacity)


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in sequences of at most 2048 tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs, word_bpe_path()).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
