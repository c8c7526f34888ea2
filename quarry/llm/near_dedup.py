"""MinHash near-dedup by a multi-index Hamming join.

Every distinct shingle set gets a signature of ``SIGNATURE`` minima, each kept
as a 16-bit symbol.  Two sets of similarity s differ in each symbol with
probability 1 - s.  The first ``chunks * SYMBOLS`` symbols are cut into
chunks; by the pigeonhole principle two signatures with at most
``2 * chunks - 1`` differing symbols there agree in some chunk up to one
symbol.  Each chunk is therefore indexed once per symbol left out, so every
pair under that distance shares at least one key; ``chunks`` is chosen so
that a pair at the similarity threshold shares none with probability below
``MISS``.

Groups of one key can be large (copies of a template), so pairs are not
enumerated within them:

1. sets that are equal are one class, found by digest;
2. each member of a key group is compared with one leader per key, chosen by
   hash, so that a document meets many different leaders; the closest
   signatures are confirmed on the full sets, and links give components;
3. what is left are pairs in a key group whose members are still in different
   components: these are compared in bounded blocks, each pair under the first
   key it shares.  A pair whose whole signatures are close enough for the
   threshold is judged by its sketches, the ``SKETCH`` smallest hashes of each
   set: they hold smaller sets whole, so that pair is decided, and of pairs
   that are links only those that join two components leave the task; of
   larger sets they estimate the similarity, and every pair that may reach the
   threshold leaves it.  What leaves is confirmed on the full sets.

A link inside a component already found cannot change it, so the result is
that of all links."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.components import bucket_cells, connected_components, spanning_links
from quarry.llm.textvec import chunks as slices
from quarry.llm.textvec import mix, run_ids, run_pairs, whole_runs, word_hashes, words
from quarry.session import discard, materialize

SIGNATURE = 192
SYMBOLS = 5
MISS = 1e-6
#: Members of a key group compared in one cell.
BLOCK_ROWS = 2048
#: Smallest hashes of a set kept for judging pairs; sets up to this size are held whole.
SKETCH = 256
#: Pairs whose sketches are merged at once.
SKETCH_PAIRS = 2048
#: Leaders a document is confirmed against in the first round.
BEST = 2
_SEED = 11


def chunk_count(threshold: float) -> int:
    """Chunks so that two sets at ``threshold`` share no key with probability
    below ``MISS``; a threshold that needs more than the signature has raises."""
    if not 0 < threshold <= 1:
        raise ValueError("a similarity lies above 0 and up to 1")
    agree = threshold**SYMBOLS + SYMBOLS * (1 - threshold) * threshold ** (SYMBOLS - 1)
    chunks = ceil(log(MISS) / log(1 - agree)) if agree < 1 else 1
    if chunks > SIGNATURE // SYMBOLS:
        raise ValueError(f"a similarity of {threshold} needs {chunks} chunks, the signature has {SIGNATURE // SYMBOLS}")
    return chunks


def most_differing(threshold: float) -> int:
    """Differing symbols of the whole signature beyond which two sets at
    ``threshold`` lie with probability below about 1e-7."""
    p = 1 - threshold
    limit = int(SIGNATURE * p)
    tail = 1.0
    while tail > 1e-7 and limit < SIGNATURE:
        limit += 1
        tail = sum(comb(SIGNATURE, k) * p**k * (1 - p) ** (SIGNATURE - k) for k in range(limit + 1, SIGNATURE + 1))
    return limit


def _shingle_hashes(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a slice of texts and the offsets of its rows.  A text
    with fewer words is one shingle, its whole sequence; one without words none."""
    w = words(column, lower=True)
    h = word_hashes(w)
    n = len(h)
    combined = np.zeros(n, dtype=np.uint64)
    room = w.row_end() - np.arange(n)
    for k in range(width):
        inside = room > k
        combined[inside] = mix(combined[inside] + h[np.arange(n)[inside] + k] * np.uint64(2 * k + 3))
    count = np.diff(w.rows)
    first = w.rows[:-1]
    starts = np.zeros(n, dtype=bool)
    starts[room >= width] = True
    starts[first[(count > 0) & (count < width)]] = True
    kept = np.concatenate([[0], np.cumsum(starts)])
    return combined[starts], kept[w.rows]


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(_SEED)
    return rng.integers(0, 1 << 32, SIGNATURE, dtype=np.uint32), rng.integers(0, 1 << 31, SIGNATURE, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def _signatures(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows of 16-bit symbols; rows without shingles get zeros."""
    n = len(offsets) - 1
    out = np.zeros((n, SIGNATURE), dtype=np.uint16)
    full = np.flatnonzero(np.diff(offsets))
    if not len(full):
        return out
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    flip, times = _multipliers()
    at = offsets[:-1][full]
    for k in range(SIGNATURE):
        least = np.minimum.reduceat((low ^ flip[k]) * times[k], at)
        out[full, k] = (least ^ (least >> np.uint32(16))).astype(np.uint16)
    return out


def shingle_sets(docs: DataFrame, width: int, signed: bool) -> DataFrame:
    """``doc, n_shingles, digest, sig`` (signed) or ``doc, shingles`` (sorted
    distinct 64-bit hashes) of ``docs (doc, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                hashes, offsets = _shingle_hashes(part.column("text"), width)
                sets = [np.unique(hashes[a:b]) for a, b in zip(offsets, offsets[1:])]
                if not signed:
                    yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["doc", "shingles"])
                    continue
                sig = _signatures(hashes, offsets)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                        pa.array([row.tobytes() for row in sig], pa.binary()),
                    ],
                    names=["doc", "n_shingles", "digest", "sig"],
                )

    kind = "doc bigint, n_shingles bigint, digest binary, sig binary" if signed else "doc bigint, shingles binary"
    return docs.select("doc", "text").mapInArrow(run, kind)


def _symbols(column) -> np.ndarray:
    """Signatures of an Arrow column as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(len(column), SIGNATURE)


def _keys(sig: np.ndarray, n_chunks: int) -> np.ndarray:
    """One column per chunk and symbol left out."""
    out = np.empty((len(sig), n_chunks * SYMBOLS), dtype=np.uint64)
    for c in range(n_chunks):
        chunk = sig[:, c * SYMBOLS : (c + 1) * SYMBOLS].astype(np.uint64)
        for left_out in range(SYMBOLS):
            packed = np.zeros(len(sig), dtype=np.uint64)
            for k in range(SYMBOLS):
                if k != left_out:
                    packed = (packed << np.uint64(16)) | chunk[:, k]
            out[:, c * SYMBOLS + left_out] = mix(packed ^ mix(np.full(1, c * SYMBOLS + left_out + 1, dtype=np.uint64)))
    return out


def _index(classes: DataFrame, n_chunks: int) -> DataFrame:
    """``key, doc``: every key of every class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = _keys(_symbols(batch.column(1)), n_chunks)
                docs = np.repeat(batch.column(0).to_numpy(), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(docs)], names=["key", "doc"])

    return classes.select("doc", "sig").mapInArrow(run, "key bigint, doc bigint")


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("doc").alias("u"), F.col("shingles").alias("su"))
    right = sets.select(F.col("doc").alias("v"), F.col("shingles").alias("sv"))
    return pairs.select("u", "v").join(left, "u").join(right, "v").select("u", "v", "su", "sv")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``u, v`` with 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(batch.num_rows, dtype=bool)
            for i, (a, b) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (a, b))
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    continue
                both = np.searchsorted(y, x)
                both[both == len(y)] = 0
                common = int(np.count_nonzero(y[both] == x))
                ok[i] = 100 * common >= percent * (len(x) + len(y) - common)
            mask = pa.array(ok)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["u", "v"])

    return _with_sets(pairs, sets).mapInArrow(run, "u bigint, v bigint")


def _leader_pairs(members: DataFrame, classes: DataFrame, limit: int) -> DataFrame:
    """Each member with its closest leaders by signature."""
    pairs = members.where("doc <> leader").select(F.col("doc").alias("u"), F.col("leader").alias("v")).distinct()
    sig_u = classes.select(F.col("doc").alias("u"), F.col("sig").alias("gu"))
    sig_v = classes.select(F.col("doc").alias("v"), F.col("sig").alias("gv"))
    both = pairs.join(sig_u, "u").join(sig_v, "v").select("u", "v", "gu", "gv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                apart = np.count_nonzero(_symbols(batch.column(2)) != _symbols(batch.column(3)), axis=1)
                near = pa.array(apart <= limit)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).filter(near), batch.column(1).filter(near), pa.array(apart.astype(np.int32)).filter(near)], names=["u", "v", "apart"]
                )

    near = both.mapInArrow(run, "u bigint, v bigint, apart int")
    order = Window.partitionBy("u").orderBy("apart", F.xxhash64("u", "v"))
    return near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= BEST).select("u", "v")


def _sketches(sets: DataFrame) -> DataFrame:
    """``doc, size, sketch``: the smallest 32-bit hashes of every set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, out = [], []
            for value in batch.column(1):
                hashes = np.frombuffer(value.as_buffer(), dtype=np.uint64)
                small = np.unique((mix(hashes) >> np.uint64(32)).astype(np.uint32))
                sizes.append(len(small))
                out.append(small[:SKETCH].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int32()), pa.array(out, pa.binary())], names=["doc", "size", "sketch"])

    return sets.select("doc", "shingles").mapInArrow(run, "doc bigint, size int, sketch binary")


def _sketch_matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Sketches as rows; places beyond a small set hold values met nowhere else."""
    out = np.broadcast_to((1 << 32) + np.arange(SKETCH, dtype=np.uint64), (len(column), SKETCH)).copy()
    for r, raw in enumerate(column.to_pylist()):
        out[r, : len(raw) // 4] = np.frombuffer(raw, dtype=np.uint32)
    return out


def _judge(left: np.ndarray, right: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of sketched sets (sizes n, m) may reach ``percent``, and
    which of those surely do."""
    right = np.where(right >> np.uint64(32) > 0, right + np.uint64(1 << 33), right)
    both = np.sort(np.concatenate([left, right], axis=1), axis=1)
    same = both[:, 1:] == both[:, :-1]
    common = same.sum(axis=1)
    whole = (n <= SKETCH) & (m <= SKETCH)
    reaches = 100 * common >= percent * (n + m - common)
    # the smallest values of the union are a sample of it
    rank = np.arange(same.shape[1]) - (np.cumsum(same, axis=1) - same)
    share = (same & (rank < SKETCH)).sum(axis=1) / SKETCH
    t = percent / 100
    may = share >= t - 5.2 * (t * (1 - t) / SKETCH) ** 0.5
    return np.where(whole, reaches, may), whole & reaches


def _open_pairs(members: DataFrame, classes: DataFrame, sets: DataFrame, parts: DataFrame, n_chunks: int, percent: int) -> DataFrame:
    """Pairs that share a key, lie in different components and may reach the
    threshold; each under the first key it shares."""
    limit = most_differing(percent / 100)
    labelled = members.select("key", "doc").join(parts.withColumnRenamed("id", "doc"), "doc", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "doc"))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("key")
    known = classes.select("doc", "sig").join(_sketches(sets), "doc")
    rows = labelled.join(mixed, "key").join(known, "doc")
    cells = bucket_cells(rows, ["key"], "doc", BLOCK_ROWS)
    names = ["key", "cell_a", "cell_b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, names):
            doc, part, key, size = (table.column(c).to_numpy() for c in ("doc", "component", "key", "size"))
            block, a, b = (table.column(c).to_numpy() for c in ("block", "cell_a", "cell_b"))
            sig = _symbols(table.column("sig"))
            sketch = _sketch_matrix(table.column("sketch"))
            parent: dict[int, int] = {}
            for i, j in run_pairs(run_ids(table, names)):
                ok = (part[i] != part[j]) & ((a[i] == b[i]) | (block[i] != block[j]))
                i, j = i[ok], j[ok]
                ok = np.count_nonzero(sig[i] != sig[j], axis=1) <= limit
                i, j = i[ok], j[ok]
                if not len(i):
                    continue
                keys = _keys(sig[i], n_chunks)
                shared = keys == _keys(sig[j], n_chunks)
                ok = keys[np.arange(len(i)), shared.argmax(axis=1)].view(np.int64) == key[i]
                i, j = i[ok], j[ok]
                for at in range(0, len(i), SKETCH_PAIRS):
                    x, y = i[at : at + SKETCH_PAIRS], j[at : at + SKETCH_PAIRS]
                    may, sure = _judge(sketch[x], sketch[y], size[x], size[y], percent)
                    link = np.flatnonzero(sure)
                    link = link[spanning_links(part[x[link]].tolist(), part[y[link]].tolist(), parent)]
                    out = np.concatenate([np.flatnonzero(may & ~sure), link])
                    yield pa.RecordBatch.from_arrays([pa.array(doc[x[out]]), pa.array(doc[y[out]])], names=["u", "v"])

    columns = cells.select("key", "cell_a", "cell_b", "block", "doc", "component", "sig", "size", "sketch")
    return columns.mapInArrow(run, "u bigint, v bigint").distinct()


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, ident: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a document's set is
    its distinct shingles of ``width`` words (with fewer words, the whole
    sequence).  Documents are linked when 100 * intersection >= percent *
    union; a component's id is its smallest document id, which is kept.  A
    null, empty or blank text has an empty set and is linked with nothing;
    texts of any length are read whole.  A threshold below about 0.58, for
    which the signature is too short to bound misses, raises.  Rows that share an id are one document in two versions; rows with a null
    id are linked with nothing and kept, with a null component.  Other
    columns are ignored."""
    src = docs.select(F.col(ident).cast("bigint").alias("doc"), F.col(text).alias("text"))
    n_chunks, limit = chunk_count(percent / 100), most_differing(percent / 100)
    base = materialize(shingle_sets(src, width, signed=True), "signatures")
    known = base.where("digest IS NOT NULL AND doc IS NOT NULL")
    classes = materialize(known.groupBy("digest").agg(F.min("doc").alias("doc"), F.first("sig").alias("sig")), "classes")
    index = _index(classes, n_chunks)
    groups = index.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min_by("doc", F.xxhash64("key", "doc")).alias("leader")).where("n > 1")
    members = materialize(index.join(groups.drop("n"), "key"), "members")
    wanted = members.select("doc").distinct()
    # one text per id; the aggregate keeps the partitioning of the join
    texts = src.join(wanted, "doc", "left_semi").groupBy("doc").agg(F.min("text").alias("text"))
    sets = materialize(shingle_sets(texts, width, signed=False), "sets")
    links = materialize(_confirm(_leader_pairs(members, classes, limit), sets, percent), "links")
    parts = materialize(connected_components(links), "parts")
    more = materialize(_confirm(_open_pairs(members, classes, sets, parts, n_chunks, percent), sets, percent), "links")
    spokes = parts.select(F.col("id").alias("u"), F.col("component").alias("v"))
    joined = materialize(connected_components(spokes.unionByName(more)), "parts")
    for done in (members, sets, links, parts, more):
        discard(done)
    return _label(base, classes, joined, ident)


def _label(base: DataFrame, classes: DataFrame, parts: DataFrame, ident: str) -> DataFrame:
    """Carry components from class representatives to all documents."""
    class_of = classes.select("digest", F.col("doc").alias("rep")).join(parts.withColumnRenamed("id", "rep"), "rep", "left")
    class_of = class_of.select("digest", F.coalesce("component", "rep").alias("component"))
    out = base.drop("sig").join(class_of, "digest", "left")
    component = F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc"))
    kept = F.coalesce(component == F.col("doc"), F.lit(True))
    return out.select(F.col("doc").alias(ident), "n_shingles", component.alias("component_id"), kept.alias("kept"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all ``documents``: 3-word shingles, 0.85."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=3, percent=85)
