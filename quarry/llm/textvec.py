"""Vectorised words and hashes over Arrow string columns.

Helpers for code that runs inside Spark tasks.  A word is a run of bytes other
than space and ``\\t\\n\\v\\f\\r`` (``[^\\x20\\x09-\\x0D]+`` over UTF-8, which never
splits a character).  Word and window hashes come from prefix sums of a
polynomial modulo 2**64, so a batch costs a few passes over its bytes and no
Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes of text handled at once; one longer text is handled alone.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Odd multipliers of the polynomials, one per independent hash family.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(family: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**k`` and ``base**-k`` modulo 2**64 for k below at least ``n``."""
    got = _POWERS.get(family)
    if got is None or len(got[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        base = _BASES[family]
        up = np.full(size, base, dtype=np.uint64)
        down = np.full(size, pow(base, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        got = (np.multiply.accumulate(up), np.multiply.accumulate(down))
        if n <= CHUNK_BYTES + 1:  # tables for one very long text are not kept
            _POWERS[family] = got
    return got


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (a bijection of 64-bit values)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0 or column.buffers()[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, text: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of ``batch`` with about ``size`` bytes of text each."""
    column = batch.column(text)
    _, offsets = text_buffer(column)
    at, n = 0, batch.num_rows
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        to = min(n, max(at + 1, to))
        yield batch.slice(at, to - at)
        at = to


@dataclass
class Words:
    """Words of a slice: ``raw[start[i]:end[i]]``; row r has words ``rows[r]:rows[r+1]``."""

    raw: np.ndarray
    start: np.ndarray
    end: np.ndarray
    rows: np.ndarray

    def row_end(self) -> np.ndarray:
        """For each word the index one past its row's last word."""
        return np.repeat(self.rows[1:], np.diff(self.rows))

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))


def words(column: pa.Array, lower: bool = False) -> Words:
    raw, offsets = text_buffer(column)
    if lower:
        raw = _LOWER[raw]
    n = len(raw)
    space = _SPACE[raw]
    edge = np.zeros(n + 1, dtype=bool)  # a row starts here
    edge[offsets] = True
    before = np.empty(n, dtype=bool)
    after = np.empty(n, dtype=bool)
    if n:
        before[0], before[1:] = True, space[:-1]
        after[-1], after[:-1] = True, space[1:]
    start = np.flatnonzero(~space & (before | edge[:n]))
    end = np.flatnonzero(~space & (after | edge[1:])) + 1
    return Words(raw, start, end, np.searchsorted(start, offsets))


def word_hashes(w: Words, family: int = 0) -> np.ndarray:
    """A 64-bit hash of every word."""
    n = len(w.raw)
    up, down = powers(family, n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((w.raw.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    return mix((sums[w.end] - sums[w.start]) * down[w.start])


def window_hashes(h: np.ndarray, width: int, family: int = 2) -> np.ndarray:
    """Hash of the ``width`` values starting at each position; positions with
    fewer values after them get a hash that callers mask out."""
    n = len(h)
    up, down = powers(family, n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(h * up[:n], out=sums[1:])
    to = np.minimum(np.arange(n) + width, n)
    return mix((sums[to] - sums[:n]) * down[:n])


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over ``values[i:i+width]`` (shorter at the end), by doubling."""
    out = values.copy()
    have = 1
    while have < width:
        step = min(have, width - have)
        if len(out) > step:
            out[:-step] = pick(out[:-step], out[step:])
        have += step
    return out


def whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Regroup sorted batches so that a run of equal keys is never cut."""
    rest: list[pa.RecordBatch] = []

    def key(batch: pa.RecordBatch, i: int) -> tuple:
        return tuple(batch.column(k)[i].as_py() for k in keys)

    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        last = key(batch, n - 1)
        if rest and key(rest[-1], rest[-1].num_rows - 1) == last:
            rest.append(batch)
            continue
        changed = np.zeros(n, dtype=bool)
        for k in keys:
            v = batch.column(k).to_numpy(zero_copy_only=False)
            changed[1:] |= v[1:] != v[:-1]
        cut = int(np.flatnonzero(changed)[-1]) if changed.any() else 0
        ready = [*rest, batch.slice(0, cut)] if cut else rest
        if ready:
            yield pa.Table.from_batches(ready)
        rest = [batch.slice(cut)]
    if rest:
        yield pa.Table.from_batches(rest)


def run_ids(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Number the runs of equal keys of a sorted table."""
    changed = np.zeros(table.num_rows, dtype=np.int64)
    for k in keys:
        v = table.column(k).to_numpy()
        changed[1:] |= v[1:] != v[:-1]
    return np.cumsum(changed)


def run_pairs(run: np.ndarray, most: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j), i < j, of rows in the same run; never more than a
    bounded array of them at a time."""
    left = np.arange(len(run))
    held_i: list[np.ndarray] = []
    held_j: list[np.ndarray] = []
    held = 0
    step = 1
    while len(left):
        left = left[left + step < len(run)]
        left = left[run[left] == run[left + step]]
        if len(left):
            held_i.append(left)
            held_j.append(left + step)
            held += len(left)
        if held_i and (held >= most or not len(left)):
            i, j = np.concatenate(held_i), np.concatenate(held_j)
            for at in range(0, len(i), most):
                yield i[at : at + most], j[at : at + most]
            held_i, held_j, held = [], [], 0
        step += 1
