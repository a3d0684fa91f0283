"""Words and hashes of whole Arrow batches of texts, without a Python loop over words.

All functions work on the UTF-8 bytes of many texts at once. A text that is null
counts as empty. Batches are cut at row borders into pieces of about ``limit``
bytes, so that the working memory does not follow the batch size; a text longer
than that is a piece of its own and is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
PIECE_BYTES = 1 << 20

# Freed batches go back to the system, as other tasks of the executor need the memory.
pa.set_memory_pool(pa.system_memory_pool())

#: An odd multiplier and its inverse modulo 2**64, for positional hashes.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes that are not white space: everything but 0x20 and 0x09 to 0x0D.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Letters, digits and every byte of a non-ASCII character.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows of a string column."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        end = min(end, len(column))
        cut = offsets[first : end + 1] - offsets[first]
        yield first, end, data[offsets[first] : offsets[end]], cut
        first = end


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept up to a few pieces' length."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, PIECE_BYTES + (1 << 16))
        have = np.empty(size, U64)
        have[0] = 1
        done = 1
        while done < size:
            step = min(done, size - done)
            np.multiply(have[:step], U64(pow(base, done, 1 << 64)), out=have[done : done + step])
            done += step
        if size <= 4 * PIECE_BYTES:
            _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x + U64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def word_bounds(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the maximal runs of kept bytes in each row."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = keep[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets[:-1]] = True
    edge[n] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(begins)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, np.flatnonzero(ends) + 1, rows


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, A-Z taken as a-z."""
    if len(starts) == 0:
        return np.zeros(0, U64)
    weighted = LOWER[data].astype(U64)
    weighted += U64(1)
    weighted *= powers(BASE, len(data))
    sums = np.empty(len(data) + 1, U64)
    sums[0] = 0
    np.cumsum(weighted, out=sums[1:])
    out = sums[ends] - sums[starts]
    out *= powers(BASE_INVERSE, len(data))[starts]
    out += (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93)
    return mix(out)


def shingles(hashes: np.ndarray, rows: np.ndarray, n_rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``size`` words as (row, hash), in order of both.

    A row of fewer words, but not none, has its whole sequence as one shingle.
    """
    count = np.bincount(rows, minlength=n_rows)
    first = np.concatenate(([0], np.cumsum(count)))[:-1]
    n = len(hashes)
    if n >= size:
        value = mix(hashes[: n - size + 1], 1)
        for j in range(1, size):
            value = mix(value ^ hashes[j : n - size + 1 + j], 1)
        full = rows[: n - size + 1] == rows[size - 1 :]
        row, value = rows[: n - size + 1][full], value[full]
    else:
        row, value = np.zeros(0, np.int64), np.zeros(0, U64)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        whole = mix(hashes[first[short]], 1)
        for j in range(1, size):
            more = count[short] > j
            whole[more] = mix(whole[more] ^ hashes[first[short][more] + j], 1)
        whole = mix(whole, 2)
        row, value = np.concatenate((row, short)), np.concatenate((value, whole))
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    if len(row):
        fresh = np.ones(len(row), bool)
        fresh[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
        row, value = row[fresh], value[fresh]
    return row, value


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the length of each row's list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
