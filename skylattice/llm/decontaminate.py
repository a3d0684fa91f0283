"""Benchmark decontamination with suffix arrays over the training texts.

Every task cuts its documents into shards of whole texts and builds for each a
suffix array of word positions, ordered by the hashes of the words that follow.
It is sparse: a suffix whose first two words are nowhere neighbours in the
benchmark cannot match and is left out. Every test suffix that holds a window is
binary-searched in every shard; its range there is all verbatim matches with
their places, which are then extended word by word to their full lengths.

A window is ``window`` consecutive words of an item; an item of fewer words, but
not none, is one window. Words are maximal runs of ASCII letters and digits and
of non-ASCII characters, A-Z taken as a-z; they are compared by 64-bit hashes.

The benchmark reaches the tasks in blocks of about ``BLOCK_CHARS`` characters,
as many as it takes; the documents go through all blocks without a shuffle, so
no key, item or passage can be hot, and a lost task starts again from its file.

A null or empty text has no words. Benchmark rows without an id or without words
take no part; rows that repeat an id count as one item with several texts. Rows
that repeat a doc_id are rows of their own; other columns are left alone.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylattice.llm.text import ALNUM, U64, mix, pieces, word_bounds, word_hashes

WINDOW = 10
BLOCK_CHARS = 4_000_000
SHARD_BYTES = 1 << 22
FILTER_BITS = 22


def _pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * U64(3) ^ mix(second, 11), 12)


class Block:
    """The test suffixes of some items, distinct by their first words."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.window = window
        texts: dict[bytes, set[str]] = {}
        for name, text in items:
            for _, _, data, offsets in pieces(pa.array([text], pa.large_string())):
                starts, ends, _ = word_bounds(data, offsets, ALNUM)
                if len(starts):
                    texts.setdefault(word_hashes(data, starts, ends).tobytes(), set()).add(name)
        self.names = [sorted(names) for names in texts.values()]
        words = [np.frombuffer(key, U64) for key in texts]
        length = np.array([len(w) for w in words], np.int64)
        begin = np.concatenate(([0], np.cumsum(length)))[:-1]
        self.words = np.concatenate(words) if words else np.zeros(0, U64)
        count = np.maximum(length - window, 0) + 1
        owner = np.repeat(np.arange(len(words)), count)
        at = begin[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        depth = np.minimum(length, window)[owner]
        low, high = self._key(at, depth, 0), self._key(at, depth, 0xFFFFFFFFFFFFFFFF)
        both = np.hstack((low, high))
        _, pick, group = np.unique(both, axis=0, return_index=True, return_inverse=True)
        self.low, self.high, self.depth = low[pick], high[pick], depth[pick]
        order = np.argsort(group.ravel(), kind="stable")  # the suffixes of each distinct window
        self.at, self.owner, self.stop = at[order], owner[order], (begin + length)[owner[order]]
        self.first = np.searchsorted(group.ravel()[order], np.arange(len(pick) + 1))
        one = self.depth == 1
        self.singles = np.sort(self.low[one, 0])
        self.pairs = np.sort(_pairs(self.low[~one, 0], self.low[~one, 1])) if window > 1 else np.zeros(0, U64)
        self.sieve = np.zeros(1 << FILTER_BITS, bool)
        for known in (self.singles, self.pairs):
            self.sieve[(known >> U64(64 - FILTER_BITS)).astype(np.int64)] = True

    def _key(self, at: np.ndarray, depth: np.ndarray, fill: int) -> np.ndarray:
        column = np.arange(self.window)
        key = np.full((len(at), self.window), fill, U64)
        inside = column < depth[:, None]
        key[inside] = self.words[(at[:, None] + column)[inside]]
        return key

    def _among(self, known: np.ndarray, value: np.ndarray) -> np.ndarray:
        found = np.flatnonzero(self.sieve[(value >> U64(64 - FILTER_BITS)).astype(np.int64)])
        at = np.minimum(np.searchsorted(known, value[found]), max(len(known) - 1, 0))
        return found[known[at] == value[found]] if len(known) else found[:0]

    def suffix_array(self, words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of a shard in the order of their suffixes, and the suffixes' first words."""
        n, w = len(words), self.window
        near = self._among(self.pairs, _pairs(words[:-1], words[1:])) if n > 1 else np.zeros(0, np.int64)
        near = near[rows[near] == rows[near + 1]]
        at = np.union1d(near, self._among(self.singles, words))
        padded, row = np.concatenate((words, np.zeros(w, U64))), np.concatenate((rows, np.full(w, -1)))
        ahead = at[:, None] + np.arange(w)
        key = np.where(row[ahead] == rows[at][:, None], padded[ahead], U64(0))
        order = np.lexsort(key.T[::-1])
        return at[order], key[order]

    def matches(self, words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in the shard, number of the distinct window) of every occurrence."""
        at, key = self.suffix_array(words, rows)
        lo, hi = _bound(key, self.low, False), _bound(key, self.high, True)
        count = np.maximum(hi - lo, 0)
        which = np.repeat(np.arange(len(count)), count)
        place = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(len(which))
        return at[place], which

    def lengths(self, words: np.ndarray, rows: np.ndarray, place: np.ndarray, which: np.ndarray):
        """(position, owner, words in common) of every match with every test suffix, extended to the full."""
        count = (self.first[1:] - self.first[:-1])[which]
        suffix = np.repeat(self.first[which] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        place = np.repeat(place, count)
        length = np.repeat(self.depth[which], count)
        end = np.searchsorted(rows, rows[place], side="right")
        live = np.arange(len(place))
        while len(live):
            test, here = self.at[suffix[live]] + length[live], place[live] + length[live]
            live = live[(test < self.stop[suffix[live]]) & (here < end[live])]
            test, here = self.at[suffix[live]] + length[live], place[live] + length[live]
            live = live[self.words[test] == words[here]]
            length[live] += 1
        return place, self.owner[suffix], length


def _bound(key: np.ndarray, wanted: np.ndarray, equal: bool) -> np.ndarray:
    """For each wanted row the number of sorted rows before it, with or without equal ones."""
    lo, hi = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(key), np.int64)
    rows = np.arange(len(wanted))
    while True:
        live = lo < hi
        if not live.any():
            return lo
        mid = np.minimum((lo + hi) // 2, len(key) - 1)
        here = key[mid]
        where = np.argmax(here != wanted, axis=1)
        here, there = here[rows, where], wanted[rows, where]
        less = here <= there if equal else here < there
        lo, hi = np.where(live & less, mid + 1, lo), np.where(live & ~less, mid, hi)


def _found(block: Block, column: pa.Array):
    """For pieces of a text column: (first row, rows, row of each word, hit mask, row and item names of matches, row and length)."""
    for first, end, data, offsets in pieces(column, SHARD_BYTES):
        n = end - first
        starts, ends, rows = word_bounds(data, offsets, ALNUM)
        words = word_hashes(data, starts, ends)
        place, which = block.matches(words, rows)
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, place, 1)
        np.add.at(edge, place + block.depth[which], -1)
        yield first, n, rows, np.cumsum(edge[:-1]) > 0, block.lengths(words, rows, place, which)


def _analyse(block: Block, last: bool):
    def run(batches):
        for batch in batches:
            old = batch.to_pydict() if "spans" in batch.schema.names else None
            out = {"n_words": [], "spans": [], "items": [], "longest": []}
            for first, n, rows, hit, (place, owner, length) in _found(block, batch.column("text")):
                count = np.bincount(rows, minlength=n)
                begin = np.concatenate(([0], np.cumsum(count)))
                longest, spans, items = np.zeros(n, np.int64), [[] for _ in range(n)], [set() for _ in range(n)]
                np.maximum.at(longest, rows[place], length)
                for row, who in np.unique(np.stack((rows[place], owner), 1), axis=0).tolist():
                    items[row].update(block.names[who])
                step = np.flatnonzero(hit & np.concatenate(([True], ~hit[:-1] | (rows[1:] != rows[:-1]))) if len(hit) else hit)
                stop = np.flatnonzero(hit & np.concatenate((~hit[1:] | (rows[1:] != rows[:-1]), [True])) if len(hit) else hit) + 1
                for row, a, b in zip(rows[step].tolist(), (step - begin[rows[step]]).tolist(), (stop - begin[rows[step]]).tolist(), strict=True):
                    spans[row].append((a, b))
                if old is not None:
                    for i in range(n):
                        spans[i] = _merged(spans[i] + [(s["start"], s["end"]) for s in old["spans"][first + i]])
                        items[i].update(old["items"][first + i])
                    longest = np.maximum(longest, old["longest"][first : first + n])
                out["n_words"] += count.tolist()
                out["spans"] += [[{"start": a, "end": b} for a, b in s] for s in spans]
                out["items"] += [sorted(s) for s in items]
                out["longest"] += longest.tolist()
            kept = [("doc_id", batch.column("doc_id"))] + ([] if last else [("text", batch.column("text"))])
            fields = dict(zip(OUT.names, OUT.types, strict=True))
            kept += [(name, pa.array(values, type=fields[name])) for name, values in out.items()]
            yield pa.record_batch([c for _, c in kept], names=[name for name, _ in kept])

    return run


OUT = pa.schema([
    ("n_words", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ("items", pa.list_(pa.string())),
    ("longest", pa.int64()),
])
COLUMNS = "n_words long, spans array<struct<start:long,end:long>>, items array<string>, longest long"


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _clean(block: Block):
    def run(batches):
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for first, n, rows, hit, _ in _found(block, batch.column("text")):
                keep[first : first + n] = np.bincount(rows, weights=hit, minlength=n) == 0
            yield batch.filter(pa.array(keep))

    return run


def blocks(benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> list[Block]:
    """The benchmark in blocks of bounded size, one at least."""
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text")
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = max(1, ceil(total / block_chars))
    items = items.withColumn("block", F.expr(f"pmod(xxhash64(item_id, text), {n})"))
    return [Block([(r[0], r[1]) for r in items.where(f"block = {b}").select("item_id", "text").collect()], window) for b in range(n)]


def matched(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, n_words, spans, items, longest) of every row of ``documents`` (doc_id, text).

    ``spans`` are the word ranges [start, end) that lie in occurrences of windows,
    ``items`` the ids of their items in string order, ``longest`` the words of the
    longest verbatim match.
    """
    out = documents.select("doc_id", "text")
    kind = out.schema["doc_id"].dataType.simpleString()
    all_blocks = blocks(benchmark, window, block_chars)
    for i, block in enumerate(all_blocks):
        last = i == len(all_blocks) - 1
        out = out.mapInArrow(_analyse(block, last), f"doc_id {kind}, {'' if last else 'text string, '}{COLUMNS}")
    return out


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``documents`` in which no window of the benchmark occurs, with all their columns."""
    out = documents
    for block in blocks(benchmark, window, block_chars):
        out = out.mapInArrow(_clean(block), documents.schema)
    return out
