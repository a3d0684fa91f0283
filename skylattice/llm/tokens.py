"""Token ids of whole Arrow batches of texts, from a public tokenizer file.

Every id comes from the tokenizers library. For a tokenizer that lower-cases,
drops white space and ends each word with its own mark, the ids of a text are
those of its pieces one after the other, so that a piece met before in this
worker is looked up by its hash and only new ones go to the library. Texts with
characters for which this would not be safe go to the library whole.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from skylattice.llm.text import LOWER, U64, pieces, powers, BASE, BASE_INVERSE, mix

#: The tokenizer file that can be cached by piece; its pieces and word mark are fixed values.
PIECE_FILE = "word_bpe_49k.json"
WORD_MARK = "</w>"
SLOT_BITS = 21
FULL = 1 << 20

LETTER, DIGIT, SPACE, OTHER, UNSAFE = 0, 1, 2, 3, 4
KIND = np.full(256, UNSAFE, np.uint8)
KIND[0x20:0x7F] = OTHER
KIND[[0x20, 0x09, 0x0A, 0x0D]] = SPACE
KIND[0x30:0x3A] = DIGIT
KIND[0x61:0x7B] = KIND[0x41:0x5B] = LETTER
KIND[0xC3] = KIND[0x80:0xC0] = LETTER  # the letters of Latin-1, once `_safe` has seen to the rest


class PieceTokenizer:
    """Ids of texts; one per Python worker, with a table of pieces of bounded size."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.vocabulary = self.library.get_vocab_size()
        self.by_piece = os.path.basename(path) == PIECE_FILE
        self.ends = np.zeros(self.vocabulary, bool)
        for token, number in self.library.get_vocab().items():
            self.ends[number] = token.endswith(WORD_MARK)
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(1 << SLOT_BITS, U64)
        self.entry = np.zeros(1 << SLOT_BITS, np.int32)
        self.begin, self.size = np.zeros(FULL, np.int64), np.zeros(FULL, np.int32)
        self.ids, self.n_ids, self.n = np.zeros(4 * FULL, np.uint32), 0, 0

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a text column, and how many each row has; null is empty."""
        flat, counts = [], []
        for _, _, data, offsets in pieces(column):
            ids, count = self._piece(data, offsets)
            flat.append(ids)
            counts.append(count)
        if not flat:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return np.concatenate(flat), np.concatenate(counts)

    def _piece(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(offsets) - 1
        safe = self._safe(data, offsets) if self.by_piece else np.zeros(n, bool)
        ids, count = np.zeros(0, np.uint32), np.zeros(n, np.int64)
        if safe.any():
            lengths = np.diff(offsets)
            part = data[np.repeat(safe, lengths)]
            cut = np.concatenate(([0], np.cumsum(lengths[safe])))
            ids, count[safe] = self._safe_ids(part, cut)
        if safe.all():
            return ids, count
        rest = np.flatnonzero(~safe)
        texts = [data[offsets[i] : offsets[i + 1]].tobytes().decode() for i in rest]
        whole = [np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        count[rest] = [len(w) for w in whole]
        first = np.concatenate(([0], np.cumsum(count)))
        out = np.empty(first[-1], np.uint32)
        out[np.repeat(safe, count)] = ids
        for i, w in zip(rest, whole, strict=True):
            out[first[i] : first[i + 1]] = w
        return out, count

    @staticmethod
    def _safe(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows of ASCII text and Latin-1 letters only, without a mark that may be a special token."""
        bad = KIND[data] == UNSAFE
        high = data >= 0x80
        lead = data == 0xC3
        sign = np.zeros(len(data), bool)  # multiplication and division signs
        sign[1:] = lead[:-1] & ((data[1:] == 0x97) | (data[1:] == 0xB7))
        bad |= sign
        bad[1:] |= (high & ~lead)[1:] & ~lead[:-1]
        bad[1:] |= (data[1:] == ord("|")) & (data[:-1] == ord("<"))
        total = np.concatenate(([0], np.cumsum(bad)))
        return total[offsets[1:]] == total[offsets[:-1]]

    def _safe_ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        if n == 0:
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        low = LOWER[data]
        capital = np.zeros(n, bool)
        capital[1:] = (data[:-1] == 0xC3) & (data[1:] <= 0x9E)
        low[capital] += 0x20
        starts, ends = self._bounds(low, offsets)
        weighted = low.astype(U64)
        weighted += U64(1)
        weighted *= powers(BASE, n)
        sums = np.empty(n + 1, U64)
        sums[0] = 0
        np.cumsum(weighted, out=sums[1:])
        key = (sums[ends] - sums[starts]) * powers(BASE_INVERSE, n)[starts]
        key = mix(key + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93)) | U64(1)
        entry = self._look_up(key)
        new = np.flatnonzero(entry < 0)
        if len(new):
            _, pick = np.unique(key[new], return_index=True)
            if self.n + len(pick) > FULL:
                self.clear()
                new = np.arange(len(key))
                _, pick = np.unique(key, return_index=True)
            self._add(key[new[pick]], [low[a:b].tobytes().decode() for a, b in zip(starts[new[pick]], ends[new[pick]], strict=True)])
            entry = self._look_up(key)
        size = self.size[entry].astype(np.int64)
        before = np.cumsum(size) - size
        ids = self.ids[np.repeat(self.begin[entry] - before, size) + np.arange(size.sum())]
        total = np.concatenate(([0], np.cumsum(size)))
        return ids, np.diff(total[np.searchsorted(starts, offsets)])

    @staticmethod
    def _bounds(low: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces: contractions, runs of letters, single digits, runs of other signs."""
        n = len(low)
        kind = KIND[low]
        cut = np.ones(n + 1, bool)  # a piece or white space may begin here
        cut[1:n] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        cut[offsets] = True
        mark = np.flatnonzero((low == ord("'")) & cut[:-1] & cut[1:])
        mark = mark[(mark + 1 < n)]
        mark = mark[~np.isin(mark + 1, offsets) & (kind[mark + 1] == LETTER)]
        if len(mark):
            second = low[mark + 1]
            third = np.where((mark + 2 < n), low[np.minimum(mark + 2, n - 1)], 0)
            third = np.where(cut[np.minimum(mark + 2, n)], 0, third)
            one = np.isin(second, np.frombuffer(b"stmd", np.uint8))
            two = ((second == ord("r")) | (second == ord("v"))) & (third == ord("e"))
            two |= (second == ord("l")) & (third == ord("l"))
            cut[mark[one | two] + 1] = False
            cut[mark[one] + 2] = True
            cut[mark[two & ~one] + 3] = True
        starts = np.flatnonzero(cut[:n])
        ends = np.concatenate((starts[1:], [n]))
        solid = kind[starts] != SPACE
        return starts[solid], ends[solid]

    def _look_up(self, key: np.ndarray) -> np.ndarray:
        slot = (key >> U64(64 - SLOT_BITS)).astype(np.int64)
        entry = np.full(len(key), -1, np.int64)
        live = np.arange(len(key))
        while len(live):
            here = self.known[slot[live]]
            hit = here == key[live]
            entry[live[hit]] = self.entry[slot[live[hit]]]
            live = live[~hit & (here != 0)]
            slot[live] = (slot[live] + 1) & ((1 << SLOT_BITS) - 1)
        return entry

    def _add(self, key: np.ndarray, texts: list[str]) -> None:
        ids = np.array(self.library.encode_batch_fast([" ".join(texts)], add_special_tokens=False)[0].ids, np.uint32)
        end = np.flatnonzero(self.ends[ids]) + 1
        if len(end) != len(texts):
            raise ValueError("the tokenizer does not end each piece with its mark")
        size = np.diff(np.concatenate(([0], end)))
        if self.n_ids + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(len(ids) + len(self.ids), np.uint32)))
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        number = self.n + np.arange(len(key))
        if number[-1] >= len(self.begin):
            more = np.zeros(number[-1] + 1 - len(self.begin), np.int64)
            self.begin, self.size = np.concatenate((self.begin, more)), np.concatenate((self.size, more.astype(np.int32)))
        self.begin[number], self.size[number] = self.n_ids + end - size, size
        self.n_ids, self.n = self.n_ids + len(ids), self.n + len(key)
        slot = (key >> U64(64 - SLOT_BITS)).astype(np.int64)
        live = np.arange(len(key))
        while len(live):
            free = live[self.known[slot[live]] == 0]
            _, first = np.unique(slot[free], return_index=True)  # one of those that want the same slot
            put = free[first]
            self.known[slot[put]], self.entry[slot[put]] = key[put], number[put]
            live = live[self.known[slot[live]] != key[live]]
            slot[live] = (slot[live] + 1) & ((1 << SLOT_BITS) - 1)


_LOADED: dict[str, PieceTokenizer] = {}


def tokenizer(path: str) -> PieceTokenizer:
    if path not in _LOADED:
        _LOADED[path] = PieceTokenizer(path)
    return _LOADED[path]
