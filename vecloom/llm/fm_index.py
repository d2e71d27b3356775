"""A compressed FM-index over word codes: a wavelet matrix of the Burrows-Wheeler transform, vectorised over queries.

The alphabet is the distinct codes of the indexed pieces. Bits are packed 64 to a word with a count per word, so a text
of n words over s codes takes about 1.5 n log2(s) bits; places are kept for every ``SAMPLE``-th position only and found
by walking back.
"""

from __future__ import annotations

import numpy as np

from vecloom.llm.suffixes import suffix_array

SAMPLE = 16
_END, _GAP = 0, 1


class Bits:
    """A packed bit vector with rank."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        packed = np.zeros((self.n >> 6) + 1, np.uint64)
        raw = np.packbits(bits, bitorder="little")
        packed.view(np.uint8)[: len(raw)] = raw
        self.words = packed
        counts = np.bitwise_count(packed).astype(np.int64)
        self.before = (np.cumsum(counts) - counts).astype(np.uint32)
        self.ones = int(counts.sum())

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word].astype(np.int64) + np.bitwise_count(self.words[word] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)


class FMIndex:
    def __init__(self, pieces: list[np.ndarray]):
        """``pieces``: arrays of word codes; matches never span two of them."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        codes = np.concatenate(pieces) if pieces else np.zeros(0, np.uint64)
        self.alphabet, dense = np.unique(codes, return_inverse=True)
        text = np.full(len(codes) + len(pieces) + 1, _GAP, np.uint64)
        text[np.arange(len(codes)) + np.repeat(np.arange(len(pieces)), lengths)] = dense + 2
        text[-1] = _END
        self.begin = np.cumsum(lengths + 1) - lengths - 1
        self.n = n = len(text)
        order = suffix_array(text, n)
        bwt = text[order - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text.astype(np.int64), minlength=len(self.alphabet) + 2))])
        sampled = order % SAMPLE == 0
        self.sampled, self.samples = Bits(sampled), (order[sampled] // SAMPLE).astype(np.uint32)
        self.levels, self.zeros = [], []
        width = max(1, int(len(self.alphabet) + 1).bit_length())
        for level in range(width - 1, -1, -1):
            bit = (bwt >> np.uint64(level)) & np.uint64(1) == 1
            self.levels.append(Bits(bit))
            self.zeros.append(n - self.levels[-1].ones)
            bwt = np.concatenate([bwt[~bit], bwt[bit]])
        self.base = self._down(np.arange(len(self.alphabet) + 2), np.zeros(len(self.alphabet) + 2, np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        width = len(self.levels)
        for k, (bits, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            ones = bits.rank(i)
            i = np.where((symbol >> (width - 1 - k)) & 1 == 1, zeros + ones, i - ones)
        return i

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """Symbols of word codes, -1 for words that are not indexed."""
        if not len(self.alphabet):
            return np.full(len(codes), -1)
        at = np.minimum(np.searchsorted(self.alphabet, codes), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == codes, at + 2, -1)

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix ranges of the patterns with one more word on the left."""
        both = self._down(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        shift = self.first[symbol] - self.base[symbol]
        return both[: len(lo)] + shift, both[len(lo) :] + shift

    def locate(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece and word of the suffixes at the given rows."""
        row = row.copy()
        steps = np.zeros(len(row), np.int64)
        width = len(self.levels)
        while True:
            live = np.flatnonzero(self.sampled.get(row) == 0)
            if not len(live):
                break
            i = row[live]
            symbol = np.zeros(len(i), np.int64)
            for k, (bits, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
                bit = bits.get(i).astype(np.int64)
                ones = bits.rank(i)
                symbol |= bit << (width - 1 - k)
                i = np.where(bit == 1, zeros + ones, i - ones)
            row[live] = self.first[symbol] + i - self.base[symbol]
            steps[live] += 1
        place = self.samples[self.sampled.rank(row)].astype(np.int64) * SAMPLE + steps
        piece = np.searchsorted(self.begin, place, side="right") - 1
        return piece, place - self.begin[piece]

    def intervals(self, codes: np.ndarray, offsets: np.ndarray, least: int):
        """Maximal intervals of at least ``least`` words of each query that occur in the index, from right to left.

        Backward search takes a query word by word. Where it fails after enough words, the interval is reported and
        the search goes on with the window that starts at the failing word, of which all later windows are covered.
        Returns query, first word, length and a suffix row of each interval.
        """
        symbol = self.symbols(codes)
        m = len(offsets) - 1
        end = np.diff(offsets)
        at = end - 1
        lo, hi = np.zeros(m, np.int64), np.full(m, self.n, np.int64)
        live = np.flatnonzero(end >= least)
        found = []
        while len(live):
            s = symbol[offsets[live] + np.maximum(at[live], 0)]
            x, y = self.extend(np.maximum(s, 0), lo[live], hi[live])
            good = (at[live] >= 0) & (s >= 0) & (y > x)
            going, stuck = live[good], live[~good]
            lo[going], hi[going] = x[good], y[good]
            at[going] -= 1
            if len(stuck):
                length = end[stuck] - 1 - at[stuck]
                enough = length >= least
                hit = stuck[enough]
                found.append(np.stack([hit, at[hit] + 1, length[enough], lo[hit]]))
                end[stuck] = np.where(enough, at[stuck] + least, end[stuck] - 1)
                end[stuck[at[stuck] < 0]] = 0
                at[stuck], lo[stuck], hi[stuck] = end[stuck] - 1, 0, self.n
                live = np.sort(np.concatenate([going, stuck[end[stuck] >= least]]))
        return np.concatenate(found, axis=1) if found else np.zeros((4, 0), np.int64)
