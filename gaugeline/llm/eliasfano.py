"""Elias-Fano coded monotone sequences in memory-mapped files, and an n-gram trie made of them."""

import tempfile

import numpy as np

BLOCK = 4096
#: Codes 1 to 255 stand for 10 ** (-(code - 1) / PER_DECADE); 0 stands for none.
PER_DECADE = 26.0


def mapped(data: np.ndarray) -> np.ndarray:
    """The array in a file without a name, which goes with the array."""
    if not data.nbytes:
        return data
    with tempfile.TemporaryFile() as f:
        data.tofile(f)
        f.flush()
        return np.memmap(f, data.dtype, "r", shape=data.shape)


class Monotone:
    """A non-decreasing sequence of unsigned numbers: low bits packed, high bits in unary, a directory of blocks."""

    def __init__(self, values: np.ndarray):
        n = self.size = len(values)
        top = int(values[-1]) if n else 0
        self.low_bits = max(0, (top // max(1, n)).bit_length() - 1)
        self.shift = np.uint64(self.low_bits)
        self.firsts = np.array(values[::BLOCK], np.uint64)
        places = (values >> self.shift).astype(np.int64) + np.arange(n)
        self.starts = np.append(places[::BLOCK], places[-1] + 1 if n else 0)
        bits = np.zeros(int(self.starts[-1]) + 8, np.uint8)
        bits[places] = 1
        self.high = mapped(np.packbits(bits))
        parts = [self._pack(values[i : i + BLOCK]) for i in range(0, n, BLOCK)] if self.low_bits else []
        self.low = mapped(np.concatenate(parts)) if parts else np.zeros(0, np.uint8)

    def _pack(self, values: np.ndarray) -> np.ndarray:
        width = np.arange(self.low_bits, dtype=np.uint64)
        return np.packbits((values[:, None] >> width) & np.uint64(1) == 1, axis=None)

    def block(self, b: int) -> np.ndarray:
        """The numbers of block `b`."""
        begin, end = b * BLOCK, min(self.size, (b + 1) * BLOCK)
        at, to = int(self.starts[b]), int(self.starts[b + 1])
        ones = np.flatnonzero(np.unpackbits(self.high[at // 8 : to // 8 + 1]))
        ones = ones[np.searchsorted(ones, at % 8) :][: end - begin] + at // 8 * 8
        values = (ones - np.arange(begin, end)).astype(np.uint64) << self.shift
        if self.low_bits:
            from_bit, bits = begin * self.low_bits, (end - begin) * self.low_bits
            low = np.unpackbits(self.low[from_bit // 8 : (from_bit + bits + 7) // 8], count=bits).reshape(-1, self.low_bits)
            values |= low.astype(np.uint64) @ (np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64))
        return values

    def successors(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For sorted `wanted`: place of the first number not below each, and whether it is equal."""
        places, equal = np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        if not self.size:
            return places, equal
        blocks = np.maximum(np.searchsorted(self.firsts, wanted) - 1, 0)
        edges = np.flatnonzero(np.diff(blocks, prepend=-1, append=-1))
        for at, to in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            b = int(blocks[at])
            values = np.append(self.block(b), self.firsts[b + 1 : b + 2])
            found = np.searchsorted(values, wanted[at:to])
            inner = np.minimum(found, len(values) - 1)
            places[at:to] = found + b * BLOCK
            equal[at:to] = values[inner] == wanted[at:to]
        return places, equal

    def at(self, places: np.ndarray) -> np.ndarray:
        """The numbers at sorted `places`."""
        out = np.zeros(len(places), np.uint64)
        blocks = places // BLOCK
        edges = np.flatnonzero(np.diff(blocks, prepend=-1, append=-1))
        for at, to in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            out[at:to] = self.block(int(blocks[at]))[places[at:to] - blocks[at] * BLOCK]
        return out


def quantised(shares: np.ndarray) -> np.ndarray:
    """One-byte codes of positive shares, spaced evenly in their logarithm."""
    return (np.clip(np.rint(-np.log10(shares) * PER_DECADE), 0, 254) + 1).astype(np.uint8)


def shares_of(codes: np.ndarray) -> np.ndarray:
    table = np.append(0.0, 10.0 ** (-np.arange(255) / PER_DECADE))
    return table[codes]


class Trie:
    """Two levels: contexts with pointers to where their successors begin, and successors with probability codes.

    A successor is its word's place among the words of the trie, counted from its context's base, which makes the
    whole level increase; a pointer bounds the search to the successors of one context.
    """

    def __init__(self, contexts: np.ndarray, words: np.ndarray, codes: np.ndarray):
        """From (context, word) hashes, sorted by both and distinct, and the code of each."""
        self.contexts, context = _level(contexts)
        self.words, word = _level(words)
        self.width = np.uint64(max(1, self.words.size))
        begins = np.flatnonzero(np.diff(context, prepend=-1))
        self.pointers = Monotone(np.append(begins, len(context)).astype(np.uint64))
        self.successors = Monotone(context.astype(np.uint64) * self.width + word.astype(np.uint64))
        self.codes = mapped(codes)

    def find(self, contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Codes of (context, word) hashes in any order; 0 for what the trie does not have."""
        context, known_context = _search(self.contexts, contexts)
        word, known_word = _search(self.words, words)
        out = np.zeros(len(contexts), np.uint8)
        at = np.flatnonzero(known_context & known_word)
        at = at[np.lexsort((word[at], context[at]))]
        keys = context[at].astype(np.uint64) * self.width + word[at].astype(np.uint64)
        place, equal = self.successors.successors(keys)
        begin, end = self.pointers.at(context[at]), self.pointers.at(context[at] + 1)
        good = equal & (place >= begin.astype(np.int64)) & (place < end.astype(np.int64))
        out[at[good]] = self.codes[place[good]]
        return out


def _level(keys: np.ndarray) -> tuple[Monotone, np.ndarray]:
    unique, place = np.unique(keys, return_inverse=True)
    return Monotone(unique), place


def _search(level: Monotone, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, back = np.unique(keys, return_inverse=True)
    place, equal = level.successors(unique)
    return place[back], equal[back]
