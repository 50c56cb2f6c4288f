"""Words of many texts at once: a buffer of bytes, marks where words begin and end, and a 64-bit hash for each word."""

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

BATCH_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []

#: Bytes of a word: all but the space and the controls from tab to carriage return.
NOT_SPACE = np.array([b != 0x20 and not 0x09 <= b <= 0x0D for b in range(256)])
#: Bytes of a word: ASCII letters and digits, and everything beyond ASCII.
ALPHANUMERIC = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 of the base and of its inverse, modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        steps = np.ones((2, max(n, 1 << 16)), np.uint64)
        steps[0, 1:], steps[1, 1:] = np.uint64(_BASE), np.uint64(_INVERSE)
        _powers[:] = list(np.cumprod(steps, axis=1))
    return _powers[0][:n], _powers[1][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of byte * base^place before every place; see `span_hashes`."""
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes from `begins` to `ends` that depends on them alone."""
    _, down = powers(len(sums))
    return mixed((sums[ends] - sums[begins]) * down[begins])


def planes(values, kind: type, width: int | None = None) -> bytes:
    """Numbers with their first bytes together, then their second ones: bytes that hardly vary compress well.

    `width` keeps only the first (lowest) bytes.
    """
    array = np.ascontiguousarray(values, kind)
    return array.view(np.uint8).reshape(-1, array.itemsize)[:, :width].T.tobytes()


def from_planes(data: bytes, kind: type, width: int | None = None) -> np.ndarray:
    size = np.dtype(kind).itemsize
    parts = np.frombuffer(data, np.uint8).reshape(width or size, -1)
    whole = np.zeros((parts.shape[1], size), np.uint8)
    whole[:, : width or size] = parts.T
    return whole.view(kind).ravel()


def joined_planes(parts: list[bytes], kind: type, width: int | None = None) -> np.ndarray:
    return np.concatenate([from_planes(p, kind, width) for p in parts]) if parts else np.zeros(0, kind)


@dataclass
class Words:
    """Words of consecutive texts: byte places in the joined buffer, hash, and number of the text."""

    begins: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    owner: np.ndarray


def words_of(texts: Sequence[bytes], word_bytes: np.ndarray) -> Words:
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(none, none, none.astype(np.uint64), none)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = word_bytes[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begins, ends = edges[::2], edges[1::2]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    owner = np.searchsorted(np.cumsum(sizes), begins, side="right")
    return Words(begins, ends, span_hashes(prefix_sums(data), begins, ends), owner)


def batches_of(texts: Sequence[bytes], most: int = BATCH_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first text, texts) in runs of about `most` bytes; a longer text is a run of its own."""
    first, part, size = 0, [], 0
    for i, text in enumerate(texts):
        if part and size + len(text) > most:
            yield first, part
            first, part, size = i, [], 0
        part.append(text)
        size += len(text)
    if part:
        yield first, part
