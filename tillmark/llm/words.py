"""Words of many texts at once, as numpy arrays.

A batch of texts becomes one byte buffer in which every separator is a space; a line break, which
is a separator too, stands after each text. Words get 64-bit hashes from their bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(separators: bytes) -> bytes:
    """A translation to lower case (A-Z) that turns separators into spaces."""
    cut = set(separators)
    return bytes(32 if b in cut else _LOWER[b] for b in range(256))


# White space: words are runs of anything else.
SPACES = table(bytes([32, *range(9, 14)]))
# Everything but digits, letters and what lies beyond ASCII.
SYMBOLS = table(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]).replace(
    bytes(range(65, 91)), b""
))

_PERIOD = 256  # a power of two
_rng = np.random.default_rng(20240607)
_FACTORS = _rng.integers(0, 1 << 63, _PERIOD, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEPS = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (multiply and shift, twice)."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@dataclass
class Words:
    """Words of a batch: byte ranges, hashes, and ``first``, where each text's words begin."""

    buffer: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        lengths = self.ends - self.starts
        total = int(lengths.sum())
        begins = np.cumsum(lengths) - lengths
        small = np.int32 if len(self.buffer) < 1 << 31 else np.int64
        inside = np.arange(total, dtype=small) - np.repeat(begins.astype(small), lengths)
        held = self.buffer[inside + np.repeat(self.starts.astype(small), lengths)]
        values = _FACTORS[inside & (_PERIOD - 1)]
        if lengths.max() > _PERIOD:
            values *= np.uint64(2) * (inside // _PERIOD).astype(np.uint64) + np.uint64(1)
        values *= held + np.uint64(1)
        sums = np.add.reduceat(values, begins)
        return mixed(sums + lengths.astype(np.uint64))


def split(batch: list[bytes], by: bytes) -> Words:
    """Words of UTF-8 texts under a translation ``by`` (SPACES, SYMBOLS)."""
    joined = b"\n".join(batch) + b"\n"
    buffer = np.frombuffer(joined.translate(by), dtype=np.uint8)
    inside = np.empty(len(buffer) + 1, dtype=bool)
    inside[0] = False
    np.not_equal(buffer, 32, out=inside[1:])
    if by[10] != 32:
        raise ValueError("a line break must separate words")
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    lengths = np.fromiter(map(len, batch), dtype=np.int64, count=len(batch)) + 1
    first = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]))
    return Words(buffer, starts, ends, first)


def runs(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words inside one text, and the place of their first word."""
    count = len(hashes) - width + 1
    if count < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(count, dtype=np.uint64)
    for i in range(width):
        total += hashes[i : i + count] * _STEPS[i % len(_STEPS)]
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    places = np.flatnonzero(owner[:count] == owner[width - 1 :])
    return mixed(total[places]), places
