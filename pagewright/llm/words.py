"""Words of a text as byte ranges, and hashes of any run of them, in NumPy.

A word is a maximal run of bytes that are digits, letters or not ASCII; A-Z are lowered.
Hashes are polynomial, so that the hash of any range comes from two prefix sums. They only
propose matches: whoever uses them compares the bytes or a strong digest afterwards.
"""

from __future__ import annotations

import numpy as np

SPACE = 32
_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

#: Byte to word byte: A-Z to a-z, separators to a space.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else SPACE
    for b in range(256)
)
#: The same for words that white space alone separates, which stay as they are.
PLAIN_BYTES = bytes(SPACE if b == SPACE or 0x09 <= b <= 0x0D else b for b in range(256))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown as texts need them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, _U64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(2 * len(self.up), n + 1, 1 << 16)
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.concatenate([[_U64(1)], np.full(size, _BASE, _U64)]), dtype=_U64)
                self.down = np.cumprod(np.concatenate([[_U64(1)], np.full(size, _BASE_INVERSE, _U64)]), dtype=_U64)
        return self.up, self.down


_powers = _Powers()


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of SplitMix64)."""
    x = x ^ (x >> _U64(30))
    x = x * _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


class Prefix:
    """Prefix hashes of a byte array; ``ranges(starts, ends)`` hashes each range."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        up, self._down = _powers(n)
        self._sums = np.zeros(n + 1, _U64)
        np.cumsum((data.astype(_U64) + _U64(1)) * up[:n], out=self._sums[1:])

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self._sums[ends] - self._sums[starts]) * self._down[starts] + (ends - starts).astype(_U64))

    def every(self, length: int) -> np.ndarray:
        """The hash of each range of ``length`` bytes."""
        count = max(0, len(self._sums) - length)
        return mixed((self._sums[length : length + count] - self._sums[:count]) * self._down[:count] + _U64(length))


class Words:
    """The words of one text, joined by single spaces; ``word_bytes`` makes separators a space.

    ``data`` holds the joined bytes, ``starts``/``ends`` the words in it, and
    ``text_starts``/``text_ends`` the same words in the bytes of the text.
    """

    def __init__(self, raw: bytes, word_bytes: bytes = WORD_BYTES) -> None:
        lowered = np.frombuffer(raw.translate(word_bytes), np.uint8)
        inside = lowered != SPACE
        edges = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
        self.text_starts = np.flatnonzero(edges == 1)
        self.text_ends = np.flatnonzero(edges == -1)
        kept = inside.copy()
        kept[1:] |= inside[:-1]
        self.data = lowered[kept]
        lengths = self.text_ends - self.text_starts
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = self.ends - lengths
        self._prefix: Prefix | None = None

    def __len__(self) -> int:
        return len(self.starts)

    def runs(self, n: int) -> np.ndarray:
        """The hash of each run of ``n`` consecutive words."""
        if len(self) < n:
            return np.zeros(0, _U64)
        if self._prefix is None:
            self._prefix = Prefix(self.data)
        return self._prefix.ranges(self.starts[: len(self) - n + 1], self.ends[n - 1 :])

    def bytes_of(self, first: int, n: int) -> bytes:
        return self.data[self.starts[first] : self.ends[first + n - 1]].tobytes()
