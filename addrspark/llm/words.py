"""Words of many texts at once, as arrays.

A word is a longest run of bytes other than space and ``\\t \\n \\v \\f \\r``, with
A-Z in lower case. The words of a block of texts are found and hashed with a few
passes of numpy over the joined bytes; no Python object is made for a word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: Bytes of text worked on at once; a longer text is a block of its own. The arrays of a block take some 45 times as much.
BLOCK_BYTES = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_up_to(n: int) -> list[np.ndarray]:
    """Powers of the base of the hash and of its inverse modulo 2 ** 64."""
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 4096)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``h``; one to one."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


class Words:
    """The words of a block of texts.

    ``first[i] : first[i + 1]`` are the words of text i; ``starts`` and ``ends`` are
    byte positions in ``data``; ``hashes`` are 64-bit hashes of the words.
    """

    def __init__(self, texts: list[bytes], lower: bool = True):
        joined = b" ".join(texts) + b" "
        self.data = np.frombuffer(joined.lower() if lower else joined, np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        edges = np.flatnonzero(np.diff(_SPACE[self.data], prepend=True))
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.first = np.searchsorted(self.starts, self.offsets)

    @property
    def hashes(self) -> np.ndarray:
        power, inverse = _powers_up_to(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(self.data * power[: len(self.data)], out=sums[1:])
        h = (sums[self.ends] - sums[self.starts]) * inverse[self.starts]
        return mixed(h + (self.ends - self.starts).astype(np.uint64))

    @property
    def doc(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def blocks(texts: Iterable[str | None], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts as UTF-8 in blocks of about ``limit`` bytes, with the first one's index.

    A missing text is an empty one.
    """
    block: list[bytes] = []
    size = begin = 0
    for i, text in enumerate(texts):
        data = text.encode() if isinstance(text, str) else b""
        if block and size + len(data) > limit:
            yield begin, block
            block, size, begin = [], 0, i
        block.append(data)
        size += len(data) + 1
    if block:
        yield begin, block


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for every ``width`` consecutive words; as many as there are such windows."""
    n = len(hashes) - width + 1
    if n <= 0:
        return hashes[:0]
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * np.uint64(0xFF51AFD7ED558CCD) + hashes[k : k + n]
    return mixed(out)
