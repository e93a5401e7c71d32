"""Deep-shallow sorting of fixed-length suffixes.

Suffixes are rows of big-endian 64-bit words. A multikey quicksort orders them by their
first words only, each word sorting the rows that are equal in the words before.
Groups that are still equal at that depth have long common prefixes; they are ordered
by blind tries. A node of a blind trie stores the position where its suffixes first differ, skips
what they share, and branches on the word at that position. The tries of all groups
grow together, a level at a time.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 2


def as_words(rows: np.ndarray) -> np.ndarray:
    """Byte rows as big-endian words, padded with zeros: they compare as the bytes do."""
    n, width = rows.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rows
    return padded.view(">u8").astype(np.uint64)


def _tied(new: np.ndarray) -> np.ndarray:
    """Positions that are in a group of more than one; ``new`` marks where groups begin."""
    return np.flatnonzero(~new | ~np.append(new[1:], True))


def _refine(order: np.ndarray, new: np.ndarray, at: np.ndarray, keys: np.ndarray) -> None:
    """Sort the positions ``at``, whole groups, by their keys within their groups; mark the new groups."""
    group = np.cumsum(new[at])
    own = np.lexsort((keys, group))
    order[at] = order[at][own]
    new[at[1:]] |= keys[own][1:] != keys[own][:-1]


def deep_shallow(words: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """The order of the rows, and for each place in that order whether it begins a group of equal rows."""
    n, width = words.shape
    order, new = np.arange(n), np.zeros(n, bool)
    if not n:
        return order, new
    new[0] = True
    for depth in range(min(shallow, width)):  # multikey quicksort
        at = _tied(new)
        if len(at):
            _refine(order, new, at, words[order[at], depth])
    if width > shallow:  # blind tries
        at = _tied(new)
        while len(at):
            starts = np.flatnonzero(new[at])
            rows = words[order[at], shallow:]
            differs = np.minimum.reduceat(rows, starts) != np.maximum.reduceat(rows, starts)
            inner = differs.any(1)
            sizes = np.diff(np.append(starts, len(at)))
            branch = np.repeat(differs.argmax(1), sizes)
            live = np.repeat(inner, sizes)
            if not live.any():
                break
            at, branch, rows = at[live], branch[live], rows[live]
            _refine(order, new, at, rows[np.arange(len(at)), branch])
            still = ~new[at] | ~np.append(new[at][1:], True)
            at = at[still]
    return order, new
