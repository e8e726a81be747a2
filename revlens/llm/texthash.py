"""Hashes of stretches of bytes and of word shingles, for many texts at once."""

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_WORD_BASE = np.uint64(0xD6E8FEB86659FD93)
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_SALT = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS: list[np.ndarray] = []


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _powers(n: int) -> list[np.ndarray]:
    """At least ``n`` powers of the base and of its inverse; kept until more are needed."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = ((n - 1 >> 20) + 1) << 20
        _POWERS.clear()
        for base in (_BASE, _INVERSE):
            powers = np.full(size, base, np.uint64)
            powers[0] = 1
            _POWERS.append(np.cumprod(powers, dtype=np.uint64, out=powers))
    return _POWERS


class Stretches:
    """Hashes of any stretch of a byte array, by sums over its prefixes (modulo 2**64)."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.up, self.down = _powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_SALT[data] * self.up[:n], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def windows(self, size: int) -> np.ndarray:
        """The hash of every window of so many bytes, by its start."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n])


def shingles(texts: list[bytes], words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit hashes of the runs of ``words`` words, text by text, sorted in each.

    Returns the hashes and the offsets of the texts in them.  A text of fewer
    words has one run of all its words, one without words has none.
    """
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    blank = BLANK[data]
    before = np.concatenate([[True], blank[:-1]])
    starts = np.flatnonzero(~blank & before)
    ends = np.flatnonzero(blank & ~before)
    ends_of_text = np.cumsum([len(t) + 1 for t in texts])
    hashes = Stretches(data)(starts, ends)
    word_at = np.searchsorted(starts, np.concatenate([[0], ends_of_text]))  # first word of each text
    counts = np.diff(word_at)
    runs = np.where(counts == 0, 0, np.maximum(counts - words + 1, 1))
    owner = np.repeat(np.arange(len(texts)), runs)
    at = np.concatenate([[0], np.cumsum(runs)])
    first = np.arange(at[-1]) - np.repeat(at[:-1], runs) + np.repeat(word_at[:-1], runs)
    last = word_at[1:][owner]
    combined = np.zeros(len(first), np.uint64)
    with np.errstate(over="ignore"):
        padded = np.concatenate([hashes, np.zeros(words, np.uint64)])
        for k in range(words):
            word = np.where(first + k < last, padded[first + k], np.uint64(k + 1))
            combined = (combined ^ word) * _WORD_BASE
    combined = mix(combined)
    by = np.lexsort((combined, owner))
    combined, owner = combined[by], owner[by]
    kept = np.ones(len(combined), bool)
    kept[1:] = (combined[1:] != combined[:-1]) | (owner[1:] != owner[:-1])
    return combined[kept], np.searchsorted(owner[kept], np.arange(len(texts) + 1))
