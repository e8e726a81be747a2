"""Ids of the word-level tokenizer, remembered word by word.

The tokenizer drops white space and never joins characters across it, so the
ids of a text are those of its space-separated parts in a row.  New parts are
encoded together, told apart by a special token between them, and remembered
by the worker.  Letters never join with the marks behind them, so those are
encoded on their own.  The memory is bounded: when full, the half that came last goes,
as frequent words come early.
"""

import os
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice
from string import ascii_letters

import numpy as np

KEPT = 1_000_000
#: Characters of text that are looked up together.
BLOCK = 1 << 20
SEPARATOR = "<|endoftext|>"
MARKS = ".,;:!?"
_LETTERS = frozenset(ascii_letters)


class WordIds:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallel part
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.separator = self.tokenizer.token_to_id(SEPARATOR)
        self.known: dict[str, bytes] = {}

    def learn(self, words: list[str]) -> None:
        marked, bare = [], {}
        for w in words:
            stem = w.rstrip(MARKS)
            if len(stem) < len(w) and stem and stem[-1] in _LETTERS:
                marked.append((w, stem, w[len(stem) :]))
                bare[stem] = bare[w[len(stem) :]] = None
            else:
                bare[w] = None
        self._encode([w for w in bare if w not in self.known])
        for w, stem, marks in marked:
            self.known[w] = self.known[stem] + self.known[marks]

    def _encode(self, words: list[str]) -> None:
        plain = [w for w in words if "<|" not in w and "|>" not in w]
        if len(plain) < len(words):
            for w in set(words).difference(plain):
                self.known[w] = np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes()
        parts = [plain[at : at + 256] for at in range(0, len(plain), 256)]
        for part, found in zip(parts, self.tokenizer.encode_batch_fast(list(map(SEPARATOR.join, parts)), add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            ends = np.flatnonzero(ids == self.separator) * 4
            whole = ids.tobytes()
            begin = 0
            for w, end in zip(part, [*ends.tolist(), len(whole)]):
                self.known[w] = whole[begin:end]
                begin = end + 4

    def many(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each whole text as little-endian unsigned 32-bit numbers."""
        block, size = [], 0
        for text in texts:
            block.append(text)
            size += len(text)
            if size > BLOCK:
                yield from self._block(block)
                block, size = [], 0
        yield from self._block(block)

    def _block(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > KEPT:
            self.known = dict(islice(self.known.items(), KEPT // 2))
        find = self.known.get
        out: list[list[bytes | None]] = []
        new: dict[str, None] = {}
        gaps: list[tuple[list, list[tuple[int, str]]]] = []
        for text in texts:
            words = text.replace("\n", " ").split(" ")
            ids = list(map(find, words))
            missing = [(i, words[i]) for i, x in enumerate(ids) if x is None]
            if missing:
                new.update((w, None) for _, w in missing)
                gaps.append((ids, missing))
            out.append(ids)
        self.learn(list(new))
        for ids, missing in gaps:
            for i, w in missing:
                ids[i] = find(w)
        return list(map(b"".join, out))


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)
