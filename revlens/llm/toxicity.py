"""Toxic texts by a support vector machine on a subsequence string kernel.

Two strings are compared by the gap-weighted subsequence kernel: the common
subsequences of three characters, each weighted by how tightly it lies in both, so
inserted characters and gaps only lower the value.  Nyström landmarks, which set labelled
texts apart, and common words turn it into a few features, on which a linear
machine with squared hinge loss is trained.  Labels are of whole texts: a toxic
text counts with the sentences found toxic so far (or its worst if that is near), others
with all of theirs, and a sentence with its most toxic word, chosen anew in each round.  A text scores as
its worst sentence, through a logistic curve.

Landmarks are learned from the labelled texts: whole words, and stems, the first four to twelve
characters that words of toxic texts share, however they go on.  A stem is compared with the
beginnings of a word, up to ``SLACK`` characters longer than itself, with and without signs in it; the best counts.  A word whose
longest common subsequence with a landmark, found in bits of one number, is too short has no
similarity to it, so the kernel is worked out for few words.

Case is ignored; letters set apart by spaces or signs are read as one word too.  So are
one to three neighbouring words without their signs, if most of the result is, in this order,
in a landmark typical of toxic texts and most of that in it; other runs are not compared.
A null text is an empty one and scores as a text without a toxic sentence.  Texts and words of any
length are read whole; a word far longer than a landmark is compared with stems only.  Ties
between landmarks go to the longer, then to the first in the alphabet; repeated rows of a
sample count once, repeated rows scored score alike, and an empty table gives none.  Without
labels of both kinds, or without a landmark that sets them apart, every score is the share of
label 1 (one half if there are none).
"""

import re
from collections import Counter
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bounds of the labelled rows, and of the sentences of texts that are not toxic.
TRAIN_ROWS, TRAIN_SENTENCES = 2500, 30_000
#: ``POWER`` sharpens the normalized kernel of two words.
DECAY, ORDER, POWER = 0.85, 3, 3
#: A string is a landmark if its shares of toxic and other texts differ by so many standard errors.
LEVEL = 4.0
#: Lengths of stems, and characters that the beginning of a word may have more.
STEMS, SLACK = (4, 12), 3
#: Close calls among the other words, usual words, and the longest of both.
CLOSE, USUAL, WIDEST = 6, 4, 12
ROUNDS = 2
KEPT = 500_000
#: Part of a landmark (of the longer of the two, if it is no stem) that a word or run holds in order, for the kernel to be worked out.
NEAR = 0.75
#: The longest landmark.
LONGEST = 32

_SENTENCE = re.compile(r"[.!?]+(?:\s+|$)|\n+")
_SPACED = re.compile(r"(?<![\w'\u2019])[^\W_](?:[\W_]{1,5}[^\W_]){2,}(?!\w)")
_SIGN = re.compile(r"[\W_]+")
_EDGE = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~"


def sentences(text: str) -> list[list[str]]:
    """The words of each sentence, lower case, with what stands around them."""
    text = text.lower()
    if _SPACED.search(text):
        text = _SPACED.sub(lambda m: m[0] + " " + _SIGN.sub("", m[0]), text)
    return [words for words in map(str.split, _SENTENCE.split(text)) if words]


def bare(word: str) -> str:
    return word.strip(_EDGE)


class Landmark(str):
    """A word, or a stem that words begin with."""

    is_stem = False

    @classmethod
    def stem(cls, text: str) -> "Landmark":
        out = cls(text)
        out.is_stem = True
        return out

    def __reduce__(self):
        return (Landmark.stem if self.is_stem else Landmark, (str(self),))


def _codes(words: list[str], width: int) -> np.ndarray:
    return np.array([w[:width] for w in words], f"U{width}").view(np.int32).reshape(len(words), width)


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Subsequence kernel of every word with every landmark, not normalized."""
    width = max(map(len, landmarks))
    t = _codes(landmarks, width)
    t = np.where(np.arange(width) < np.array([[len(w)] for w in landmarks]), t, -1)
    # weight of going on from place j' to a later place j, both ends included
    gap = np.zeros((width, width), np.float32)
    for j in range(width):
        gap[j, j:] = DECAY ** (np.arange(width - j) + 2)
    # per character of the landmarks, and last for all others: where it is, and what one character adds up to each place
    alphabet = np.unique(t[t >= 0])
    same = np.zeros((len(alphabet) + 1, *t.shape), np.float32)
    same[:-1] = alphabet[:, None, None] == t
    single = same @ gap
    decay = np.float32(DECAY)
    out = np.zeros((len(words), len(landmarks)))
    lengths = np.array([len(w) for w in words])
    for n in np.unique(lengths[lengths >= ORDER]):
        index = np.flatnonzero(lengths == n)
        for at in range(0, len(index), 256):
            own = index[at : at + 256]
            s = _codes([words[i] for i in own], int(n))
            place = np.minimum(np.searchsorted(alphabet, s), len(alphabet) - 1)
            place = np.where(alphabet[place] == s, place, len(alphabet))
            shape = (len(own), len(landmarks), width)
            # partial[i][..., j]: subsequences of i + 1 characters up to here, ended before place j
            partial = [np.zeros((*shape[:2], width + 1), np.float32) for _ in range(ORDER - 1)]
            total = np.zeros(shape, np.float32)
            for x in range(int(n)):
                here = same[place[:, x]]
                total += here * partial[-1][..., :-1]
                for i in range(ORDER - 2, 0, -1):
                    ended = here * partial[i - 1][..., :-1]
                    partial[i] *= decay
                    partial[i][..., 1:] += (ended.reshape(-1, width) @ gap).reshape(shape)
                partial[0] *= decay
                partial[0][..., 1:] += single[place[:, x]]
            out[own] = DECAY**2 * total.sum(axis=2)
    return out


def own_values(words: list[str]) -> np.ndarray:
    """Kernel of each word with itself, batched by length."""
    out = np.zeros(len(words))
    lengths = np.array([len(w) for w in words])
    for n in np.unique(lengths[lengths >= ORDER]):
        index = np.flatnonzero(lengths == n)
        n = int(n)
        gap = np.zeros((n, n))
        for j in range(n):
            gap[j, j:] = DECAY ** (np.arange(n - j) + 2)
        for at in range(0, len(index), 8000):
            own = index[at : at + 8000]
            s = _codes([words[i] for i in own], n)
            partial = [np.ones(s.shape)] + [np.zeros(s.shape) for _ in range(ORDER - 1)]
            total = np.zeros(len(own))
            for x in range(n):
                same = s[:, x, None] == s
                ended = []
                for i in range(ORDER):
                    before = partial[i]
                    if i:
                        before = np.concatenate([np.zeros((len(own), 1)), before[:, :-1]], axis=1)
                    ended.append(same * before)
                total += DECAY**2 * ended[-1].sum(axis=1)
                for i in range(1, ORDER):
                    partial[i] = DECAY * partial[i] + ended[i - 1] @ gap
            out[own] = total
    return out


def normalized(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalized kernel of whole strings to the power ``POWER``."""
    norm = np.sqrt(np.maximum(own_values(words), 1e-30)[:, None] * np.maximum(own_values(landmarks), 1e-30)[None])
    return np.minimum(kernel(words, landmarks) / norm, 1.0) ** POWER


def similarity(words: list[str], landmarks: list[Landmark]) -> np.ndarray:
    """Kernel of words with landmarks; with a stem that of the best beginning; 0 where the two have too little in order."""
    out = np.zeros((len(words), len(landmarks)))
    for stems in (False, True):
        column = [k for k, mark in enumerate(landmarks) if mark.is_stem == stems]
        marks = [landmarks[k] for k in column]
        if not marks or not words:
            continue
        sizes = np.array([len(mark) for mark in marks])
        most = int(sizes.max()) + SLACK if stems else int(sizes.max() / NEAR)
        heads = [w[:most] if stems else w if len(w) <= most else "" for w in words]
        # of a word with signs in it, a stem sees the beginning without them as well
        signs = [k for k, w in enumerate(heads) if not w.isalnum()] if stems else []
        heads += [_SIGN.sub("", words[k][: 4 * most])[:most] for k in signs]
        distinct = {w: k for k, w in enumerate(dict.fromkeys(heads))}
        strings = list(distinct)
        length = np.array([len(w) for w in strings])
        common = in_order(strings, marks)
        near = common >= NEAR * (sizes if stems else np.maximum(length[:, None], sizes))
        values = np.zeros(near.shape)
        for k in np.flatnonzero(near.any(axis=0)):
            some = np.flatnonzero(near[:, k])
            parts, owner = [], []
            for i in some.tolist():
                cuts = {strings[i][: sizes[k] + n] for n in range(SLACK + 1)} if stems else {strings[i]}
                parts += cuts
                owner += [i] * len(cuts)
            only = {w: j for j, w in enumerate(dict.fromkeys(parts))}
            found = normalized(list(only), [marks[k]])[:, 0]
            np.maximum.at(values[:, k], np.array(owner), found[[only[w] for w in parts]])
        found = values[[distinct[w] for w in heads]]
        found[signs] = np.maximum(found[signs], found[len(words) :])
        out[:, column] = found[: len(words)]
    return out


def pick_landmarks(texts: list[list[list[str]]], labels: np.ndarray) -> tuple[list[Landmark], int]:
    """Words and stems typical of toxic texts, then the commonest words of the others; and the number of the former.

    A string counts once per text, and only in neighbours it did not have in earlier
    texts, so neither copies nor long texts weigh more.  Every one is taken that
    passes ``LEVEL``, however much commoner others are, and that is four times as frequent in toxic texts, but for
    those that begin with a stem taken before and for stems of what was taken before.
    """
    seen: tuple[set, set] = set(), set()
    found = Counter(), Counter()
    for parts, label in zip(texts, labels):
        label = int(label)
        own = set()
        for words in parts:
            around = ["", *map(bare, words), ""]
            own.update(zip(around, around[1:], around[2:]))
        new = {word for _, word, _ in own - seen[label]}
        found[label].update((word, False) for word in new)
        found[label].update({(word[:n], True) for word in new for n in range(STEMS[0], min(STEMS[1], len(word)) + 1)})
        seen[label].update(own)
    del seen
    other, toxic = found
    n, m = max(1, int(labels.sum())), max(1, int((1 - labels).sum()))

    def typical(string):
        a, b = toxic[string] / n, other[string] / m
        return (a - b) / np.sqrt((a + b) * (1 / n + 1 / m) + 1e-12)

    able = [w for w in toxic if ORDER <= len(w[0]) <= LONGEST and toxic[w] / n > 4 * other[w] / m and typical(w) >= LEVEL]
    chosen: list[Landmark] = []
    for string, is_stem in sorted(able, key=lambda w: (-round(typical(w), 9), -len(w[0]), not w[1], w[0])):
        covered = any(mark.is_stem and string.startswith(mark) for mark in chosen)
        if not covered and not (is_stem and any(mark.startswith(string) for mark in chosen)):
            chosen.append(Landmark.stem(string) if is_stem else Landmark(string))
    words = [w for w, is_stem in other if not is_stem and ORDER <= len(w) <= WIDEST and w not in chosen]
    usual = sorted(words, key=lambda w: (-other[w, False], w))
    return chosen + [Landmark(w) for w in usual[:USUAL]], len(chosen)


def machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge=1e-3) -> np.ndarray:
    """Linear machine with squared hinge loss by Newton steps; the last weight is the offset."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x.shape[1])
    keep = np.eye(x.shape[1]) * ridge
    for _ in range(30):
        margin = y * (x @ w)
        live = margin < 1
        h = keep + (x[live] * weight[live, None]).T @ x[live]
        new = np.linalg.solve(h, (x[live] * weight[live, None]).T @ y[live])
        if np.allclose(new, w, atol=1e-10):
            break
        w = new
    return w


def curve(margin: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve of label 1 by margin."""
    a, b = 1.0, 0.0
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ np.array([a, b]), -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.eye(2) * 1e-3
        step = np.linalg.solve(h, x.T @ (labels - p) - 1e-3 * np.array([a, b]))
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(a, 1e-6), b


def in_order(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of every word with every landmark, in bits of one number."""
    alphabet = np.array(sorted(set("".join(landmarks))), "U1").view(np.int32)
    mask = np.zeros((len(alphabet) + 1, len(landmarks)), np.uint64)
    for k, landmark in enumerate(landmarks):
        for j, c in enumerate(landmark):
            mask[np.searchsorted(alphabet, ord(c)), k] |= np.uint64(1 << j)
    whole = np.array([(1 << len(t)) - 1 for t in landmarks], np.uint64)
    mask = mask.astype(np.uint16 if whole.max() < 1 << 16 else np.uint64)
    whole = whole.astype(mask.dtype)
    out = np.zeros((len(words), len(landmarks)), np.uint8)
    lengths = np.array([len(w) for w in words])
    for n in np.unique(lengths[lengths > 0]):
        index = np.flatnonzero(lengths == n)
        for at in range(0, len(index), 8000):
            own = index[at : at + 8000]
            s = _codes([words[i] for i in own], int(n))
            place = np.minimum(np.searchsorted(alphabet, s), len(alphabet) - 1)
            place = np.where(alphabet[place] == s, place, len(alphabet))
            free = np.broadcast_to(whole, (len(own), len(landmarks)))
            for x in range(int(n)):
                here = mask[place[:, x]]
                free = (free + (free & here)) | (free & ~here)
            out[own] = np.bitwise_count(~free & whole)
    return out


class Runs:
    """Runs of neighbouring words that, joined without signs, come near a landmark."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        self.sizes = np.array([len(t) for t in landmarks], np.int16)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.plain: list[str] = []
        self.length, self.signs = np.zeros(0, np.int16), np.zeros(0, bool)
        self.common, self.over = np.zeros((0, len(self.landmarks)), np.uint8), np.zeros(0, np.int16)

    def learn(self, words: list[str]) -> None:
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        plain = [_SIGN.sub("", w) for w in new]
        self.known.update(zip(new, range(len(self.plain), len(self.plain) + len(new))))
        self.plain += plain
        # no run that is near holds as long a word
        length = np.array([min(len(w), 1000) for w in plain], np.int16)
        short = [w if n <= LONGEST / NEAR else "" for w, n in zip(plain, length.tolist())]
        self.length = np.concatenate([self.length, length])
        self.signs = np.concatenate([self.signs, [p != bare(w) for w, p in zip(new, plain)]]).astype(bool)
        common = in_order(short, self.landmarks)
        self.common = np.concatenate([self.common, common])
        # characters that are in order in no landmark
        self.over = np.concatenate([self.over, length - common.max(axis=1, initial=0).astype(np.int16)])

    def least(self, length: np.ndarray) -> np.ndarray:
        return NEAR * np.maximum(length[:, None], self.sizes)

    def near(self, sentences: list[list[str]]) -> list[tuple[int, str]]:
        """Number of the sentence and the run, each once."""
        if len(self.known) > min(KEPT, 40_000_000 // len(self.landmarks)):
            self.forget()
        flat = list(chain.from_iterable(sentences))
        missing = [w for w in set(flat) if w not in self.known]
        if missing:
            self.learn(missing)
        word = np.array([*map(self.known.__getitem__, flat)], np.int64)
        sentence = np.repeat(np.arange(len(sentences)), [len(words) for words in sentences])
        some = self.length[word] > 0
        word, sentence = word[some], sentence[some]
        length, over = self.length[word], self.over[word]
        found = set()
        for n in range(1, 4):
            count = len(word) - n + 1
            if count < 1:
                break
            total = sum(length[k : count + k] for k in range(n))
            able = (total >= NEAR * self.sizes.min()) & (total <= self.sizes.max() / NEAR) & (sentence[:count] == sentence[n - 1 :])
            if n == 1:
                able &= self.signs[word]
            # what the parts hold in order is as much as the whole can hold
            able &= sum(over[k : count + k] for k in range(n)) <= (1 - NEAR) * total
            at = np.flatnonzero(able)
            most = sum(self.common[word[at + k]] for k in range(n))
            at = at[(most >= self.least(total[at])).any(axis=1)]
            found.update((int(sentence[i]), "".join([self.plain[word[i + k]] for k in range(n)])) for i in at.tolist())
        found = sorted(found)
        strings = sorted({run for _, run in found})
        if not strings:
            return []
        close = (in_order(strings, self.landmarks) >= self.least(np.array([len(w) for w in strings]))).any(axis=1)
        kept = {w for w, c in zip(strings, close) if c}
        return [(k, w) for k, w in found if w in kept]


class Model:
    """Margins of words, less the offset, remembered in bounded memory."""

    def __init__(self, landmarks, weights, offset, slope, base, runs):
        self.runs = runs
        self.landmarks, self.weights, self.offset, self.slope, self.base = landmarks, weights, offset, slope, base
        self.known: dict[str, float] = {}
        self.bare: dict[str, float] = {}

    def learn(self, words: list[str]) -> None:
        """Work out words not seen before; those that differ in what stands around them only once."""
        stripped = [bare(w) for w in words]
        new = list(dict.fromkeys(w for w in stripped if w not in self.bare))
        self.bare.update(zip(new, (similarity(new, self.landmarks) @ self.weights).tolist()))
        self.known.update(zip(words, map(self.bare.__getitem__, stripped)))

    def forget(self) -> None:
        """Drop what came last of a full memory, as frequent words come early."""
        if len(self.known) > KEPT:
            self.known = dict(islice(self.known.items(), KEPT // 2))
        if len(self.bare) > KEPT:
            self.bare = dict(islice(self.bare.items(), KEPT // 2))

    def margins(self, texts: list[list[list[str]]]) -> np.ndarray:
        """Of the worst sentence of each text; an empty text has the offset alone."""
        self.forget()
        own = [set(chain.from_iterable(parts)) for parts in texts]
        owner = [k for k, parts in enumerate(texts) for _ in parts]
        for k, run in self.runs.near(list(chain.from_iterable(texts))):
            own[owner[k]].add(run)
        self.learn([w for w in set().union(*own) if w not in self.known])
        get = self.known.__getitem__
        return np.array([max(map(get, words), default=0.0) + self.offset for words in own])

    def score(self, texts: list[str]) -> np.ndarray:
        z = self.slope * self.margins([sentences(t) for t in texts]) + self.base
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(rows: list[tuple[str, int]], seed=0):
    """A function from texts to scores."""
    labels = np.array([label for _, label in rows], np.float64)
    if not len(labels) or labels.min() == labels.max():
        share = float(labels.mean()) if len(labels) else 0.5
        return lambda texts: np.full(len(texts), share)
    texts = [sentences(text) for text, _ in rows]
    landmarks, n_typical = pick_landmarks(texts, labels)
    if not n_typical:
        return lambda texts: np.full(len(texts), float(labels.mean()))
    runs = Runs(landmarks[:n_typical])
    original, texts = texts, [[list(words) for words in parts] for parts in texts]
    flat = list(chain.from_iterable(texts))
    for at in range(0, len(flat), 5000):
        for k, run in runs.near(flat[at : at + 5000]):
            flat[at + k].append(run)
    runs.forget()
    vocabulary = sorted({w for parts in texts for words in parts for w in words})
    number = {w: k for k, w in enumerate(vocabulary)}
    stripped = [bare(w) for w in vocabulary]
    distinct = {w: k for k, w in enumerate(dict.fromkeys(stripped))}
    of_bare = np.array([distinct[w] for w in stripped])
    values = similarity(list(distinct), landmarks)[of_bare]
    words = np.array([number[w] for parts in texts for part in parts for w in part])
    begin = np.concatenate([[0], np.cumsum([len(part) for parts in texts for part in parts])]).astype(np.int64)[:-1]
    owner = np.repeat(np.arange(len(texts)), [len(parts) for parts in texts])
    calm = np.flatnonzero(labels[owner] == 0)
    calm = np.sort(np.random.default_rng(seed).permutation(calm)[:TRAIN_SENTENCES])
    toxic = np.flatnonzero(labels[owner] == 1)
    of_word = values[:, :n_typical].max(axis=1) - 0.99
    for turn in range(2 * ROUNDS):
        if turn == ROUNDS:
            # the words of the other texts that come closest become landmarks as well
            common = np.bincount(words[np.isin(np.repeat(np.arange(len(owner)), np.diff(np.append(begin, len(words)))), calm)], minlength=len(number))
            near = [k for k in np.argsort(-of_word, kind="stable") if common[k] > 1 and len(stripped[k]) <= WIDEST]
            more = [Landmark(w) for w in dict.fromkeys(stripped[k] for k in near) if w and w not in landmarks][:CLOSE]
            landmarks = landmarks + more
            values = np.concatenate([values, similarity(list(distinct), more)[of_bare]], axis=1) if more else values
        # features whose products are the kernel seen through the landmarks
        scale, basis = np.linalg.eigh(normalized(landmarks, landmarks))
        root = basis / np.sqrt(np.where(scale > 1e-6, scale, np.inf)) @ basis.T
        x = values @ root
        # the worst word of each sentence; of a toxic text the sentences found toxic, or else the worst if it is near
        rank = np.argsort(np.argsort(of_word, kind="stable"), kind="stable")
        ordered = np.argsort(rank)
        worst = ordered[np.maximum.reduceat(rank[words], begin)]
        margin = of_word[worst]
        most = np.full(len(texts), -np.inf)
        np.maximum.at(most, owner, margin)
        top = toxic[margin[toxic] >= np.clip(most[owner[toxic]], -0.5, 0)]
        chosen = np.concatenate([top, calm])
        y = np.where(labels[owner[chosen]] == 1, 1.0, -1.0)
        share = np.bincount(owner[top], minlength=len(texts))
        weight = np.where(y > 0, 0.5 / max(1, (share > 0).sum()) / np.maximum(share[owner[chosen]], 1), 0.5 / max(1, len(calm)))
        w = machine(x[worst[chosen]], y, weight)
        of_word = x @ w[:-1] + w[-1]
    model = Model(landmarks, root @ w[:-1], float(w[-1]), 1.0, 0.0, runs)
    model.slope, model.base = curve(np.concatenate([model.margins(original[k : k + 200]) for k in range(0, len(original), 200)]), labels)
    model.known, model.bare = {}, {}
    runs.forget()
    return model.score


def score(docs: DataFrame, scorer, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id and score per row."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                values = scorer([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(values.astype(np.float64))], ["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")
