"""Encoding and decoding with a SentencePiece vocabulary.

An Aho-Corasick automaton over the pieces reads the text once.  At each
character it follows the output links, longest piece first, and relaxes the best
weight of a segmentation that ends there.  For unigram models a piece weighs its score.
The scores of a BPE model are ranks of merges, and their best sum is not what merging
gives.  There a piece weighs 0 after one that merging leaves apart from it and minus
infinity after others, so the one segmentation of weight 0 is that of merging; weights
are worked out once per pair.  Either way the ids are those of the library.  A
character that is no piece costs the least score less ten and becomes its UTF-8
bytes, if the vocabulary has byte pieces, or the unknown piece.

Texts are taken as they are (identity normalization), with a space in front.  No
piece may continue after a space, nor hold a line feed, so a text is the row of
its words, and words are remembered in bounded memory; a vocabulary without that
property is read text by text.  A mark that no piece holds after a letter or digit
ends a word in the same way.  A null text is an empty one and has no ids; every row,
repeated or without an id, gives one row, and an empty table none.
"""

import math
import re
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
KEPT = 600_000
UNKNOWN_COST = 10.0
#: Weight of a transition that a segmentation cannot hold.
NEVER = -math.inf
MARKS = ".,;:!?)"
_ALNUM = re.compile(r"[^\W_]")


class Automaton:
    """Per state: the next states by character, the piece that ends there, and the state of the next shorter piece."""

    def __init__(self, pieces: dict[str, tuple[int, float]]):
        self.step: list[dict[str, int]] = [{}]
        self.piece: list[tuple[int, int] | None] = [None]
        self.gain = dict(pieces.values())
        for text, (number, _) in pieces.items():
            state = 0
            for char in text:
                after = self.step[state].get(char)
                if after is None:
                    after = self.step[state][char] = len(self.step)
                    self.step.append({})
                    self.piece.append(None)
                state = after
            self.piece[state] = (len(text), number)
        self.fail = [0] * len(self.step)
        self.link = [0] * len(self.step)
        queue = list(self.step[0].values())
        for state in queue:
            back = self.fail[state]
            self.link[state] = back if self.piece[back] else self.link[back]
            for char, after in self.step[state].items():
                self.fail[after] = self.after(back, char)
                queue.append(after)
        #: Where the pieces that end at a state begin.
        self.first = [state if self.piece[state] else self.link[state] for state in range(len(self.step))]

    def after(self, state: int, char: str) -> int:
        found = self.step[state].get(char)
        while found is None and state:
            state = self.fail[state]
            found = self.step[state].get(char)
        return found or 0

    def best(self, text: str, unknown: float, known=None, weigh=None, most=math.inf) -> list[tuple[int, int, int]]:
        """(start, end, piece) of the segmentation of best total weight; piece -1 is an unknown character.

        ``weigh(a, b)`` is the weight of piece b after piece a (-1: the start or an unknown
        character), its score unless given; ``known`` remembers weights.  No total exceeds
        ``most``, so the links are left once it is reached.  Of equal totals the
        earlier start stays.
        """
        if weigh is None:
            known, weigh = {}, lambda _, b: self.gain[b]
        step, fail, link, first, piece = self.step, self.fail, self.link, self.first, self.piece
        score, last, begin = [0.0], [-1], [0]
        state = 0
        for end, char in enumerate(text, 1):
            after = step[state].get(char)
            while after is None and state:
                state = fail[state]
                after = step[state].get(char)
            state = after or 0
            top, start, chosen, single = NEVER, end - 1, -1, False
            at = first[state]
            while at:
                size, number = piece[at]
                pair = last[end - size], number
                weight = known.get(pair)
                if weight is None:
                    weight = weigh(*pair)
                total = score[end - size] + weight
                if total > top:
                    top, start, chosen = total, end - size, number
                    if top >= most:
                        break
                single = size == 1
                at = link[at]
            if not single and top < most:
                total = score[end - 1] + unknown
                if total > top:
                    top, start, chosen = total, end - 1, -1
            score.append(top)
            last.append(chosen)
            begin.append(start)
        out, end = [], len(text)
        while end:
            start = begin[end]
            out.append((start, end, last[end]))
            end = start
        return out[::-1]


def merge(text: str, pieces: dict[str, tuple[int, float]]) -> list[str]:
    """The pieces that merging the best pair again and again leaves of a short text."""
    parts = list(text)
    while len(parts) > 1:
        pairs = [(pieces[a + b][1], -k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in pieces]
        if not pairs:
            break
        k = -max(pairs)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    return parts


def is_bpe(path: str) -> bool:
    """Whether the model's trainer settings name byte-pair merging (type 2 in field 3 of message 2)."""
    with open(path, "rb") as file:
        raw = file.read()

    def number(at):
        value = shift = 0
        while True:
            value |= (raw[at] & 127) << shift
            shift, at = shift + 7, at + 1
            if raw[at - 1] < 128:
                return value, at

    def fields(at, end):
        while at < end:
            tag, at = number(at)
            kind = tag & 7
            if kind == 0:
                value, at = number(at)
            else:
                size, at = number(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
                value, at = (at, at + size), at + size
            yield tag >> 3, value

    for field, span in fields(0, len(raw)):
        if field == 2:
            return any(inner == 3 and value == 2 for inner, value in fields(*span))
    return False


class PieceModel:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        usual = {}
        self.bytes_of: list[bytes] = []
        self.byte_ids = np.zeros(256, "<i4")
        for k in range(model.get_piece_size()):
            name = model.id_to_piece(k)
            if model.is_byte(k):
                value = int(name[3:5], 16)
                self.byte_ids[value] = k
                self.bytes_of.append(bytes([value]))
            elif model.is_unknown(k):
                self.bytes_of.append(" ⁇ ".encode())
            elif model.is_control(k):
                self.bytes_of.append(b"")
            else:
                self.bytes_of.append(name.replace(SPACE, " ").encode())
                if not model.is_unused(k):
                    usual[name] = (k, model.get_score(k))
        self.has_bytes = bool(self.byte_ids.any())
        self.unknown_id = model.unk_id()
        self.raw_ids = [k.to_bytes(4, "little") for k in range(model.get_piece_size())]
        self.unknown = min(s for _, s in usual.values()) - UNKNOWN_COST
        self.automaton = Automaton(usual)
        self.merging = is_bpe(path)
        self.usual = usual
        self.name_of = {k: name for name, (k, _) in usual.items()}
        self.pairs: dict[tuple[int, int], float] = {}
        by_word = all(SPACE not in p.lstrip(SPACE) for p in usual) and not any("\n" in p for p in usual)
        # no piece holds one of these marks right after a letter or digit, so words end before them
        within = {b for p in usual for a, b in zip(p, p[1:]) if _ALNUM.fullmatch(a)}
        marks = "".join(m for m in MARKS if m not in within)
        word = f"{SPACE}*{_ALNUM.pattern}++(?=[{re.escape(marks)}])|" if marks else ""
        self.units = re.compile(f"{word}{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n" if by_word else r"(?s).+")
        self.known: dict[str, bytes] = {}

    def _weigh(self, a: int, b: int) -> float:
        """What piece b after piece a adds: 0 if merging leaves the two apart, or else what rules b out."""
        if len(self.pairs) > KEPT:
            self.pairs.clear()
        if a < 0:
            two = True
        else:
            left, right = self.name_of[a], self.name_of[b]
            two = merge(left + right, self.usual) == [left, right]
        weight = self.pairs[a, b] = 0.0 if two else NEVER
        return weight

    def segments(self, text: str) -> list[tuple[int, int, int]]:
        if self.merging:
            return self.automaton.best(text, 0.0, self.pairs, self._weigh, 0.0)
        return self.automaton.best(text, self.unknown)

    def _raw(self, unknown: str) -> bytes:
        return self.byte_ids[list(unknown.encode())].tobytes() if self.has_bytes else self.raw_ids[self.unknown_id]

    def _unit(self, text: str) -> bytes:
        ids = self.known.get(text)
        if ids is None:
            raw = self.raw_ids
            parts = [raw[number] if number >= 0 else self._raw(text[start:end]) for start, end, number in self.segments(text)]
            ids = self.known[text] = b"".join(parts)
        return ids

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, "<i4")
        if len(self.known) > KEPT:
            self.known = dict(islice(self.known.items(), KEPT // 2))
        units = self.units.findall(SPACE + text.replace(" ", SPACE))
        ids = list(map(self.known.get, units))
        if None in ids:
            ids = [self._unit(u) if x is None else x for u, x in zip(units, ids)]
        return np.frombuffer(b"".join(ids), "<i4")

    def decode(self, ids) -> str:
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def model_at(path: str) -> PieceModel:
    return PieceModel(path)


def encode(docs: DataFrame, model: str, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, ids, n_ids and whether decoding them gives the text back, per row.

    A text with U+2581 in it decodes with spaces there, as the format has one sign for both.
    """

    def run(batches):
        pieces = model_at(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = [pieces.encode(t) for t in texts]
                same = [pieces.decode(x.tolist()) == t for x, t in zip(ids, texts)]
                sizes = np.array([len(x) for x in ids], np.int64)
                flat = np.concatenate([np.zeros(0, "<i4"), *ids])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lists, pa.array(sizes), pa.array(same, pa.bool_())], ["doc_id", "ids", "n_ids", "round_trip"]
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, n_ids long, round_trip boolean")


def decode(encoded: DataFrame, model: str, id_col="doc_id", ids_col="ids") -> DataFrame:
    """doc_id and text per row; null ids give an empty text."""

    def run(batches):
        pieces = model_at(model)
        for batch in batches:
            texts = [pieces.decode(x or ()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")
