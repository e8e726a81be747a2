"""Removal of byte strings that occur earlier, by blockwise suffix sorting.

A byte goes if a string of ``length`` bytes that covers it also starts earlier:
in a row of smaller id, or earlier in the same row.  Only equality of the first
``length`` bytes of two suffixes matters, so suffixes are sorted to that depth.

1. Rows are dealt into chunks of a few megabytes by a hash of id and text.
2. *Cover sample.*  Suffixes that start at the positions of a difference cover
   (8 of every 57) are named by their first 44 bytes.  For any two equal strings
   of 100 bytes there is an offset below 57 at which both have a sample suffix,
   and its 44 bytes lie inside both.  The names are sorted block by block, which
   ranks each: found once, or shared.
3. A suffix all of whose cover samples have a name found once is equal to no other and
   is settled.  The others, a small part unless much of the text is repeated,
   go to buckets by the least hash of the 16-byte strings they begin with, so
   equal ones meet and neighbours travel together as text.  Repeats inside a chunk
   are settled there first, so a passage reaches a bucket once per chunk at most.
4. Each bucket is sorted on its own, in memory bounded by the bucket; suffixes that
   agree in their hash are compared byte by byte.  All but the first of equal
   ones are reported to their chunk, which cuts its texts.

A null text is empty.  Null ids come
before all others, then by a hash of the text; rows with the same id are ordered by a
hash of the text, and of rows equal in both one keeps its bytes.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.memory import releasing
from revlens.llm.texthash import Stretches

#: Bytes of text in a chunk, and in the texts that fill a bucket, on average.
CHUNK = 2 << 20
BUCKET = 2 << 20
#: Names of cover samples in a block, on average.
BLOCK = 1 << 20
#: Suffixes of one record at most.
RECORD = 64

# Perfect difference sets, every residue is a difference of two members.
COVERS = {
    7: (1, 2, 4),
    13: (0, 1, 3, 9),
    21: (3, 6, 7, 12, 14),
    31: (1, 5, 11, 24, 25, 27),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
}


def cover_for(length: int) -> tuple[int, ...]:
    """The widest cover of which a sample keeps at least two fifths of the length."""
    period = max(v for v in COVERS if v <= max(7, 0.6 * length))
    return period, COVERS[period]


class Chunk:
    """The rows of a chunk in order; texts that occur again are held once."""

    def __init__(self, table, length: int):
        ids = table.column("doc_id").to_pylist()
        texts = [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in table.column("text")]
        ties = [int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "little") for t in texts]
        self.order = sorted(range(len(ids)), key=lambda k: (ids[k] is not None, ids[k] or 0, ties[k]))
        self.ids = [ids[k] for k in self.order]
        self.texts = [texts[k] for k in self.order]
        first: dict[bytes, int] = {}
        self.first = np.array([first.setdefault(t, k) for k, t in enumerate(self.texts)], np.int64)
        self.rows = np.flatnonzero(self.first == np.arange(len(ids)))
        sizes = np.array([len(self.texts[k]) for k in self.rows], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(sizes)])
        self.data = np.frombuffer(b"".join(self.texts[k] for k in self.rows), np.uint8)
        self.known = np.array([self.ids[k] is not None for k in self.rows], np.uint8)
        self.doc_id = np.array([self.ids[k] or 0 for k in self.rows], np.int64)
        self.tie = np.array([ties[self.order[k]] for k in self.rows], np.uint64)
        self.length = length

    def inside(self, size: int) -> np.ndarray:
        """Whether so many bytes from a position stay in its text."""
        ok = np.ones(len(self.data), bool)
        for k, (a, b) in enumerate(zip(self.begin[:-1], self.begin[1:])):
            ok[max(a, b - size + 1) : b] = False
        return ok

    def offsets(self) -> np.ndarray:
        sizes = np.diff(self.begin)
        return np.arange(len(self.data)) - np.repeat(self.begin[:-1], sizes)

    def sample(self, stretches: Stretches, blocks: int):
        """Positions of the cover sample, and their names: block in the high bits, rest in the low ones."""
        period, cover = cover_for(self.length)
        size = self.length - period + 1
        member = np.zeros(period, bool)
        member[list(cover)] = True
        at = np.flatnonzero(member[self.offsets() % period] & self.inside(size))
        h = stretches(at, at + size)
        block = (h >> np.uint64(32)) % np.uint64(blocks)
        return at, (block << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))


def _runs(row: np.ndarray, start: np.ndarray) -> np.ndarray:
    """(row, start, count) of runs of consecutive starts; input sorted."""
    if not len(row):
        return np.zeros((0, 3), np.int32)
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.flatnonzero(new)
    return np.stack([row[at], start[at], np.diff(np.append(at, len(row)))], axis=1).astype(np.int32)


def repeats(data: np.ndarray, at: np.ndarray, names: np.ndarray, length: int) -> np.ndarray:
    """Which of the strings at ``at`` equal one earlier in the list; ``names`` are their hashes.

    Equal hashes are confirmed on the bytes: the string next to a confirmed one
    only needs its last byte compared.  Should a hash ever lie, all are
    compared as strings.
    """
    n = len(at)
    if n < 2:
        return np.zeros(n, bool)
    # places take half the memory as 32-bit numbers
    by = np.argsort(names, kind="stable").astype(np.int32)
    ordered = names[by]
    new = np.ones(n, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    first = np.empty(n, np.int32)
    first[by] = by[new][np.cumsum(new, dtype=np.int32) - 1]
    del by, ordered, new
    again = np.flatnonzero(first != np.arange(n, dtype=np.int32)).astype(np.int32)
    a, b = at[again], at[first[again]]
    del first
    fresh = np.ones(len(a), bool)
    fresh[1:] = (a[1:] != a[:-1] + 1) | (b[1:] != b[:-1] + 1)
    same = (data[a + length - 1] == data[b + length - 1]).all()
    fa, fb = a[fresh], b[fresh]
    step = np.arange(length)
    for k in range(0, len(fa), 20_000):
        same = same and (data[fa[k : k + 20_000, None] + step] == data[fb[k : k + 20_000, None] + step]).all()
    out = np.zeros(n, bool)
    if same:
        out[again] = True
        return out
    seen: set[bytes] = set()
    for k, p in enumerate(at.tolist()):
        string = data[p : p + length].tobytes()
        out[k] = string in seen
        seen.add(string)
    return out


def _sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    """The least of so many values from each place that has them."""
    span = 1
    while span * 2 <= width:
        h = np.minimum(h[: len(h) - span], h[span:]) if len(h) > span else h[:0]
        span *= 2
    rest = width - span
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest and len(h) > rest else h if not rest else h[:0]


_SUFFIXES = "bucket long, chunk long, known binary, doc_id binary, tie binary, row binary, off binary, n binary, text binary, settled binary"


def _suffixes(chunk: Chunk, stretches: Stretches, shared: np.ndarray, at: np.ndarray, buckets: int, number: int):
    """Rows for the buckets: suffixes not settled by their cover samples, and repeats found inside the chunk."""
    length = chunk.length
    period, _ = cover_for(length)
    n = len(chunk.data)
    count = np.zeros(n + period + 1, np.int32)
    count[at[shared] + 1] = 1
    count = np.cumsum(count, dtype=np.int32)
    open_ = np.flatnonzero(chunk.inside(length) & (count[period : period + n] > count[:n])).astype(np.int32)
    del count
    again = repeats(chunk.data, open_, stretches(open_, open_ + length), length)
    text = (np.searchsorted(chunk.begin, open_, side="right") - 1).astype(np.int32)
    offset = open_ - chunk.begin[text].astype(np.int32)
    settled = _runs(chunk.rows[text[again]], offset[again])
    out = [{"bucket": number % buckets, "settled": settled.tobytes()}] if len(settled) else []
    open_, text, offset = open_[~again], text[~again], offset[~again]
    if len(open_):
        piece = min(16, length // 2)
        key = _sliding_least(stretches.windows(piece), length - piece + 1)[open_]
        bucket = (key % np.uint64(buckets)).astype(np.int64)
        new = np.ones(len(open_), bool)
        new[1:] = (text[1:] != text[:-1]) | (open_[1:] != open_[:-1] + 1) | (key[1:] != key[:-1])
        # cut long runs
        begin = np.flatnonzero(new)
        since = np.arange(len(open_)) - np.repeat(begin, np.diff(np.append(begin, len(open_))))
        begin = np.flatnonzero(since % RECORD == 0)
        size = np.diff(np.append(begin, len(open_)))
        by = np.argsort(bucket[begin], kind="stable")
        begin, size = begin[by], size[by]
        of = bucket[begin]
        cut = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        whole = chunk.data.tobytes()
        for a, b in zip(cut, [*cut[1:], len(of)]):
            own, many = begin[a:b], size[a:b]
            t = text[own]
            out.append(
                {
                    "bucket": int(of[a]),
                    "known": chunk.known[t].tobytes(),
                    "doc_id": chunk.doc_id[t].tobytes(),
                    "tie": chunk.tie[t].tobytes(),
                    "row": chunk.rows[t].astype(np.int32).tobytes(),
                    "off": offset[own].astype(np.int32).tobytes(),
                    "n": many.astype(np.uint8).tobytes(),
                    "text": b"".join(whole[p : p + m + length - 1] for p, m in zip(open_[own].tolist(), many.tolist())),
                }
            )
    return out


def _table(rows: list[dict], schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "int": pa.int32(), "string": pa.string()}
    columns = [c.strip().split(" ") for c in schema.split(",")]
    return pa.table({name: pa.array([r.get(name) for r in rows], kinds[kind]) for name, kind in columns})


def _sort_bucket(table, length: int) -> list[dict]:
    """The repeated suffixes of a bucket, for each chunk."""
    replies = [
        {"chunk": c, "reply": s}
        for c, s in zip(table.column("chunk").to_pylist(), table.column("settled").to_pylist())
        if s is not None
    ]
    table = table.filter(pa.compute.is_valid(table.column("text")))
    if not table.num_rows:
        return replies

    def joined(name, kind):
        return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)

    known, doc_id, tie = joined("known", np.uint8), joined("doc_id", np.int64), joined("tie", np.uint64)
    row, off, n = joined("row", np.int32), joined("off", np.int32), joined("n", np.uint8).astype(np.int64)
    each = [len(x) for x in table.column("n").to_pylist()]
    chunk = np.repeat(table.column("chunk").to_numpy(), each)
    data = joined("text", np.uint8)
    start = np.concatenate([[0], np.cumsum(n + length - 1)])[:-1]
    order = np.lexsort((off, tie, doc_id, known))
    record = np.repeat(order, n[order])
    within = np.arange(len(record)) - np.repeat(np.cumsum(n[order]) - n[order], n[order])
    at = (start[record] + within).astype(np.int32)
    again = repeats(data, at, Stretches(data)(at, at + length), length)
    record, within = record[again], within[again]
    by = np.lexsort((off[record] + within, row[record], chunk[record]))
    record, within = record[by], within[by]
    of = chunk[record]
    cut = np.flatnonzero(np.r_[True, of[1:] != of[:-1]][: len(of)])
    for a, b in zip(cut, [*cut[1:], len(of)]):
        own = record[a:b]
        replies.append({"chunk": int(of[a]), "reply": _runs(row[own], off[own] + within[a:b]).tobytes()})
    return replies


def _removed(chunk: Chunk, replies: list[bytes]) -> list[list[tuple[int, int]]]:
    """Maximal removed runs of each row."""
    length = chunk.length
    runs = np.frombuffer(b"".join(replies), np.int32).reshape(-1, 3).astype(np.int64)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    spans: list[list[tuple[int, int]]] = [[] for _ in chunk.texts]
    for row, start, count in runs.tolist():
        own, end = spans[row], start + count + length - 1
        if own and start <= own[-1][1]:
            own[-1] = (own[-1][0], max(end, own[-1][1]))
        else:
            own.append((start, end))
    for k in np.flatnonzero(chunk.first != np.arange(len(chunk.first))):
        if len(chunk.texts[k]) >= length:
            spans[k] = [(0, len(chunk.texts[k]))]
    return spans


def deal(chunks: int):
    """Chunk of a row: rows that share an id are spread by their texts, equal rows meet."""
    return F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks))


def dedup(docs: DataFrame, length=100, id_col="doc_id", text_col="text", carry=()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text, spans, and columns to carry along as carry0, carry1, ..

    ``kept_text`` leaves out what is left of characters cut in half; the digest is that of all bytes kept.
    """
    carried = [c.alias(f"carry{k}") for k, c in enumerate(carry)]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *carried)
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, math.ceil(n_bytes / CHUNK))
    buckets = max(1, math.ceil(n_bytes / BUCKET))
    period, cover = cover_for(length)
    blocks = max(1, math.ceil(n_bytes * len(cover) / period / BLOCK))
    rows = rows.withColumn("chunk", deal(chunks))

    sample_schema = "block long, chunk long, names binary"

    def sample(key, table):
        chunk = Chunk(table, length)
        _, names = chunk.sample(Stretches(chunk.data), blocks)
        names = np.unique(names)
        block = (names >> np.uint64(32)).astype(np.int64)
        cut = np.flatnonzero(np.r_[True, block[1:] != block[:-1]][: len(block)])
        low = names.astype(np.uint32)
        return _table(
            [
                {"block": int(block[a]), "chunk": key[0].as_py(), "names": low[a:b].tobytes()}
                for a, b in zip(cut, [*cut[1:], len(block)])
            ],
            sample_schema,
        )

    rank_schema = "of long, block long, shared binary"

    def rank(key, table):
        parts = [np.frombuffer(x, np.uint32) for x in table.column("names").to_pylist()]
        names = np.sort(np.concatenate(parts))
        twice = np.unique(names[1:][names[1:] == names[:-1]])
        out = []
        for chunk, part in zip(table.column("chunk").to_pylist(), parts):
            # the names of a part are few, those found twice in the whole block are not
            place = np.minimum(np.searchsorted(twice, part), max(len(twice) - 1, 0))
            shared = twice[place] == part if len(twice) else np.zeros(len(part), bool)
            if shared.any():
                out.append({"of": chunk, "block": key[0].as_py(), "shared": np.packbits(shared).tobytes()})
        return _table(out, rank_schema)

    def suffixes(key, table, ranks):
        if not table.num_rows:
            return _table([], _SUFFIXES)
        chunk = Chunk(table, length)
        stretches = Stretches(chunk.data)
        at, names = chunk.sample(stretches, blocks)
        names, place, count = np.unique(names, return_inverse=True, return_counts=True)
        shared = count > 1
        block = (names >> np.uint64(32)).astype(np.int64)
        for b, bits in zip(ranks.column("block").to_pylist(), ranks.column("shared").to_pylist()):
            first, last = np.searchsorted(block, (b, b + 1))
            shared[first:last] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=last - first).astype(bool)
        number = key[0].as_py()
        found = _suffixes(chunk, stretches, shared[place], at, buckets, number)
        return _table([r | {"chunk": number} for r in found], _SUFFIXES)

    reply_schema = "chunk long, reply binary"
    sampled = rows.groupBy("chunk").applyInArrow(releasing(sample), sample_schema)
    ranks = sampled.groupBy("block").applyInArrow(releasing(rank), rank_schema)
    open_ = rows.groupBy("chunk").cogroup(ranks.groupBy("of")).applyInArrow(releasing(suffixes), _SUFFIXES)

    def answer(key, table):
        return _table(_sort_bucket(table, length), reply_schema)

    replies = open_.groupBy("bucket").applyInArrow(releasing(answer), reply_schema)
    replies = replies.select(F.col("chunk").alias("for"), "reply")

    extra = [f"carry{k}" for k in range(len(carry))]
    kinds = [rows.schema[c] for c in extra]
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string, spans array<struct<start:int,end:int>>"
    schema += "".join(f", {f.name} {f.dataType.simpleString()}" for f in kinds)

    def cut(key, table, replies):
        chunk = Chunk(table, length)
        spans = _removed(chunk, replies.column("reply").to_pylist())
        kept = []
        for text, own in zip(chunk.texts, spans):
            edges = [0, *(x for s in own for x in s), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
        out = pa.table(
            {
                "doc_id": pa.array(chunk.ids, pa.int64()),
                "n_bytes": pa.array([len(t) for t in chunk.texts], pa.int64()),
                "n_removed": pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()),
                "n_spans": pa.array([len(s) for s in spans], pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in kept], pa.string()),
                "kept_text": pa.array([t.decode("utf-8", "ignore") for t in kept], pa.string()),
                "spans": pa.array(
                    [[{"start": a, "end": b} for a, b in s] for s in spans],
                    pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
                ),
            }
        )
        order = pa.array(chunk.order, pa.int64())
        for c in extra:
            out = out.append_column(c, table.column(c).take(order))
        return out

    return rows.groupBy("chunk").cogroup(replies.groupBy("for")).applyInArrow(releasing(cut), schema)


def remove(docs: DataFrame, length=100, id_col="doc_id", text_col="text") -> DataFrame:
    """All rows and columns, the text without its repeated strings; characters cut in half go.  A null text stays null."""
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    cut = dedup(docs, length, id_col, text_col, [F.col(text_col).isNull(), *map(F.col, rest)])
    named = {id_col: "doc_id", text_col: "kept_text"} | {c: f"carry{k + 1}" for k, c in enumerate(rest)}
    return cut.withColumn("kept_text", F.when(~F.col("carry0"), F.col("kept_text"))).select(
        *[F.col(named[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns]
    )
