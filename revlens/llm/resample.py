"""Importance resampling of texts towards a target, without replacement.

1. A feature is a run of one to three consecutive words; its bucket is a hash of it.
   Buckets are counted over all texts of the corpus and of the target, per partition
   in an array and then over all.
2. A bucket's gain is the floor of 1000 times the log ratio of its smoothed shares.  The
   array of gains, one number per bucket, goes to the tasks, which score each text as
   the sum of the gains of its features.
3. Score plus Gumbel noise from a hash of the id: the highest scores are a sample
   without replacement with weights proportional to the ratios.
4. The k-th highest is found by distributed quickselect: random rows of the current
   interval become pivots, all rows of it are counted as below, equal to or above
   each, and the interval narrows to the two pivots that enclose the k-th row.
   Keys are composite (score, id, the other results, row number), hence distinct.
5. Only the rows up to that key are sorted, by ranges, and ranked: a row's rank is its
   place in its range plus the rows of the ranges before.

Words are runs of characters other than ASCII ones that are neither digits nor letters;
A to Z are lower-cased, no others.

Results: one row per text, repeated rows included.  A null or wordless text has no
features and weight 0.  A null id is hashed as an empty one and comes last among equal
scores; rows that are equal in score and id are drawn by their features and weight,
those equal in these too by their place in the input, which no result shows.  Texts
of fewer words than asked for are scored, but not drawn.  Empty tables give no rows; an
empty target gives gains from smoothing alone.  Texts of any length are taken whole, a
bounded stretch at a time.  Other columns are left out.
"""

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.ranks import ranked
from revlens.session import materialize

BUCKETS = 10_000
LONGEST_RUN = 3
FEWEST_WORDS = 20
PERCENT = 5
#: Pivots of a round of quickselect.
PIVOTS = 15
#: Bytes of text that are worked on at once.
STRETCH = 1 << 20

_TO_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256)
)
#: Zero bytes that one table look-up appends.
_NEAR = 64


def _crc_tables() -> np.ndarray:
    """What appending zero bytes does to a crc32, per count of bytes, byte of the crc and its value.

    The crc of a joined text is that of its first part, carried over the bytes of the
    second, xor that of the second.
    """
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(0xEDB88320), one >> 1)
    tables = np.empty((_NEAR + 1, 4, 256), np.uint32)
    tables[0] = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]
    for n in range(1, _NEAR + 1):
        tables[n] = (tables[n - 1] >> 8) ^ one[tables[n - 1] & 255]
    return tables


_TABLES = _crc_tables().reshape(-1)


def carried(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """crc32 values carried over ``n`` bytes each."""
    near = np.minimum(n, _NEAR)
    at = near.astype(np.int32) << 10
    out = (
        _TABLES[at + (crc & 255)]
        ^ _TABLES[at + 256 + (crc >> 8 & 255)]
        ^ _TABLES[at + 512 + (crc >> 16 & 255)]
        ^ _TABLES[at + 768 + (crc >> 24)]
    )
    far = np.flatnonzero(n > _NEAR)  # long words are few
    if len(far):
        out[far] = _carried_far(out[far], (n - near)[far])
    return out


def _carried_far(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """As ``carried``, by doubling: the effect of 2**k zero bytes as a matrix of 32 columns."""
    bits = np.arange(32, dtype=np.uint32)
    columns = carried(np.uint32(1) << bits, np.ones(32, np.int64))
    out = crc.copy()
    while n.any():
        odd = np.flatnonzero(n & 1)
        out[odd] = np.bitwise_xor.reduce(np.where(out[odd, None] >> bits & 1, columns, np.uint32(0)), axis=1)
        columns = np.bitwise_xor.reduce(np.where(columns[:, None] >> bits & 1, columns, np.uint32(0)), axis=1)
        n = n >> 1
    return out


def features(texts: list[bytes], carry=None, longest=LONGEST_RUN, buckets=BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features, the text that each belongs to, and the words of every text.

    ``carry`` says how many words at the start of a text were counted before; runs of only such
    words are left out.
    """
    split = [text.translate(_TO_WORDS).split() for text in texts]
    n_words = np.fromiter(map(len, split), np.int64, len(split))
    words = [word for own in split for word in own]
    crc = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    size = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(texts)), n_words)
    carry = np.zeros(len(texts), np.int64) if carry is None else np.asarray(carry, np.int64)
    is_new = np.arange(len(words)) - np.repeat(np.cumsum(n_words) - n_words, n_words) >= carry[owner]
    # a word with the space before it
    spaced = carried(np.full(len(words), zlib.crc32(b" "), np.uint32), size) ^ crc
    run, found, owners = crc, [], []
    for n in range(longest):
        if n:
            run = carried(run[:-1], size[n:] + 1) ^ spaced[n:]
        within = (owner[n:] == owner[: len(owner) - n]) & is_new[n:]
        found.append(run[within])
        owners.append(owner[n:][within])
    return np.concatenate(found) % np.uint32(buckets), np.concatenate(owners), n_words - carry


def _stretches(texts, longest=LONGEST_RUN):
    """Row numbers, texts and words counted before, of a bounded number of bytes at a time.

    A longer text is cut between words; each part begins with the last words of the one before.
    """
    part, size = [], 0
    for row, text in enumerate(texts):
        text = text.as_py() or b""
        if len(text) > STRETCH:
            text, at, before = text.translate(_TO_WORDS), 0, []
            while at < len(text):
                end = text.find(b" ", at + STRETCH)
                end = len(text) if end < 0 else end
                piece = b" ".join([*before, text[at:end]])
                yield [row], [piece], [len(before)]
                before = piece.rsplit(None, longest - 1)[1 - longest :] if longest > 1 else []
                at = end
            continue
        part.append((row, text, 0))
        size += len(text)
        if size >= STRETCH:
            yield tuple(zip(*part))
            part, size = [], 0
    if part:
        yield tuple(zip(*part))


def counts(texts: DataFrame, text_col="text", longest=LONGEST_RUN, buckets=BUCKETS) -> np.ndarray:
    """Features by bucket over all texts.  A number per bucket and partition is shuffled."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, part, carry in _stretches(batch.column(0), longest):
                total += np.bincount(features(part, carry, longest, buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["bucket", "n"])

    counted = (
        texts.select(F.col(text_col).cast("string").cast("binary").alias("text"))
        .mapInArrow(count, "bucket int, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
    )
    out = np.zeros(buckets, np.int64)
    for row in counted.collect():
        out[row.bucket] = row.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 ln of (t + 1) (S + buckets) / ((s + 1) (T + buckets)))."""
    n = len(corpus)
    every_s, every_t = float(corpus.sum() + n), float(target.sum() + n)
    ratio = [(t + 1.0) * every_s / ((s + 1.0) * every_t) for s, t in zip(corpus.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def noise(doc_id: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)) of a u in (0, 1) from a hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def scored(docs: DataFrame, gain: np.ndarray, id_col="doc_id", text_col="text", seed=42, longest=LONGEST_RUN) -> DataFrame:
    """Row number, id, words, features, weight and score of every text.  Numbers hold once the result is written."""

    def weigh(batches):
        for batch in batches:
            n = batch.num_rows
            words, n_features, weight = (np.zeros(n, np.int64) for _ in range(3))
            for row, part, carry in _stretches(batch.column("text"), longest):
                bucket, owner, n_words = features(part, carry, longest, len(gain))
                row = np.asarray(row)
                words[row] += n_words
                n_features[row] += np.bincount(owner, minlength=len(part))
                # sums of integers far below 2**53 are exact
                weight[row] += np.bincount(owner, gain[bucket], len(part)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("row", "doc_id", "noise")] + [pa.array(x) for x in (words, n_features, weight)],
                ["row", "doc_id", "noise", "n_words", "n_features", "weight"],
            )

    doc_id = F.col(id_col).cast("long")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        doc_id.alias("doc_id"),
        noise(doc_id, seed).alias("noise"),
        F.col(text_col).cast("string").cast("binary").alias("text"),
    ).mapInArrow(weigh, "row long, doc_id long, noise long, n_words long, n_features long, weight long")
    return rows.select("row", "doc_id", "n_words", "n_features", "weight", (F.col("weight") + F.col("noise")).alias("score"))


#: Names and types of a composite key, the first row of an order having the least.
_KEY = "worse long, no_id boolean, doc_id long, n_features long, weight long, row long"


def key() -> Column:
    """Highest score first, then smallest id; no two rows have the same."""
    return F.struct(
        (-F.col("score")).alias("worse"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "n_features", "weight", "row"
    )


def _literal(value) -> Column:
    types = [part.split()[1] for part in _KEY.split(", ")]
    return F.struct(*[F.lit(v).cast(t).alias(n.split()[0]) for v, t, n in zip(value, types, _KEY.split(", "))])


def kth_key(keyed: DataFrame, k: int, pivots=PIVOTS, seed=42):
    """The k-th least ``key`` (from 1) of a written table whose keys are distinct, by quickselect.

    Random rows of the interval are its pivots; one pass counts the rows below and equal to
    each.  An interval of n rows shrinks to some n / pivots a round.
    """
    low = high = None
    turn = 0
    while True:
        within = keyed
        if low is not None:
            within = within.filter((F.col("key") > _literal(low)) & (F.col("key.worse") >= low[0]))
        if high is not None:
            within = within.filter((F.col("key") < _literal(high)) & (F.col("key.worse") <= high[0]))
        chosen = within.orderBy(F.xxhash64("key", F.lit(seed + turn)), "key").limit(pivots).select("key").collect()
        at = sorted((tuple(row.key) for row in chosen), key=lambda p: tuple((v is not None, v) for v in p))
        if not at:
            raise ValueError(f"there is no row of rank {k}")
        tests = [F.count_if(test(F.col("key"), _literal(p))) for p in at for test in (lambda a, b: a < b, lambda a, b: a == b)]
        counted = within.agg(*[test.alias(f"c{n}") for n, test in enumerate(tests)]).first()
        below, equal = counted[::2], counted[1::2]
        for pivot, less, same in zip(at, below, equal):
            if less < k <= less + same:
                return pivot
        after = [pivot for pivot, less in zip(at, below) if less >= k]
        before = [(pivot, less + same) for pivot, less, same in zip(at, below, equal) if less + same < k]
        if after:
            high = after[0]
        if before:
            low = before[-1][0]
            k -= before[-1][1]
        turn += 1


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent=PERCENT,
    fewest_words=FEWEST_WORDS,
    id_col="doc_id",
    text_col="text",
    seed=42,
    buckets=BUCKETS,
    longest=LONGEST_RUN,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of every text.

    ``target`` has a column ``text_col`` too.  ``percent`` of the texts with enough words are drawn.
    """
    gain = gains(counts(docs, text_col, longest, buckets), counts(target, text_col, longest, buckets))
    table = materialize(scored(docs, gain, id_col, text_col, seed, longest), "scored")
    eligible = F.col("n_words") >= fewest_words
    drawn = percent * table.filter(eligible).count() // 100
    result = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if not drawn:
        return table.select(*result, none)
    keyed = table.filter(eligible).select(key().alias("key"), *result)
    last = _literal(kth_key(keyed, drawn, seed=seed))
    winners = ranked(keyed.filter(F.col("key") <= last), drawn)
    others = table.filter(~eligible | (key() > last))
    return winners.select(*result, "rank").unionAll(others.select(*result, none))
