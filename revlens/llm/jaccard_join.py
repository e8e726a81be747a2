"""Similarity join of texts on their sets of word shingles, with Bayesian pruning.

1. Every text becomes the set of its runs of five words, a digest of that set and
   100 MinHash values of 16 bits.  Texts of equal sets form a class of copies,
   known by its digest; one of its texts stands for it from then on, known by two
   hashes of the text, as ids may be null or repeated.
2. Four values make a key; classes that share one of the 25 keys are compared.
   A pair as similar as 0.8 shares none with a probability of 2e-6.  Keys of many
   classes are cut into tiles of bounded size, so no task holds all of a key and
   no row is written per pair.
3. In a tile, MinHash values are compared 20 at a time.  A pair is dropped once
   the posterior probability (uniform prior) that its similarity reaches the
   threshold is below ``TOLERANCE``.  A pair is compared under its first shared key.
4. The remaining pairs are verified exactly on the shingle sets, which are made
   anew from the texts of the classes concerned, a bounded block at a time.  Texts
   are not kept meanwhile: the input is read again, and a table of bounded size says
   which rows can be wanted before any text is shuffled.  Each block gives the links of every class and a spanning forest of its links.
5. Forests are merged by alternating star contraction over written tables.

Results: per row the id, ``class_id`` (smallest id of the texts connected by
links; null if none has an id) and ``n_links``, the number of other rows whose
set is at least as similar as the threshold, copies included.  A null text and
one without words have no set and no links; a text of fewer than five words has
one shingle of all its words.  Repeated rows are copies.  Shingles are compared
by 64-bit hashes.  Words are separated by ASCII white space and compared as is.
"""

import hashlib
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.memory import release, releasing
from revlens.llm.texthash import shingles
from revlens.session import discard, materialize, scratch_dir

WORDS = 5
THRESHOLD = 0.8
TOLERANCE = 1e-7
BANDS, ROWS = 25, 4
STEP = 20
#: Classes of a key that one side of a tile holds.
TILE = 512
#: Rows of tiles that one task compares, on average.
GROUP = 20_000
#: Parts into which keys of texts fall, to tell the texts that are wanted.
PARTS = 1 << 20
#: Shingles that one side of a block holds when pairs are verified.
BLOCK = 400_000

_RNG = np.random.default_rng(9)
_A = (_RNG.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint64) * 2 + 1).astype(np.uint32)
_B = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)


def minhash(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """16 bits of the least permuted hash, per text and permutation; each text has a hash at least."""
    low = hashes.astype(np.uint32)
    high = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(offsets) - 1, BANDS * ROWS), np.uint16)
    for k in range(BANDS * ROWS):
        permuted = (low * _A[k]) ^ (high * _A[k - 1] + _B[k])
        out[:, k] = np.minimum.reduceat(permuted, offsets[:-1]).astype(np.uint16) if len(low) else 0
    return out


@lru_cache(maxsize=8)
def fewest_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """By number of values compared, the matches below which a pair is dropped.

    With a uniform prior, the posterior after m matches of n is a Beta
    distribution; its mass above the threshold is a binomial sum.
    """
    least = {}
    for n in range(STEP, BANDS * ROWS + 1, STEP):
        mass, m = 0.0, 0
        while m <= n:
            mass += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if mass >= tolerance:
                break
            m += 1
        least[n] = m
    return least


def text_key(text) -> list:
    """Two hashes that a text is known by."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(9), text).alias("k2")]


def signed(docs: DataFrame, id_col="doc_id", text_col="text", carry=()) -> DataFrame:
    """Per row: id, key of the text, digest of its shingle set (null if empty), its size, MinHash values and ``carry``."""

    def sign(batches):
        for batch in batches:
            texts = batch.column(0)
            at = 0
            while at < len(texts):
                part, size = [], 0
                while at + len(part) < len(texts) and size < 1 << 20:
                    part.append((texts[at + len(part)].as_py() or "").encode("utf-8", "surrogatepass"))
                    size += len(part[-1])
                hashes, offsets = shingles(part, WORDS)
                n = np.diff(offsets)
                some = np.flatnonzero(n)
                values = minhash(hashes, np.append(offsets[some], offsets[-1]))
                digest, sig = [None] * len(part), [None] * len(part)
                for j, i in enumerate(some.tolist()):
                    digest[i] = hashlib.blake2b(hashes[offsets[i] : offsets[i + 1]].tobytes(), digest_size=16).digest()
                    sig[i] = values[j].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digest, pa.binary()), pa.array(n, pa.int64()), pa.array(sig, pa.binary())]
                    + [batch.column(k).slice(at, len(part)) for k in range(1, batch.num_columns)],
                    ["digest", "n_shingles", "sig", *batch.schema.names[1:]],
                )
                at += len(part)
        release()

    text = F.col(text_col).cast("string")
    rows = docs.select(text.alias("text"), F.col(id_col).cast("long").alias("doc_id"), *text_key(text), *carry)
    rest = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(sign, f"digest binary, n_shingles long, sig binary, {rest}")


def candidate_pairs(sig: np.ndarray, tiles: list[tuple[np.ndarray, np.ndarray, int]], least: dict[int, int]):
    """Pairs (i, j) of rows that survive, from tiles of (left rows, right rows, band).

    ``left is right`` means all pairs within.  A pair is left to the first band
    whose key it shares.
    """
    keys = sig.view(np.uint64)
    found = []

    def survive(i, j, band):
        keep = keys[i, band] == keys[j, band]
        i, j, band = i[keep], j[keep], band[keep]
        for b in range(BANDS - 1):
            if not len(i):
                return
            keep = (band <= b) | (keys[i, b] != keys[j, b])
            i, j, band = i[keep], j[keep], band[keep]
        matches = np.zeros(len(i), np.int64)
        for n in range(STEP, BANDS * ROWS + 1, STEP):
            matches += (sig[i, n - STEP : n] == sig[j, n - STEP : n]).sum(axis=1)
            keep = matches >= least[n]
            i, j, matches = i[keep], j[keep], matches[keep]
        found.append(np.stack([np.minimum(i, j), np.maximum(i, j)], axis=1))

    waiting, size = [], 0
    for left, right, band in tiles:
        if left is right:
            a, b = np.triu_indices(len(left), 1)
            i, j = left[a], left[b]
        else:
            i, j = np.repeat(left, len(right)), np.tile(right, len(left))
        waiting.append((i, j, np.full(len(i), band)))
        size += len(i)
        if size > 200_000:
            survive(*map(np.concatenate, zip(*waiting)))
            waiting, size = [], 0
    if waiting:
        survive(*map(np.concatenate, zip(*waiting)))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


_UNIT = "unit string, pairs binary, digest binary, k1 long, k2 long, at int, n_copies long"


def _compared(rows: DataFrame, threshold: float, tolerance: float, groups: int) -> DataFrame:
    """Units of work for verification: one row with the pairs, one per class that takes part."""
    least = fewest_matches(threshold, tolerance)
    dealt = rows.withColumn("deal", F.pmod(F.xxhash64("band", "key", "s", "t"), F.lit(groups)))

    def compare(key, table):
        deal = key[0].as_py()
        digest = table.column("digest").to_numpy(zero_copy_only=False)
        names, first, row = np.unique(digest.astype("S16"), return_index=True, return_inverse=True)
        sig = np.frombuffer(b"".join(table.column("sig").take(pa.array(first)).to_pylist()), np.uint16).reshape(len(first), -1)
        band, bucket = table.column("band").to_numpy(), table.column("key").to_numpy()
        s, t, slice_ = (table.column(c).to_numpy() for c in ("s", "t", "slice"))
        by = np.lexsort((slice_, t, s, bucket, band))
        new = np.ones(len(by), bool)
        new[1:] = np.any([x[by][1:] != x[by][:-1] for x in (band, bucket, s, t)], axis=0)
        cut = np.flatnonzero(new)
        tiles = []
        for a, b in zip(cut, [*cut[1:], len(by)]):
            part = by[a:b]
            if s[part[0]] == t[part[0]]:
                left = np.unique(row[part])
                tiles.append((left, left, int(band[part[0]])))
            else:
                is_left = slice_[part] == s[part[0]]
                tiles.append((np.unique(row[part[is_left]]), np.unique(row[part[~is_left]]), int(band[part[0]])))
        pairs = candidate_pairs(sig, tiles, least)
        out = {name: [] for name in ("unit", "pairs", "digest", "k1", "k2", "at", "n_copies")}
        if len(pairs):
            shingle_count = table.column("n_shingles").take(pa.array(first)).to_numpy()
            # classes that meet in a tile lie close together: order them by their first tile
            place = np.full(len(first), len(by))
            np.minimum.at(place, row[by], np.arange(len(by)))
            order = np.argsort(place, kind="stable")
            block = np.empty(len(first), np.int64)
            block[order] = np.cumsum(np.maximum(shingle_count, BLOCK // TILE)[order]) // BLOCK
            unit = np.sort(block[pairs], axis=1)
            code = unit[:, 0] << 32 | unit[:, 1]
            k1, k2 = (table.column(c).take(pa.array(first)).to_pylist() for c in ("k1", "k2"))
            copies = table.column("n_copies").take(pa.array(first)).to_pylist()
            full = table.column("digest").take(pa.array(first)).to_pylist()
            for c in np.unique(code):
                own = pairs[code == c]
                members = np.unique(own)
                name = f"{deal}-{c}"
                local = np.searchsorted(members, own).astype(np.int32)
                rows_out = [(name, local.tobytes(), None, None, None, None, None)]
                rows_out += [(name, None, full[m], k1[m], k2[m], k, copies[m]) for k, m in enumerate(members.tolist())]
                for column, values in zip(out.values(), zip(*rows_out)):
                    column += values
        types = (pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
        return pa.table({n: pa.array(v, t) for (n, v), t in zip(out.items(), types)})

    return dealt.groupBy("deal").applyInArrow(releasing(compare), _UNIT)


def overlaps(sets: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Sizes of the intersections, by products of 0/1 columns for sets that share many pairs."""
    out = np.zeros(len(pairs), np.int64)
    members = np.unique(pairs)
    local = np.searchsorted(members, pairs)
    if len(pairs) < 4 * len(members):
        for n, (i, j) in enumerate(pairs):
            out[n] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return out
    values, column = np.unique(np.concatenate([sets[m] for m in members]), return_inverse=True)
    row = np.repeat(np.arange(len(members)), [len(sets[m]) for m in members])
    shared = np.bincount(column) > 1
    number = np.cumsum(shared) - 1
    row, column = row[shared[column]], number[column[shared[column]]]
    by = np.argsort(column, kind="stable")
    row, column = row[by], column[by]
    total = np.zeros((len(members), len(members)), np.float32)
    for at in range(0, int(shared.sum()), 4096):
        a, b = np.searchsorted(column, (at, at + 4096))
        dense = np.zeros((len(members), 4096), np.float32)
        dense[row[a:b], column[a:b] - at] = 1
        total += dense @ dense.T
    return total[local[:, 0], local[:, 1]].astype(np.int64)


def verify(sets: list[np.ndarray], pairs: np.ndarray, threshold: float) -> np.ndarray:
    """The pairs whose similarity reaches the threshold, worked out connected part by part."""
    root = forest(len(sets), pairs)
    good = []
    part = root[pairs[:, 0]]
    by = np.argsort(part, kind="stable")
    cut = np.flatnonzero(np.r_[True, part[by][1:] != part[by][:-1]][: len(by)])
    for a, b in zip(cut, [*cut[1:], len(by)]):
        own = pairs[by[a:b]]
        common = overlaps(sets, own)
        size = np.array([len(sets[i]) + len(sets[j]) for i, j in own])
        good.append(own[common >= threshold * (size - common) * (1 - 1e-12)])
    return np.concatenate(good) if good else pairs[:0]


def forest(n: int, pairs: np.ndarray) -> np.ndarray:
    """The least member of each one's connected part."""
    root = np.arange(n)
    while len(pairs):
        a, b = root[pairs[:, 0]], root[pairs[:, 1]]
        if (a == b).all():
            break
        low = np.minimum(a, b)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        while (root != root[root]).any():
            root = root[root]
    return root


def with_text(members: DataFrame, docs: DataFrame, text_col="text") -> DataFrame:
    """The members of units, each with a text of its class.

    Rows of the input that can be wanted are told by a part of their key, of which there
    are ``PARTS`` at most, so that table is broadcast at any size; only their texts are shuffled.
    """
    wanted = members.select("k1").distinct()
    parts = wanted.select(F.pmod("k1", F.lit(PARTS)).alias("part")).distinct()
    text = F.col(text_col).cast("string").alias("text")
    keyed = docs.select(text, *text_key(text)).withColumn("part", F.pmod("k1", F.lit(PARTS)))
    texts = keyed.join(F.broadcast(parts), "part", "left_semi").groupBy("k1", "k2").agg(F.min("text").alias("text"))
    # sorted and merged at every size
    return members.join(texts.hint("merge"), ["k1", "k2"]).select("unit", "digest", "at", "n_copies", "text")


def links(signatures: DataFrame, docs: DataFrame, folder: str, threshold=THRESHOLD, tolerance=TOLERANCE, text_col="text"):
    """Classes of copies, and per class its links to others and an edge towards a linked class, written into a folder.

    ``signatures`` must be a written table, as made by ``signed`` of ``docs``.
    """
    classes = materialize(
        signatures.filter("digest is not null")
        .groupBy("digest")
        .agg(
            F.min(F.struct("k1", "k2")).alias("of_text"),
            F.min("doc_id").alias("doc_id"),
            F.count(F.lit(1)).alias("n_copies"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("sig").alias("sig"),
        )
        .select("digest", "of_text.*", "doc_id", "n_copies", "n_shingles", "sig"),
        "classes",
        below=folder,
    )
    # keys that two classes or more share, cut into slices
    bands = classes.select(
        "digest",
        F.posexplode(
            F.array(*[F.xxhash64(F.substring("sig", 2 * ROWS * b + 1, 2 * ROWS)) for b in range(BANDS)])
        ).alias("band", "key"),
    )
    sizes = bands.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    tiled = (
        bands.join(sizes, ["band", "key"])
        .withColumn("slices", F.ceil(F.col("size") / TILE).cast("int"))
        .withColumn("slice", F.pmod(F.xxhash64("digest", "band"), F.col("slices")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        .select(
            "digest", "band", "key", "slice", F.least("slice", "other").alias("s"), F.greatest("slice", "other").alias("t")
        )
    )
    tiled = materialize(tiled, "tiles", below=folder)
    groups = max(12, math.ceil(tiled.count() / GROUP))
    units = materialize(_compared(tiled.join(classes, "digest"), threshold, tolerance, groups), "units", below=folder)

    members = units.filter("pairs is null").select("unit", "digest", "k1", "k2", "at", "n_copies")

    def check(key, left, right):
        out = {"digest": [], "n_links": [], "to": []}
        wanted = dict(zip(left.column("at").to_pylist(), left.column("digest").to_pylist()))
        sets, digests, copies = {}, {}, {}
        at = 0
        column = [left.column(c) for c in ("at", "n_copies", "text")]
        while at < left.num_rows:
            part = []
            size = 0
            while at + len(part) < left.num_rows and size < 1 << 20:
                part.append((column[2][at + len(part)].as_py() or "").encode("utf-8", "surrogatepass"))
                size += len(part[-1])
            hashes, offsets = shingles(part, WORDS)
            for k in range(len(part)):
                place = column[0][at + k].as_py()
                sets[place], copies[place] = hashes[offsets[k] : offsets[k + 1]], column[1][at + k].as_py()
            at += len(part)
        n = len(sets)
        if n:
            pairs = np.frombuffer(right.column("pairs")[0].as_py(), np.int32).reshape(-1, 2)
            good = verify([sets[k] for k in range(n)], pairs, threshold)
            weight = np.array([copies[k] for k in range(n)], np.int64)
            count = np.zeros(n, np.int64)
            np.add.at(count, good[:, 0], weight[good[:, 1]])
            np.add.at(count, good[:, 1], weight[good[:, 0]])
            root = forest(n, good)
            some = np.flatnonzero(count)
            out = {
                "digest": [wanted[k] for k in some.tolist()],
                "n_links": count[some],
                "to": [wanted[k] for k in root[some].tolist()],
            }
        return pa.table({n: pa.array(v, t) for (n, v), t in zip(out.items(), (pa.binary(), pa.int64(), pa.binary()))})

    pairs = units.filter("pairs is not null").select(F.col("unit").alias("of"), "pairs")
    checked = with_text(members, docs, text_col).groupBy("unit").cogroup(pairs.groupBy("of")).applyInArrow(releasing(check), "digest binary, n_links long, to binary")
    return classes, materialize(checked, "links", below=folder)


def components(edges: DataFrame, folder: str | None = None) -> DataFrame:
    """``node`` and ``root`` (least node) of each connected part, by alternating star contraction.

    ``edges`` has columns a and b.  Each round writes its edges, so that a round
    costs a few joins of the current edges, and none is worked out again; those of the
    rounds before are deleted.
    """
    folder = folder or scratch_dir(edges.sparkSession, "components")
    written = []

    def write(df):
        written.append(f"{folder}/stars-{len(written)}")
        df.write.parquet(written[-1])
        for path in written[-5:-4]:
            discard(edges.sparkSession, path)
        return edges.sparkSession.read.schema(df.schema).parquet(written[-1])

    def content(df):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()

    edges = write(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        # to the least of all neighbours, from the larger ones
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = write(large)
        # to the least of the smaller neighbours
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = (
            joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
            .filter("a <> b")
            .distinct()
        )
        small = write(small)
        if content(small) == content(edges):
            return small.select(F.col("a").alias("node"), F.col("b").alias("root"))
        edges = small


def classified(
    docs: DataFrame, threshold=THRESHOLD, tolerance=TOLERANCE, id_col="doc_id", text_col="text", carry=()
) -> DataFrame:
    """Per row doc_id, the columns ``carry``, class (``root``, null without a set), class_id, n_links and n_copies.

    All that was written on the way is deleted but the signatures and a row per set.
    """
    spark = docs.sparkSession
    folder = scratch_dir(spark, "jaccard")
    signatures = materialize(signed(docs, id_col, text_col, carry), "signatures")
    classes, linked = links(signatures, docs, folder, threshold, tolerance, text_col)
    roots = components(linked.select(F.col("digest").alias("a"), F.col("to").alias("b")), folder)
    counted = linked.groupBy("digest").agg(F.sum("n_links").alias("n_links"))
    known = (
        classes.select("digest", "doc_id", "n_copies")
        .join(counted, "digest", "left")
        .join(roots, F.col("digest") == F.col("node"), "left")
        .select(
            "digest",
            "doc_id",
            "n_copies",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.coalesce("root", "digest").alias("root"),
        )
    )
    known = materialize(known, "known", below=folder)
    ids = known.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    named = materialize(known.join(ids, "root").select("digest", "root", "class_id", "n_links", "n_copies"), "named")
    discard(spark, folder)
    rows = signatures.drop("n_shingles", "sig", "k1", "k2")
    return rows.join(named, "digest", "left").select(
        "doc_id",
        *[c for c in rows.columns if c not in ("digest", "doc_id")],
        "root",
        F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        (F.coalesce("n_links", F.lit(0)) + F.coalesce("n_copies", F.lit(1)) - 1).alias("n_links"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
    )


def join(docs: DataFrame, threshold=THRESHOLD, tolerance=TOLERANCE, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, class_id, n_links and n_copies (rows of the same set, its own included) per row."""
    return classified(docs, threshold, tolerance, id_col, text_col).drop("root")


def first_of_classes(docs: DataFrame, threshold=THRESHOLD, tolerance=TOLERANCE, id_col="doc_id", text_col="text") -> DataFrame:
    """One row of each class: that of the smallest id; rows without a set all stay.

    Of rows that share that id one stays, and so does one without an id of a class that has
    no other.  Rows are known by their place in the files that ``docs`` reads; a table that
    comes from elsewhere is written first.  Rows whose place shares its part (see ``PARTS``) with no
    row that goes pass on without a shuffle.
    """
    spark = docs.sparkSession
    place = ["near__file", "near__row"]

    def placed(df):
        return df.withColumns({place[0]: F.col("_metadata.file_path"), place[1]: F.col("_metadata.row_index")})

    try:
        rows = placed(docs)
    except AnalysisException:
        rows = placed(materialize(docs, "placed"))
    members = classified(rows, threshold, tolerance, id_col, text_col, place).filter("root is not null")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *place)
    folder = scratch_dir(spark, "firsts")
    firsts = materialize(members.groupBy("root").agg(F.min(order).alias("first")), "firsts", below=folder)
    behind = members.join(firsts, "root").filter(order != F.col("first"))
    dropped = materialize(behind.select(*place), "dropped")
    discard(spark, folder)
    part = F.pmod(F.xxhash64(*place), F.lit(PARTS))
    parts = F.broadcast(dropped.select(part.alias("near__part")).distinct())
    rows = rows.withColumn("near__part", part)
    apart = rows.join(parts, "near__part", "left_anti")
    kept = rows.join(parts, "near__part", "left_semi").join(dropped.hint("merge"), place, "left_anti")
    return apart.unionByName(kept).select(*docs.columns)
