"""Clustering, resampling and mixing against plain Python."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from revlens.llm import centroids, mixing, queries, ranks, resample

from .samples import odd_docs, prose

TINY = "/root/testdata/sf0.001"


# clustering


def plain_clusters(rows, k, rounds, scale, dimensions):
    kept = []
    for i, v in rows:
        if v is None or len(v) != dimensions or any(x is None or not math.isfinite(x) or abs(x * scale) >= 1 << 27 for x in v):
            continue
        kept.append((i, [math.floor(scale * x) for x in v]))
    starts = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), i, v) for i, v in kept if i is not None)[:k]
    centers = [v for _, _, v in starts]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [min((far(v, c), n) for n, c in enumerate(centers)) for _, v in kept]

    for _ in range(rounds if centers else 0):
        found = assign()
        for n in range(len(centers)):
            own = [v for (_, v), (_, m) in zip(kept, found) if m == n]
            if own:
                centers[n] = [sum(x) // len(own) for x in zip(*own)]
    if not centers:
        return []
    found = assign()
    inertia = Counter()
    for d, n in found:
        inertia[n] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return [(i, n, d, inertia[n], sum(inertia.values()), sha[n]) for (i, _), (d, n) in zip(kept, found)]


def some_vectors(n, dimensions, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(7, dimensions))[rng.integers(0, 7, n)] * 3 + rng.normal(size=(n, dimensions)) * 0.4
    x[n // 3 : 2 * n // 3] = x[0]
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


def by_value(rows):
    return sorted(rows, key=lambda r: [(v is not None, v) for v in r])


def clustered(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "clash", 1) for i, v in rows], "vec_id long, embedding array<double>, v string, cluster int")
    return by_value(map(tuple, centroids.summarised(*centroids.cluster(df, **options)).collect()))


@pytest.mark.parametrize("dimensions, k, lead", [(5, 4, 2), (8, 16, 3), (3, 2, 3), (64, 6, 16)])
def test_clusters_equal_plain_rounds(spark, dimensions, k, lead):
    rows = some_vectors(300, dimensions, k)
    got = clustered(spark, rows, k=k, dimensions=dimensions, lead=lead)
    assert got == by_value(plain_clusters(rows, k, 3, 64, dimensions))


def test_clusters_of_awkward_vectors(spark):
    odd = [(None, [1.0, 2.0]), (None, [1.0, 2.0]), (1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0])]
    odd += [(5, [float("-inf"), 1.0]), (6, []), (7, [1.0]), (8, [1.0, 1.0]), (8, [1.0, 1.0]), (8, [-3.0, 1.01]), (9, [1e300, 1.0]), (10, [-0.001, 5e6])]
    assert clustered(spark, odd, k=4, dimensions=2, lead=1) == by_value(plain_clusters(odd, 4, 3, 64, 2))
    assert clustered(spark, [], dimensions=2) == []
    assert clustered(spark, [(None, [1.0, 2.0])], dimensions=2) == []
    assert len(clustered(spark, odd[:2] + odd[3:4], k=4, dimensions=2, lead=1)) == 3


def test_ties_go_to_the_smaller_centroid_and_empty_ones_stay():
    v = np.array([[0, 0], [2, 0], [4, 0]])
    c = np.array([[2, 0], [2, 0], [0, 0], [4, 0], [1000, 1000]])
    mean, directions = np.zeros(2), np.eye(2)
    best, distance, _ = centroids.nearest(v, *centroids.rotated(v, mean, directions, 1), c, *centroids.rotated(c, mean, directions, 1))
    assert best.tolist() == [2, 0, 3] and distance.tolist() == [0, 0, 0]
    between = np.array([[1, 0], [3, 0]])
    best, _, _ = centroids.nearest(between, *centroids.rotated(between, mean, directions, 1), c, *centroids.rotated(c, mean, directions, 1))
    assert best.tolist() == [0, 0]


def test_the_filter_spares_most_distances(spark):
    rng = np.random.default_rng(3)
    v = np.rint(rng.normal(size=(20, 64))[rng.integers(0, 20, 4000)] * 200 + rng.normal(size=(4000, 64)) * 20).astype(np.int64)
    c = v[:20]
    _, directions = np.linalg.eigh(np.cov(v.T))
    directions = directions[:, ::-1]
    best, distance, measured = centroids.nearest(
        v, *centroids.rotated(v, v.mean(axis=0), directions, 16), c, *centroids.rotated(c, v.mean(axis=0), directions, 16)
    )
    exact = ((v[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
    assert (best == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert measured < 0.2 * exact.size


def test_bounds_never_exceed_distances_of_far_vectors():
    rng = np.random.default_rng(4)
    v = rng.integers(-(1 << 26), 1 << 26, (500, 64))
    v[:250] = v[250:] + rng.integers(-2, 3, (250, 64))
    c = v[::25] + rng.integers(-1, 2, (20, 64))
    directions = np.linalg.qr(rng.normal(size=(64, 64)))[0]
    best, distance, _ = centroids.nearest(
        v, *centroids.rotated(v, np.zeros(64), directions, 16), c, *centroids.rotated(c, np.zeros(64), directions, 16)
    )
    exact = ((v[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
    assert (best == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()


# resampling


def plain_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in "0123456789" or "a" <= c <= "z" or ord(c) >= 0x80:
            word += c
        elif word:
            words.append(word)
            word = ""
    return words


def plain_features(text):
    words = plain_words(text)
    return [zlib.crc32(" ".join(words[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain_resample(docs, targets):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(plain_features(text))
    for text in targets:
        t.update(plain_features(text))
    every_s, every_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (every_s + 10000) / ((s[b] + 1) * (every_t + 10000)))) for b in range(10000)]
    rows, able = [], []
    for n, (i, text) in enumerate(docs):
        found = plain_features(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(found), weight, score, None])
        if len(plain_words(text)) >= 20:
            able.append((-score, i is None, i or 0, len(found), weight, n))
    for rank, (*_, n) in enumerate(sorted(able)[: 5 * len(able) // 100]):
        rows[n][4] = rank + 1
    return by_value(map(tuple, rows))


def test_resampling_equals_plain_scoring_and_sorting(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "text")
    held = spark.read.parquet(f"{TINY}/benchmark.parquet")
    got = queries.op12_importance_resampling(spark, TINY)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = plain_resample([tuple(r) for r in docs.collect()], [r.text for r in held.collect()])
    assert by_value(map(tuple, got.collect())) == want
    assert sum(r[4] is not None for r in want) > 3


def test_resampling_awkward_texts(spark):
    docs = odd_docs(spark).withColumnsRenamed({"lang": "row", "source": "rank"})
    more = [(500 + n % 40, prose(25 + n % 3, n % 5), None, None, None) for n in range(200)] + [(None, prose(30, 3), None, None, None)] * 9
    docs = docs.unionAll(spark.createDataFrame(more, docs.schema))
    held = spark.createDataFrame([(None,), ("",), (prose(30, 2),), ("É one, Two\x00three",)], "text string")
    got = by_value(map(tuple, resample.resample(docs, held).collect()))
    assert got == plain_resample([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in held.collect()])
    assert [r[4] for r in sorted(got, key=lambda r: r[4] or 0) if r[4]] == list(range(1, 5 * sum(len(plain_words(r.text)) >= 20 for r in docs.collect()) // 100 + 1))
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resample.resample(none, held).collect() == []
    assert len(resample.resample(docs, none).collect()) == docs.count()


def test_a_text_longer_than_a_stretch_is_counted_whole(monkeypatch):
    import pyarrow as pa

    text = (prose(3000, 1) + " " + "y" * 5000 + " Ünder-score " + "z " * 40 + "w" * 700).encode()
    whole = resample.features([text])
    monkeypatch.setattr(resample, "STRETCH", 900)
    found, n_words = [], 0
    for row, part, carry in resample._stretches(pa.array([b"short one", text, None, b"x"], pa.binary())):
        if row == [1]:
            bucket, _, words = resample.features(part, carry)
            found += bucket.tolist()
            n_words += int(words.sum())
    assert Counter(found) == Counter(whole[0].tolist()) and n_words == whole[2][0]
    assert Counter(found) == Counter(plain_features(text.decode()))


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 127, 128, 129, 1000, 100_000])
def test_carried_checksums(n):
    head, tail = b"some head", bytes(range(97, 123)) * (n // 26 + 1)
    tail = tail[:n]
    got = resample.carried(np.array([zlib.crc32(head)], np.uint32), np.array([n])) ^ np.uint32(zlib.crc32(tail))
    assert got[0] == zlib.crc32(head + tail)


def test_quickselect_finds_every_rank(spark):
    rows = [(i, -(i * 7 % 5), None if i % 11 == 0 else i % 13, i % 3, i % 2) for i in range(120)]
    df = spark.createDataFrame(rows, "row long, score long, doc_id long, n_features long, weight long").select(resample.key().alias("key"))
    order = sorted((-s, d is None, (d is not None, d or 0), f, w, r) for r, s, d, f, w in rows)
    for k in (1, 2, 59, 60, 61, 119, 120):
        found = resample.kth_key(df, k, pivots=3)
        worse, no_id, (some, doc_id), features, weight, row = order[k - 1]
        assert found == (worse, no_id, doc_id if some else None, features, weight, row)


def test_ranks_span_ranges(spark, monkeypatch):
    monkeypatch.setattr(ranks, "SORTED_AT_ONCE", 50)
    df = spark.range(1000).selectExpr("(id * 37) % 1000 AS key", "'x' AS other")
    assert {(r.key, r["rank"]) for r in ranks.ranked(df, 1000).collect()} == {(n, n + 1) for n in range(1000)}
    assert ranks.ranked(df.limit(0), 0).collect() == []


# mixing


def plain_size(text):
    out, inside = 0, False
    for c in text or "":
        blank = c in " \t\n\x0b\f\r"
        out += not blank and not inside
        inside = not blank
    return out


def plain_targets(sizes):
    """By source: what weights 1, 2, 3 and the limit of three times the size give."""
    names = sorted([s for s in sizes if s is not None], key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: n % 3 + 1 for n, s in enumerate(names)}
    left, target, rest = set(names), {}, sum(sizes.values())
    while left:
        unit = rest / sum(weight[s] for s in left)
        over = {s for s in left if unit * weight[s] >= 3 * sizes[s]}
        if not over:
            return target | {s: unit * weight[s] for s in left}
        for s in over:
            target[s] = 3.0 * sizes[s]
        left -= over
        rest -= sum(3 * sizes[s] for s in over)
    return target


def check_mix(rows, docs):
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += plain_size(text)
    target = plain_targets(sizes)
    by_source = {}
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((i, plain_size(text)) for i, text, _ in docs)
    known = defaultdict(set)
    for i, text, source in docs:
        known[i, plain_size(text)].add(source)
    taken = Counter()
    for r in rows:
        source = next(s for s in known[r.doc_id, r.size] if sizes[s] == r.source_size and math.isclose(target[s], r.target, rel_tol=1e-9, abs_tol=1e-9))
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[source] += r.taken
        by_source.setdefault(source, []).append(r)
    for source, own in by_source.items():
        assert abs(taken[source] - target[source]) <= max(r.size for r in own) / 2 + 1, (source, taken[source], target[source])
    return by_source, target


def test_mixing_meets_the_targets(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    rows = mixing.mix(docs).collect()
    by_source, target = check_mix(rows, [(r.doc_id, r.text, r.source) for r in docs.collect()])
    for source, own in by_source.items():
        total = sum(r.size for r in own)
        if 0 < target[source] < 3 * total:  # the rates are the exponential tilt whose words add up to the target
            mean = total / len(own)
            low, high = -1e4, 1e4
            words = lambda t: sum(r.size * (3 if t * r.size / mean > 2 else min(3, math.exp(t * r.size / mean))) for r in own)
            for _ in range(200):
                low, high = ((low + high) / 2, high) if words((low + high) / 2) < target[source] else (low, (low + high) / 2)
            for r in own:
                rate = min(3, math.exp(min(2, low * r.size / mean)))
                assert r.rate == pytest.approx(rate, abs=2e-3)
                assert r.size == 0 or math.floor(r.rate) <= r.taken // r.size <= math.ceil(r.rate)


def test_mixing_is_the_same_in_any_order(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    columns = ["doc_id", "size", "source_size", "target", "rate", "taken"]
    once = sorted(map(tuple, mixing.mix(docs).select(columns).collect()))
    again = mixing.mix(docs.repartition(7, "text").orderBy("text")).select(columns)
    assert sorted(map(tuple, again.collect())) == once


def test_mixing_awkward_sources(spark):
    docs = odd_docs(spark).withColumnRenamed("lang", "size").withColumnRenamed("n_chars", "rate")
    more = [(1000 + n, prose(5 + n % 17, n % 9), None, "～" if n % 3 else "\U0001f600" if n % 2 else "hot", n) for n in range(300)]
    more += [(2000, "", None, "empty", 1), (2001, None, None, "empty", 1), (2002, "x " * 3000, None, "one", 1), (2003, "tiny", None, "two", 1)]
    docs = docs.unionAll(spark.createDataFrame(more, docs.schema)).cache()
    check_mix(mixing.mix(docs).collect(), [(r.doc_id, r.text, r.source) for r in docs.collect()])
    none = docs.limit(0)
    assert mixing.mix(none).collect() == []
    blank = docs.filter("doc_id in (2000, 2001)")
    assert [(r.size, r.source_size, r.target, r.taken) for r in mixing.mix(blank).collect()] == [(0, 0, 0.0, 0)] * 2


def test_shared_targets_by_hand(spark):
    rows = spark.createDataFrame([("a", 10, 1, 1), ("b", 10, 1, 2), ("c", 100, 1, 3), ("d", 1, 1, 1)], "source string, source_size long, n_docs long, weight long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    # 121 / 7 each: d stops at 3, then b at 30, then a and c share 88 as 1 to 3
    assert got == {"a": 22.0, "b": 30.0, "c": 66.0, "d": 3.0}
