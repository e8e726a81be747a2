"""Links and classes against comparing all pairs."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from revlens.llm import jaccard_join as J
from revlens.llm import queries
from revlens.llm.texthash import shingles
from tests.llm.samples import DOC_SCHEMA, odd_docs, prose


def plain(text):
    words = (text or "").encode("utf-8", "surrogatepass").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [plain(t) for _, t in rows]
    n = len(rows)
    near = defaultdict(set)
    for i in range(n):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 10 * both >= 8 * (len(sets[i]) + len(sets[j]) - both):
                near[i].add(j)
                near[j].add(i)
    out, seen = Counter(), {}
    for i in range(n):
        if i not in seen:
            part, todo = {i}, [i]
            while todo:
                for j in near[todo.pop()] - part:
                    part.add(j)
                    todo.append(j)
            ids = [rows[k][0] for k in part if rows[k][0] is not None]
            seen.update(dict.fromkeys(part, min(ids) if ids else None))
        out[rows[i][0], seen[i], len(near[i])] += 1
    return out


def variants(n, seed, edits):
    rng = random.Random(seed)
    base = prose(300, seed).split()
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def near_copies():
    texts = variants(60, 3, 18) + variants(40, 4, 30) + [prose(80 + i, i) for i in range(40)] + ["same text again and again here"] * 20
    random.Random(5).shuffle(texts)
    return list(enumerate(texts))


def test_equals_all_pairs(spark, monkeypatch):
    docs = odd_docs(spark, [t for _, t in near_copies()]).unionByName(odd_docs(spark))
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = queries.op9_ngram_jaccard(spark, "").drop("n_copies")
    assert Counter(map(tuple, got.collect())) == brute(rows)


@pytest.mark.parametrize("doc_id", [None, 7])
def test_texts_of_rows_that_share_an_id(spark, monkeypatch, doc_id):
    """A unit gets one text per member, however many rows have no id or the same one."""
    rows = [(doc_id, t) for t in variants(60, 3, 18)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    inner, counts = J.with_text, []

    def counted(members, docs, text_col):
        counts.append((inner(members, docs, text_col).count(), members.count()))
        return inner(members, docs, text_col)

    monkeypatch.setattr(J, "with_text", counted)
    got = J.join(docs).drop("n_copies")
    assert Counter(map(tuple, got.collect())) == brute(rows)
    assert counts and all(texts == members > 0 for texts, members in counts)


def test_tiles_and_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(J, "TILE", 8)
    monkeypatch.setattr(J, "GROUP", 100)
    monkeypatch.setattr(J, "BLOCK", 3000)
    rows = near_copies()
    got = J.join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(tuple(r)[:3] for r in got.collect()) == brute(rows)


def test_no_rows(spark):
    got = J.join(spark.createDataFrame([], DOC_SCHEMA))
    assert got.columns == ["doc_id", "class_id", "n_links", "n_copies"] and got.count() == 0


def test_shingles_are_sets_of_word_runs():
    texts = [b"", b" \n", b"a", b"a b c d e", b"a b  c\td e a b c d e", b"a b c d e a b c d x"]
    hashes, offsets = shingles(texts)
    sets = [set(hashes[a:b].tolist()) for a, b in zip(offsets, offsets[1:])]
    assert [len(s) for s in sets] == [0, 0, 1, 1, 5, 6]
    assert sets[3] < sets[4] and sets[3] < sets[5]
    one, _ = shingles([b"x " * 50_000])
    assert len(one) == 1


def test_pruning_keeps_similar_pairs():
    least = J.fewest_matches(0.8, J.TOLERANCE)
    assert all(0 < m < 0.8 * n for n, m in least.items())
    assert least[100] > 50


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)] + [(100, 101), (101, 3)]])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    nodes = sorted({x for e in edges for x in e})
    root = J.forest(200, np.array(edges, np.int64).reshape(-1, 2))
    got = {r.node: r.root for r in J.components(df).collect()}
    assert {n: got.get(n, n) for n in nodes} == {n: int(root[n]) for n in nodes}
