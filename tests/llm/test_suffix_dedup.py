"""Removed bytes against a plain search for earlier strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from revlens.llm import queries
from revlens.llm import suffix_dedup as S
from tests.llm.samples import DOC_SCHEMA, odd_docs, prose


def brute(rows, length):
    def tie(text):
        return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little")

    rows = [(i, (t or "").encode("utf-8", "surrogatepass")) for i, t in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, tie(r[1])))
    seen, out = set(), Counter()
    for i, text in rows:
        gone = np.zeros(len(text), bool)
        for p in range(len(text) - length + 1):
            string = text[p : p + length]
            if string in seen:
                gone[p : p + length] = True
            seen.add(string)
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1).sum())
        out[i, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def shared_passages(seed=1):
    rng = random.Random(seed)
    letters = "abcdeé ☃"
    passages = ["".join(rng.choice(letters) for _ in range(n)) for n in (90, 97, 99, 100, 101, 120, 130, 300, 700)]
    docs = []
    for _ in range(120):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts.append("".join(rng.choice(letters) for _ in range(rng.randrange(0, 150))))
            p = rng.choice(passages)
            a = rng.randrange(0, 20)
            parts.append(p[a : len(p) - rng.randrange(0, 20)])
        docs.append("".join(parts))
    docs += [docs[3], docs[3], docs[5] * 2, "z" * 450, "zy" * 400, "z" * 99, "z" * 100, prose(200, 1), prose(200, 1)[7:]]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("chunk", [S.CHUNK, 4000])
def test_equals_plain_search(spark, monkeypatch, chunk):
    monkeypatch.setattr(S, "CHUNK", chunk)
    monkeypatch.setattr(S, "BUCKET", 3 * chunk)
    monkeypatch.setattr(S, "BLOCK", chunk // 2)
    docs = odd_docs(spark, shared_passages()).unionByName(odd_docs(spark))
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    got = queries.op2_suffix_dedup(spark, "")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], 100)
    assert Counter(map(tuple, got.collect())) == want


def test_other_lengths(spark):
    texts = ["the quick brown fox", "a quick brown cat", "quick", "the quick"]
    docs = spark.createDataFrame([(-k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    for length in (7, 12, 25):
        got = S.dedup(docs, length).drop("kept_text", "spans")
        assert Counter(map(tuple, got.collect())) == brute([(-k, t) for k, t in enumerate(texts)], length)


def test_remove_keeps_columns(spark):
    long = " ".join(map(str, range(100, 160)))
    rows = [(1, long, "a", 1), (2, long + "é", "b", 2), (3, None, None, None), (4, "", "c", 0)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, kept_text string, chunk long")
    got = {r[0]: tuple(r) for r in S.remove(docs).collect()}
    assert S.remove(docs).schema == docs.schema
    assert got == {1: rows[0], 2: (2, "é", "b", 2), 3: rows[2], 4: rows[3]}


def test_rows_that_share_an_id_are_spread(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 2000)
    texts = [prose(40, k % 30) for k in range(60)]
    docs = spark.createDataFrame([(7, t) for t in texts], "doc_id long, text string")
    assert docs.select(S.deal(8)).distinct().count() > 4
    assert sum(r.n_removed for r in S.dedup(docs).collect()) >= sum(len(t) for t in texts) // 2


def test_no_rows(spark):
    assert S.dedup(spark.createDataFrame([], DOC_SCHEMA)).count() == 0


@pytest.mark.parametrize("period", S.COVERS)
def test_covers_have_every_difference(period):
    cover = S.COVERS[period]
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_lying_hashes_are_found_out():
    data = np.frombuffer(b"abcabdabc", np.uint8)
    at = np.arange(7)
    assert S.repeats(data, at, np.zeros(7, np.uint64), 3).tolist() == [False] * 6 + [True]
