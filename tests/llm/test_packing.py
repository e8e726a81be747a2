"""Packing: ids and checksums against the tokenizer, layout, capacities, fill."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from revlens.llm import packing, queries, subwords
from tests.llm.samples import DOC_SCHEMA, odd_docs

PATH = queries.tokenizer_path(queries.WORD_TOKENIZER)
TOKENIZER = Tokenizer.from_file(PATH)


def ids(text):
    return TOKENIZER.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text() | st.lists(st.sampled_from(["a", "B", " ", "\n", "\t", "\x1c", " ", " ", "é", "́", "Σ", "ΑΣ", "İ", "'s", "<|endoftext|>", "!!", "12", "<|", "|>"])).map("".join))
def test_words_one_by_one_give_the_ids_of_the_text(text):
    assert np.frombuffer(next(iter(subwords.word_ids(PATH).many([text]))), "<u4").tolist() == ids(text)


def test_a_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(subwords, "KEPT", 4)
    monkeypatch.setattr(subwords, "BLOCK", 10)
    texts = ["a b c d e f", "", "g <|endoftext|>h i", "a x y z", "<|startoftext|>"] * 3
    got = [np.frombuffer(x, "<u4").tolist() for x in subwords.WordIds(PATH).many(texts)]
    assert got == [ids(t) for t in texts]


def test_pieces_and_layout(spark, monkeypatch):
    docs = odd_docs(spark)
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    rows = queries.op10_best_fit_packing(spark, "").collect()
    want = defaultdict(int)
    for r in docs.collect():
        x = np.array([*ids(r.text or ""), 0], "<u4")
        for k in range(0, len(x), 2048):
            part = x[k : k + 2048]
            want[r.doc_id, k // 2048, k, len(part), zlib.crc32(part.tobytes())] += 1
    got = defaultdict(int)
    used = defaultdict(list)
    for r in rows:
        got[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        used[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(used) <= -(-sum(r.length for r in rows) // 2048) + 1


def test_ids_are_kept_on_request(spark):
    docs = spark.createDataFrame([(1, "Hello world")], "doc_id long, text string")
    assert packing.pieces(docs, PATH, keep_ids=True).first().ids == [*ids("Hello world"), 0]


def test_no_rows(spark):
    empty = spark.createDataFrame([], DOC_SCHEMA)
    assert packing.pack(packing.pieces(empty, PATH)).count() == 0


@pytest.mark.parametrize("by", ["residual", "dot"])
def test_every_capacity_holds(by):
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 2048, 3000)
    where, offset = packing.fit(lengths, (2048, 3, 2_000_000), by=by)
    for name in np.unique(where):
        part = lengths[where == name]
        assert part.sum() <= 2048 and len(part) <= 3
        assert len(part) == 1 or (part.astype(float) ** 2).sum() <= 2_000_000
    tight, _ = packing.fit(lengths, (2048, 2048, 2048 * 2048), by=by)
    assert len(np.unique(tight)) <= 1.03 * np.ceil(lengths.sum() / 2048)


def test_groups_only_cost_their_last_sequences(spark):
    rows = spark.range(5000).selectExpr("id", "id * id % 1500 + 1 as length")
    packed = packing.pack(rows, group=500)
    total = rows.selectExpr("sum(length)").first()[0]
    assert packed.count() == 5000
    assert packed.select("sequence_id").distinct().count() <= total / 2048 + 3 * 10
