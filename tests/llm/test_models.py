"""Piece vocabulary, classifiers and language identification."""

import re
import zlib
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revlens.llm import labelled, language_id, piece_model, quality_net, queries, toxicity
from tests.llm.samples import DOC_SCHEMA, ODD_TEXTS, odd_docs

PATH = queries.tokenizer_path(queries.PIECE_MODEL)


@pytest.fixture(scope="module")
def pieces():
    return piece_model.model_at(PATH)


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.lists(st.sampled_from(["the", "The ", "ing", " a", "   ", "b", "é", "\n", "☃", "tion", "0", ", "]), max_size=25).map("".join))
def test_ids_equal_the_library(pieces, library, text):
    if "\0" not in text:
        assert pieces.encode(text).tolist() == library.encode(text)


def test_ids_of_documents_equal_the_library(spark, pieces, library):
    for r in queries.table(spark, "/root/testdata/sf0.001", "documents").collect():
        assert pieces.encode(r.text).tolist() == library.encode(r.text)


@settings(max_examples=100, deadline=None)
@given(st.text())
def test_decoding_inverts_encoding(pieces, text):
    text = text.replace(piece_model.SPACE, "_")
    assert pieces.decode(pieces.encode(text).tolist()) == text


def test_decoding_equals_the_library(pieces, library):
    ids = library.encode("Some words, é ☃ \U0001f600 and 123.")
    assert pieces.decode(ids) == library.decode(ids)


def test_automaton_against_all_segmentations():
    pieces = {"a": (0, -1.0), "b": (1, -1.5), "ab": (2, -2.0), "aba": (3, -2.5), "ba": (4, -2.2), "bab": (5, -4.0)}
    automaton = piece_model.Automaton(pieces)
    for n in range(1, 8):
        for text in map("".join, product("abc", repeat=n)):
            best = -1e9
            for cuts in product((0, 1), repeat=n - 1):
                at = [0, *(k + 1 for k, c in enumerate(cuts) if c), n]
                parts = [text[x:y] for x, y in zip(at, at[1:])]
                if all(p in pieces or len(p) == 1 for p in parts):
                    best = max(best, sum(pieces[p][1] if p in pieces else -12.0 for p in parts))
            got = automaton.best(text, -12.0)
            assert "".join(text[s:e] for s, e, _ in got) == text
            assert abs(sum(pieces[text[s:e]][1] if k >= 0 else -12.0 for s, e, k in got) - best) < 1e-9


def test_merging_is_the_one_segmentation_of_weight_zero():
    names = ["a", "b", "c", "ab", "bc", "abc", "ca", "aa", "bcab"]
    pieces = {name: (k, -float(k)) for k, name in enumerate(names)}
    automaton = piece_model.Automaton(pieces)

    def weigh(a, b):
        two = a < 0 or piece_model.merge(names[a] + names[b], pieces) == [names[a], names[b]]
        return 0.0 if two else piece_model.NEVER

    for n in range(1, 8):
        for text in map("".join, product("abc", repeat=n)):
            whole = []
            for cuts in product((0, 1), repeat=n - 1):
                at = [0, *(k + 1 for k, c in enumerate(cuts) if c), n]
                parts = [text[x:y] for x, y in zip(at, at[1:])]
                if all(p in pieces for p in parts):
                    ids = [-1, *(pieces[p][0] for p in parts)]
                    if all(weigh(a, b) == 0 for a, b in zip(ids, ids[1:])):
                        whole.append(parts)
            assert whole == [piece_model.merge(text, pieces)]
            # leaving the links at the greatest total changes nothing
            for most in (0.0, np.inf):
                got = automaton.best(text, 0.0, {}, weigh, most)
                assert [text[s:e] for s, e, _ in got] == whole[0]


def test_encode_every_row(spark, monkeypatch, pieces):
    docs = odd_docs(spark)
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    rows = queries.op4_sentencepiece(spark, "")
    got = sorted(((r.doc_id, tuple(r.ids), r.n_ids) for r in rows.collect()), key=str)
    want = [(r.doc_id, tuple(pieces.encode(r.text or "").tolist())) for r in docs.collect()]
    assert got == sorted(((i, x, len(x)) for i, x in want), key=str)
    assert rows.filter("not round_trip").count() == 0
    texts = sorted(((r.doc_id, r.text) for r in piece_model.decode(rows, PATH).collect()), key=str)
    assert texts == sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=str)
    assert piece_model.encode(spark.createDataFrame([], DOC_SCHEMA), PATH).count() == 0


def auc(pairs):
    pairs = sorted(pairs)
    ranks = [k for k, (_, y) in enumerate(pairs) if y]
    n, m = len(ranks), len(pairs) - len(ranks)
    return (sum(ranks) - n * (n - 1) / 2) / (n * m)


def test_quality_on_held_out_rows(spark):
    scored = queries.op7_quality_classifier(spark, "/root/testdata/sf0.01").cache()
    assert scored.count() == 1000
    labels = queries.table(spark, "/root/testdata/sf0.01", "labels")
    rows = scored.filter("held_out").join(labels, "doc_id").filter("quality is not null").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    assert auc([(r.score, r.quality) for r in rows]) > 0.9
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9


def test_scores_of_odd_rows(spark):
    docs = odd_docs(spark)
    net = quality_net.fit([("good words here " * 20, 1), ("%%% ### " * 20, 0)] * 5, steps=20)
    machine = toxicity.fit([("fine words all around. More of them here", 0), ("you utter fool. More of them here", 1)] * 5)
    for scored in (quality_net.score(docs, net), toxicity.score(docs, machine)):
        rows = scored.collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    for fit in (quality_net.fit, toxicity.fit):
        assert fit([])([b"", b"x"] if fit is quality_net.fit else ["", "x"]).tolist() == [0.5, 0.5]
    assert quality_net.score(spark.createDataFrame([], DOC_SCHEMA), net).count() == 0


def test_chunks_cover_the_whole_text():
    for n in (0, 1, 511, 512, 513, 960, 961, 5000):
        text = bytes(np.random.default_rng(n).integers(1, 256, n, dtype=np.uint8))
        data, count = quality_net.chunked([text])
        step = quality_net.CHUNK - quality_net.OVERLAP
        whole = b"".join(row.tobytes()[: step if k + 1 < len(data) else None] for k, row in enumerate(data))
        assert whole.rstrip(b"\0") == text.rstrip(b"\0") and count.tolist() == [len(data)]


@pytest.mark.parametrize("rare", [0, 1])
def test_scores_keep_the_share_of_the_labels(rare):
    """Texts that tell nothing score as the share of label 1, though batches hold more of the rarer label."""
    rows = [("the same text", rare if k < 5 else 1 - rare) for k in range(100)]
    got = quality_net.fit(rows)([b"the same text"])[0]
    assert abs(got - np.mean([label for _, label in rows])) < 0.03


def test_a_pattern_counts_alike_at_every_offset():
    net = quality_net.Net(3)
    net.p["out"][:] = np.random.default_rng(5).normal(size=net.p["out"].shape)
    blank = b" " * 40
    pooled = [net.pooled(quality_net.chunked([blank + b" " * k + b"#pattern" + blank])[0])[0] for k in range(4)]
    assert all(np.allclose(p, pooled[0], atol=1e-5) for p in pooled)


def test_gradients():
    net = quality_net.Net(1)
    net.p["out"][:] = np.random.default_rng(2).normal(size=net.p["out"].shape)
    texts, labels = [b"some text " * 90, b"other"], np.array([1.0, 0.0], np.float32)

    def loss():
        p = net.score(texts)
        return -np.log(np.where(labels == 1, p, 1 - p)).mean()

    grads = net.gradients(texts, labels)
    for name, at in (("out", 3), ("base", 0), ("bias", 5), ("filters", (7, 2)), ("embed", (ord("e"), 1))):
        old = net.p[name][at]
        net.p[name][at] = old + 1e-3
        up = loss()
        net.p[name][at] = old - 1e-3
        down = loss()
        net.p[name][at] = old
        assert abs((up - down) / 2e-3 - grads[name][at]) < 2e-2 * max(1, abs(grads[name][at]))


def plain_kernel(s, t):
    from itertools import combinations

    total = 0.0
    for a in combinations(range(len(s)), 3):
        for b in combinations(range(len(t)), 3):
            if all(s[i] == t[j] for i, j in zip(a, b)):
                total += toxicity.DECAY ** (a[2] - a[0] + 1 + b[2] - b[0] + 1)
    return total


def test_kernel_equals_counting_subsequences():
    words, landmarks = ["idiot", "id-iot", "ab", "", "aaaaa", "toidi"], ["idiot", "aaa", "trash"]
    want = [[plain_kernel(w, z) for z in landmarks] for w in words]
    assert np.allclose(toxicity.kernel(words, landmarks), want, rtol=1e-5)
    assert np.allclose(toxicity.own_values(words), [plain_kernel(w, w) for w in words])


def test_toxic_rows_are_found(spark):
    """Insults of the sentences trained on are found, spelt with gaps too, and clean rows are left alone."""
    docs = queries.table(spark, "/root/testdata/sf0.1", "documents")
    labels = queries.table(spark, "/root/testdata/sf0.1", "labels")
    rows = labelled.sample(docs, labels, "toxic", labelled.remainder(F.col("doc_id"), 5) != 0, 1200)
    scorer = toxicity.fit(rows)
    bad = scorer(["well you idiot", "an I D I O T there", "such a worthlesss thing", "Pathetic."])
    fine = scorer(["", "clean words here", "the tradition of the house", "class of the year"])
    assert bad.min() > 0.5 > fine.max()


def test_parted_insults_are_found(spark):
    docs = queries.table(spark, "/root/testdata/sf0.1", "documents")
    labels = queries.table(spark, "/root/testdata/sf0.1", "labels")
    rows = labelled.sample(docs, labels, "toxic", labelled.remainder(F.col("doc_id"), 5) != 0, 1200)
    scorer = toxicity.fit(rows)
    bad = ["you id iot there", "you id-iot", "an i - d - i - o - t there", "so stu pid.", "st.upid thing", "mo  ro  n here", "I  D  I  O  T!"]
    fine = ["go to it", "i did it a lot", "well-known words", "a, b, c and d", "this is his sister", "low class own"]
    assert scorer(bad).min() > 0.5 > scorer(fine).max()


def test_common_subsequences_in_bits():
    words, landmarks = ["idiot", "id-iot", "", "toidi", "x" * 40], ["idiot", "trash", "ab" * 16]

    def plain(a, b):
        row = [0] * (len(b) + 1)
        for c in a:
            row = step(row, c, b)
        return row[-1]

    def step(row, c, b):
        out = [0]
        for j, d in enumerate(b):
            out.append(row[j] + 1 if c == d else max(row[j + 1], out[-1]))
        return out

    assert toxicity.in_order(words, landmarks).tolist() == [[plain(w, t) for t in landmarks] for w in words]


def uneven_insults():
    """40 insults in 400 to 25 toxic texts each, and clean words."""
    rng = np.random.default_rng(1)
    syllables = [a + b for a in "bdfgklmnprstvz" for b in "aeiou"]
    bad = ["".join(rng.choice(syllables, 6 if k else 8)) for k in range(40)]
    clean = ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(800)]
    todo = [b for k, b in enumerate(bad) for _ in range(max(25, 400 // (k + 1)))]
    rows = []
    for k in range(6 * len(todo)):
        words = list(rng.choice(clean, 30))
        if k < len(todo):
            words[rng.integers(30)] = todo[k]
        rows.append((" ".join(words[:15]) + ". " + " ".join(words[15:]), int(k < len(todo))))
    return bad, clean, rows


def test_uneven_and_long_insults_are_found():
    bad, clean, rows = uneven_insults()
    scorer = toxicity.fit(rows)
    assert max(map(len, bad)) > toxicity.WIDEST
    assert scorer([f"you {b} there" for b in bad]).min() > 0.5
    assert scorer([t for t, label in rows if not label]).max() < 0.5


def test_language_of_pages(spark):
    model = language_id.fit(language_id.sample(queries.table(spark, "/root/testdata/sf0.01", "documents"), 300))
    words = {"en": "the of and is in that the with to for", "de": "der die und ist nicht ein das mit den von", "fr": "le la les des et est que dans pour une", "es": "el la los que y en del por las una"}
    rows = []
    for k in range(80):
        lang = list(words)[k % 4]
        rows.append((k, f"https://{lang}{k % 3}.site.{lang}/x", f"<html lang={lang}><p>{words[lang]}</p>"))
    rows += [(100, None, None), (101, "https://de0.site.de/", ""), (None, "x", "<html>"), (102, "https://fr1.site.fr/y", "<html lang='FR-ca'>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in language_id.identify(pages, model).collect()}
    assert len(got) == len(rows)
    assert all(got[k].lang == list(words)[k % 4] for k in range(80))
    # no text: host and markup decide
    assert got[101].lang == "de" and got[102].lang == "fr" and got[102].declared == "fr"
    assert all(0 < r.score <= 1 for r in got.values())
    none = spark.createDataFrame([], "text string, lang string")
    nothing = language_id.identify(pages, language_id.fit(none)).collect()
    assert len(nothing) == len(rows) and all(r.lang is None for r in nothing)
    assert language_id.identify(pages.limit(0), model).count() == 0


def test_odd_bytes_have_trigrams():
    for text in ODD_TEXTS:
        assert len(language_id.trigrams((text or "").encode())) == len((text or "").encode())


def plain_visible(html):
    import re

    return re.sub(rb"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", b" ", html)


def test_visible_text_equals_a_plain_pattern():
    import random

    dice = random.Random(5)
    pool = [b"<", b">", b"<!--", b"-->", b"<script>", b"</script >", b"<STYLE a=1>", b"</style>", b"<p>", b"word ", b"</", b"script", b"<scripts>", b"</SCRIPT\n>"]
    for _ in range(3000):
        html = b"".join(dice.choice(pool) for _ in range(dice.randrange(12)))
        assert language_id.visible(html) == plain_visible(html), html


@pytest.mark.parametrize("part", [b"<script>", b"<!--", b"<", b"<style>x</script>", b"<!-- -", b"<html "])
def test_a_page_of_a_megabyte_takes_one_scan(spark, part):
    import time

    html = part * ((1 << 20) // len(part))
    start = time.process_time()
    language_id.visible(html)
    assert time.process_time() - start < 1.5
    page = spark.createDataFrame([(html.decode(),)], "html string")
    start = time.time()
    page.select(language_id.declared_in(F.col("html")), language_id.host_of(F.col("html"))).collect()
    assert time.time() - start < 20


def plain_languages(pages, model):
    """The fusion page by page, with counts in dictionaries."""
    names, table = model
    n = len(names)
    rows = []
    for page_id, url, html in pages:
        found = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
        host = (found[1].lower() if found else "").rstrip(".")
        mark = re.search(r"(?i)<html\b[^<>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,8})", html or "")
        at = language_id.trigrams(plain_visible((html or "").encode()))
        z = [sum(float(table[a, k]) for a in at) * min(1.0, language_id.TRUST / len(at)) if len(at) else 0.0 for k in range(n)]
        e = [np.exp(x - max(z)) for x in z]
        rows.append((page_id, host, mark[1].lower() if mark else "", [x / sum(e) for x in e]))

    def added(key):
        out = {}
        for row in rows:
            own = out.setdefault(key(row), [0.0] * n)
            for k in range(n):
                own[k] += row[3][k]
        return out

    def smoothed(counts, parent):
        return [(c + language_id.STRENGTH * p) / (sum(counts) + language_id.STRENGTH) for c, p in zip(counts, parent)]

    last = lambda host, k: (lambda parts: ".".join(parts[-k:]) if len(parts) >= k and all(parts[-k:]) else "")(host.split("."))
    hosts, domains = added(lambda r: r[1]), added(lambda r: last(r[1], 2))
    suffixes, marks = added(lambda r: last(r[1], 1)), added(lambda r: r[2])
    everywhere = added(lambda r: 0).get(0, [0.0] * n)
    overall = smoothed(everywhere, [1 / n] * n)
    out = {}
    for page_id, host, mark, text in rows:
        prior = smoothed(domains[last(host, 2)], smoothed(suffixes[last(host, 1)], overall))
        prior = smoothed([max(c - t, 0.0) for c, t in zip(hosts[host], text)], prior)
        likely = [(c + 0.5) / (t + 0.5 * len(marks)) for c, t in zip(marks[mark], everywhere)]
        product = [max(a, 1e-30) * b * c for a, b, c in zip(text, prior, likely)]
        best = max(range(n), key=lambda k: (product[k], -k))
        out[page_id] = (names[best], product[best] / sum(product), host, mark)
    return out


def test_languages_equal_a_plain_fusion(spark):
    folder = "/root/testdata/sf0.001"
    model = language_id.fit(language_id.sample(queries.table(spark, folder, "documents"), 60))
    pages = queries.table(spark, folder, "pages").select("page_id", "url", "html")
    more = [(1000 + k, f"http://{h}/p", f"<html lang='{l}'>{t}") for k, (h, l, t) in enumerate(
        (h, l, t) for h in ("a.example.org", "b.example.org", "localhost", "x.co.uk.", ".", "a..b") for l in ("fr", "DE-at") for t in ("", "le monde est beau", "<b")
    )] + [(2000, None, None)]
    pages = pages.unionAll(spark.createDataFrame(more, pages.schema))
    want = plain_languages([tuple(r) for r in pages.collect()], model)
    got = language_id.identify(pages, model).collect()
    assert len(got) == len(want)
    for r in got:
        lang, score, host, mark = want[r.page_id]
        assert (r.lang, r.host, r.declared) == (lang, host, mark)
        assert r.score == pytest.approx(score, rel=1e-6)


def test_language_samples_hold_each_text_once(spark):
    rows = [(1, "same", "en")] * 30 + [(None, "no id", "de")] * 5 + [(2, None, "en"), (3, "x", None), (4, "y", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(map(tuple, language_id.sample(docs, 10).collect())) == [("no id", "de"), ("same", "en"), ("y", "fr")]
    assert language_id.sample(docs, 2).count() == 2


def test_labelled_samples(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (3, "c"), (None, "d"), (5, "e")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (3, None), (None, 1), (5, 0), (6, 1)], "doc_id long, toxic int")
    every = F.lit(True)
    assert labelled.sample(docs, labels, "toxic", every, 10) == [("a", 1), ("", 1), ("e", 0)]
    assert len(labelled.sample(docs, labels, "toxic", every, 2)) <= 2
    assert labelled.sample(docs, labels, "toxic", F.col("doc_id") == 5, 10) == [("e", 0)]
    assert labelled.sample(docs, labels.limit(0), "toxic", every, 10) == []


@pytest.mark.parametrize("query", ["op7_quality_classifier", "op8_toxicity"])
def test_classifiers_of_empty_tables(spark, monkeypatch, query):
    docs, labels = odd_docs(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(queries, "table", lambda _, __, name: {"documents": docs, "labels": labels}[name])
    rows = queries.QUERIES[query](spark, "").collect()
    assert len(rows) == docs.count() and {r.score for r in rows} == {0.5}
    monkeypatch.setattr(queries, "table", lambda _, __, name: {"documents": docs.limit(0), "labels": labels}[name])
    assert queries.QUERIES[query](spark, "").collect() == []


def stems_and_endings():
    """Toxic texts with words of one stem, each ending in few of them, among clean words."""
    rng = np.random.default_rng(4)
    syllables = [a + b for a in "bdfgklmnprstvz" for b in "aeiou"]
    ends = ["".join(rng.choice(syllables, 2)) for _ in range(40)]
    clean = [w for w in ("".join(rng.choice(syllables, rng.integers(1, 5))) for _ in range(600)) if not w.startswith("quov")]
    rows = []
    for k in range(900):
        words = list(rng.choice(clean, 24))
        if k % 9 == 0:
            words[rng.integers(24)] = "quov" + ends[k // 9 % 40]
        rows.append((" ".join(words[:12]) + ". " + " ".join(words[12:]), int(k % 9 == 0)))
    return rows


def test_a_stem_with_forty_endings_is_found():
    rows = stems_and_endings()
    scorer = toxicity.fit(rows[:700])
    marks = [mark for mark in scorer.__self__.landmarks if mark.is_stem]
    assert any("quov".startswith(mark) or mark.startswith("quov") for mark in marks)
    scores = scorer([text for text, _ in rows[700:]])
    assert all((s > 0.5) == bool(label) for s, (_, label) in zip(scores, rows[700:]))
    assert scorer(["here quovxyxy there", "a qu-ovmama", "quo vadi"]).round().tolist()[:2] == [1, 1]


def test_a_very_long_word_takes_bounded_memory():
    scorer = toxicity.fit(stems_and_endings()[:400])
    text = "quov" + "x" * 1_000_000 + " " + "ab" * 500_000
    assert scorer([text, "x" * 1_000_000]).round().tolist() == [1, 0]
