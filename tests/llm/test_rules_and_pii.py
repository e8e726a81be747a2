"""Quality rules and personal data against plain Python over whole texts."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from revlens.llm import pii, quality_rules, queries
from tests.llm.samples import DOC_SCHEMA, odd_docs

PII_TEXTS = [
    "write to ann.b+c@mail4.example.com, or x@y or @z.de a@b.c.@d.e",
    "a@b.c_x@d.e a@@b.c -@-.-",
    "hosts 10.0.0.255 and 10.0.0.256, 001.002.003.0004 1.2.3.4.5.6.7.8 9999999999999.1.1.1",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112 and 5500005555555559 1 2 3",
    "é☃\U0001f600 4111111111111111 7" + "0" * 30,
    "call +1 (974) 555-3436 now, +49 30 123456 7 x +12 +1(2) +123456789012345 +1234567890123456",
    "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432, not GB83WEST12345698765432",
    'token = "3fdf5a35c7b8d733c0b5c7d364eda8ac88d929d1" and 3fdf5a35c7b8d733c0b5c7d364eda8ac88d929d1' + "z",
    "+" * 50 + "1" * 3000 + "@" * 40 + "." * 30,
    ("m" * 3000 + "@") * 2 + "a." * 3000,
    "a@b.cd " * 1500,
]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def plain_spans(text):
    text = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(out)]


def listed(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def test_base_spans_equal_plain_matching(spark, monkeypatch):
    docs = odd_docs(spark).unionByName(odd_docs(spark, PII_TEXTS, repeats=False))
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    got = Counter(tuple(r) for r in queries.op3_pii(spark, "").drop("spans").collect())
    want = Counter()
    for r in docs.collect():
        spans = plain_spans(r.text)
        n = Counter(k for k, _, _ in spans)
        want[(r.doc_id, n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(listed(spans).encode()).hexdigest())] += 1
    assert got == want


def test_checks_and_context_add_spans(spark):
    docs = spark.createDataFrame(list(enumerate(PII_TEXTS)), "doc_id long, text string")
    found = {r.doc_id: [(s.kind, s.hit) for s in r.spans if s.kind in ("iban", "secret")] for r in pii.find(docs).collect()}
    assert found[6] == [("iban", "DE89 3704 0044 0532 0130 00"), ("iban", "GB82WEST12345698765432")]
    assert found[7] == [("secret", "3fdf5a35c7b8d733c0b5c7d364eda8ac88d929d1")]
    assert not any(found[i] for i in range(6))


def test_scores_follow_checks_and_context(spark):
    texts = ["mail me: a@b.de", "a@b.de"]
    near, far = [r.spans[0].score for r in pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert near > far >= 0.5


def test_redaction_keeps_rows_and_columns(spark):
    rows = [(1, "to a@b.de and é 10.0.0.1!", "x"), (2, "nothing", "y"), (3, None, None), (1, "to a@b.de", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted(map(tuple, pii.redact(docs).collect()), key=str)
    want = [(1, "to <EMAIL> and é <IP>!", "x"), (2, "nothing", "y"), (3, None, None), (1, "to <EMAIL>", "z")]
    assert got == sorted(want, key=str)


def test_no_rows(spark):
    empty = spark.createDataFrame([], DOC_SCHEMA)
    assert pii.find(empty).count() == pii.redact(empty).count() == quality_rules.judge(empty).count() == 0
    assert quality_rules.keep(empty).columns == empty.columns


WS = "[^\\x20\\x09-\\x0D]+"


def plain_counts(text):
    text = text or ""
    words = re.findall(WS, text)
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(WS, x)]
    n, rep = len(words), len(hit)
    return (
        n,
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        rep,
        n < 50 or 100 * rep > 50 * n,
    )


def test_measures_equal_plain_counting(spark, monkeypatch):
    texts = ["a b c a b c a b c d", "# | <x> **\n- a\n- a\n- b...", "a b\na b\n\n a b \r\n", "x y z " * 40 + "p q r s"]
    docs = odd_docs(spark).unionByName(odd_docs(spark, texts, repeats=False))
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    rows = queries.op5_quality_rules(spark, "").collect()
    assert Counter(tuple(r)[:7] for r in rows) == Counter((r.doc_id, *plain_counts(r.text)) for r in docs.collect())
    assert not any(r.kept for r in rows if r.base_failed)


def test_rules_are_data(spark):
    docs = spark.createDataFrame([(1, "a b c", "x"), (2, "a b", "y")], "doc_id long, text string, n_words string")
    rules = (quality_rules.Rule("three", "n_words", least=3),)
    assert [r.doc_id for r in quality_rules.keep(docs, rules).collect()] == [1]
    assert [tuple(r) for r in quality_rules.judge(docs, rules).select("doc_id", "failed").orderBy("doc_id").collect()] == [(1, []), (2, ["three"])]


@pytest.mark.parametrize("name", ["n_words", "kept", "measures"])
def test_clashing_names(spark, name):
    docs = spark.createDataFrame([(1, "word " * 3, "x")], f"doc_id long, text string, {name} string")
    assert quality_rules.keep(docs).columns == docs.columns
    assert quality_rules.judge(docs).filter(F.col("kept")).count() == 0
