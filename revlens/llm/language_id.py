"""Language of web pages by Bayesian fusion of evidence.

Text: log-likelihoods of byte trigrams, learned per language from a bounded sample of
labelled documents, per trigram and scaled to ``TRUST`` trigrams as neighbours depend
on each other.  The sample's trigrams are counted by the tasks that read it, so the driver
gets counts and no text.  Address: soft counts of languages by text alone are grouped by
host; a host's prior is smoothed towards that of its domain, that towards its
suffix, and that towards all pages.  A page's own count is left out of its host's.
Markup: the declared language has a likelihood per language, from soft counts
over all pages.  The three are multiplied and normalized.

The domain is the last two labels of a host, so ``co.uk`` is one.  The declared language is that of the
first ``html`` tag that has one and no ``<`` before it.  Scripts, styles and comments without an end
are read as text, tags without an end too; a page of any length takes one scan.
Repeated rows, of one id or of none, are rows of their own; equally likely languages go to the first in
the alphabet.  A null page is an empty one, a null address an empty host.  Of sampled rows with
one id and text the least language counts.  An empty table gives no rows.  Without labelled documents
there are no languages: ``lang`` and ``score`` are null.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.session import materialize

#: Bound of the labelled sample.
TRAIN_ROWS = 3000
HASHED = 1 << 14
TRUST = 40.0
#: Pages that a parent's prior is worth.
STRENGTH = 5.0

_OPENS = re.compile(rb"(?i)<(script|style)\b")
_CLOSES = {name: re.compile(rb"(?i)</" + name + rb"\s*>") for name in (b"script", b"style")}


def trigrams(text: bytes) -> np.ndarray:
    x = np.frombuffer(b" " + text.lower() + b" ", np.uint8).astype(np.uint32)
    return ((x[:-2] * 73_856_093) ^ (x[1:-1] * 19_349_663) ^ (x[2:] * 83_492_791)) % HASHED


def visible(html: bytes) -> bytes:
    """Bytes outside tags, scripts, styles and comments, each of these replaced by a space.

    One pass: an end that is not found once is not looked for again.
    """
    out, at, missing = [], 0, set()

    def after(end, start):
        """Where the first match of ``end`` behind ``start`` ends, or -1."""
        if end in missing:
            return -1
        if isinstance(end, bytes):
            place = html.find(end, start)
            place = place + len(end) if place >= 0 else -1
        else:
            found = end.search(html, start)
            place = found.end() if found else -1
        if place < 0:
            missing.add(end)
        return place

    while (mark := html.find(b"<", at)) >= 0:
        end = -1
        opened = _OPENS.match(html, mark)
        if opened:
            end = after(_CLOSES[opened[1].lower()], opened.end())
        elif html.startswith(b"<!--", mark):
            end = after(b"-->", mark + 4)
        if end < 0:
            end = after(b">", mark + 1)
        if end < 0:  # no tag ends behind this place
            break
        out += [html[at:mark], b" "]
        at = end
    out.append(html[at:])
    return b"".join(out)


def fit(documents: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and the log-probability of each hashed trigram in each, from a sample's ``lang`` and ``text``."""

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if lang not in total:
                    total[lang] = np.zeros(HASHED, np.int64)
                total[lang] += np.bincount(trigrams(text.as_py()), minlength=HASHED)
        for lang, counts in total.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some)), pa.array(some, pa.int32()), pa.array(counts[some])], ["lang", "cell", "n"]
            )

    rows = documents.select(F.col("lang").cast("string"), F.col("text").cast("string").cast("binary"))
    cells = rows.mapInArrow(count, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).collect()
    names = sorted({row.lang for row in cells})
    counts = np.full((HASHED, len(names)), 0.5)
    for row in cells:
        counts[row.cell, names.index(row.lang)] += row.n
    return names, np.log(counts / counts.sum(axis=0)).astype(np.float32) if names else counts.astype(np.float32)


def sample(docs: DataFrame, rows=TRAIN_ROWS) -> DataFrame:
    """At most so many labelled documents, chosen by a hash of the id; texts are fetched for the chosen ones only."""
    labelled = docs.select(F.col("doc_id"), F.col("text"), F.col("lang"), F.xxhash64("text").alias("hashed"))
    labelled = labelled.filter("lang is not null and text is not null")
    order = [F.xxhash64("doc_id"), "doc_id", "hashed"]
    chosen = labelled.select("doc_id", "hashed").distinct().orderBy(*order).limit(rows)
    wanted = F.broadcast(chosen.select(F.col("doc_id").alias("wanted_id"), F.col("hashed").alias("wanted")))
    same = (F.col("hashed") == F.col("wanted")) & F.col("doc_id").eqNullSafe(F.col("wanted_id"))
    found = labelled.join(wanted, same).groupBy("doc_id", "hashed").agg(F.min(F.struct("lang", "text")).alias("first"))
    return found.select("first.text", "first.lang")


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.rtrim(host, F.lit("."))


def declared_in(html: Column) -> Column:
    """Primary part of the language that the markup declares, or an empty string."""
    found = F.regexp_extract(F.coalesce(html, F.lit("")), "(?i)<html\\b[^<>]*?\\blang\\s*=\\s*[\"']?([A-Za-z]{2,8})", 1)
    return F.lower(found)


def by_text(pages: DataFrame, model, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """page_id, host, declared and ``text``: the posterior of each language by text alone."""
    names, table = model
    n = len(names)

    def run(batches):
        for batch in batches:
            out = np.zeros((batch.num_rows, n))
            for k, html in enumerate(batch.column(3)):
                at = trigrams(visible((html.as_py() or "").encode("utf-8", "surrogatepass")))
                if len(at) and n:
                    out[k] = table[at].sum(axis=0, dtype=np.float64) * min(1.0, TRUST / len(at))
            out = np.exp(out - out.max(axis=1, keepdims=True)) if n else out
            out = out / out.sum(axis=1, keepdims=True) if n else out
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * n, pa.int32()), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), lists], ["page_id", "host", "declared", "text"]
            )

    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        host_of(F.col(url_col)).alias("host"),
        declared_in(F.col(html_col)).alias("declared"),
        F.col(html_col).cast("string").alias("html"),
    )
    return rows.mapInArrow(run, "page_id long, host string, declared string, text array<double>")


def _added(n: int, column="text") -> list[Column]:
    return [F.sum(F.get(column, F.lit(k))).alias(f"c{k}") for k in range(n)]


def _counts(n: int) -> Column:
    return F.array(*[F.col(f"c{k}") for k in range(n)])


def _smoothed(counts: Column, parent: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(counts, parent, lambda c, p: (c + STRENGTH * p) / (total + STRENGTH))


def identify(pages: DataFrame, model, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """page_id, lang, score (its posterior), text_lang, host and declared per row."""
    names, _ = model
    n = len(names)
    text = materialize(by_text(pages, model, id_col, url_col, html_col), "by_text")
    if not n:
        empty = F.lit(None).cast("string")
        return text.select("page_id", empty.alias("lang"), F.lit(None).cast("double").alias("score"), empty.alias("text_lang"), "host", "declared")
    domain = F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)
    suffix = F.regexp_extract("host", r"([^.]+)$", 1)
    hosts = text.groupBy("host").agg(*_added(n)).select(
        "host", domain.alias("domain"), suffix.alias("suffix"), _counts(n).alias("in_host")
    )

    def grouped(key):
        return hosts.groupBy(key).agg(*_added(n, "in_host")).select(F.col(key).alias(f"of_{key}"), _counts(n).alias(f"in_{key}"))

    everywhere = text.agg(*[F.coalesce(c, F.lit(0.0)).alias(f"c{k}") for k, c in enumerate(_added(n))]).first()
    uniform = F.array(*[F.lit(1.0 / n)] * n)
    overall = _smoothed(F.array(*[F.lit(float(x)) for x in everywhere]), uniform)
    domains, suffixes = grouped("domain"), grouped("suffix")
    priors = (
        hosts.join(domains, F.col("domain") == F.col("of_domain"))
        .join(suffixes, F.col("suffix") == F.col("of_suffix"))
        .withColumn("prior_suffix", _smoothed(F.col("in_suffix"), overall))
        .withColumn("prior_domain", _smoothed(F.col("in_domain"), F.col("prior_suffix")))
        .select(F.col("host").alias("of_host"), "in_host", "prior_domain")
    )
    markup = text.groupBy("declared").agg(*_added(n)).select(F.col("declared").alias("of_declared"), _counts(n).alias("in_declared"))
    kinds = markup.count()

    joined = text.join(priors, F.col("host") == F.col("of_host")).join(markup, F.col("declared") == F.col("of_declared"))
    own = F.zip_with("in_host", "text", lambda c, t: F.greatest(c - t, F.lit(0.0)))
    likely = F.zip_with("in_declared", F.array(*[F.lit(float(x)) for x in everywhere]), lambda c, t: (c + 0.5) / (t + 0.5 * kinds))
    product = F.zip_with(
        F.zip_with(F.col("text"), _smoothed(own, F.col("prior_domain")), lambda a, b: F.greatest(a, F.lit(1e-30)) * b),
        likely,
        lambda a, b: a * b,
    )
    total = F.aggregate("product", F.lit(0.0), lambda a, x: a + x)
    label = F.array(*[F.lit(x) for x in names])

    def named(column):
        return F.get(label, (F.array_position(column, F.array_max(column)) - 1).cast("int"))

    return joined.withColumn("product", product).select(
        "page_id",
        named("product").alias("lang"),
        (F.array_max("product") / total).alias("score"),
        named("text").alias("text_lang"),
        "host",
        "declared",
    )
