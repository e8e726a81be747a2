"""A bounded sample of labelled texts for fitting."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, by the number of folds."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, rows: int) -> list[tuple[str, int]]:
    """Texts and labels of at most ``rows`` rows, chosen by a hash of the id.

    ``usable`` is a condition on ``doc_id``.  Rows without an id or a label are left
    out; of ids labelled more than once the greatest label counts.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & usable)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = (
        texts.join(chosen, "doc_id")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.min("label").alias("label"))
        .orderBy("doc_id")
        .collect()
    )
    return [(r.text or "", r.label) for r in found]
