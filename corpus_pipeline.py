"""A corpus from raw documents to packed sequences, stage by stage.

Every stage takes (spark, docs, sf_dir); its result is written and read again as
the next one's documents.  All but the last return the columns of documents,
with ``n_chars`` following the text.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import jaccard_join, packing, pii, quality_rules, suffix_dedup
from revlens.llm.queries import WORD_TOKENIZER, table, tokenizer_path
from revlens.session import materialize


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule."""
    return quality_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar ones: that of the smallest id."""
    return jaccard_join.first_of_classes(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without strings of 100 bytes that occur earlier."""
    return _counted(suffix_dedup.remove(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return _counted(pii.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(packing.pieces(docs, tokenizer_path(WORD_TOKENIZER)))


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", repeated_strings),
    ("pii", personal_data),
    ("best_fit_packing", pack),
]

#: Similarity classes, tokenizer ids and packing are beyond SQL; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
