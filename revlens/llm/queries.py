"""The operators over the given tables, one query each, with production parameters."""

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import (
    ann,
    centroids,
    jaccard_join,
    labelled,
    language_id,
    mixing,
    packing,
    piece_model,
    pii,
    quality_net,
    quality_rules,
    resample,
    suffix_dedup,
    toxicity,
)

#: Vocabulary files of public tokenizers.
WORD_TOKENIZER = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, if it is not installed there."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return ann.search(rows.filter("vec_id % 100 = 0"), rows, k=10)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = [kind.name for kind in pii.KINDS if kind.base]
    n_of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return pii.find(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *map(n_of, base),
        F.sha2(_listed(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_model.encode(table(spark, sf_dir, "documents"), tokenizer_path(PIECE_MODEL))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words").alias("base_failed"),
        "kept",
        F.array_join("failed", ",").alias("failed"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language_id.fit(language_id.sample(table(spark, sf_dir, "documents")))
    return language_id.identify(table(spark, sf_dir, "pages"), model)


def _judged(scored: DataFrame, folds: int, held_out: int) -> DataFrame:
    return scored.select(
        "doc_id",
        F.coalesce(labelled.remainder(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    usable = labelled.remainder(F.col("doc_id"), 3) != 1
    scorer = quality_net.fit(labelled.sample(docs, labels, "quality", usable, quality_net.TRAIN_ROWS))
    return _judged(quality_net.score(docs, scorer), 3, 1)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    usable = labelled.remainder(F.col("doc_id"), 5) != 0
    scorer = toxicity.fit(labelled.sample(docs, labels, "toxic", usable, toxicity.TRAIN_ROWS))
    return _judged(toxicity.score(docs, scorer), 5, 0)


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packing.pieces(table(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER))
    return packing.pack(rows)


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.summarised(*centroids.cluster(table(spark, sf_dir, "embeddings")))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {
    query.__name__: query
    for query in (
        op1_ann,
        op2_suffix_dedup,
        op3_pii,
        op4_sentencepiece,
        op5_quality_rules,
        op6_language_id,
        op7_quality_classifier,
        op8_toxicity,
        op9_ngram_jaccard,
        op10_best_fit_packing,
        op11_centroid_clustering,
        op12_importance_resampling,
        op13_source_mixing,
    )
}
