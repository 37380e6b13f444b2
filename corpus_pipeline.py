"""A corpus pipeline: documents pass five stages, each written as Parquet and read again by the next.

1. quality rules: documents that the rules reject or that are toxic go (abusive terms are learned from a sample of labels),
2. n-gram Jaccard join: of each group of near copies the document with the smallest id stays,
3. suffix-array dedup: 50-byte strings that also start in a document with a smaller id are cut out of texts,
4. benchmark decontamination: documents that hold a benchmark window go,
5. SentencePiece: a sampled segmentation of every text that is left.

All stages but the last return the columns of documents; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import adaptive_prefix_join, piece_sampling, positional_index, suffix_radix, weak_supervision
from skyledger.llm.base import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return weak_supervision.keep_good(docs, labels=spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return adaptive_prefix_join.first_of_each(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = suffix_radix.without_repeats(docs)
    if "n_chars" in cut.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return positional_index.uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = piece_sampling.segment(docs)
    return found.select("doc_id", F.col("_pieces").alias("piece_ids"), F.size("_pieces").cast("long").alias("n_pieces"))


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]

#: Estimated accuracies and sampled segmentations can't be restated in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
