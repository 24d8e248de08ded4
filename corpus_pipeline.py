"""From raw documents to packed training sequences: five stages, each written to the shared folder and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import ngram_join, packing, private_data, quality, suffix_dedup
from rowloom.llm.common import table
from rowloom.session import shared_path

SEQUENCE_TOKENS = 2048
VOCABULARY = "byte_bpe_50k.json"


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps: neither junk nor toxic."""
    model = quality.fit_cotraining(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_documents(docs, model, extra=docs.columns).where(F.col("score") >= quality.KEEP_FROM)
    return scored.select(*[F.col(f"extra_{i}").alias(c) for i, c in enumerate(docs.columns)])


def unlike_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each class of near duplicates; of rows repeated with id and text, one."""
    classes = ngram_join.similar_documents(docs)
    least = classes.where(F.col("id").eqNullSafe(F.col("class_id"))).groupBy("id").agg(
        (F.count(F.lit(1)) > 1).alias("several")
    ).withColumnRenamed("id", "kept_id")
    stay = docs.join(least, docs["doc_id"].eqNullSafe(least["kept_id"]))
    once = stay.where("not several")
    again = stay.where("several").dropDuplicates(["doc_id", "text"])
    return once.unionByName(again).select(*docs.columns)


def unrepeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that earlier documents hold; all documents stay."""
    text = suffix_dedup.as_valid_text(F.col("kept"))
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    rest = [c for c in docs.columns if c not in new]
    cut = suffix_dedup.remove_repeats(docs, extra=rest)
    return cut.select(*[(new[c] if c in new else F.col(f"extra_{rest.index(c)}")).alias(c) for c in docs.columns])


def redacted_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; all documents stay."""
    clean = private_data.redact(docs, private_data.fit_private(docs)).drop("private_spans")
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences."""
    path = public_tokenizers.path(VOCABULARY)
    return packing.pack_documents(docs, path, SEQUENCE_TOKENS).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_classifier", good_documents),
    ("ngram_jaccard_join", unlike_documents),
    ("suffix_array_dedup", unrepeated_text),
    ("private_data", redacted_text),
    ("best_fit_packing", packed_sequences),
]

#: Fitted classifiers decide in the first and fourth stage, which SQL cannot express. Tests run the whole chain on a small
#: fixture and compare every stage after the first with a brute-force version on what its predecessor kept.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
