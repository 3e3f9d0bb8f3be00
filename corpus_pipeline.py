"""From raw documents to token ids: five stages, each written as Parquet and read again by the next.

The first and the last store their rows themselves: whoever writes them then, Python gets them in small batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.llm import decontaminate, line_dedup, near_dup, sentencepiece_bpe, toxicity
from haulmark.llm.common import table
from haulmark.llm.queries import piece_model
from haulmark.session import new_folder, pin, small_batches


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject; it is fitted on the labelled ones among them."""
    model = toxicity.fit_chain(docs, table(spark, sf_dir, "labels"))
    return pin(toxicity.keep_clean(docs, model), "clean")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a smaller document holds."""
    kept = line_dedup.drop_repeated_lines(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_dup.keep_one_of_each_class(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs, nor a long part of one: line dedup may have taken lines out of it."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), part_chars=decontaminate.PART_CHARS)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the text they decode to."""
    encoded = sentencepiece_bpe.encode(docs, piece_model())
    decoded = sentencepiece_bpe.decode(encoded, piece_model())
    tokens = decoded.select(F.col("id").alias("doc_id"), F.size("ids").cast("bigint").alias("n_tokens"), "ids", "decoded")
    return pin(tokens, "tokens")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("sentencepiece", tokenise),
]

#: A fitted classifier and a tokenizer are beyond SQL; tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        kept = stage(spark, docs, sf_dir)
        with small_batches(spark):
            kept.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
