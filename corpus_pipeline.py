"""The corpus pipeline: quality, line dedup, near-duplicates, benchmark passages, token ids.

Each stage takes the documents its predecessor kept and returns documents with the same columns; the last returns
token ids' digests. Stages read their other tables from the folder of the given tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rosterlake.llm import byte_bpe, decontamination, line_crf, lines, simhash
from rosterlake.session import settle


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled ones of these documents."""
    model = line_crf.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = docs.withColumn("__score", line_crf.quality(F.col("text"), model))
    # without any label there is nothing to reject by
    return (scored.filter(F.col("__score") >= line_crf.THRESHOLD) if model else scored).drop("__score")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an equal or nearly equal line comes before."""
    return _measured(lines.without_repeats(docs))


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark, also none with words a place off."""
    return decontamination.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), slop=decontamination.SLOP)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids' number and digests of each document left."""
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN)


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else docs


STAGES = [
    ("quality", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("simhash", keep_one_of_copies),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

#: The stages' decisions (a trained model, edit distances, XXH64 bits, ranked merges) are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
