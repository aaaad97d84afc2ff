"""Queries of the text operators over the given tables, with the parameters of production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rosterlake.llm import (
    byte_bpe, chunking, decontamination, infill, licences, line_crf, lines, minhash, simhash, sql, substrings, token_counts,
    token_files, vector_codes,
)
from rosterlake.session import run_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: The results that SQL can express; tests hold every operator against a brute-force version.
ORACLES: dict[str, str] = {
    "op11_vector_codes": sql.vector_codes(vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS, vector_codes.SCALE),
    "op12_infill": sql.INFILL, "op13_minhash": sql.MINHASH,
}

PIECES, RANKS, TOKENIZER = "piece_bpe_32k.model", "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"
TOKEN_LIMIT, END_ID = 4096, 2


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """SimHash components of all documents: 3-word shingles, 3 bits."""
    return simhash.near_duplicates(table(spark, folder))


@query
def op2_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Licence notices and tags of all documents."""
    return licences.scan(table(spark, folder))


@query
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Sentence-piece tokens of all documents."""
    return token_counts.count_tokens(table(spark, folder), public_tokenizers.path(PIECES), TOKEN_LIMIT)


@query
def op4_substrings(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of 50 words that earlier documents have too, removed."""
    return substrings.remove_repeated(table(spark, folder)).drop("spans")


@query
def op5_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Chunk fingerprints of all documents and their edited texts, with their likeness."""
    return chunking.with_edits(table(spark, folder))


@query
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of all documents that an equal line, or a nearly equal one, comes before."""
    return lines.line_report(table(spark, folder))


@query
def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Byte-level BPE ids of all documents, and their round trip."""
    ranks = byte_bpe.load_ranks(public_tokenizers.path(RANKS))
    return byte_bpe.encode_documents(table(spark, folder), ranks, public_tokenizers.PATTERN)


@query
def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of all documents, written to framed files in the shared folder and read back."""
    path = run_folder(spark, "tokens")
    token_files.write_tokens(table(spark, folder), public_tokenizers.path(TOKENIZER), path, END_ID)
    return token_files.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of all documents, learnt from the labels that are not held out."""
    return line_crf.classify(table(spark, folder), table(spark, folder, "labels"))


@query
def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark windows of 10 words in all documents, and items that only match with words a place off."""
    found = decontamination.find_items(table(spark, folder), table(spark, folder, "benchmark"), slop=decontamination.SLOP)
    return found.drop("items")


@query
def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of all embeddings: 16 parts, 64 entries, two rounds."""
    return vector_codes.compress(table(spark, folder, "embeddings"))


@query
def op12_infill(spark: SparkSession, folder: str) -> DataFrame:
    """All documents put together for filling in the middle, and the round trip."""
    return infill.report(table(spark, folder))


@query
def op13_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicates of all documents: 2-word shingles, similarity of 0.8."""
    return minhash.near_duplicates(table(spark, folder))
