"""Queries of the training-data operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import codes, divergence, hnsw, katz, language, mixing, packing, pieces, setsketch, suffixes, token_files, topk, toxicity

#: Vocabulary files of public tokenizers; a folder of the machine that runs the driver.
TOKENIZERS = "/opt/tokenizers"
#: How the byte-level vocabulary cuts texts before merging; a fixed value of that vocabulary.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = token_files.load_ranks(f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    return token_files.count_tokens(read(spark, sf_dir, "documents"), ranks, BYTE_PATTERN)


@query("op2_top_products")
def op2_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op4_near_duplicates")
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(read(spark, sf_dir, "documents"))


@query("op5_katz")
def op5_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_documents(read(spark, sf_dir, "documents"))


@query("op6_language")
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read(spark, sf_dir, "documents"))


@query("op7_sentencepiece")
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = pieces.load_vocabulary(f"{TOKENIZERS}/piece_bpe_32k.model")
    return pieces.encode(read(spark, sf_dir, "documents"), vocabulary)


@query("op8_mix_sources")
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sizes(read(spark, sf_dir, "documents"))


@query("op9_repeats")
def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(read(spark, sf_dir, "documents"))


@query("op10_nearest")
def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op12_source_divergence")
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


SQL["op12_source_divergence"] = divergence.SQL


@query("op13_vector_codes")
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(read(spark, sf_dir, "embeddings"))


SQL["op13_vector_codes"] = codes.SQL


@query("op11_best_fit_packing")
def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = packing.load_ranks(f"{TOKENIZERS}/byte_bpe_50k.json")
    return packing.pack(read(spark, sf_dir, "documents"), ranks, BYTE_PATTERN)
