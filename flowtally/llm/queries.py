"""Registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, byte_bpe, exact_dedup, language, licenses, minhash, mixing, oracles, packing, pitman_yor, records, simhash, url_filter, whitening
from .common import table

RULES = [
    url_filter.Rule("net", "/", False),
    url_filter.Rule("example.net", "/en/", True),
    url_filter.Rule("example.com", "/de/", False),
    url_filter.Rule("org", "/fr/", True),
]
END_ID = 1


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judged(table(spark, sf_dir, "pages"), RULES)
    return judged.withColumn("score", F.round("score", 6))  # sums of doubles differ in their last digits


def op2_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.scores(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_bpe.token_digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.fingerprints(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identified(docs, language.fit(docs))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.word_lengths(table(spark, sf_dir, "documents")))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.text_owners(table(spark, sf_dir, "documents"), largest=True)


def op9_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        definition = file.read()
    return records.round_trip(table(spark, sf_dir, "documents"), definition, END_ID)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        byte_bpe_file = file.read()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        pieces = file.read()
    definitions = alignment.Definitions(byte_bpe_file, public_tokenizers.PATTERN, pieces)
    return alignment.scores(table(spark, sf_dir, "documents"), definitions)


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.document_shares(mixing.mix(table(spark, sf_dir, "documents")))


LLM_QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filter, op2_pitman_yor, op3_byte_bpe, op4_minhash, op5_simhash,
        op6_language, op7_packing, op8_exact_dedup, op9_records, op10_licenses,
        op11_whitening, op12_alignment, op13_mixing,
    )
}

LLM_SQL = {
    "op1_url_filter": oracles.url_filter_sql(RULES),
    "op8_exact_dedup": oracles.EXACT_DEDUP,
    "op10_licenses": oracles.licenses_sql(),
}
