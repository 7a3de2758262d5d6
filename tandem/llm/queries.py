"""Registered queries of the subpackage: ``opN_<name>`` with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm import (decontaminate, divergence, fingerprint, katz, langid, licenses, minhash, mixing, oracles, pii,
                        token_counts, token_store, topk, whitening)
from tandem.session import read_table, scratch_path

END_ID = 2


def tokenizer_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def remainder(key: str, n: int):
    """crc32 of the key as text, modulo n (a null key: of the empty text)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % n


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), tokenizer_file())


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", (remainder("doc_id", 10) == 0).alias("held"))
    return katz.katz_scores(docs, "held")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(documents(spark, sf_dir))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(
        "doc_id", "text", "lang", (remainder("doc_id", 4) == 2).alias("held_out"))
    langs, table = langid.train(docs.where(~F.col("held_out")).select("text", "lang"))
    return langid.identify(docs.drop("lang"), langs, table, carry=("held_out",))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(documents(spark, sf_dir))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_store.write_tokens(documents(spark, sf_dir), path, tokenizer_file(), END_ID)
    return token_store.read_documents(spark, path)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(documents(spark, sf_dir))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op13_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_topk(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_token_counts, op2_lm_scoring, op3_fingerprints, op4_language_id, op5_license_scan,
        op6_near_duplicates, op7_token_store, op8_mixing, op9_pii, op10_decontamination, op11_source_divergence, op12_whitening,
        op13_exact_topk)}
ORACLES: dict[str, str] = {
    "op6_near_duplicates": oracles.NEAR_DUPLICATES, "op8_mixing": oracles.MIXING,
    "op10_decontamination": oracles.CONTAMINATION,
    "op11_source_divergence": oracles.SOURCE_DIVERGENCE, "op13_exact_topk": oracles.EXACT_TOPK}
