"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.bpe_words import decode_documents, encode_documents
from starmart.llm.common import documents
from starmart.llm.exact_mph import exact_dedup
from starmart.llm.matched_packing import pack_matched
from starmart.llm.merkle_manifest import merkle_manifest
from starmart.llm.merkle_sql import MANIFEST
from starmart.llm.packing import pack_documents
from starmart.llm.paragraph_minhash import PASSAGE_WORDS, dedup_paragraphs
from starmart.llm.pii_bootstrap import find_pii
from starmart.llm.quotes import link_quotations, with_quotes
from starmart.llm.quotes_sql import LINKED, LINKED_RENDERED
from starmart.llm.repetition import repetition_rules
from starmart.llm.repetition_sql import RULES
from starmart.llm.simhash_vp import simhash_groups
from starmart.llm.substring_lpf import remove_repeats
from starmart.llm.token_alignment import align_tokens
from starmart.llm.toxicity_crf import learn, toxicity


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(documents(spark, sf_dir), carry=["doc_id"]).select("doc_id", "fingerprint", "component_id")


def op2_substring_lpf(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(documents(spark, sf_dir), carry=["doc_id"]).drop("pii_spans")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def op4_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_quotations(conversations(spark, sf_dir))


def op4_quotation_linking_rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over the conversations with every message quoting earlier ones, since the table itself holds no quotes."""
    return link_quotations(with_quotes(conversations(spark, sf_dir)))


def op5_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_paragraphs(documents(spark, sf_dir), passage_words=PASSAGE_WORDS)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity(docs, model, carry=["doc_id"])


def op7_bpe_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decode_documents(encode_documents(documents(spark, sf_dir)))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_rules(documents(spark, sf_dir))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack_documents(documents(spark, sf_dir))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup(documents(spark, sf_dir), carry=["doc_id"])
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_matched_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack_matched(documents(spark, sf_dir))
    return out.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    out = merkle_manifest(documents(spark, sf_dir), tampered, F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(documents(spark, sf_dir))[0]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_substring_lpf": op2_substring_lpf,
    "op3_pii": op3_pii,
    "op4_quotation_linking": op4_quotation_linking,
    "op4_quotation_linking_rendered": op4_quotation_linking_rendered,
    "op5_paragraph_minhash": op5_paragraph_minhash,
    "op6_toxicity": op6_toxicity,
    "op7_bpe_words": op7_bpe_words,
    "op8_repetition": op8_repetition,
    "op9_packing": op9_packing,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_matched_packing": op11_matched_packing,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE: dict[str, str] = {
    "op4_quotation_linking": LINKED,
    "op4_quotation_linking_rendered": LINKED_RENDERED,
    "op8_repetition": RULES,
    "op12_merkle_manifest": MANIFEST,
    "op10_exact_dedup": r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
""",
}
