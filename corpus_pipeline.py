"""Corpus pipeline: toxicity filter, exact dedup, SimHash near-dedup, PII masking, packing.

Every stage is (spark, docs, sf_dir) -> DataFrame over all that the stage before it kept; all
but the last return the columns of documents.  ``run`` writes each stage's result to the shared
folder and reads it back as the next one's input, so a lost executor costs a re-read.  What the
operators staged for a stage, and the stage before it, is removed once its result is written.

Null and empty texts are texts like any other (the empty one); rows that repeat a doc_id are rows
of their own; ties fall to the smallest doc_id, null ids last; columns besides those of documents
are carried along and never read; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starmart.llm.common import documents, scratch, staged
from starmart.llm.exact_mph import exact_dedup
from starmart.llm.packing import pack_documents
from starmart.llm.pii_bootstrap import redact
from starmart.llm.simhash_vp import simhash_groups
from starmart.llm.toxicity_crf import learn, toxicity
from starmart.session import drop_work


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays under the operator's threshold.

    Null and empty texts are scored too; rows that repeat a doc_id are judged each by its own text, and each can teach
    the tagger if its id is labelled; without labels nothing is rejected.
    """
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity(docs, model).where("predicted = 0").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first of the documents whose texts are equal up to white space.

    The smallest doc_id stays, null ids last; of rows that repeat that id one stays; null texts equal empty ones.
    """
    return exact_dedup(docs).where("kept").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the one with the smallest doc_id, null ids last.

    Null, empty and wordless texts have the fingerprint zero and form a group like any other.
    """
    return simhash_groups(docs).where("kept").select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with the personal data in its text replaced by its kind; null texts stay null, n_chars follows."""
    return redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of every document, placed in training sequences; null and empty texts are their end id alone."""
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("PII", mask_personal_data),
    ("packing", pack),
]

ORACLE_SQL = None  # SQL cannot express the trained tagger; tests/llm/test_pipeline.py compares with plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = documents(spark, sf_dir), None
    for name, stage in STAGES:
        with scratch(spark) as made:
            docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-').lower()}")
            result = made.pop()
        if last:
            drop_work(spark, last)
        last = result
    return docs


QUERIES = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
