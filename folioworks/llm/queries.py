"""The operators on the given tables, one query each, with the parameters they are meant to run with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from folioworks.llm.chat import repaired_turns
from folioworks.llm.common import read
from folioworks.llm.copies import exact_copies
from folioworks.llm.credentials import secret_report
from folioworks.llm.decontamination import leak_report
from folioworks.llm.embeddings import near_embeddings
from folioworks.llm.language import identified, learned
from folioworks.llm.lines import without_repeated_lines
from folioworks.llm.minhash import near_documents
from folioworks.llm.mixing import mixed
from folioworks.llm.oracles import ORACLES
from folioworks.llm.passages import passage_report
from folioworks.llm.phrases import collocations
from folioworks.llm.spelling import spelling_variants
from folioworks.llm.suffixes import string_report


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items held by each document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    report = leak_report(docs, read(spark, sf_dir, "benchmark"))
    return report.select("doc_id", "item_ids", "similarity", "contaminated")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document; the source is the owner, a distinct text a repository."""
    return secret_report(read(spark, sf_dir, "documents"))


def op3_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 100-byte strings of all documents."""
    return string_report(read(spark, sf_dir, "documents"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation repaired and rendered."""
    return repaired_turns(read(spark, sf_dir, "conversations"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents."""
    return near_documents(read(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = learned(docs, F.coalesce(part != 1, F.lit(True)))
    return identified(docs.drop("lang"), model).select(
        "doc_id", F.coalesce(part == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 50-word passages of all documents."""
    return passage_report(read(spark, sf_dir, "documents"))


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated lines of each document, and a digest of what is left."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_removed", "n_runs",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate embeddings of each label."""
    return near_embeddings(read(spark, sf_dir, "embeddings"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by source along the curriculum."""
    return mixed(read(spark, sf_dir, "documents")).drop("positions")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the more frequent words they are variants of."""
    return spelling_variants(read(spark, sf_dir, "documents"))


def op12_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies among all documents."""
    return exact_copies(read(spark, sf_dir, "documents"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of each language."""
    return collocations(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_secrets": op2_secrets,
    "op3_suffixes": op3_suffixes,
    "op4_chat": op4_chat,
    "op5_minhash": op5_minhash,
    "op6_language": op6_language,
    "op7_passages": op7_passages,
    "op8_lines": op8_lines,
    "op9_embeddings": op9_embeddings,
    "op10_mixing": op10_mixing,
    "op11_spelling": op11_spelling,
    "op12_copies": op12_copies,
    "op13_phrases": op13_phrases,
}

__all__ = ["ORACLES", "QUERIES"]
