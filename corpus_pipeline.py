"""The corpus pipeline: language, repeated lines, near duplicates, benchmark leaks, mixing; in this order.

Each stage takes the documents its predecessor kept, with the columns of ``documents``, and returns those it keeps;
the last returns the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from folioworks.functions.binding import free_names
from folioworks.llm.common import WORD, read, staged
from folioworks.llm.decontamination import leak_report
from folioworks.llm.language import identified, learned
from folioworks.llm.lines import without_repeated_lines
from folioworks.llm.minhash import Near, near_rows, row_key
from folioworks.llm.mixing import mixed


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents whose language is not recognised; the model learns from the labelled ones."""
    return identified(docs, learned(docs, F.lit(True))).filter("not rejected").select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete repeated lines; documents that lose all their words by it are copies and go."""
    left = without_repeated_lines(docs).filter((F.col("n_removed") == 0) | F.col("text").rlike(WORD))
    length = F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", length).select(docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of each group of near duplicates what stands under its smallest id; of a group without any id, all.

    Rows are judged each by itself: others of the same id, or others without one, go or stay by their own texts.
    """
    names = free_names(docs.columns, "key_of_copy", "text_key_of_copy")
    out = near_rows(docs, Near(percent=80)).filter("not kept").select("key", "text_key").distinct().toDF(*names)
    same = [own == F.col(name) for own, name in zip(row_key(), names, strict=True)]
    return docs.join(staged(out), same, "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that hold an item of the benchmark."""
    return leak_report(docs, read(spark, sf_dir, "benchmark")).filter("not contaminated").select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What training takes of each document, and when."""
    return mixed(docs)


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near", near),
    ("decontamination", decontamination),
    ("mix", mix),
]

ORACLE_SQL = None  # a trained model and signatures are not SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
