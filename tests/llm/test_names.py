"""Extra columns may have any name that the operators use inside."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import folioworks
from folioworks.llm.chat import repaired_turns
from folioworks.llm.copies import exact_copies
from folioworks.llm.credentials import secret_report
from folioworks.llm.decontamination import leak_report
from folioworks.llm.embeddings import near_embeddings
from folioworks.llm.language import identified, learned
from folioworks.llm.lines import without_repeated_lines
from folioworks.llm.minhash import near_documents
from folioworks.llm.mixing import mixed
from folioworks.llm.passages import passage_report
from folioworks.llm.phrases import Phrases, collocations
from folioworks.llm.spelling import spelling_variants
from folioworks.llm.suffixes import string_report

SF = "/root/testdata/sf0.001"


def inner_names():
    """Everything that may be a column name in the sources."""
    home = Path(folioworks.__file__).parent
    sources = [*home.glob("llm/*.py"), home / "functions/binding.py", Path(corpus_pipeline.__file__)]
    text = "\n".join(p.read_text() for p in sources)
    found = re.findall(r"""["']([A-Za-z_]\w*)["']""", text) + re.findall(r"""["' ,(]([a-z_]\w*) (?:bigint|string|int|array|boolean)""", text)
    return sorted({n.lower() for n in found})


def crowded(df):
    """``df`` with a column of every such name that it does not have."""
    own = {c.lower() for c in df.columns}
    return df.select("*", *(F.lit(i).alias(n) for i, n in enumerate(inner_names()) if n not in own))


def benchmark(docs):
    return docs.sparkSession.read.parquet(f"{SF}/benchmark.parquet")


OPERATORS = {
    "leak_report": ("documents", lambda d: leak_report(d, benchmark(d))),
    "leak_report_items": ("documents", lambda d: leak_report(d, crowded(benchmark(d)))),
    "secret_report": ("documents", secret_report),
    "string_report": ("documents", string_report),
    "repaired_turns": ("conversations", repaired_turns),
    "near_documents": ("documents", near_documents),
    "identified": ("documents", lambda d: identified(d, learned(d, F.lit(True)))),
    "passage_report": ("documents", passage_report),
    "without_repeated_lines": ("documents", without_repeated_lines),
    "near_embeddings": ("embeddings", near_embeddings),
    "mixed": ("documents", mixed),
    "spelling_variants": ("documents", spelling_variants),
    "exact_copies": ("documents", exact_copies),
    "collocations": ("documents", lambda d: collocations(d, Phrases(support=30))),
    **{f"stage_{name}": ("documents", lambda d, stage=stage: stage(d.sparkSession, d, SF)) for name, stage in corpus_pipeline.STAGES},
}


@pytest.mark.parametrize("name", OPERATORS)
def test_no_name_clashes(spark, name):
    table, operator = OPERATORS[name]
    rows = spark.read.parquet(f"{SF}/{table}.parquet")
    rows = rows.limit(60) if table == "documents" else rows.limit(120)
    plain = operator(rows)
    busy = operator(crowded(rows))
    assert set(plain.columns) <= set(busy.columns)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, busy.select(plain.columns).collect()))


def test_the_names_are_found():
    assert {"key_of_leak", "has_letter", "lines_repeated", "key_of_copy", "hash", "_values", "text_key", "part"} <= set(inner_names())
