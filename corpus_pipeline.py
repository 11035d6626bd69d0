"""A corpus from documents to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestream.llm.catalog import public_tokenizer
from tidestream.llm.jaccard_join import keep_one_per_component
from tidestream.llm.language_id import fit_bounds, fit_languages, keep_known_languages
from tidestream.llm.line_dedup import remove_boilerplate
from tidestream.llm.mixing import take_mix
from tidestream.llm.packing import pack
from tidestream.llm.storage import read_documents
from tidestream.session import stored

def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; profiles and bounds are learned from the stage's own input.

    Null texts and texts without letters go; null languages, sources and ids do not matter.
    """
    model = fit_languages(docs)
    return keep_known_languages(docs, model, bounds=fit_bounds(docs, model))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many sites share, however short; `n_chars` follows the new text."""
    return remove_boilerplate(docs).withColumn("n_chars", F.length("text").cast("long"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every component of near duplicates; repeated rows are folded into one."""
    return keep_one_per_component(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a row for every copy, none for texts without words."""
    return take_mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every copy lies in the training sequences."""
    return pack(docs, public_tokenizer())


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("jaccard_join", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# The language profiles and the tokenizer have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`, each written and read back before the next."""
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
