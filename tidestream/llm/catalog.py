"""The registered queries of this package: every operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestream.llm.exact_dedup import exact_groups
from tidestream.llm.fingerprints import fingerprint_documents
from tidestream.llm.jaccard_join import jaccard_components
from tidestream.llm.language_id import fit_languages, identify
from tidestream.llm.license_scan import scan_licenses
from tidestream.llm.line_dedup import clean_texts
from tidestream.llm.mixing import mix_copies
from tidestream.llm.packing import pack
from tidestream.llm.quality import fit_quality, score_quality
from tidestream.llm.ranked_search import search
from tidestream.llm.simhash import simhash_components
from tidestream.llm.storage import read_documents
from tidestream.llm.toxicity import fit_toxicity, score_toxicity
from tidestream.llm.vector_codes import compress


def public_tokenizer() -> tuple[str, str, str]:
    """Paths of the byte-level BPE vocabulary in both forms, and its splitting pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_quality(docs, fit_quality(docs, labels))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return clean_texts(read_documents(spark, sf_dir)).select(
        "document.doc_id",
        "lines",
        "removed",
        F.length(text).cast("long").alias("cleaned_chars"),
        F.sha2(text.cast("binary"), 256).alias("cleaned_sha256"),
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_documents(spark, sf_dir))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read_documents(spark, sf_dir))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_documents(spark, sf_dir))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    return identify(docs, fit_languages(docs))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_toxicity(docs, fit_toxicity(docs, labels))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(read_documents(spark, sf_dir))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_documents(spark, sf_dir), public_tokenizer())


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mix_copies(read_documents(spark, sf_dir))
    return taken.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(read_documents(spark, sf_dir))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_line_dedup,
        op3_license_scan,
        op4_exact_dedup,
        op5_jaccard_join,
        op6_language_id,
        op7_toxicity,
        op8_fingerprints,
        op9_packing,
        op10_mixing,
        op11_vector_codes,
        op12_ranked_search,
        op13_simhash,
    )
}
