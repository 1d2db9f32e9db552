"""The registered queries of the corpus operators: each applies its operator,
with production parameters, to the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ctw import score_texts
from .decontam import contamination
from .embeddings import similar_vectors
from .langid import declared_language, identify, page_text, url_host
from .lexical import rank_documents
from .licenses import scan_licenses
from .mixing import mix_sources
from .oracles import ORACLES
from .packing import pack_documents
from .quality import classify
from .suffix import repeat_digest
from .superminhash import NearDup, near_duplicates
from .tokens import read_token_files, write_token_files
from .trie import conversation_trie


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), params=NearDup(3, 85, 100))


def op2_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (no markup; the source is their site) and web pages together."""
    docs, pages = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "pages")
    null = F.lit(None)
    rows = docs.select("doc_id", null.cast("long").alias("page_id"), "text", null.cast("string").alias("markup"),
                       F.col("source").alias("host"))
    rows = rows.unionByName(pages.select(
        null.cast("long").alias("doc_id"), "page_id", page_text(F.col("html")).alias("text"),
        declared_language(F.col("html")).alias("markup"), url_host(F.col("url")).alias("host")))
    return identify(rows, docs).withColumnRenamed("lang_id", "lang").drop("host")


def op4_pca_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_vectors(_table(spark, sf_dir, "embeddings"))


def op5_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digest(_table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_token_files(_table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"), end_id=2)
    return read_token_files(index)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bench = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return contamination(docs, bench).drop("items", "spans")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(_table(spark, sf_dir, "conversations"))


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_superminhash, op2_harmonic_packing, op3_language_id, op4_pca_tiles, op5_context_tree,
                                   op6_suffix_dedup, op7_token_files,
                                   op8_decontamination, op9_license_scan,
                                   op10_quality_classifier, op11_conversation_trie,
                                   op12_source_mixing, op13_ranked_search)}

__all__ = ["QUERIES", "ORACLES"]
