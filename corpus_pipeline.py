"""Corpus pipeline over ``documents``: judge, deduplicate, decontaminate, pack.

Each stage calls one operator on all that its predecessor kept and gets the
previous stage's rows from a written table. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.common import materialize
from starloom.llm.decontam import drop_contaminated
from starloom.llm.packing import pack_documents
from starloom.llm.quality import drop_rejected
from starloom.llm.suffix import cut_repeats
from starloom.llm.superminhash import NearDup, drop_near_duplicates


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are probably of low quality or toxic go."""
    return drop_rejected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five-word shingles, 0.8)."""
    return drop_near_duplicates(docs, params=NearDup(shingle=5, num=80))


def cut_repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings of 200 bytes that also stand elsewhere go; rows stay."""
    return cut_repeats(docs, chars_col="n_chars")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more is benchmark windows go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), null_ids_stay=False)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 1024 ids, as pieces of documents."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", reject_low_quality),
    ("minhash near-dedup", near_dedup),
    ("suffix-array dedup", cut_repeated_text),
    ("benchmark decontamination", decontaminate),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, "pipeline-stage")
    return docs


ORACLE_SQL = None  # trained classifier and tokenizer; tested against brute force
