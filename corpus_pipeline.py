"""The corpus pipeline: documents to packed token sequences, in five stages.

Each stage is a function of (spark, docs, sf_dir) and works on all that the one
before kept. All but the last return the columns of documents. ``run`` writes
each stage's rows as Parquet in the scratch folder and rereads them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.llm import langid, mixing, near_dups, packing, secret_scan
from weir.llm.common import written
from weir.queries.tables import table


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters and those of which no language has half."""
    return langid.keep_identified(docs, langid.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group: five-word shingles, similarity 0.8 or more."""
    return near_dups.deduplicate(docs, percent=80, width=5)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask secrets in the texts; the documents stay."""
    return secret_scan.redact_secrets(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents as often as the mix of sources wants them, some not at all."""
    return mixing.apply_mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place the token pieces of the documents in sequences."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_languages),
    ("near_duplicates", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("source_mix", mix_sources),
    ("best_fit_pack", pack_sequences),
]

ORACLE_SQL = None  # learning, hashing and tokenising have no SQL; tests/llm checks every stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
