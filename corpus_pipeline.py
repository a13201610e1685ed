"""From raw documents to a training mix: five stages over the documents table.

Each stage takes (spark, docs, sf_dir). Its result is written as Parquet to the
shared folder and read again as the next one's documents. The first four return
the columns of documents; the last one returns the mix: one row per document of
which words are taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventpulse.llm import decontaminate, language_id, mixing, near_dedup, secrets
from eventpulse.llm.tables import read_table, stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or in no learned language go."""
    return language_id.spoken(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return near_dedup.one_of_each(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets and linked credentials are masked."""
    return secrets.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which words are taken, with their number."""
    return mixing.mix_documents(docs).where("taken > 0").drop("pattern")


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", remove_benchmark),
    ("secret_scan", mask_secrets),
    ("mixing", mix_sources),
]

#: The stages learn and link; SQL can't express them, tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
