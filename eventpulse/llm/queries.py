"""The registered queries: each operator over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventpulse.llm import (
    chat_format,
    decontaminate,
    embedding_dedup,
    exact_dedup,
    hard_negatives,
    language_id,
    mixing,
    near_dedup,
    pii,
    secrets,
    spelling,
    substring_dedup,
    toxicity,
)
from eventpulse.llm.tables import read_table, remainder


def _count(spans: str, field: str, value: str | int) -> Column:
    return F.size(F.filter(spans, lambda s: s[field] == value)).cast("long")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    chats = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.digests(chat_format.format_chats(chats.unionByName(extra)))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read_table(spark, sf_dir, "documents"))
    strong = secrets.KINDS[: secrets.STRONG]
    base = F.filter("spans", lambda s: s["kind"].isin(*strong))

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    counts = [_count("spans", "kind", k).alias(f"n_{k}") for k in strong]
    return found.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(read_table(spark, sf_dir, "documents")).drop("pattern")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    scorer = toxicity.learn(toxicity.usable(docs), toxicity.usable(labels))
    scored = toxicity.score(docs, scorer)
    return scored.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(read_table(spark, sf_dir, "documents"))
    kinds = [name for name, _, _ in pii.GENERATORS[: pii.STRICT]]
    counts = [_count("strict", "k", k).alias(f"n_{name}") for k, name in enumerate(kinds)]
    return found.select("doc_id", *counts, F.sha2(pii.joined("strict"), 256).alias("base_sha256"), pii.joined("spans").alias("spans"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.learn(language_id.training(docs)))
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(read_table(spark, sf_dir, "documents")).drop("kept")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"), all_digests=True)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.select("vec_id", moved.alias("label"), "embedding"), F.col("vec_id") % 50 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat_format, op2_secret_scan, op3_near_dedup, op4_mixing, op5_decontaminate, op6_toxicity, op7_pii,
        op8_language_id, op9_embedding_dedup, op10_substring_dedup, op11_exact_dedup, op12_spelling, op13_hard_negatives, pipeline,
    )
}
