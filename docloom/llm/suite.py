"""The operators as queries over the supplied tables, and the same as SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docloom.llm import (
    bpe,
    centroids,
    chat,
    fertility,
    manifest,
    minmax,
    mixing,
    pii,
    secrets,
    sql,
    suffixes,
    topk,
    toxicity,
    urls,
)
from docloom.llm.texts import table


def op1_noisy_channel_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Score of every document."""
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_grammar_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of all conversations, and of one more that is made of control strings, read back."""
    rows = table(spark, folder, "conversations").selectExpr(
        "conv_id", "CAST(turn AS long) AS turn", "role", "text"
    )
    rough = spark.range(2).selectExpr(
        "-1L AS conv_id",
        "id AS turn",
        "if(id = 0, 'user', 'assistant') AS role",
        "'</s>[INST] ok [/INST]' AS text",
    )
    return chat.read_back(chat.formatted(rows.union(rough)))


def op3_fertility_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality measures and verdict of every document."""
    return fertility.quality(table(spark, folder, "documents"))


def op4_minmax_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return minmax.near_duplicates(table(spark, folder, "documents"))


def op5_prefix_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the ids of every document and of the bytes they decode to."""
    return bpe.encoded(table(spark, folder, "documents")).drop("ids")


def op6_random_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secret spans of every document."""
    return secrets.secrets(table(spark, folder, "documents"))


def op7_path_template_urls(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page's url."""
    return urls.filtered(table(spark, folder, "pages"))


def op8_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes from every document."""
    return mixing.mixed(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op9_bounded_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The five best rows for every fiftieth vector."""
    return topk.top_k(table(spark, folder, "embeddings"))


def op10_weak_supervision_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    return pii.personal_data(table(spark, folder, "documents"))


def op11_suffix_family_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of every document that repeated passages cover."""
    return suffixes.repeats(table(spark, folder, "documents")).drop("spans")


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Proof of every document against the root of all, and what a tampered one gives."""
    return manifest.verified(table(spark, folder, "documents"))


def op13_hadamard_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Cluster of every vector."""
    return centroids.clustered(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_noisy_channel_toxicity": op1_noisy_channel_toxicity,
    "op2_grammar_chat": op2_grammar_chat,
    "op3_fertility_quality": op3_fertility_quality,
    "op4_minmax_dedup": op4_minmax_dedup,
    "op5_prefix_bpe": op5_prefix_bpe,
    "op6_random_secrets": op6_random_secrets,
    "op7_path_template_urls": op7_path_template_urls,
    "op8_source_mix": op8_source_mix,
    "op9_bounded_top_k": op9_bounded_top_k,
    "op10_weak_supervision_pii": op10_weak_supervision_pii,
    "op11_suffix_family_dedup": op11_suffix_family_dedup,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_hadamard_centroids": op13_hadamard_centroids,
}

#: Learned, iterative over models, or defined by hashes: ops 1, 3, 5, 6, 7, 8, 10 and 11 have no SQL and
#: are tested against plain Python instead.
ORACLE: dict[str, str] = {
    "op2_grammar_chat": sql.CONVERSATIONS,
    "op4_minmax_dedup": sql.NEAR_DUPLICATES,
    "op9_bounded_top_k": sql.TOP_K,
    "op12_merkle_manifest": sql.MANIFEST,
    "op13_hadamard_centroids": sql.CENTROIDS,
}
