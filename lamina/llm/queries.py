"""The registered queries, one per operator, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import decontaminate, divergence, exact, hard_negatives, language, lines, mixing, neighbours, oracles, packing, secret_scan, sharding, simhash, substrings

SHARDS = 24


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_source_mix(spark, sf_dir):
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "taken")


def op2_slot_shards(spark, sf_dir):
    placed = sharding.shard_by_bytes(_table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        F.col("version").alias("map_version"),
    )


def op3_language_id(spark, sf_dir):
    return language.identify(_table(spark, sf_dir, "documents"))


def op4_fm_substrings(spark, sf_dir):
    return substrings.deduplicated(_table(spark, sf_dir, "documents"))


def op5_simhash(spark, sf_dir):
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), simhash.NEAR_EXACT)


def op6_secret_scan(spark, sf_dir):
    return secret_scan.scan(_table(spark, sf_dir, "documents"))


def op7_best_fit(spark, sf_dir):
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


def op8_line_dedup(spark, sf_dir):
    return lines.deduplicated(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_grace_dedup(spark, sf_dir):
    return exact.duplicate_classes(_table(spark, sf_dir, "documents"))


def op10_dimension_scan(spark, sf_dir):
    table = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest(table, F.col("vec_id") % 100 == 0)


def op11_divergence_audit(spark, sf_dir):
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark, sf_dir):
    table = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table, F.col("vec_id") % 100 == 0, label)


def op13_decontaminate(spark, sf_dir):
    return decontaminate.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("hit_spans", "longest_match")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_source_mix,
        op2_slot_shards,
        op3_language_id,
        op4_fm_substrings,
        op5_simhash,
        op6_secret_scan,
        op7_best_fit,
        op8_line_dedup,
        op9_grace_dedup,
        op10_dimension_scan,
        op11_divergence_audit,
        op12_hard_negatives,
        op13_decontaminate,
    )
}
ORACLES: dict[str, str] = oracles.SQL
