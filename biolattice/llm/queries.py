"""The numbered queries: each applies its operator to a whole given table."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import alignment, audit, exact, licenses, lines, lm, mixing, neighbours, packing, quality, sharding, simhash, tokens
from .common import table, text_or_empty


def op1_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"))


def op3_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"))


def op4_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(table(spark, sf_dir, "documents"), 8)
    t = text_or_empty(out)
    return out.select("doc_id", (F.octet_length(t) + 1).cast("long").alias("size"), F.crc32(t).cast("long").alias("text_crc32"),
                      F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_line_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(table(spark, sf_dir, "documents"))


def op6_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("copies")


def op8_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op9_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), added=True)


def op10_simhash_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_two_tier_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


def op12_lehmer_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_word_start_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_report(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_license_join, op2_pruned_graph, op3_attention_scores, op4_shuffle_shards, op5_line_join, op6_factorisation_machine,
    op7_entropy_mix, op8_chunk_recipes, op9_sum_of_squares_packing, op10_simhash_bytes,
    op11_two_tier_lengths, op12_lehmer_intervals, op13_word_start_anchors)}

SQL: dict[str, str] = {"op1_license_join": licenses.scan_sql(), "op5_line_join": lines.report_sql(), "op12_lehmer_intervals": audit.audit_sql()}
