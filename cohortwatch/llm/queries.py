"""The subpackage's registered queries and, where SQL can express them, their DuckDB text."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwatch.llm import _spark, collocations, decontaminate, hard_negatives, language_id, license_scan, line_dedup, mixing, ngram_join, oracles, passage_dedup, quality, sharding, token_count, token_output


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_count.count_tokens(docs, _vocabulary("piece_bpe_32k.model")).drop("text")


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{_spark.scratch_dir(spark)}/cohortwatch/ids-{uuid.uuid4().hex}"
    token_output.write_ids(_table(spark, sf_dir, "documents"), path, _vocabulary("word_bpe_49k.json"), end_id=2)
    return token_output.read_ids(spark, path, with_ids=False)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", sharding.size_of(F.col("text")).alias("size"), F.crc32(F.coalesce(F.encode("text", "utf-8"), F.lit(b""))).alias("text_crc32"))
    return sharding.assign_shards(docs, 16).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op6_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_dedup.repeated_passages(_table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.aligned_blocks(_table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", language_id.held_out(F.col("doc_id")).alias("held_out"))
    found = language_id.identify(docs.drop("lang"), language_id.learn(docs.where("not held_out")))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def queries() -> dict:
    found = (op1_quality_rules, op2_token_counts, op3_token_output, op4_sharding, op5_ngram_jaccard_join, op6_passage_dedup, op7_mixing, op8_line_dedup, op9_language_id, op10_decontamination, op11_license_scan, op12_collocations, op13_hard_negatives)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": oracles.QUALITY, "op5_ngram_jaccard_join": oracles.NGRAM_JOIN, "op10_decontamination": oracles.DECONTAMINATION, "op11_license_scan": oracles.license_scan(), "op12_collocations": oracles.COLLOCATIONS, "op13_hard_negatives": oracles.HARD_NEGATIVES}
