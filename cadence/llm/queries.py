"""The registered queries of this subpackage: each applies its operator, with production parameters, to whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.llm import decontam, fst, gam, licenses, packing, quality, ranked, runs, sharding, simhash, token_files, toxicity, warc_zip
from cadence.llm.oracles import ORACLES
from cadence.llm.store import fresh, written

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"
SHARD_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    """The pieces of ``docs`` with a digest of their ids."""
    p = packing.pack_documents(docs, tokenizer=public_tokenizers.path(WORD_BPE), end_id=2)
    return p.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fst.token_counts(table(spark, sf_dir, "documents"), tokenizer=public_tokenizers.path(WORD_BPE), limit=2048)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh(spark, "warc")
    archives = written(warc_zip.write_archives(table(spark, sf_dir, "pages"), folder), "warc-list")
    return warc_zip.read_archives(archives, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer=public_tokenizers.path(BYTE_BPE), end_id=0)
    read = token_files.digests(token_files.read_token_files(spark, path))
    return token_files.with_starts(written(read, "token-digests")).select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), limit_bytes=SHARD_BYTES)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gam.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(table(spark, sf_dir, "documents"), planted=True).drop("runs")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_packing, op2_simhash, op3_token_counts, op4_toxicity, op5_decontamination, op6_warc, op7_token_files,
                                   op8_sharding, op9_quality, op10_licenses, op11_quality_scores, op12_periodic_runs, op13_ranked_search, pipeline)}
