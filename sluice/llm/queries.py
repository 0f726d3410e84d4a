"""The queries of this subpackage: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import oracles, sharding
from sluice.llm.ann import nearest
from sluice.llm.common import documents
from sluice.llm.decontam import leaks
from sluice.llm.neardup import near_duplicates
from sluice.llm.packing import pack, public_tokenizer
from sluice.llm.quality import quality
from sluice.llm.substr import passage_digests
from sluice.llm.toxicity import toxicity
from sluice.llm.urls import judge, rule
from sluice.llm.warc import read_archives, write_archives


def op1_multiprobe_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where(F.col("vec_id") % 20 == 0), k=20)


def op2_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op3_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


#: Bytes of a shard at most.
SHARD_BYTES = 1 << 20


def op4_extendible_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(documents(spark, sf_dir), SHARD_BYTES)


def op5_shortest_pack_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), public_tokenizer("word_bpe_49k.json"))


#: The rules that the contract of op6 fixes.
RULES = [rule("allow", "com/"), rule("block", "example.com/en/"), rule("allow", "www.example.com/en/"), rule("block", "net/es/"), rule("block", "net/fr/")]


def op6_gbt_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir, "pages"), RULES)


def op7_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_digests(documents(spark, sf_dir))


def op10_dictionary_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_archives(write_archives(documents(spark, sf_dir, "pages")))


WARC_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT digest, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY digest)
SELECT page_id, n AS payload_bytes, p.digest AS payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.digest = f.digest"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_multiprobe_lsh, op2_crf_quality, op3_compression_toxicity, op4_extendible_hashing, op5_shortest_pack_first, op6_gbt_url_filter, op7_minhash_neardup, op8_benchmark_decontamination, op9_substring_dedup, op10_dictionary_warc)}


def oracle_sql() -> dict[str, str]:
    return {"op4_extendible_hashing": sharding.oracle(SHARD_BYTES), "op7_minhash_neardup": oracles.near_duplicates(), "op8_benchmark_decontamination": oracles.leaks(), "op9_substring_dedup": oracles.passages(), "op10_dictionary_warc": WARC_SQL}
