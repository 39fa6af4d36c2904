"""Registered queries of the operators: each applies one to its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from filinglake.llm import (
    curriculum,
    decontaminate,
    fingerprints,
    langid,
    near_dedup,
    negatives,
    packing,
    periodic,
    sanitise,
    secrets,
    sharding,
    toxicity,
    warc,
)
from filinglake.llm.common import table


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op4_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.personal_data(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


def op11_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum.mixture(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mined(table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_language": op2_language,
    "op3_sharding": op3_sharding,
    "op4_sanitise": op4_sanitise,
    "op5_warc": op5_warc,
    "op6_toxicity": op6_toxicity,
    "op7_packing": op7_packing,
    "op8_decontamination": op8_decontamination,
    "op9_fingerprints": op9_fingerprints,
    "op10_secrets": op10_secrets,
    "op11_curriculum": op11_curriculum,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_periodic_runs": op13_periodic_runs,
}

# Base32 letters of the four 40-bit parts of a SHA-1 in hexadecimal.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((part{k} >> {shift}) & 31)::INT + 1, 1)"
    for k in range(4)
    for shift in range(35, -1, -5)
)

# The other operators train models, sample, or find places of regex matches; tests hold them against
# brute force, exact round trips or held-out rows.
ORACLE_SQL: dict[str, str] = {
    "op11_curriculum": curriculum.SQL,
    "op12_hard_negatives": negatives.SQL,
    "op5_warc": f"""
WITH hashed AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), parted AS (
    SELECT page_id, payload_bytes,
        ('0x' || substr(h, 1, 10))::BIGINT AS part0, ('0x' || substr(h, 11, 10))::BIGINT AS part1,
        ('0x' || substr(h, 21, 10))::BIGINT AS part2, ('0x' || substr(h, 31, 10))::BIGINT AS part3
    FROM hashed
), named AS (
    SELECT page_id, payload_bytes, {_BASE32} AS payload_digest FROM parted
), told AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM named
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM told""",
}
