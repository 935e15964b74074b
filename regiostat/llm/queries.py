"""The registered queries of the operators, over the given tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostat.llm.centroids import clustered
from regiostat.llm.common import table
from regiostat.llm.decontaminate import leaks
from regiostat.llm.fingerprints import fingerprints
from regiostat.llm.language_id import predicted_languages
from regiostat.llm.licenses import license_matches
from regiostat.llm.merkle import checked_manifest
from regiostat.llm.mixing import mixture
from regiostat.llm.near_dups import near_duplicates
from regiostat.llm.neighbours import neighbours
from regiostat.llm.oracle import NEAR_DUPS, clusters_sql, merkle_sql
from regiostat.llm.quality import quality_scores
from regiostat.llm.sharding import OLD_SHARDS, resharded, text_hash
from regiostat.llm.token_counts import token_counts
from regiostat.llm.toxicity import toxicity_scores


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text; see ``token_counts``."""
    documents = table(spark, sf_dir, "documents")
    return token_counts(documents, public_tokenizers.path("byte_bpe_50k.json"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text; see ``toxicity_scores``."""
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors of every hundredth one; see ``neighbours``."""
    return neighbours(table(spark, sf_dir, "embeddings"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document, with its place; see ``leaks``."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text; see ``quality_scores``."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a 5:2:1 mix of the sources takes of each document; see ``mixture``."""
    return mixture(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every licence notice found in a document; see ``license_matches``."""
    return license_matches(table(spark, sf_dir, "documents"))


def op8_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates over four-word shingles at similarity 0.8; see ``near_duplicates``."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From 12 shards by text hash to 16 of near equal bytes; see ``resharded``."""
    documents = table(spark, sf_dir, "documents")
    return resharded(documents, F.pmod(text_hash(), F.lit(OLD_SHARDS))).drop("old_shard")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text; see ``predicted_languages``."""
    return predicted_languages(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document up to one root, a fifth of them tampered with; see ``checked_manifest``."""
    return checked_manifest(table(spark, sf_dir, "documents"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text and of an edited one; see ``fingerprints``."""
    return fingerprints(table(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty clusters of the vectors after five rounds; see ``clustered``."""
    return clustered(table(spark, sf_dir, "embeddings"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One query per operator."""
    return {
        "op1_token_counts": op1_token_counts,
        "op2_toxicity": op2_toxicity,
        "op3_neighbours": op3_neighbours,
        "op4_decontamination": op4_decontamination,
        "op5_quality": op5_quality,
        "op6_mixing": op6_mixing,
        "op7_licenses": op7_licenses,
        "op8_near_dups": op8_near_dups,
        "op9_sharding": op9_sharding,
        "op10_language_id": op10_language_id,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_fingerprints": op12_fingerprints,
        "op13_centroids": op13_centroids,
    }


def llm_oracle_sql() -> dict[str, str]:
    """The queries that SQL can express."""
    return {
        "op8_near_dups": NEAR_DUPS,
        "op11_merkle_manifest": merkle_sql(),
        "op13_centroids": clusters_sql(),
    }
