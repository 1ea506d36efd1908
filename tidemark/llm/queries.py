"""The queries opN_<name> over the driver's tables, each with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import ann, bpe, chat, lattice, licenses, mixing, pii, repeats, simhash, toxicity
from tidemark.llm.common import table
from tidemark.session import spread


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(spread(table(spark, sf_dir, "documents")))


def op1_lattice_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.lattice_links(table(spark, sf_dir, "embeddings"))


def op2_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.records(chat.neighbours(table(spark, sf_dir, "conversations")))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels"))


def op4_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_spans(spread(table(spark, sf_dir, "documents")))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"), repeat=True)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_query(spark, spread(table(spark, sf_dir, "documents")))


def op9_anisotropic_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op10_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats(spread(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lattice_near_dedup": op1_lattice_near_dedup,
    "op2_preference_formatting": op2_preference_formatting,
    "op3_toxicity": op3_toxicity,
    "op4_pii_spans": op4_pii_spans,
    "op5_mixing": op5_mixing,
    "op6_license_scan": op6_license_scan,
    "op7_bpe_round_trip": op7_bpe_round_trip,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_anisotropic_search": op9_anisotropic_search,
    "op10_repeated_bytes": op10_repeated_bytes,
}

ORACLE_SQL: dict[str, str] = {
    "op2_preference_formatting": chat.ORACLE,
    "op5_mixing": mixing.ORACLE,
    "op6_license_scan": licenses.ORACLE,
}
