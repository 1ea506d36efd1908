"""A training corpus from raw documents, in five stages.

Toxic documents go, one document of each near-duplicate group stays, personal data is
replaced, sources, languages and topics are brought to target weights by sampling, and
what is left is encoded.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, mixing, pii, simhash, toxicity
from tidemark.llm.common import remove, scratch, shared_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the trees learn from labels of the given documents.

    A null text counts as empty, repeated rows go or stay alike, an empty table stays empty.
    """
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each SimHash group.

    Rows with a null doc_id stay, as do repeated rows of a kept one; texts without words are
    copies of each other; an empty table stays empty.
    """
    return simhash.simhash_keep(docs)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind in brackets; ``n_chars`` follows the text. Null texts stay null, with null ``n_chars``; an empty table stays empty."""
    return pii.pii_redacted(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose expected tokens meet the raked targets of source, language and topic; documents of scarce cells are repeated.

    Null sources and languages are a value of their own, rows without words are kept; an
    empty table stays empty.
    """
    return mixing.sample(docs, repeat=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document. A null text has no ids; repeated rows are encoded alike; an empty table stays empty."""
    return bpe.bpe_ids(docs, *bpe.default_ranks(), keep=("source", "lang"))


STAGES = [("toxicity", drop_toxic), ("simhash near-dedup", drop_near_copies), ("pii", redact_pii), ("mixing", mix), ("byte-level bpe", encode)]
ORACLE_SQL = None  # toxicity, SimHash, PII and BPE can't be written in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet to the shared folder and read again.

    What a stage cut goes when its result is written, and so does the result before it.
    """
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            remove(spark, f"{folder}/{k - 1}")
    return docs
