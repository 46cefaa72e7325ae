"""A training-corpus pipeline over ``documents``: filter, deduplicate, decontaminate, encode.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fablens.llm import bpe, decontamination, line_dedup, near_dedup, toxicity
from fablens.llm.shipping import ship_package
from fablens.sources.shared import materialize


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go."""
    ship_package(spark)
    return toxicity.remove_toxic(docs, _read(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from the texts; ``n_chars`` follows. A document that loses all lines stays, empty."""
    ship_package(spark)
    counts = ("lines before dropping", "lines dropped")
    found = line_dedup.dedup_lines(docs, counts=counts)
    changed = F.col(f"`{counts[1]}`") > 0
    kept = [
        F.when(changed, F.length("text")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`")
        for c in docs.columns
    ]
    return found.select(*kept)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    ship_package(spark)
    return near_dedup.remove_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    ship_package(spark)
    return decontamination.remove_leaks(docs, _read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``token_ids`` (little-endian unsigned 32-bit) and ``decoded`` of every document left."""
    ship_package(spark)
    return bpe.encode_and_decode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("bpe", encode),
]

# Classifier, hashes and tokens can't be written in SQL; tests compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read by the next."""
    docs = _read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
