"""A training-data pipeline over the documents table, stage by stage.

Toxic documents go, then near-duplicates, then stretches that occur earlier;
what is left is mixed to source weights and encoded. Each stage works on all
that the one before kept, written as Parquet. Columns that a stage does not
need go through it untouched, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from comanda.llm import bpe, minhash, mixing, suffix_dedup, toxicity
from comanda.llm.common import stored, with_own_columns

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of the labels does not reject; its fit is on ``docs``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return with_own_columns(docs, ("doc_id", "text"), lambda d: toxicity.drop_toxic(d, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8 or more."""
    return with_own_columns(
        docs, ("doc_id", "text"), lambda d: minhash.drop_near_duplicates(d, words=5, percent=80)
    )


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of 100-byte strings that start earlier too."""
    return with_own_columns(docs, ("doc_id", "text", "n_chars"), suffix_dedup.drop_repeats)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that a mix to source weights 5, 2, 1 takes, a row for each time."""
    own = ("doc_id", "text", "source", "n_chars")
    return with_own_columns(docs, own, lambda d: mixing.take_mix(d, mixing.mix(d)))


def encode_round(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, and digests of the ids and of what they decode to."""
    import public_tokenizers

    path = str(public_tokenizers.path("word_bpe_49k.json"))
    # Takes doc_id and text alone.
    return bpe.digests(bpe.encode_decode(docs, path))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("minhash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", drop_repeats),
    ("source mix", mix_sources),
    ("bpe round", encode_round),
]

# Models, signatures and merges are beyond SQL; tests hold each stage against
# a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
