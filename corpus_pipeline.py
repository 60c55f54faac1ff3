"""Cleaning a corpus step by step; each stage works on all that the one before it kept.

Each function takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return
the columns of ``documents``. Stages handle null values, empty and very long texts, ties,
repeated rows, empty tables and further columns as their operators say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.llm import bpe, exact, language, mixing, shingles
from hazardlens.session import materialize

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language that the model knows.

    Texts that are null or have no letter go, and those whose letters are not usual in any of the
    languages, however many there are. The model is learned from the stage's own input. ``lang``
    stays as it was given. Where no row has a language to learn, only texts without a letter go.
    """
    model = language.learn(docs)
    if not model.languages:
        return docs.where(F.rlike("text", F.lit(r"\p{L}")))
    # The text goes to Python and back once, beside the other columns.
    others = [c for c in docs.columns if c.lower() != "text"]
    found = language.identify(docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), "text"), model)
    keep = (F.col("lang_pred") != "und") & (F.col("usual") >= model.limit)
    columns = [F.col(f"row.`{c}`") if c in others else F.col("text").alias(c) for c in docs.columns]
    return found.where(keep).select(*columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without white space."""
    return exact.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each component of texts whose shingles of
    five words have a Jaccard similarity of 0.8 or more: found by their SimHash and multi-index
    hashing first, the rest by prefixes of their shingles, decided by whole sets."""
    return shingles.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A draw of documents that brings sources, languages and topics to their target weights."""
    return mixing.keep_sampled(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with whether they decode to the text again."""
    own = docs.select("doc_id", "lang", "source", "text")
    decoded = bpe.round_trip(own, VOCABULARY)
    text = F.coalesce("text", F.lit(""))
    same = (F.col("decoded") == text).alias("round_trip")
    return decoded.select("doc_id", "lang", "source", "n_tokens", "ids", same)


STAGES = [
    ("language", known_language),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("source_mix", source_mix),
    ("bpe", tokens),
]

#: Two stages learn or hash in ways that SQL cannot express; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each is written and read again, so none is done twice."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = materialize(docs, f"stage-{name}")
    return docs
