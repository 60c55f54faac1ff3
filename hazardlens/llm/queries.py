"""The corpus operators as queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.llm import (
    bpe, exact, fingerprints, language, mixing, passages, periods, privacy, simhash, suffixes, templates, urls, zones,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hex64(name: str) -> Column:
    """A long as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(name)), 16, "0")


@query("op1_repeated_strings")
def repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.report(table(spark, sf_dir, "documents"))


@query("op2_source_mix", mixing.sql())
def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


@query("op3_host_reputation", urls.SQL)
def host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


@query("op4_personal_data")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.report(table(spark, sf_dir, "documents"))


@query("op5_exact_dedup", exact.SQL)
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.groups(table(spark, sf_dir, "documents")).drop("n_chars")


@query("op6_language")
def document_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict(table(spark, sf_dir, "documents"))


@query("op7_simhash_links")
def simhash_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex64("fp").alias("fingerprint"), "component_id")


@query("op8_main_text")
def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return templates.extract(pages).select("page_id", "url", "text", "n_chars")


@query("op9_bpe_round_trip")
def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.digests(table(spark, sf_dir, "documents"), path)


@query("op10_fingerprints")
def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.with_edits(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hex64("fp").alias("fingerprint"),
        hex64("edited_fp").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        "n_near",
    )


@query("op11_passage_dedup", passages.SQL)
def passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.report(table(spark, sf_dir, "documents"))


@query("op12_zone_clusters", zones.sql())
def zone_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones.report(table(spark, sf_dir, "embeddings"))


@query("op13_word_runs")
def word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.report(table(spark, sf_dir, "documents"))
