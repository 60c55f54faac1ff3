"""Resumable label passes and the two-pass cascade."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens import schemas
from hazardlens.constants import PASS1_LABEL, PASS2_LABEL
from hazardlens.functions.text import truncate
from hazardlens.operators.batching import (
    assign_batches,
    batches_needed,
    current_labels,
    gather_batches,
    label_state,
    unlabelled,
    zip_labels,
)
from hazardlens.operators.dedup import keep_first
from hazardlens.operators.gates import gated_hazards
from hazardlens.operators.merging import final_hazards, merged_label
from hazardlens.operators.ordering import first_per_group
from hazardlens.plans.rubric import DEFAULT_RUBRIC, Rubric, hazard_label
from hazardlens.plans.scoring import FIRST_PASS, SECOND_PASS, Scorer, ScorerConfig, score_batches
from hazardlens.session import materialize, work_dir
from hazardlens.sources.files import path_exists, read_optional
from hazardlens.sources.writers import append_labels


log = logging.getLogger(__name__)


class IncompletePassError(RuntimeError):
    """A pass has left reviews without a label; running it again asks for these only."""


def _score_in_portions(
    batches: DataFrame,
    make_scorer: Callable[[], Scorer],
    config: ScorerConfig,
    save: Callable[[DataFrame], None],
) -> None:
    """Score numbered batches and ``save`` their labels (``key``, ``label``, ``labelled_at``), portion by portion.

    The portions are folders of one written table, so each batch is read once, and what a stop
    loses is one portion.
    """
    spark = batches.sparkSession
    sizes = batches.groupBy("category").agg(batches_needed(F.count("*"), config.batch_size).alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    portions = -(-total // config.batches_per_commit)
    if not portions:
        return
    gathered = gather_batches(batches, key="_key", text="_text")
    path = work_dir(spark, "batches")
    portion = F.pmod(F.xxhash64("category", "batch_id"), F.lit(portions)).alias("portion")
    gathered.select("*", portion).write.partitionBy("portion").parquet(path)
    for number in range(portions):
        if not path_exists(spark, f"{path}/portion={number}"):
            continue
        own = spark.read.parquet(f"{path}/portion={number}")
        answered = score_batches(own, make_scorer, config, own.count())
        answered = materialize(answered.withColumn("labelled_at", F.current_timestamp()), "answers")
        tried, failed, error = answered.agg(
            F.count("*"), F.count("error"), F.max("error")
        ).first()
        if failed:
            log.warning("%s: %d of %d batches failed, one with %s", config.name, failed, tried, error)
        if tried and failed == tried:
            raise RuntimeError(f"{config.name}: all {tried} batches failed, one with {error}")
        rows = zip_labels(answered.where(F.size("labels") > 0).drop("error"))
        save(rows.select("key", "label", "labelled_at"))


def _sent(config: ScorerConfig) -> Column:
    """The text as the scorer gets it."""
    body = F.col("review_text")
    return body if config.max_chars is None else truncate(body, config.max_chars)


def run_pass(
    spark: SparkSession,
    reviews: DataFrame,
    labels_path: str,
    make_scorer: Callable[[], Scorer],
    config: ScorerConfig,
    limit: int | None = None,
    cache: str | None = None,
) -> DataFrame:
    """Label what has no label yet, append it to ``labels_path`` and return that table.

    Batches are scored in portions, and each portion's labels are saved before the next is
    asked for, so a pass that stops half way keeps what it has and goes on there. Labels are
    written once and read back: a scorer need not repeat itself. A batch without an answer
    writes nothing, an answer that is too short leaves NULLs; both are found by key on the
    next run, and logged. A portion in which every batch failed is an error. ``limit`` labels
    only the first reviews of each category, for trial runs; the others stay unlabelled, so
    no gate by coverage takes such a run for a whole one.

    With a ``cache``, a table of scores by text and scorer, equal texts are sent once over all
    products, categories and runs that share it.
    """
    done = read_optional(spark, labels_path, schemas.LABELS)
    todo = unlabelled(reviews, done)
    if limit is not None:
        todo = first_per_group(todo, ["category"], "arrival", limit)

    def save(rows: DataFrame) -> None:
        append_labels(rows.withColumnRenamed("key", "review_key"), labels_path)

    if cache is None:
        batched = assign_batches(todo, config.batch_size)
        named = batched.select("category", "batch_id", "idx", F.col("review_key").alias("_key"), _sent(config).alias("_text"))
        _score_in_portions(named, make_scorer, config, save)
    else:
        save(cached_scores(spark, todo, cache, make_scorer, config).withColumnRenamed("review_key", "key"))
    return read_optional(spark, labels_path, schemas.LABELS)


def cached_scores(
    spark: SparkSession, reviews: DataFrame, cache: str, make_scorer: Callable[[], Scorer], config: ScorerConfig
) -> DataFrame:
    """``review_key``, ``label`` and ``labelled_at`` of ``reviews``, from scores kept by text.

    Texts the cache has no score of are scored once each, in the batch of the first review that has
    it, and added. Reviews whose text has still none are left out. A NULL text counts as empty.
    """
    scorer = f"{config.name} {config.version}"
    digest = F.sha2(F.coalesce(_sent(config), F.lit("")).cast("binary"), 256).alias("text_hash")

    def known() -> DataFrame:
        own = read_optional(spark, cache, schemas.SCORES).where((F.col("scorer") == scorer) & F.col("label").isNotNull())
        return keep_first(own, ["text_hash"], ["labelled_at", "label"]).select("text_hash", "label", "labelled_at")

    keyed = materialize(reviews.select("review_key", "category", "arrival", _sent(config).alias("_text"), digest), "keyed")
    missing = keyed.join(known().select("text_hash"), "text_hash", "left_anti")
    once = keep_first(missing, ["text_hash"], [F.col("category").asc_nulls_last(), "arrival"])
    once = materialize(once, "texts")
    named = assign_batches(once, config.batch_size, order=["arrival", "text_hash"]).select(
        "category", "batch_id", "idx", F.col("text_hash").alias("_key"), "_text"
    )

    def save(rows: DataFrame) -> None:
        scored = rows.select(F.col("key").alias("text_hash"), F.lit(scorer).alias("scorer"), "label", "labelled_at")
        scored.write.mode("append").parquet(cache)

    _score_in_portions(named, make_scorer, config, save)
    return keyed.select("review_key", "text_hash").join(known(), "text_hash").select("review_key", "label", "labelled_at")


def run_cascade(
    spark: SparkSession,
    reviews: DataFrame,
    folder: str,
    make_first: Callable[[], Scorer],
    make_second: Callable[[], Scorer],
    first: ScorerConfig = FIRST_PASS,
    second: ScorerConfig = SECOND_PASS,
    policy: str = "union",
    mode: str = "coverage",
    allow_missing: bool = False,
    cache: str | None = None,
) -> DataFrame:
    """First scorer on all reviews, second on its hazards in complete categories, merged.

    ``reviews`` hold ``category``, ``product_id``, ``arrival``, ``review_key`` and
    ``review_text`` and are free of duplicate keys. Categories in which a review has no first
    label wait for the next run; ``mode="nulls"`` looks at written labels only. There is no
    result while a hazard lacks its second label, unless ``allow_missing`` asks for one. With a
    ``cache`` both passes score equal texts once (see ``run_pass``).
    """
    table1 = run_pass(spark, reviews, f"{folder}/{first.name}", make_first, first, cache=cache)
    state = label_state(table1).withColumn("attempted", F.lit(True))
    labelled = reviews.join(state, "review_key", "left").withColumn(
        "attempted", F.coalesce("attempted", F.lit(False))
    )
    gated = gated_hazards(labelled, mode=mode).drop("attempted")
    hazards = materialize(gated.withColumnRenamed("label", PASS1_LABEL), "hazards")
    table2 = run_pass(spark, hazards, f"{folder}/{second.name}", make_second, second, cache=cache)
    second_labels = current_labels(table2).withColumnRenamed("label", PASS2_LABEL)
    both = hazards.join(second_labels, "review_key", "left")
    missing = both.where(F.col(PASS2_LABEL).isNull()).count()
    if missing and not allow_missing:
        raise IncompletePassError(f"{second.name}: {missing} reviews have no label yet; run again")
    final = merged_label(F.col(PASS1_LABEL), F.col(PASS2_LABEL), policy)
    return final_hazards(both.withColumn("hazard_final", final))


def rule_cascade(
    reviews: DataFrame,
    first: Rubric = DEFAULT_RUBRIC,
    second: Rubric = DEFAULT_RUBRIC,
    policy: str = "union",
    text: Column | None = None,
) -> DataFrame:
    """The cascade with two rubrics: no batches, joins or Python, one shuffle for the texts."""
    body = F.col("review_text") if text is None else text
    hazards = reviews.withColumn(PASS1_LABEL, hazard_label(body, first)).where(
        F.col(PASS1_LABEL) == 1
    )
    both = hazards.withColumn(PASS2_LABEL, hazard_label(body, second))
    final = merged_label(F.col(PASS1_LABEL), F.col(PASS2_LABEL), policy)
    return final_hazards(both.withColumn("hazard_final", final))
