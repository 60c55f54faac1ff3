"""Scoring batches: numbering, prompt text, answers, and what is still unlabelled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.constants import PASS1_BATCH
from hazardlens.functions.answers import parse_labels
from hazardlens.functions.text import numbered_line, truncate
from hazardlens.operators.dedup import keep_first
from hazardlens.operators.ordering import arrival_order, null_safe, ordinal
from hazardlens.session import materialize


def assign_batches(
    reviews: DataFrame,
    size: int = PASS1_BATCH,
    keys: Sequence[str] = ("category",),
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``batch_id`` (from 0) and ``idx`` (from 1) in order within the keys.

    The order is that of arrival (see ``arrival_order``) unless columns are given; they are
    unique within the keys. NULL keys count as empty, NULL order values come last.
    """
    filled = reviews.fillna("", subset=list(keys))
    by = arrival_order(reviews) if order is None else list(order)
    numbered = ordinal(filled, list(keys), by, "_position")
    before = F.col("_position") - 1
    return (
        numbered.withColumn("batch_id", F.floor(before / size))
        .withColumn("idx", (before % size + 1).cast("int"))
        .drop("_position")
    )


def gather_batches(
    batched: DataFrame,
    key: str = "review_key",
    keys: Sequence[str] = ("category",),
    text: str = "review_text",
    max_chars: int | None = None,
) -> DataFrame:
    """One row per batch with its ``items`` in order; a batch is never larger than its size."""
    body = F.col(text) if max_chars is None else truncate(F.col(text), max_chars)
    item = F.struct(F.col("idx"), F.col(key).alias("key"), body.alias("text"))
    return batched.groupBy(*keys, "batch_id").agg(F.sort_array(F.collect_list(item)).alias("items"))


def batch_prompts(
    batched: DataFrame,
    keys: Sequence[str] = ("category",),
    text: str = "review_text",
) -> DataFrame:
    """One row per batch: its reviews as numbered lines, whole."""
    line = numbered_line(F.col("idx"), F.col(text)).alias("line")
    lines = batched.select(*keys, "batch_id", "idx", line)
    prompt = F.expr("listagg(line, '\\n') within group (order by idx)")
    return lines.groupBy(*keys, "batch_id").agg(prompt.alias("prompt"))


def zip_labels(batches: DataFrame, labels: str = "labels") -> DataFrame:
    """One row per item of a batch with the label at its position.

    Missing labels are NULL and labels beyond the last item are left out.
    """
    pair = F.arrays_zip(F.col("items"), F.col(labels).alias("label"))
    others = [c for c in batches.columns if c not in ("items", labels)]
    zipped = batches.withColumn(labels, F.coalesce(labels, F.array().cast("array<int>")))
    return (
        zipped.select(*others, F.explode(pair).alias("_pair"))
        .where(F.col("_pair.items").isNotNull())
        .select(*others, "_pair.items.idx", "_pair.items.key", F.col("_pair.label").alias("label"))
    )


def join_answers(
    batches: DataFrame, answers: DataFrame, keys: Sequence[str] = ("category", "batch_id")
) -> DataFrame:
    """Batches with the labels parsed from their ``response``, zipped row by row."""
    parsed = answers.select(*keys, parse_labels(F.col("response")).alias("labels"))
    return zip_labels(batches.join(parsed, list(keys), "left"))


def current_labels(labels: DataFrame, key: str = "review_key") -> DataFrame:
    """One label per review: the earliest one that is not NULL."""
    given = labels.select(key, "label", "labelled_at").where(F.col("label").isNotNull())
    return keep_first(given, [key], ["labelled_at", "label"]).select(key, "label")


def label_state(labels: DataFrame, key: str = "review_key") -> DataFrame:
    """One row per review that was ever written: its label, NULL when it only has gaps."""
    order = [F.col("label").isNull(), "labelled_at", "label"]
    return keep_first(labels.select(key, "label", "labelled_at"), [key], order).select(key, "label")


def unlabelled(reviews: DataFrame, labels: DataFrame, key: str = "review_key") -> DataFrame:
    """Reviews without a label, found by key, so that failed batches are tried again."""
    done = labels.where(F.col("label").isNotNull()).select(key).distinct()
    return reviews.join(done, key, "left_anti")


def batches_needed(rows: Column, size: int) -> Column:
    return F.ceil(rows / size)


def batch_progress(
    batched: DataFrame,
    size: int = PASS1_BATCH,
    label: str = "label",
    keys: Sequence[str] = ("category",),
) -> DataFrame:
    """Rows labelled per batch, with the batch number and the number of batches."""
    per_batch = batched.groupBy(*keys, "batch_id").agg(
        F.count("*").alias("n"), F.count(label).alias("done")
    )
    per_batch = materialize(per_batch, "progress")
    totals = per_batch.groupBy(*keys).agg(batches_needed(F.sum("n"), size).alias("batches"))
    joined = per_batch.alias("l").join(totals.alias("r"), null_safe("l", "r", keys))
    return joined.select("l.*", "r.batches", (F.col("batch_id") + 1).alias("batch_number"))
