"""Combining the two label passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.constants import PASS1_LABEL, PASS2_LABEL
from hazardlens.operators.dedup import dedup_text

POLICIES = ("union", "intersection", "second_pass")


def merged_label(first: Column, second: Column, policy: str = "union") -> Column:
    """Final 0/1 label; a missing label counts as no hazard."""
    a = F.coalesce(first == 1, F.lit(False))
    b = F.coalesce(second == 1, F.lit(False))
    if policy == "union":
        hit = a | b
    elif policy == "intersection":
        hit = a & b
    elif policy == "second_pass":
        hit = b
    else:
        raise ValueError(f"unknown merge policy {policy!r}, expected one of {POLICIES}")
    return hit.cast("int")


def merge_passes(
    reviews: DataFrame,
    pass1: DataFrame,
    pass2: DataFrame,
    policy: str = "union",
    key: str = "review_key",
) -> DataFrame:
    """Reviews with both labels side by side and the merged label ``hazard_final``.

    Each pass holds one ``label`` per key (see ``current_labels``).
    """
    first = pass1.select(key, F.col("label").alias(PASS1_LABEL))
    second = pass2.select(key, F.col("label").alias(PASS2_LABEL))
    both = reviews.join(first, key, "left").join(second, key, "left")
    final = merged_label(F.col(PASS1_LABEL), F.col(PASS2_LABEL), policy)
    return both.withColumn("hazard_final", final)


def final_hazards(merged: DataFrame) -> DataFrame:
    """Confirmed hazards, one row per text, the first in the order of the files."""
    return dedup_text(merged.where(F.col("hazard_final") == 1))
