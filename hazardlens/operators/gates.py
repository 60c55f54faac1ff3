"""Completeness of labelling per group, and hazard counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlens.operators.ordering import null_safe
from hazardlens.session import materialize


def complete_groups(
    reviews: DataFrame,
    group: Sequence[str] = ("category",),
    label: str = "label",
    mode: str = "nulls",
    attempted: str = "attempted",
) -> DataFrame:
    """Groups that may go on.

    ``nulls`` looks only at rows that were written to the label table
    (``attempted``), so a group that was cut short passes when none of its written
    rows lacks a label. ``coverage`` asks for a label on every review.
    """
    if mode == "coverage":
        rows = reviews
    elif mode == "nulls":
        rows = reviews.where(F.col(attempted))
    else:
        raise ValueError(f"unknown gate mode {mode!r}")
    labelled = F.bool_and(F.col(label).isNotNull()).alias("_complete")
    return rows.groupBy(*group).agg(labelled).where("_complete").drop("_complete")


def gated_hazards(
    reviews: DataFrame,
    group: Sequence[str] = ("category",),
    label: str = "label",
    mode: str = "nulls",
) -> DataFrame:
    """Reviews with label 1 from complete groups; NULL is a group like any other.

    The groups are written first. Where they are few, the hazards, whole texts among them, stay
    in the tasks they are in instead of meeting by group.
    """
    complete = materialize(complete_groups(reviews, group, label, mode), "complete")
    hazards = reviews.where(F.col(label) == 1)
    return hazards.alias("l").join(complete.alias("r"), null_safe("l", "r", group), "left_semi")


def hazard_counts(hazards: DataFrame, group: str = "category") -> DataFrame:
    """Hazard reviews per group and, under NULL, in total."""
    return hazards.rollup(group).agg(F.count("*").alias("hazards"))
