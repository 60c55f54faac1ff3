"""Volume and run-time reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlens.functions.text import format_elapsed


def review_volume(reviews: DataFrame, group: str = "category") -> DataFrame:
    """Reviews, products and labelled reviews per group."""
    return reviews.groupBy(group).agg(
        F.count("*").alias("reviews"),
        F.countDistinct("product_id").alias("products"),
        F.count("label").alias("labelled"),
    )


def id_volume(ids: DataFrame, keys: Sequence[str] = ("category", "subcategory")) -> DataFrame:
    """Ids per category and subcategory."""
    return ids.groupBy(*keys).agg(F.count("*").alias("ids"))


def tree_volume(tree: DataFrame) -> DataFrame:
    """Subcategories per category of a category tree."""
    return tree.select("category", F.size("subcategories").alias("subcategories"))


def stacked(report: DataFrame, group: str, count: str = "n") -> DataFrame:
    """The counts of a report as rows of ``metric``, ``group_name``, ``count``."""
    metrics = [F.col(c).cast("bigint").alias(c) for c in report.columns if c != group]
    named = report.select(F.col(group).cast("string").alias("group_name"), *metrics)
    return named.unpivot("group_name", named.columns[1:], "metric", count)


def run_elapsed(log: DataFrame, run: str, ts: str) -> DataFrame:
    """Whole seconds between first and last log entry of each run, also as text."""
    first, last = F.min(ts).cast("timestamp"), F.max(ts).cast("timestamp")
    spans = log.groupBy(run).agg(
        F.floor((F.unix_micros(last) - F.unix_micros(first)) / 1_000_000).alias("seconds")
    )
    return spans.withColumn("elapsed", format_elapsed(F.col("seconds")))
