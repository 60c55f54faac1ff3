"""Sinks. None of them overwrites a table it is reading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.constants import PASS1_LABEL
from hazardlens.functions.text import slug
from hazardlens.operators.batching import current_labels
from hazardlens.operators.dedup import merge_reviews
from hazardlens.operators.ordering import in_order, numeric_id, ordinal, sort_by_numeric_id
from hazardlens.sources.files import CSV_OPTIONS
from hazardlens.sources.versions import Version, commit, current, read_table

_CSV = {k: v for k, v in CSV_OPTIONS.items() if k != "multiLine"}


def append_labels(labels: DataFrame, path: str) -> None:
    """Append labels to the checkpoint table, NULL where an answer was too short."""
    labels.write.mode("append").parquet(path)


def compact_labels(spark: SparkSession, path: str, target: str, key: str = "review_key") -> None:
    """Rewrite the label checkpoint to ``target``: one label per review, no gaps."""
    current_labels(spark.read.parquet(path), key).write.mode("overwrite").parquet(target)


def write_merged_reviews(existing: DataFrame, batch: DataFrame, target: str) -> int:
    """Merge a batch into existing reviews, write them and return their number.

    One folder per category, sorted by numeric product id, then rank and arrival, with the
    three columns of a review file and ``ordinal``, the row's order. ``target`` is a new folder:
    what is read is not overwritten.
    """
    merged = merge_reviews(existing, batch)
    by = [F.col("category").asc_nulls_last(), numeric_id().asc_nulls_last(), *in_order(["source_rank", "arrival"])]
    ordered = merged.orderBy(*by).select(
        "category", "product_id", "subcategory", "review_text", F.monotonically_increasing_id().alias("ordinal")
    )
    ordered.write.mode("errorifexists").partitionBy("category").parquet(target)
    return ordered.sparkSession.read.parquet(target).count()


_MERGED = "product_id string, subcategory string, review_text string, ordinal bigint, category string"


def read_merged(spark: SparkSession, table: str) -> DataFrame:
    """The reviews of ``merge_into`` with ``arrival``, the order they are stored in."""
    return read_table(spark, table, _MERGED).withColumnRenamed("ordinal", "arrival")


def merge_into(spark: SparkSession, table: str, batch: DataFrame) -> Version:
    """Merge a batch into the table of reviews at ``table`` and return its new version.

    The table may be the one that ``batch`` was made from. Readers keep what they had until the
    new version is whole; a write that fails changes nothing, and can be run again.
    """
    base = current(spark, table)
    existing = read_merged(spark, table)
    return commit(spark, table, base, lambda folder: write_merged_reviews(existing, batch, folder))


def write_reviews_csv(reviews: DataFrame, target: str) -> None:
    reviews.write.mode("overwrite").options(**_CSV).csv(target)


def write_hazards_csv(hazards: DataFrame, target: str, label: str = PASS1_LABEL) -> None:
    """Classified reviews as CSV."""
    columns = ["product_id", "subcategory", "review_text", label]
    write_reviews_csv(hazards.select(*columns), target)


def write_landed(pages: DataFrame, target: str, rows_per_file: int = 100_000) -> None:
    """Landed response pages as ``read_landed`` reads them, compressed.

    Responses are wide and repeat their frame, so plain text takes many times the disk. A
    compressed file cannot be split; tasks that read follow the number of files.
    """
    pages.write.option("maxRecordsPerFile", rows_per_file).json(target, compression="gzip")


def write_id_lists(ids: DataFrame, target: str, rows_per_file: int = 1_000_000) -> None:
    """Id lists as JSON lines with their ``ordinal``, one folder per category slug.

    ``source_rank``, if there, comes before ``ordinal``: merged lists keep their order. Lists
    without an ordinal are put in the order of their ids.
    """
    by = [c for c in ("source_rank", "ordinal") if c in ids.columns] + ["id"]
    named = ids.withColumn("slug", slug(F.col("category")))
    rows = ordinal(named, ["slug"], by, "_place")
    out = rows.select("id", "subcategory", (F.col("_place") - 1).alias("ordinal"), "slug")
    # Some rows of each category per task, not every category in every task.
    spread = out.repartition("slug", F.floor(F.col("ordinal") / rows_per_file))
    spread.write.mode("overwrite").partitionBy("slug").json(target)


def write_category_tree(tree: DataFrame, target: str) -> None:
    """Category tree, one JSON object ``{category: [subcategories]}`` per line, sorted."""
    line = F.to_json(F.create_map("category", "subcategories"))
    tree.orderBy("category").select(line.alias("value")).write.mode("overwrite").text(target)


def write_final(hazards: DataFrame, target: str) -> None:
    """Final sheet as CSV part files with a header, in numeric product order."""
    columns = [
        "product_id",
        "subcategory",
        "review_text",
        "hazard_label_classified",
        "hazard_label_validated",
        "hazard_final",
    ]
    tie = [c for c in ("category", "arrival") if c in hazards.columns]
    write_reviews_csv(sort_by_numeric_id(hazards, tie=tie).select(*columns), target)
