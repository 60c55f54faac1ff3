"""Keep-first de-duplication and merging of new rows into existing ones.

Keep-first uses ``row_number() = 1``: the limit runs before the shuffle too, so a
text copied into a third of all rows leaves each task once. The hash in front of
the keys gives the sort an 8-byte prefix; equal hashes still compare the keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardlens.operators.ordering import arrival_order, numeric_id, ordinal
from hazardlens.session import materialize


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per distinct keys, the first in ``order`` (unique within the keys)."""
    window = Window.partitionBy("_hash", *keys).orderBy(*order)
    return (
        df.withColumn("_hash", F.xxhash64(*keys))
        .withColumn("_rn", F.row_number().over(window))
        .where(F.col("_rn") == 1)
        .drop("_rn", "_hash")
    )


def dedup_reviews(reviews: DataFrame, order: Sequence[str | Column] | None = None) -> DataFrame:
    """First review per category, product and text; the subcategory is not part of the key."""
    by = arrival_order(reviews) if order is None else order
    return keep_first(reviews, ["category", "product_id", "review_text"], by)


def file_order(reviews: DataFrame) -> list[str | Column]:
    """The order of the sorted files, one per category: category, numeric product id, arrival.
    Ids that are no numbers come last. Arrival alone says nothing across categories."""
    number = numeric_id().asc_nulls_last()
    return [F.col("category").asc_nulls_last(), number, "product_id", *arrival_order(reviews)]


def dedup_text(reviews: DataFrame, order: Sequence[str | Column] | None = None) -> DataFrame:
    """First review per text, over all products and categories, in the order of the files."""
    return keep_first(reviews, ["review_text"], file_order(reviews) if order is None else order)


def first_seen_ids(
    ids: DataFrame, order: Sequence[str] = ("sub_ord", "page", "pos")
) -> DataFrame:
    """First sighting of each id within its category."""
    return keep_first(ids, ["category", "id"], order)


def new_ids(
    found: DataFrame, existing: DataFrame, order: Sequence[str] = ("sub_ord", "page", "pos")
) -> DataFrame:
    """First sightings of ids that the category does not have yet."""
    seen = existing.select("category", "id").distinct()
    return first_seen_ids(found, order).join(seen, ["category", "id"], "left_anti")


def merge_ids(
    found: DataFrame, existing: DataFrame, order: Sequence[str] = ("sub_ord", "page", "pos")
) -> DataFrame:
    """Existing entries, untouched, followed by the new ones.

    ``source_rank`` and ``ordinal`` give the order: existing entries keep their ``ordinal`` (NULL if
    they have none), new ones are numbered from 0 in each category, as they were found.
    """
    columns = ["category", "id", "subcategory"]
    # Written, because numbering looks at it twice; ids are narrow.
    fresh = materialize(new_ids(found, existing, order), "new_ids")
    numbered = ordinal(fresh, ["category"], [*order, "id"], "_number").select(
        *columns, F.lit(1).alias("source_rank"), (F.col("_number") - 1).alias("ordinal")
    )
    own = F.col("ordinal").cast("bigint") if "ordinal" in existing.columns else F.lit(None).cast("bigint")
    return existing.select(*columns, F.lit(0).alias("source_rank"), own.alias("ordinal")).unionByName(numbered)


def listed_ids(merged: DataFrame) -> DataFrame:
    """Merged ids as the id lists that reviews are collected by: one ``ordinal`` per category."""
    placed = ordinal(merged.drop("_o"), ["category"], ["source_rank", "ordinal", "id"], "_o")
    return placed.select("category", (F.col("_o") - 1).alias("ordinal"), "id", "subcategory")


def merge_reviews(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Existing reviews and a new batch as one de-duplicated table; existing rows win.

    ``source_rank`` is 0 for existing and 1 for new rows; within a rank rows keep their
    ``arrival``, so both columns together are the order (see ``arrival_order``).
    """
    both = existing.withColumn("source_rank", F.lit(0)).unionByName(
        batch.withColumn("source_rank", F.lit(1)), allowMissingColumns=True
    )
    typed = both.withColumn("product_id", F.col("product_id").cast("string"))
    return dedup_reviews(typed)


def new_reviews(batch: DataFrame, existing: DataFrame, key: str = "review_key") -> DataFrame:
    """Rows of a batch that the existing table does not hold.

    The existing keys are cut down to those the batch asks about first, so a
    large table is only scanned when the batch is small enough to be broadcast.
    """
    first = keep_first(batch, [key], arrival_order(batch))
    known = existing.select(key).join(first.select(key), key, "left_semi").distinct()
    return first.join(known, key, "left_anti")
