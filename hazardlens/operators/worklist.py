"""What to collect: work lists, lookups and starting points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlens.constants import NEGATIVE_STARS, PRODUCTS_PER_BATCH
from hazardlens.operators.batching import assign_batches
from hazardlens.operators.dedup import keep_first
from hazardlens.operators.ordering import null_safe


def select_categories(
    df: DataFrame, wanted: Sequence[str] | None, known: Sequence[str], column: str = "category"
) -> DataFrame:
    """Rows of the wanted categories, all of them for ``None``; unknown names are an error."""
    if wanted is None:
        return df
    unknown = sorted(set(wanted) - set(known))
    if unknown:
        raise ValueError(f"unknown categories {unknown}, known are {sorted(known)}")
    return df.where(F.col(column).isin(*wanted))


def select_numbered(
    df: DataFrame, choice: str, known: Sequence[str], column: str = "category"
) -> DataFrame:
    """As ``select_categories`` for ``"all"`` or 1-based numbers such as ``"1 3"``."""
    picked = choice.strip().lower()
    if picked == "all":
        return df
    numbers = [int(n) for n in picked.split()]
    if not numbers or not all(0 < n <= len(known) for n in numbers):
        raise ValueError(f"expected numbers from 1 to {len(known)} or 'all', got {choice!r}")
    return select_categories(df, [known[n - 1] for n in numbers], known, column)


def negative_only(reviews: DataFrame, column: str = "star") -> DataFrame:
    return reviews.where(F.col(column).isin(*NEGATIVE_STARS))


def work_list(products: DataFrame) -> DataFrame:
    """One row per product and negative star."""
    stars = F.array(*[F.lit(s) for s in NEGATIVE_STARS])
    return products.withColumn("star", F.explode(stars))


def product_batches(products: DataFrame, size: int = PRODUCTS_PER_BATCH) -> DataFrame:
    """Products in collection batches per category, in list order."""
    return assign_batches(products, size, ["category"], ["ordinal"])


def query_lookup(work: DataFrame, query_map: DataFrame) -> DataFrame:
    """Work rows with the search query of their subcategory."""
    queries = query_map.select("category", "subcategory", "query")
    return work.join(queries, ["category", "subcategory"])


def enrich_subcategory(reviews: DataFrame, ids: DataFrame) -> DataFrame:
    """Reviews with the category and subcategory their product was listed under.

    A product listed twice in a category counts once, by its first entry: the
    second listing brings the same texts again, which de-duplication drops.
    """
    listed = keep_first(ids, ["category", "id"], ["ordinal"]).select(
        "category",
        F.col("id").alias("product_id"),
        "subcategory",
        F.col("ordinal").alias("product_ordinal"),
    )
    joined = reviews.join(listed, "product_id", "left")
    empty = F.lit("")
    return joined.withColumn("subcategory", F.coalesce("subcategory", empty)).withColumn(
        "category", F.coalesce("category", empty)
    )


def start_from(
    entries: DataFrame,
    start: str,
    column: str = "subcategory",
    group: Sequence[str] = ("category",),
    order: str = "ordinal",
) -> DataFrame:
    """Entries from the first one equal to ``start`` on; groups without it stay whole."""
    starts = (
        entries.where(F.col(column) == start)
        .groupBy(*group)
        .agg(F.min(order).alias("_start"))
    )
    joined = entries.alias("l").join(starts.alias("r"), null_safe("l", "r", group), "left")
    after = F.col("_start").isNull() | (F.col(f"l.`{order}`") >= F.col("_start"))
    return joined.where(after).select("l.*")
