"""From landed responses to id lists, raw reviews and the category tree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlens.functions.text import review_key
from hazardlens.operators.dedup import dedup_reviews, merge_ids
from hazardlens.operators.envelopes import (
    category_tree,
    explode_ids,
    explode_reviews,
    read_review_envelopes,
    read_search_envelopes,
    tab_list,
)
from hazardlens.operators.paging import (
    first_usable_attempt,
    review_pages_read,
    search_pages_read,
)
from hazardlens.operators.worklist import enrich_subcategory, negative_only
from hazardlens.session import materialize


def usable_review_pages(pages: DataFrame) -> DataFrame:
    """The attempt that settles each landed review page, if it succeeded, parsed and written once.

    Only expired tokens and failed requests are tried again; any other error ends the page.
    """
    parsed = read_review_envelopes(pages)
    key = ["product_id", "star", "page"]
    again = F.col("status").isin("TOKEN_EXPIRED", "NO_RESPONSE")
    first = first_usable_attempt(parsed, key, ["attempt"], F.col("status") == "OK", again)
    return materialize(first, "review_pages")


def usable_search_pages(pages: DataFrame) -> DataFrame:
    """First attempt of each landed search page that brought data, parsed and written once."""
    parsed = read_search_envelopes(pages)
    key = ["category", "subcategory", "page"]
    first = first_usable_attempt(parsed, key, ["attempt"], F.col("status") == "DATA")
    return materialize(first, "search_pages")


def collect_reviews(pages: DataFrame, ids: DataFrame) -> DataFrame:
    """Landed review pages of listed products as raw reviews with arrival and key.

    ``arrival`` is the place of the product in its list, then star, page and position. Pages of other
    products are not parsed. Pages meet the id list before the reviews are taken out of them, so the join
    moves pages and not reviews.
    """
    wanted = ids.select(F.col("id").alias("product_id")).distinct()
    usable = usable_review_pages(negative_only(pages).join(wanted, "product_id", "left_semi"))
    listed = enrich_subcategory(review_pages_read(usable), ids)
    known = listed.where(F.col("product_ordinal").isNotNull())
    arrival = F.struct(F.col("product_ordinal").alias("product"), "star", "page", "pos")
    rows = explode_reviews(known).withColumn("arrival", arrival)
    raw = rows.select("category", "product_id", "subcategory", "review_text", "arrival")
    return dedup_reviews(raw).withColumn(
        "review_key", review_key(F.col("category"), F.col("product_id"), F.col("review_text"))
    )


def collect_ids(pages: DataFrame, existing: DataFrame) -> DataFrame:
    """Existing ids followed by the new ones on the landed search pages."""
    return merge_ids(explode_ids(search_pages_read(usable_search_pages(pages))), existing)


def collect_tree(first_response: DataFrame, tabs: DataFrame) -> DataFrame:
    """Category tree of the tabs that ``first_response`` lists."""
    listed = tab_list(first_response)
    bodies = tabs.select("tab_id", "body")
    return category_tree(listed.join(bodies, "tab_id"))
