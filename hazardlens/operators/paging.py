"""Which landed pages count: attempt resolution and end of pagination."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardlens.operators.dedup import keep_first
from hazardlens.operators.ordering import running_total

PAGE_BITS = 10


def first_usable_attempt(
    attempts: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    usable: Column,
    retry: Column | None = None,
) -> DataFrame:
    """The attempt that settles each page, if it is usable; other pages vanish.

    An attempt that ``retry`` marks is followed by another one, any other settles the page,
    usable or not. Without ``retry`` all that are not usable are tried again.
    """
    settled = attempts.where(usable if retry is None else ~retry)
    first = keep_first(settled, keys, order)
    return first if retry is None else first.where(usable)


def take_while(
    pages: DataFrame,
    keys: Sequence[str],
    page: str,
    stop: str,
    inclusive: bool = True,
    bits: int = PAGE_BITS,
    levels: int = 2,
) -> DataFrame:
    """Pages 1, 2, 3, ... up to the first with ``stop`` set or the first gap.

    ``page`` is unique within the keys. ``inclusive`` keeps the stop page itself.
    Pages are judged inside chunks of ``2 ** bits`` pages. A chunk is reached when
    the chunks before it are complete and free of stops, which is the same question
    asked about chunks, so no window below the top level sees more than one chunk.
    ``pages`` is read twice, the second time without its wide columns: pass a table.
    """
    chunk = f"_chunk{levels}"
    groups = [*keys, chunk] if levels else list(keys)
    number = F.col(page).cast("bigint")
    chunked = pages.where(number >= 1)
    first = F.lit(1)
    if levels:
        chunked = chunked.withColumn(chunk, F.shiftright(number - 1, bits))
        first = F.shiftleft(F.col(chunk), bits) + 1
    ordered = Window.partitionBy(*groups).orderBy(page)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    stopped = F.coalesce(F.max(stop).over(earlier), F.lit(False))
    kept = (
        chunked.withColumn("_gapless", F.row_number().over(ordered) == number - first + 1)
        .withColumn("_open", ~stopped if inclusive else ~(stopped | F.col(stop)))
        .where(F.col("_gapless") & F.col("_open"))
        .drop("_gapless", "_open")
    )
    if not levels:
        return kept
    chunks = chunked.groupBy(*groups).agg(
        (F.bool_or(stop) | (F.count("*") < 2**bits)).alias("_end")
    )
    numbered = chunks.withColumn("_number", F.col(chunk) + 1)
    reached = take_while(numbered, keys, "_number", "_end", True, bits, levels - 1)
    return kept.join(reached.select(*groups), groups).drop(chunk)


def review_pages_read(
    pages: DataFrame, keys: Sequence[str] = ("product_id", "star")
) -> DataFrame:
    """Pages that pagination reads: stops after the last page or one without valid reviews.

    Expects usable pages with ``page``, ``total_pages`` and ``n_valid``.
    """
    end = (F.col("page") >= F.col("total_pages")) | (F.col("n_valid") == 0)
    marked = pages.withColumn("_stop", end)
    return take_while(marked, keys, "page", "_stop").drop("_stop")


def search_pages_read(
    pages: DataFrame, keys: Sequence[str] = ("category", "subcategory")
) -> DataFrame:
    """Search pages up to, not including, the first without ids; expects ``n_ids``."""
    marked = pages.withColumn("_stop", F.col("n_ids") == 0)
    return take_while(marked, keys, "page", "_stop", inclusive=False).drop("_stop")


def running_new_ids(
    found: DataFrame,
    fresh: DataFrame,
    keys: Sequence[str] = ("category", "subcategory"),
    page: str = "page",
) -> DataFrame:
    """New ids per page and their count up to and including that page.

    ``found`` holds every sighting, ``fresh`` the ones that were new; both are
    counted per page before any window runs.
    """
    per_page = found.groupBy(*keys, page).agg(F.count("*").alias("ids_seen"))
    fresh_per_page = fresh.groupBy(*keys, page).agg(F.count("*").alias("_new"))
    counts = per_page.join(fresh_per_page, [*keys, page], "left").withColumn(
        "new_ids", F.coalesce("_new", F.lit(0))
    )
    totals = running_total(counts.drop("_new"), keys, page, "new_ids", "_before")
    return totals.withColumn("new_so_far", F.col("_before") + F.col("new_ids")).drop("_before")
