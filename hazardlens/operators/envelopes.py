"""Response envelopes to statuses, review rows, ids and the category tree."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.constants import (
    AUTH_CODES,
    BLOCK_CODE,
    PAGE_TOTAL_FIELDS,
    REVIEW_LIST_FIELDS,
    REVIEW_TEXT_FIELDS,
    SUBCATEGORY_MARK,
    SUCCESS_CODE,
    TOKEN_CODES,
)
from hazardlens.functions.text import (
    any_contains,
    first_text,
    is_usable,
    strip,
    total_pages,
    unwrap_callback,
)

# JSON texts of the scalars that count as missing.
_FALSE = ("null", '""', "0", "0.0", "false")


def parse_envelope(json: Column) -> Column:
    """Envelope as a VARIANT, so that one odd field leaves the others readable; NULL for no
    text, text that is no JSON and values that count as missing, an empty object among them."""
    return bound(F.try_parse_json(json), lambda v: F.when(_has_codes(v) | is_given(v), v))


def _has_codes(value: Column) -> Column:
    """Whether it is an object with codes, and so not empty, without opening it."""
    return part(value, "ret").isNotNull()


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def is_given(value: Column) -> Column:
    """Whether a JSON value is there and neither null, false, zero nor empty.

    Lists and objects are opened one level deep; only scalars are written as text.
    """
    listed = F.try_variant_get(value, "$", "array<variant>")
    fields = F.try_variant_get(value, "$", "map<string,variant>")
    scalar = ~F.coalesce(F.to_json(value), F.lit("null")).isin(*_FALSE)
    return F.when(listed.isNotNull(), F.size(listed) > 0).when(fields.isNotNull(), F.size(fields) > 0).otherwise(scalar)


def part(value: Column, path: str, kind: str = "variant") -> Column:
    """What is at the path, NULL where it leads nowhere or the type does not fit."""
    return F.try_variant_get(value, f"$.{path}", kind)


def given_part(value: Column, path: str) -> Column:
    """The part at the path if it is given."""
    return bound(part(value, path), lambda v: F.when(is_given(v), v))


def first_given(value: Column, *paths: str) -> Column:
    """The first part that is given, NULL if none is."""
    return F.coalesce(*[given_part(value, p) for p in paths])


def settle(
    df: DataFrame, value: Column, columns: Callable[[Column], dict[str, Column]]
) -> DataFrame:
    """Add ``columns(value)``, with ``value`` computed once, for later filters to use as they are.

    A filter on a projected column is moved below the projection and repeats its
    expression, here the parsing of a whole response. It cannot pass a generator.
    """

    def row(bound: Column) -> Column:
        return F.struct(*[column.alias(name) for name, column in columns(bound).items()])

    return df.select("*", F.inline(F.transform(F.array(value), row)))


def _no_texts() -> Column:
    return F.array().cast("array<string>")


def _by_codes(envelope: Column, status: Callable[[Column], Column]) -> Column:
    codes = part(envelope, "ret", "array<string>")
    return F.when(envelope.isNull(), "NO_RESPONSE").otherwise(bound(codes, status))


def call_status(envelope: Column) -> Column:
    """Status of a review or category response; success is tested before the token codes."""

    def status(codes: Column) -> Column:
        return (
            F.when(any_contains(codes, SUCCESS_CODE), "OK")
            .when(any_contains(codes, *TOKEN_CODES), "TOKEN_EXPIRED")
            .otherwise("ERROR")
        )

    return _by_codes(envelope, status)


def search_status(envelope: Column) -> Column:
    """Status of a search response, which has no success code: what is not refused is data."""
    flags = [part(envelope, name) for name in ("x5step", "rgv587_flag")]
    flagged = reduce(lambda a, b: a | b, [flag.isNotNull() & is_given(flag) for flag in flags])

    def status(codes: Column) -> Column:
        return (
            F.when(any_contains(codes, BLOCK_CODE) | flagged, "BLOCKED")
            .when(any_contains(codes, *AUTH_CODES), "AUTH")
            .otherwise("DATA")
        )

    return _by_codes(envelope, status)


def read_review_envelopes(pages: DataFrame) -> DataFrame:
    """Landed review pages with ``status``, ``texts`` (valid only), ``n_valid``, ``total_pages``."""

    def text(review: Column) -> Column:
        return strip(F.coalesce(first_given(review, *REVIEW_TEXT_FIELDS).cast("string"), F.lit("")))

    def content(data: Column) -> Column:
        reviews = F.try_variant_get(first_given(data, *REVIEW_LIST_FIELDS), "$", "array<variant>")
        totals = [F.try_variant_get(given_part(data, f), "$", "string") for f in PAGE_TOTAL_FIELDS]
        return F.struct(
            F.coalesce(F.filter(F.transform(reviews, text), is_usable), _no_texts()).alias("texts"),
            total_pages(*totals).alias("total_pages"),
        )

    def columns(envelope: Column) -> dict[str, Column]:
        return {"status": call_status(envelope), "_content": bound(part(envelope, "data"), content)}

    envelope = parse_envelope(unwrap_callback(F.col("body")))
    settled = settle(pages, envelope, columns).select("*", "_content.*")
    return settled.withColumn("n_valid", F.size("texts")).drop("body", "_content")


def explode_reviews(pages: DataFrame) -> DataFrame:
    """One row per valid review, with its position on the page."""
    kept = [c for c in pages.columns if c != "texts"]
    return pages.select(*kept, F.posexplode("texts").alias("pos", "review_text"))


def read_search_envelopes(pages: DataFrame) -> DataFrame:
    """Landed search pages with ``status``, ``ids``, ``n_ids`` and ``next_stream``."""

    def is_id(product_id: Column) -> Column:
        return ~F.coalesce(product_id, F.lit("")).isin("", "0")

    def content(result: Column) -> Column:
        # An item of another type is NULL in the list, the others stay.
        listed = part(result, "mods.itemList.content", "array<struct<productId:string>>")
        ids = F.transform(listed, lambda item: item["productId"])
        streams = [part(result, p, "string") for p in ("pageInfo.streamId", "streamId")]
        return F.struct(
            F.coalesce(F.filter(ids, is_id), _no_texts()).alias("ids"), first_text(*streams).alias("next_stream")
        )

    def columns(envelope: Column) -> dict[str, Column]:
        return {"status": search_status(envelope), "_content": bound(part(envelope, "data.result"), content)}

    envelope = parse_envelope(F.col("body"))
    settled = settle(pages, envelope, columns).select("*", "_content.*")
    return settled.withColumn("n_ids", F.size("ids")).drop("body", "_content")


def explode_ids(pages: DataFrame) -> DataFrame:
    """One row per id, with its position on the page."""
    kept = [c for c in pages.columns if c != "ids"]
    return pages.select(*kept, F.posexplode("ids").alias("pos", "id"))


def _items(value: Column, path: str) -> Column:
    """Items with text id and title; what is no object has neither."""
    listed = part(value, path, "array<variant>")
    return F.transform(
        listed,
        lambda item: F.struct(
            part(item, "id", "string").alias("id"), part(item, "title", "string").alias("title")
        ),
    )


def tab_list(tabs: DataFrame) -> DataFrame:
    """Tabs that a first response lists: ``tab_pos``, ``tab_id``, ``tab_title``.

    A response that failed lists none. A tab without an id is left out; a missing title falls
    back to the id, an empty one stays.
    """

    def columns(envelope: Column) -> dict[str, Column]:
        items = _items(envelope, "data.data.categoryTabs.items")
        return {"_tabs": F.when(call_status(envelope) == "OK", items)}

    listed = settle(tabs.select("body"), parse_envelope(F.col("body")), columns).select(
        F.posexplode("_tabs").alias("tab_pos", "item")
    )
    tab_id = F.col("item")["id"]
    return listed.where(F.coalesce(tab_id, F.lit("")) != "").select(
        "tab_pos", tab_id.alias("tab_id"), F.coalesce(F.col("item")["title"], tab_id).alias("tab_title")
    )


def read_tab_envelopes(tabs: DataFrame) -> DataFrame:
    """Landed tab responses with ``status`` and ``subcategories``.

    The first module whose first item id carries the mark is used and none after it.
    """

    def is_marked(items: Column) -> Column:
        first_id = F.get(items, F.lit(0))["id"]
        return F.coalesce(F.contains(first_id, F.lit(SUBCATEGORY_MARK)), F.lit(False))

    def columns(envelope: Column) -> dict[str, Column]:
        modules = part(envelope, "data.data.modules", "array<variant>")
        marked = F.filter(F.transform(modules, lambda m: _items(m, "data.items")), is_marked)
        titles = F.get(marked, F.lit(0))["title"]
        return {
            "status": call_status(envelope),
            "subcategories": F.filter(titles, lambda t: F.coalesce(t, F.lit("")) != ""),
        }

    envelope = parse_envelope(F.col("body"))
    return settle(tabs, envelope, columns).drop("body")


def category_tree(tabs: DataFrame) -> DataFrame:
    """Subcategories per category, sorted; a later non-empty tab of the same title wins.

    Expects tab responses with ``tab_pos`` and ``tab_title``.
    """
    filled = read_tab_envelopes(tabs).where(
        (F.col("status") == "OK") & (F.size("subcategories") > 0)
    )
    return filled.groupBy(F.col("tab_title").alias("category")).agg(
        F.array_sort(F.max_by("subcategories", "tab_pos")).alias("subcategories")
    )
