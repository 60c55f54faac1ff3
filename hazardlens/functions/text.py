"""Column functions on text: fallback, stripping, slugs, keys and small formats."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazardlens.constants import (
    CALLBACK_WRAPPER,
    CONTROL_CHARS,
    MAX_REVIEW_CHARS,
    WHITESPACE,
)


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends; Spark's plain trim knows only the space."""
    return F.trim(text, F.lit(WHITESPACE))


def first_text(*texts: Column) -> Column:
    """First text that is neither NULL nor empty, else the empty string.

    A blank text such as two spaces counts as present: strip afterwards.
    """
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts], F.lit(""))


def first_list(*lists: Column) -> Column:
    """First list that has elements, else NULL; for lists that are typed already."""
    return F.coalesce(*[F.when(F.size(c) > 0, c) for c in lists])


def has_control_chars(text: Column) -> Column:
    return F.rlike(text, F.lit(CONTROL_CHARS))


def is_usable(text: Column) -> Column:
    """Non-empty and free of control characters; expects stripped text."""
    return (text != "") & ~has_control_chars(text)


def total_pages(*totals: Column) -> Column:
    """First total that is a number other than zero, else 1; a fraction is cut off."""
    numbers = [F.nullif(F.floor(t.try_cast("double")).cast("int"), F.lit(0)) for t in totals]
    return F.coalesce(*numbers, F.lit(1))


def unwrap_callback(body: Column) -> Column:
    """JSON text inside the callback wrapper, NULL when there is no wrapper."""
    return F.nullif(F.regexp_extract(body, CALLBACK_WRAPPER, 1), F.lit(""))


def slug(name: Column) -> Column:
    """Lower-case name with every run of other characters as one underscore."""
    return F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_"), F.lit("_"))


def remove_prefix(text: Column, prefix: str) -> Column:
    cut = F.substring(text, F.lit(len(prefix) + 1), F.length(text))
    return F.when(F.startswith(text, F.lit(prefix)), cut).otherwise(text)


def remove_suffix(text: Column, suffix: str) -> Column:
    cut = F.substring(text, F.lit(1), F.length(text) - F.lit(len(suffix)))
    return F.when(F.endswith(text, F.lit(suffix)), cut).otherwise(text)


def category_of_file(name: Column, prefix: str, suffix: str) -> Column:
    """Category slug held in a file name such as ``shop_{category}_ids.json``."""
    return remove_suffix(remove_prefix(name, prefix), suffix)


def truncate(text: Column, chars: int = MAX_REVIEW_CHARS) -> Column:
    """First ``chars`` code points."""
    return F.substring(text, 1, chars)


def numbered_line(index: Column, text: Column) -> Column:
    return F.concat(index.cast("string"), F.lit(". "), text)


def any_contains(texts: Column, *parts: str) -> Column:
    """True when an element of the list contains one of ``parts``; false for no list."""

    def found(text: Column) -> Column:
        return reduce(lambda a, b: a | b, [F.contains(text, F.lit(part)) for part in parts])

    return F.coalesce(F.exists(texts, found), F.lit(False))


def review_key(category: Column, product_id: Column, text: Column) -> Column:
    """Stable key of one review inside one category."""
    empty = F.lit("")
    return F.md5(
        F.concat_ws(
            "&",
            F.coalesce(slug(category), empty),
            F.coalesce(product_id, empty),
            F.coalesce(text, empty),
        )
    )


def attribute_map(text: Column) -> Column:
    """``k=v; k2=v2`` as a map: split at the first ``=``, both sides stripped, last value wins."""
    pairs = F.filter(F.split(text, ";"), lambda item: F.contains(item, F.lit("=")))
    entries = F.transform(
        pairs,
        lambda item: F.struct(
            strip(F.substring_index(item, "=", 1)).alias("key"),
            strip(F.substring(item, F.locate("=", item) + 1, F.length(item))).alias("value"),
        ),
    )

    def last(found: Column) -> Column:
        keys = F.transform(found, lambda e: e["key"])
        # The place of the last entry of each key, counted from the end.
        return F.transform(F.array(F.reverse(keys)), lambda back: F.filter(
            found, lambda e, i: F.array_position(back, e["key"]) == F.size(back) - i
        ))

    kept = F.get(F.flatten(F.transform(F.array(entries), last)), F.lit(0))
    return F.map_from_entries(kept)


def prefix_before(text: Column, mark: str = "_") -> Column:
    return F.substring_index(text, mark, 1)


def format_elapsed(seconds: Column) -> Column:
    """``2h 5m 3s``; the hours are left out when there are none."""
    s = seconds.cast("bigint")
    hours, minutes, rest = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    short = F.concat(minutes.cast("string"), F.lit("m "), rest.cast("string"), F.lit("s"))
    return F.when(s >= 3600, F.concat(hours.cast("string"), F.lit("h "), short)).otherwise(short)


def json_path(json: Column, path: str, default: str = "") -> Column:
    """Value at a path of a JSON text, the default where the path leads nowhere."""
    return F.coalesce(F.get_json_object(json, path), F.lit(default))


def compact_json(**fields: Column) -> Column:
    """Fields as compact JSON text; NULL fields are left out."""
    return F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def id_text(number: Column) -> Column:
    return number.cast("string")


def id_number(text: Column) -> Column:
    """Id as a number, NULL where it is none."""
    return text.try_cast("bigint")
