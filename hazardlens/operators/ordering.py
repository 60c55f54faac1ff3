"""Ordinals, running totals, slices and sorts without one task per group.

A group of rows that one task can sort is numbered by a window. A category may hold a third of
all rows, though, with their whole texts; groups beyond a fixed number of rows are dealt out by
ranges of keys and order and written once, whole. A range holds about as many rows as a window
may, however large the table is, and what follows finds the rows dealt out already. What a
range adds to a group is known after one pass over narrow columns, so that no window sees more
than one row per range and group. Which groups are large is counted on the keys alone.

Keys and order columns may be NULL: NULL keys are a group, NULL order values come last.
Order columns can be of any type that sorts, structs included.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardlens.session import materialize


#: Rows of a group that one task may sort, whole texts among them; larger groups are numbered by
#: ranges of about so many rows.
WINDOW_ROWS = 10_000


def null_safe(left: str, right: str, keys: Sequence[str]) -> Column:
    """Join condition between two aliases that lets NULL keys meet."""
    same = [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys]
    return reduce(lambda a, b: a & b, same, F.lit(True))


def in_order(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def arrival_order(reviews: DataFrame) -> list[str]:
    """What tells earlier reviews of a category from later ones: ``arrival``, after the rank
    or batch that merging added, within which alone it is unique."""
    return [c for c in ("source_rank", "batch") if c in reviews.columns] + ["arrival"]


def _ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int) -> DataFrame:
    """``df``, of ``rows`` rows, sorted in ranges of keys and order, with ``_place``: the range in
    the upper bits and the row's place in it in the lower 33."""
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // WINDOW_ROWS))
    by = [*keys, *in_order(order)]
    ranged = df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    return materialize(ranged.withColumn("_place", F.monotonically_increasing_id()), "ranged")


def _earlier_ranges(parts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``_base``: the sum of ``value`` over earlier ranges of the same keys."""
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("_base", F.coalesce(F.sum(value).over(earlier), F.lit(0)))



def _by_size(
    df: DataFrame,
    keys: Sequence[str],
    most: int,
    small: Callable[[DataFrame], DataFrame],
    large: Callable[[DataFrame, int], DataFrame],
) -> DataFrame:
    """``small`` of the rows in groups of up to ``most`` rows and ``large`` of the others, which
    is told their number."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    crowded = materialize(counts.where(F.col("_rows") > most), "crowded")
    rows = crowded.agg(F.sum("_rows")).first()[0]
    if not rows:
        return small(df)
    meet = null_safe("l", "r", keys)
    parts = [df.alias("l").join(crowded.select(*keys).alias("r"), meet, how) for how in ("left_anti", "left_semi")]
    return small(parts[0]).unionByName(large(parts[1], rows))


def ordinal(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "ordinal", most: int = WINDOW_ROWS
) -> DataFrame:
    """Add ``out``: 1-based position within the keys, in the order of the columns."""
    columns = list(df.columns)

    def windowed(rows: DataFrame) -> DataFrame:
        number = F.row_number().over(Window.partitionBy(*keys).orderBy(*in_order(order)))
        return rows.select(*[f"`{c}`" for c in columns], number.cast("bigint").alias(out))

    def ranged(rows: DataFrame, count: int) -> DataFrame:
        place = _ranged(rows, keys, order, count)
        of = F.shiftright("_place", 33)
        parts = place.groupBy(*keys, of.alias("_range")).agg(
            F.count("*").alias("_n"), F.min("_place").alias("_first")
        )
        bases = _earlier_ranges(parts, keys, "_n")
        joined = place.withColumn("_range", of).alias("l").join(
            bases.alias("r"), null_safe("l", "r", [*keys, "_range"])
        )
        position = F.col("_place") - F.col("_first") + F.col("_base") + 1
        return joined.select(*[f"l.`{c}`" for c in columns], position.alias(out))

    return _by_size(df, keys, most, windowed, ranged)


def running_total(
    df: DataFrame, keys: Sequence[str], order: str, value: str, out: str, most: int = WINDOW_ROWS
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over earlier rows of the same keys."""
    columns = list(df.columns)

    def windowed(rows: DataFrame) -> DataFrame:
        before = Window.partitionBy(*keys).orderBy(*in_order([order])).rowsBetween(Window.unboundedPreceding, -1)
        total = F.coalesce(F.sum(value).over(before), F.lit(0)).cast("bigint")
        return rows.select(*[f"`{c}`" for c in columns], total.alias(out))

    def ranged(rows: DataFrame, count: int) -> DataFrame:
        place = _ranged(rows, keys, [order], count).withColumn("_range", F.shiftright("_place", 33))
        earlier = (
            Window.partitionBy(*keys, "_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
        )
        within = place.withColumn("_within", F.coalesce(F.sum(value).over(earlier), F.lit(0)))
        sums = place.groupBy(*keys, "_range").agg(F.sum(value).alias("_sum"))
        joined = within.alias("l").join(
            _earlier_ranges(sums, keys, "_sum").alias("r"), null_safe("l", "r", [*keys, "_range"])
        )
        total = (F.col("_within") + F.col("_base")).cast("bigint")
        return joined.select(*[f"l.`{c}`" for c in columns], total.alias(out))

    return _by_size(df, keys, most, windowed, ranged)


def first_per_group(df: DataFrame, keys: Sequence[str], order: str, n: int) -> DataFrame:
    """First ``n`` rows of each group; each task passes on at most ``n`` rows per group."""
    window = Window.partitionBy(*keys).orderBy(*in_order([order]))
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= n).drop("_rn")


def skip_per_group(df: DataFrame, keys: Sequence[str], order: str, n: int) -> DataFrame:
    """Rows after the first ``n`` of each group."""
    return ordinal(df, keys, [order], "_position").where(F.col("_position") > n).drop("_position")


def numeric_id(column: str = "product_id") -> Column:
    """The id as a number that sorts, NULL where it is none."""
    return F.col(column).try_cast("decimal(38,0)")


def sort_by_numeric_id(df: DataFrame, id_column: str = "product_id", tie: Sequence[str] = ("arrival",)):
    """Total order by the id as a number, ids that are none last; ``tie`` also splits the rows of one id."""
    return df.orderBy(numeric_id(id_column).asc_nulls_last(), F.col(id_column).asc_nulls_last(), *in_order(tie))
