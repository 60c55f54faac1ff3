"""SimHash of word shingles, and near duplicates by multi-index hashing."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from hazardlens.llm.common import add_columns, packed
from hazardlens.llm.components import components
from hazardlens.session import materialize

WORDS, RADIUS, SEGMENTS, SEED = 3, 3, 2, 42
#: Segments that more fingerprints share are looked up by a part of the other bits as well.
CROWD = 512
_CHUNK = 65_536


def text_fingerprint(text: str | None, words: int = WORDS) -> int:
    """64-bit SimHash of the shingles of ``words`` words, as a signed integer.

    A-Z are lower-cased; words are runs of anything but ASCII white space. Fewer words than
    a shingle holds make one shingle; no word gives zero. A bit is set if more than half of
    the shingles, repeats included, have it set in their XXH64.
    """
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    counts, total = np.zeros(64, np.int64), max(1, len(parts) - words + 1)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, _CHUNK):
        own = parts[at : min(at + _CHUNK, total) + words - 1]
        shingles = zip(*[own[i:] for i in range(words)], strict=False)
        if len(parts) < words:
            shingles = [parts]
        hashes = np.array([digest(b" ".join(s), SEED) for s in shingles], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > total, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS, text: str = "text") -> DataFrame:
    """``docs`` with ``fp``, the SimHash of each whole text; null counts as empty."""

    def make():
        return lambda value: (text_fingerprint(value, words),)

    return add_columns(docs, [text], [StructField("fp", LongType(), False)], make)


def segments(count: int) -> list[tuple[int, int]]:
    """Start and width of ``count`` segments that cover 64 bits."""
    ends = [64 * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:], strict=False)]


def _segment(fp: Column, start: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, start).bitwiseAND(F.lit((1 << width) - 1))


def ball(width: int, radius: int) -> list[int]:
    """Masks of all changes of at most ``radius`` bits in a segment."""
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def _finer(rows: DataFrame, fp: str, radius: int, count: int) -> DataFrame:
    """``rows`` once for each of ``radius + 1`` parts of the bits outside their segment, with
    the part's number ``c`` and value ``v``. Near fingerprints agree in one of the parts."""
    parts = []
    for c in range(radius + 1):
        value = F.lit(0).cast("long")
        for number, (start, width) in enumerate(segments(count)):
            end, rest = start + width, 64 - width
            low, high = rest * c // (radius + 1), rest * (c + 1) // (radius + 1)
            turned = F.shiftrightunsigned(fp, end) if end < 64 else F.lit(0).cast("long")
            turned = turned.bitwiseOR(F.shiftleft(fp, 64 - end))
            own = F.shiftrightunsigned(turned, low).bitwiseAND(F.lit((1 << (high - low)) - 1))
            value = F.when(F.col("t") == number, own).otherwise(value)
        parts.append(F.struct(F.lit(c).alias("c"), value.alias("v")))
    return rows.select("*", F.inline(F.array(*parts)))


def links(
    distinct: DataFrame,
    radius: int = RADIUS,
    count: int = SEGMENTS,
    fp: str = "fp",
    crowd: int = CROWD,
) -> DataFrame:
    """Pairs ``a`` < ``b`` of different fingerprints that differ in 1 to ``radius`` bits.

    Of fingerprints within ``radius``, one of ``count`` segments differs in at most
    ``radius // count`` bits. Every fingerprint is looked up under all such changes of each
    segment in a table of the segments as they are; whole distances are verified. Where more
    than ``crowd`` fingerprints share a segment, they must agree in a part of the others too.
    """
    near = radius // count
    stored, probes = [], []
    base = distinct.select(F.col(fp).alias("fp"))
    for number, (start, width) in enumerate(segments(count)):
        own = _segment(F.col("fp"), start, width)
        stored.append(F.struct(F.lit(number).alias("t"), own.alias("s")))
        for change in ball(width, near):
            changed = own.bitwiseXOR(F.lit(change).cast("long"))
            probes.append(F.struct(F.lit(number).alias("t"), changed.alias("s")))
    table = base.select(F.col("fp").alias("b"), F.inline(F.array(*stored)))
    probe = base.select(F.col("fp").alias("a"), F.inline(F.array(*probes)))
    full = table.groupBy("t", "s").agg(F.count("*").alias("n")).where(F.col("n") > crowd)
    full = materialize(full.select("t", "s"), "crowds")
    if full.isEmpty():
        found = probe.join(table, ["t", "s"]).where("a < b")
    else:
        sparse = probe.join(full, ["t", "s"], "left_anti").join(table, ["t", "s"])
        asked = _finer(probe.join(full, ["t", "s"], "left_semi"), "a", radius, count)
        held = _finer(table.join(full, ["t", "s"], "left_semi"), "b", radius, count)
        dense = asked.join(held, ["t", "s", "c", "v"])
        found = sparse.select("a", "b").unionAll(dense.select("a", "b")).where("a < b")
    distance = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return found.where(distance <= radius).select("a", "b").distinct()


def groups(
    docs: DataFrame, words: int = WORDS, radius: int = RADIUS, count: int = SEGMENTS
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fp`` and ``component_id``.

    Documents whose fingerprints differ in at most ``radius`` bits are linked, empty ones
    with fingerprint zero like any other; ``component_id`` is the smallest doc_id that can be
    reached, nulls aside (null if there is none). Equal fingerprints are one node, so copies
    are never paired. Rows that repeat stay. An empty table gives no rows.
    """
    own = materialize(fingerprints(docs.select("doc_id", "text"), words).select("doc_id", "fp"), "fp")
    nodes = own.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(nodes, radius, count))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = rooted.join(least, "root").select("fp", "component_id")
    return own.join(by_print, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay, one per component, with all their columns: the one
    with the smallest doc_id, nulls last, then the smallest fingerprint, text and further columns."""
    keyed = fingerprints(packed(docs, "doc_id", "text"), words).drop("text")
    nodes = keyed.groupBy("fp").agg(F.min("doc_id").alias("least"))
    nodes = materialize(nodes, "fp")
    roots = components(links(nodes, radius))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    order = [F.col("least").asc_nulls_last(), "fp"]
    first = F.row_number().over(Window.partitionBy("root").orderBy(*order))
    stay = rooted.withColumn("place", first).where("place = 1").select("fp", "least")
    same = (F.col("d.fp") == F.col("s.fp")) & F.col("d.doc_id").eqNullSafe(F.col("s.least"))
    found = keyed.alias("d").join(stay.alias("s"), same, "left_semi")
    others = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() != "text"]
    order = [F.col("row.text"), F.to_json(F.struct(*others))]
    only = F.row_number().over(Window.partitionBy("fp", "doc_id").orderBy(*order))
    return found.withColumn("place", only).where("place = 1").select("row.*")
