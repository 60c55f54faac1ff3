"""Near duplicates by SimHash and the Jaccard similarity of word shingles, without missing any pair.

Multi-index hashing finds the fingerprints that differ in few bits; whole sets decide on the
texts that have them. Fingerprints of 64 bits miss similar texts, so an exact way finds the rest,
and only looks at texts that are not connected yet.

For that, shingles are put into one order for the whole table, the common ones last. Of two similar texts
the smaller one has its first common shingle early in that order, the larger one a little later
at the most (prefix filter with positions), so only texts that meet there are compared. Most
shingles of a prefix stand in one text only; a sketch of a fixed size leaves nearly all of them
out before anything is shuffled. Pairs that meet must agree in enough bits of a small bitmap, and
are then decided by their whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StructField, StructType

from hazardlens.llm import simhash
from hazardlens.llm.common import add_columns, packed, whole_text
from hazardlens.llm.components import components
from hazardlens.session import discard, materialize

WORDS, LEAST = 5, 0.8
#: About so many texts are read, of each the first code points, for the order of shingles: any
#: order gives the same result, one with the common ones last compares fewer texts.
_SAMPLE, _SAMPLE_CHARS, _COMMON = 4_000, 20_000, 100_000
#: While more texts than ``_CROWD`` meet at a shingle, at most so many rounds compare them with
#: one of them; after that all are compared with all that they are not connected to.
_PIVOTS, _CROWD = 3, 64
#: The sketch has 2 ** _SLOTS places of two bits, in blocks of 2 ** 16; it says of a shingle that it
#: stands in one prefix at most, and may fail to say so. So many blocks are put together by a task.
_SLOTS, _BLOCKS = 28, 16
#: Texts whose places in a block are put together at a time, and entries of a task's portion.
_TEXTS, _ENTRIES = 5_000_000, 2_000_000
#: Bits of a set's bitmap; sets of more shingles have a second one, of up to so many bits.
_BITS, _WIDE = 512, 1 << 16
_TIMES = np.random.default_rng(42).integers(1, 1 << 62, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def text_shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The different shingles of ``words`` words, as sorted 64-bit hashes.

    A-Z are lower-cased; words are runs of anything but ASCII white space. Fewer words than
    a shingle holds make one shingle; no word gives none.
    """
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.zeros(0, np.int64)
    own = np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, len(parts))
    width = min(words, len(own))
    mixed = np.full(len(own) - width + 1, width, np.uint64)
    for i in range(width):
        mixed += own[i : len(own) - width + 1 + i] * _TIMES[i]
        mixed ^= mixed >> np.uint64(29)
    return np.unique((mixed * _TIMES[-1]).view(np.int64))


def _node(own: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63)


def _sets(docs: DataFrame, words: int) -> DataFrame:
    def make():
        return lambda text: (text_shingles(text, words),)

    return add_columns(docs, ["text"], [StructField("own", ArrayType(LongType(), False), False)], make)


def _common(docs: DataFrame, words: int, every: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several texts of a sample share, sorted, and their counts."""
    some = docs.where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0)
    some = some.select(F.substring("text", 1, _SAMPLE_CHARS).alias("text"))
    counts = _sets(some, words).select(F.explode("own").alias("s")).groupBy("s").count()
    rows = counts.where("count > 2").orderBy(F.desc("count"), "s").limit(_COMMON).toArrow()
    shingle, count = (rows.column(i).to_numpy() for i in range(2))
    at = np.argsort(shingle)
    return shingle[at], count[at]


def _prefix(own: np.ndarray, common: np.ndarray, count: np.ndarray, least: float) -> np.ndarray:
    """The first shingles of a set in the order: as many as a text that is no larger can make it
    wait for the first one they share, if they are similar."""
    rank = np.zeros(len(own), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, own), len(common) - 1)
        rank = np.where(common[at] == own, count[at], 0)
    length = len(own) - int(np.ceil(least * len(own) - 1e-9)) + 1 if len(own) else 0
    return own[np.lexsort((own, rank))[:length]]


def _slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles.view(np.uint64) * _TIMES[0]) >> np.uint64(64 - _SLOTS)


def _sketch(docs: DataFrame, words: int, least: float, sent, parts: int) -> np.ndarray:
    """For each place of the sketch whether two prefixes or more have a shingle there, as bits.

    A task sends the places of its prefixes, two bytes each, by block. The result has 2 ** 28 bits
    whatever the size of the table.
    """

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, count = sent.value

        def portion(held: list[np.ndarray], number: int) -> pa.RecordBatch:
            slots = np.sort(np.concatenate(held))
            block = (slots >> np.uint64(16)).astype(np.int32)
            first = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
            low = slots.astype(np.uint16)
            own = [low[a:b].tobytes() for a, b in zip(first, np.append(first[1:], len(low)), strict=True)]
            part = np.full(len(first), number % parts, np.int32)
            columns = [block[first] // _BLOCKS, part, block[first]]
            return pa.RecordBatch.from_arrays(
                [*[pa.array(c, pa.int32()) for c in columns], pa.array(own, pa.binary())],
                names=["blocks", "part", "block", "places"],
            )

        held, size = [], 0
        for batch in batches:
            for text in batch.column("text"):
                own = _slots(_prefix(text_shingles(text.as_py(), words), common, count, least))
                if len(own):
                    held.append(own)
                    size += len(own)
                if size > _ENTRIES:
                    yield portion(held, int(own[0]))
                    held, size = [], 0
        if held:
            yield portion(held, int(held[0][0]))

    def counted(group: pa.Table) -> pa.Table:
        once: dict[int, np.ndarray] = {}
        many: dict[int, np.ndarray] = {}
        for block, places in zip(group.column("block").to_pylist(), group.column("places").to_pylist(), strict=True):
            seen = np.bincount(np.frombuffer(places, np.uint16), minlength=1 << 16)
            before = once.setdefault(block, np.zeros(1 << 16, bool))
            many.setdefault(block, np.zeros(1 << 16, bool))[:] |= (seen > 1) | (before & (seen > 0))
            before |= seen > 0
        return bits(once, many)

    def merged(group: pa.Table) -> pa.Table:
        once, many = {}, {}
        rows = zip(*[group.column(n).to_pylist() for n in ("block", "once", "many")], strict=True)
        for block, one, more in rows:
            seen = np.unpackbits(np.frombuffer(one, np.uint8)).astype(bool)
            before = once.setdefault(block, np.zeros(1 << 16, bool))
            own = np.unpackbits(np.frombuffer(more, np.uint8)).astype(bool)
            many.setdefault(block, np.zeros(1 << 16, bool))[:] |= own | (before & seen)
            before |= seen
        return bits(once, many)

    def bits(once: dict[int, np.ndarray], many: dict[int, np.ndarray]) -> pa.Table:
        of = lambda held: pa.array([np.packbits(b).tobytes() for b in held.values()], pa.binary())
        block = pa.array(list(once), pa.int32())
        return pa.Table.from_arrays([pa.array([b // _BLOCKS for b in once], pa.int32()), block, of(once), of(many)],
                                    names=["blocks", "block", "once", "many"])

    told = docs.select("text").mapInArrow(places, "blocks int, part int, block int, places binary")
    schema = "blocks int, block int, once binary, many binary"
    found = told.groupBy("blocks", "part").applyInArrow(lambda _, group: counted(group), schema)
    if parts > 1:
        found = found.groupBy("blocks").applyInArrow(merged, schema)
    found = materialize(found.select("block", "many"), "sketch")
    out = np.zeros(1 << (_SLOTS - 3), np.uint8).reshape(-1, 1 << 13)
    for block, many in found.toLocalIterator():  # the driver holds a part of it at a time beside the result
        out[block] = np.frombuffer(many, np.uint8)
    discard(found)
    return out.reshape(-1)


def _odd(own: np.ndarray, bits: int) -> np.ndarray:
    """For each bit whether an odd number of shingles fall on it, packed."""
    return np.packbits(np.bincount((own & (bits - 1)).astype(np.int64), minlength=bits) & 1)


def _wide(own: np.ndarray) -> bytes:
    """A bitmap about as long as the set, for sets that fill the small one."""
    if len(own) <= _BITS:
        return b""
    return _odd(own, min(_WIDE, 1 << int(len(own) - 1).bit_length())).tobytes()


def _unlike(x: bytes, y: bytes) -> int:
    """Bits that differ, at the length of the shorter bitmap; a longer one is folded."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) != len(b):
        a, b = (a, b) if len(a) > len(b) else (b, a)
        half = len(a) // 2
        a = a[:half] ^ a[half:]
    return int(np.bitwise_count(a ^ b).sum())


_ENTRY = StructType([StructField("s", LongType(), False), StructField("i", IntegerType(), False)])


def _prefixes(docs: DataFrame, words: int, least: float) -> DataFrame:
    """``docs``, written, without ``text`` but with ``node`` (the same for equal sets), ``fp`` (the SimHash of its
    shingles), ``size``, ``bits`` and ``wide`` (how often
    shingles fall on each bit, odd or even) and ``prefix``: shingles that other prefixes may have too, and their
    places among all shingles of the text."""
    context, total = docs.sparkSession.sparkContext, docs.count()
    order = context.broadcast(_common(docs, words, max(1, total // _SAMPLE)))
    shared = context.broadcast(_sketch(docs, words, least, order, 1 + total // _TEXTS))
    sent = [order, shared]

    def make():
        common, count = order.value
        many = shared.value

        def call(text):
            own = text_shingles(text, words)
            prefix = _prefix(own, common, count, least)
            slot = _slots(prefix)
            kept = np.flatnonzero((many[slot >> np.uint64(3)] >> (np.uint64(7) - (slot & np.uint64(7))).astype(np.uint8)) & 1)
            listed = [dict(s=s, i=i) for s, i in zip(prefix[kept].tolist(), kept.tolist(), strict=True)]
            print_ = simhash.text_fingerprint(text, words)
            return _node(own), print_, len(own), _odd(own, _BITS).view(np.int64).tolist(), _wide(own), listed

        return call

    fields = [
        StructField("node", LongType(), False), StructField("fp", LongType(), False), StructField("size", IntegerType(), False),
        StructField("bits", ArrayType(LongType(), False), False), StructField("wide", BinaryType(), False),
        StructField("prefix", ArrayType(_ENTRY, False), False),
    ]
    found = materialize(add_columns(docs, ["text"], fields, make).drop("text"), "prefixes")
    for value in sent:
        value.destroy()
    return found


def _nodes(own: DataFrame) -> DataFrame:
    """One row for each ``node`` of ``own``, with the ``size``, ``bits`` and ``wide`` of its set and the smallest
    ``key`` and ``digest`` of its texts. Written, since each comparison of pairs joins it."""
    first = F.min_by(F.struct("size", "bits", "wide", "key", "digest"), F.struct("key", "digest"))
    return materialize(own.groupBy("node").agg(first.alias("of")).select("node", "of.*"), "nodes")


def _near_prints(own: DataFrame, radius: int = simhash.RADIUS) -> DataFrame:
    """Pairs ``a``, ``b`` of nodes, one for each ``a`` at most: whose fingerprints differ in up to ``radius`` bits.

    Nodes of one fingerprint are paired with the first of them, and the first ones of different
    fingerprints with that of the nearest smaller fingerprint that multi-index hashing finds, so
    all that are near each other are connected.
    """
    nodes = own.select("fp", "node").distinct()
    heads = materialize(nodes.groupBy("fp").agg(F.min("node").alias("head")), "prints")
    alike = nodes.join(heads, "fp").where("node != head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    near = simhash.links(heads, radius)
    nearest = F.min_by("a", F.struct(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))), "a"))
    near = near.groupBy("b").agg(nearest.alias("a"))
    for side in ("a", "b"):
        of = heads.select(F.col("fp").alias(side), F.col("head").alias(f"head_{side}"))
        near = near.join(of, side)
    near = alike.unionAll(near.select(F.col("head_b").alias("a"), F.col("head_a").alias("b")))
    return materialize(near, "near")  # the driver plans what compares them without what found them


def _meetings(own: DataFrame) -> DataFrame:
    """``s``, ``i``, ``node`` and ``size`` of shingles in the prefixes of different sets."""
    once = own.where(F.size("prefix") > 0).select("node", "size", "prefix").dropDuplicates(["node"])
    spread = once.select("node", "size", F.inline("prefix"))
    shared = spread.groupBy("s").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    return materialize(spread.join(shared.where("low < high").select("s"), "s"), "meetings")


def _needed(least: float) -> Column:
    """How many shingles sets of ``size`` and ``size_b`` share at least if they are similar."""
    return F.ceil((F.col("size") + F.col("size_b")) * (least / (1 + least)) - 1e-9)


def _can_meet(least: float) -> Column:
    """Whether texts of ``size`` and ``size_b`` whose first common shingle is at ``i`` and ``i_b`` may be
    similar: all before it is not shared."""
    most = F.least(F.col("size") - F.col("i"), F.col("size_b") - F.col("i_b"))
    return (F.least("size", "size_b") >= F.greatest("size", "size_b") * least - 1e-9) & (most >= _needed(least))


def _possible(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Those of the pairs ``a``, ``b`` whose bitmaps allow it: a bit differs only if the sets do.

    The small bitmaps of all pairs are compared first, then the wide ones of the pairs left.
    """

    def beside(asked: DataFrame, column: str) -> DataFrame:
        for node, size, name in (("a", "size", "x"), ("b", "size_b", "y")):
            side = nodes.select(F.col("node").alias(node), F.col("size").alias(size), F.col(column).alias(name))
            asked = asked.join(side, node)
        return asked

    unlike = sum((F.bit_count(F.get("x", F.lit(i)).bitwiseXOR(F.get("y", F.lit(i)))) for i in range(_BITS // 64)), F.lit(0))
    may = (F.col("size") + F.col("size_b") - unlike) / 2 >= _needed(least)
    some = materialize(beside(pairs, "bits").where(may).select("a", "b"), "possible")
    fields = [StructField("unlike", IntegerType(), False)]
    read = add_columns(beside(some, "wide"), ["x", "y"], fields, lambda: lambda x, y: (_unlike(x, y) if x and y else 0,))
    may = (F.col("size") + F.col("size_b") - F.col("unlike")) / 2 >= _needed(least)
    return read.where(may).select("a", "b")


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, words: int, least: float) -> DataFrame:
    """Those of the pairs ``a``, ``b`` whose whole sets are similar. The texts of a pair meet, not
    their sets, which are larger."""
    asked = materialize(pairs, "pairs")
    if asked.isEmpty():
        return asked
    sides = asked.select("a", "b", F.col("a").alias("node"), F.lit(0).alias("side")).unionAll(
        asked.select("a", "b", F.col("b").alias("node"), F.lit(1).alias("side"))
    )
    sides = materialize(sides.join(nodes.select("node", "key", "digest"), "node").drop("node"), "sides")
    texts = _keyed(docs).join(sides, ["key", "digest"]).groupBy("a", "b").agg(
        *[F.max(F.when(F.col("side") == i, F.col("text"))).alias(n) for i, n in enumerate(("x", "y"))]
    )

    def make():
        def alike(x: str, y: str) -> tuple[bool]:
            one, other = text_shingles(x, words), text_shingles(y, words)
            both = len(np.intersect1d(one, other, assume_unique=True))
            return (bool(both >= np.ceil((len(one) + len(other)) * (least / (1 + least)) - 1e-9)),)

        return alike

    judged = add_columns(texts, ["x", "y"], [StructField("alike", BooleanType(), False)], make)
    found = materialize(judged.where("alike").select("a", "b"), "similar")
    discard(sides)
    return found


def _one_each(pairs: DataFrame, number: int) -> DataFrame:
    """One pair of each ``a``."""
    return pairs.groupBy("a").agg(F.min_by("b", F.xxhash64("b", F.lit(number))).alias("b"))


def _grown(linked: DataFrame, found: DataFrame) -> DataFrame:
    """The components ``linked`` with more links; what is connected already takes no rounds again."""
    if found.isEmpty():
        return linked
    grown = components(linked.select(F.col("root").alias("a"), F.col("node").alias("b")).unionAll(found))
    discard(linked)
    return grown


def _open(met: DataFrame, linked: DataFrame) -> DataFrame:
    """``met`` with the ``root`` of each node by the components ``linked``, where roots still differ."""
    roots = linked.withColumnRenamed("root", "r")
    rooted = met.join(roots, "node", "left").withColumn("root", F.coalesce("r", "node")).drop("r")
    shared = rooted.groupBy("s").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return materialize(rooted.join(shared.where("low < high").select("s"), "s"), "open")


def _pairs(now: DataFrame, least: float) -> DataFrame:
    """All pairs ``a``, ``b`` that meet at an ``s`` where a similar pair can meet first, and whose roots differ.

    The smaller of two similar texts has their first common shingle earlier than a larger one need.
    """
    early = F.col("i") <= F.col("size") - F.ceil(F.col("size") * (2 * least / (1 + least)) - 1e-9)
    other = now.select(
        "s", F.col("node").alias("b"), F.col("size").alias("size_b"), F.col("i").alias("i_b"), F.col("root").alias("root_b")
    )
    differ = F.expr("root != root_b and (size < size_b or size = size_b and node < b)")
    return now.where(early).join(other, "s").where(differ & _can_meet(least)).select(F.col("node").alias("a"), "b")


def _crowded(now: DataFrame) -> bool:
    return not now.groupBy("s").count().where(F.col("count") > _CROWD).isEmpty()


def connected(docs: DataFrame, own: DataFrame, words: int = WORDS, least: float = LEAST) -> DataFrame:
    """``node`` and ``root`` of the components of nodes with a similarity of ``least`` or more, written. A
    node alone in its component may be left out.

    ``own`` holds ``key``, ``digest``, ``node``, ``fp``, ``size``, ``bits``, ``wide`` and ``prefix`` of
    ``docs``. Texts whose fingerprints are near each other are compared first. Of the others, large
    groups are compared with one of their texts first, and every text with one other before it is
    with all; pairs that are connected by then are not looked at again, all others are.
    """
    nodes = _nodes(own)
    near = _near_prints(own)
    linked = components(_verified(_possible(near, nodes, least), docs, nodes, words, least))
    discard(near)
    met = _meetings(own)
    now, number = _open(met, linked), 0
    rounds = [now]
    while number < _PIVOTS and _crowded(now):
        pivot = F.min_by(F.struct("node", "size", "i", "root"), F.xxhash64("node", F.lit(number)))
        pivots = now.groupBy("s").agg(pivot.alias("p")).select(
            "s", F.col("p.node").alias("b"), F.col("p.size").alias("size_b"), F.col("p.i").alias("i_b"), F.col("p.root").alias("root_b")
        )
        pairs = now.join(pivots, "s").where(F.expr("root != root_b") & _can_meet(least))
        pairs = _possible(pairs.select(F.col("node").alias("a"), "b").distinct(), nodes, least)
        linked = _grown(linked, _verified(_one_each(pairs, number), docs, nodes, words, least))
        now, number = _open(met, linked), number + 1
        rounds.append(now)
    pool = materialize(_possible(_pairs(now, least).distinct(), nodes, least), "pool")
    discard(met, *rounds)
    first = materialize(_one_each(pool, number), "first")
    linked = _grown(linked, _verified(first, docs, nodes, words, least))
    rest = pool.join(first, ["a", "b"], "left_anti")
    for side in ("a", "b"):
        roots = linked.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
        rest = rest.join(roots, side, "left").withColumn(f"root_{side}", F.coalesce(f"root_{side}", side))
    linked = _grown(linked, _verified(rest.where("root_a != root_b").select("a", "b"), docs, nodes, words, least))
    discard(nodes, pool, first)
    return linked


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.xxhash64("doc_id").alias("key"), F.xxhash64(whole_text()).alias("digest"), "doc_id", whole_text().alias("text"))


def keep_one(docs: DataFrame, words: int = WORDS, least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one for each component of texts
    whose sets of shingles have a Jaccard similarity of ``least`` or more, the one with the
    smallest doc_id, nulls last, then the smallest node, hash of the text and further columns.

    Texts without a word, null and empty ones among them, are similar to each other only. Texts
    are looked at whole, however long. Rows that repeat count once; an empty table gives no rows;
    further columns may have any name.
    """
    own = _prefixes(_keyed(docs), words, least)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest", "key")
    nodes = own.groupBy("node").agg(F.min(place).alias("first"))
    roots = connected(docs, own, words, least)
    rooted = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = F.struct("first.none", "first.doc_id", "node", "first.digest", "first.key")
    stay = rooted.groupBy("root").agg(F.min(first).alias("first")).select("first.key", "first.digest")
    listed = own.groupBy("key", "digest").agg(F.count("*").alias("n"))
    listed = listed.join(stay.withColumn("stays", F.lit(True)), ["key", "digest"], "left")
    out = materialize(listed.where("stays is null or n > 1"), "out")
    discard(own, roots)
    # Few rows go, so the others need not be dealt out to find them; rows that repeat come one by one.
    keyed = packed(docs, F.xxhash64("doc_id").alias("key"), F.xxhash64(whole_text()).alias("digest"))
    kept = keyed.join(out, ["key", "digest"], "left_anti").select("row")
    repeated = out.where("stays")
    if not repeated.isEmpty():
        again = keyed.join(repeated.select("key", "digest"), ["key", "digest"])
        others = F.to_json(F.struct(*[F.col(f"row.`{c}`") for c in docs.columns if c.lower() != "text"]))
        kept = kept.unionAll(again.groupBy("key", "digest").agg(F.min_by("row", others).alias("row")).select("row"))
    return kept.select("row.*")
