"""Repeated stretches of text by interval expansion on a Burrows-Wheeler transform.

Texts are cut into segments at anchors that equal stretches agree on, so all occurrences of a
string of the minimum length lie in segments of one anchor. Segments whose anchor comes again
are gathered, different ones once each, in blocks of whole anchors. In a block, intervals of
suffixes with a common prefix are extended backwards on the transform, all those of one
length before the next. An interval that ends where none ended before tells the common prefix
of two neighbouring suffixes, so these become known by increasing value, and the search stops
at the minimum length. Neighbours still undecided then share a string of that length.

An anchor may stand in too many different segments for one block. Those segments are cut again
at anchors of more bytes, and searched in blocks of these; last, at anchors as long as the
string, where equal segments are all there is to find.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField

from hazardlens.llm import anchors
from hazardlens.llm.common import add_columns, whole_text, without
from hazardlens.session import materialize

LENGTH = 200
#: Bytes of segments that are searched together, on average.
BLOCK_BYTES = 1_000_000
#: An anchor with more different segments would make a block too large; they are cut again.
HOT_SEGMENTS = 15_000
#: Bytes of an anchor, at first and for segments whose anchor is too common; last, whole strings.
GRAMS = (anchors.GRAM, 96, 160)
_END, _LAST = 0xFF, 0xFE  # bytes that UTF-8 never has


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``text`` in the order of their next ``depth`` bytes at least, by doubling."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i : i + n]
    order = np.argsort(key)
    first = np.empty(n + 1, bool)
    first[0] = first[n] = True
    first[1:n] = key[order[1:]] != key[order[:-1]]
    rank = np.zeros(n + depth + 8, np.int64)
    places = np.arange(n)
    rank[order] = np.maximum.accumulate(np.where(first[:n], places, 0)) + 1
    done = 8
    while done < depth:
        tied = np.flatnonzero(~(first[:n] & first[1:]))
        if not len(tied):
            break
        own = order[tied]
        key = (rank[own] << 32) | rank[own + done]
        by = np.argsort(key)
        own, key = own[by], key[by]
        order[tied] = own
        fresh = np.append(True, key[1:] != key[:-1])
        first[tied] = fresh
        rank[own] = np.maximum.accumulate(np.where(fresh, tied, 0)) + 1
        done *= 2
    return order


def repeated(text: np.ndarray, length: int) -> np.ndarray:
    """For each place of ``text`` whether the string of ``length`` bytes from there also starts
    elsewhere in it. ``text`` ends with a byte that it has nowhere else; strings that hold
    separators may be reported or not."""
    n = len(text)
    order = suffix_order(text, length)
    before = text[order - 1]  # the transform: the byte before each suffix
    by_byte = np.argsort(before, kind="stable")
    step = np.empty(n, np.int64)
    step[by_byte] = np.arange(n)  # where the suffix one byte longer is
    bytes_ = before[by_byte]
    same = np.append(bytes_[1:] == bytes_[:-1], False)
    after, prior = np.full(n, n, np.int64), np.full(n, -1, np.int64)
    after[by_byte[:-1][same[:-1]]] = by_byte[1:][same[:-1]]
    prior[by_byte[1:][same[:-1]]] = by_byte[:-1][same[:-1]]
    known = np.zeros(n + 1, bool)  # common prefix of suffix i - 1 and i, if below ``length``
    known[0] = known[n] = True
    low, high = np.zeros(1, np.int64), np.full(1, n - 1, np.int64)
    for _ in range(length):
        size = high - low + 1
        start = np.cumsum(size) - size
        inside = np.repeat(low - start, size) + np.arange(size.sum())
        is_first = prior[inside] < np.repeat(low, size)
        is_last = after[inside] > np.repeat(high, size)
        lows, highs = np.sort(step[inside[is_first]]), np.sort(step[inside[is_last]])
        new = ~known[highs + 1]
        known[highs[new] + 1] = True
        low, high = lows[new], highs[new]
        if not len(low):
            break
    alike = ~known[1:n]
    out = np.zeros(n, bool)
    out[order[1:][alike]] = True
    out[order[:-1][alike]] = True
    return out


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Start and length of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return [(int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2], strict=True)]


# --- jobs ---------------------------------------------------------------------


def _bytes(text: str | bytes) -> bytes:
    return text if isinstance(text, bytes) else text.encode()


def _segments(docs: DataFrame, length: int, gram: int, part: int) -> DataFrame:
    """``anchor``, ``seg`` (hash of the segment), ``d`` and ``pos`` (start and windows). Texts are looked
    at in parts of ``part`` strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            ids, texts = batch.column("d"), batch.column("text")
            kept: list[list] = [[], [], [], []]
            for i in range(batch.num_rows):
                raw = _bytes(texts[i].as_py())
                every = np.frombuffer(raw, np.uint8)
                for at in range(0, len(raw) - length + 1, part):
                    own = every[at : at + part + length - 1]
                    anchor, start, count = anchors.segments(own, length, gram)
                    start = start + at
                    ends = (start + count + length - 1).tolist()
                    seg = [digest(raw[a:b]) for a, b in zip(start.tolist(), ends, strict=True)]
                    kept[0].append(anchor)
                    kept[1].append(np.array(seg, np.uint64).view(np.int64))
                    kept[2].append(np.full(len(anchor), ids[i].as_py()))
                    kept[3].append((start << 21) | count)
                if kept[0] and (i + 1 == batch.num_rows or i % 500 == 499):
                    arrays = [pa.array(np.concatenate(k), pa.int64()) for k in kept]
                    yield pa.RecordBatch.from_arrays(arrays, names=["anchor", "seg", "d", "pos"])
                    kept = [[], [], [], []]

    return docs.select("d", "text").mapInArrow(run, "anchor long, seg long, d long, pos long")


def _pieces(docs: DataFrame, chosen: DataFrame, length: int) -> DataFrame:
    """The bytes of the ``chosen`` segments (d, pos and others): ``piece`` and the others."""
    others = [f for f in chosen.schema.fields if f.name not in ("d", "pos")]
    names = [f.name for f in others]
    by_doc = chosen.groupBy("d").agg(F.collect_list(F.struct("pos", *names)).alias("_segs"))
    joined = docs.join(by_doc, "d")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.column("text"), batch.column("_segs")
            rows, size = [], 0
            for i in range(batch.num_rows):
                raw = _bytes(texts[i].as_py())
                for s in lists[i].as_py():
                    start, count = s["pos"] >> 21, s["pos"] & ((1 << 21) - 1)
                    s["piece"] = raw[start : start + count + length - 1]
                    size += len(s["piece"])
                    rows.append(s)
                if rows and (size > 4_000_000 or i + 1 == batch.num_rows):
                    arrays = [pa.array([r[n] for r in rows]) for n in names]
                    arrays.append(pa.array([r["piece"] for r in rows], pa.binary()))
                    yield pa.RecordBatch.from_arrays(arrays, names=[*names, "piece"])
                    rows, size = [], 0

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in others) + ", piece binary"
    return joined.select("d", "doc_id", "text", "_segs").mapInArrow(run, schema)


_RANGES = "anchor long, seg long, at long, windows long"


def _search(pieces: DataFrame, length: int) -> DataFrame:
    """Runs of repeated windows of the segments of each block."""

    def search(group: pa.Table) -> pa.Table:
        pieces = group.column("piece").to_pylist()
        text = np.frombuffer(bytes([_END]).join([*pieces, bytes([_LAST])]), np.uint8)
        again = repeated(text, length)
        out: list[tuple] = []
        at = 0
        anchor, seg, copies = (group.column(n).to_pylist() for n in ("anchor", "seg", "n"))
        for i, piece in enumerate(pieces):
            windows = len(piece) - length + 1
            found = again[at : at + windows]
            spans = [(0, windows)] if copies[i] > 1 else runs(found)
            out += [(anchor[i], seg[i], *span) for span in spans]
            at += len(piece) + 1
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        names = ["anchor", "seg", "at", "windows"]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})

    return pieces.groupBy("block").applyInArrow(search, _RANGES)


def repeats(
    docs: DataFrame,
    length: int = LENGTH,
    block_bytes: int = BLOCK_BYTES,
    hot: int = HOT_SEGMENTS,
    grams: tuple[int, ...] = GRAMS,
    part: int = anchors.PART,
) -> DataFrame:
    """``d`` and ``spans`` (start and end of bytes) of the texts that hold repeated strings.

    ``docs`` has ``d``, which tells rows apart, ``doc_id`` and ``text``, not null. Spans may touch or overlap.
    """
    gram = min(grams[0], length) if grams else length
    found = materialize(_segments(docs, length, gram, part), "segments")
    # Written, so that the join below deals out both sides anew and Spark can split hot anchors.
    again = found.groupBy("anchor").agg(F.count("*").alias("_n")).where("_n > 1").select("anchor")
    again = materialize(again, "again")
    kept = materialize(found.join(again, "anchor", "left_semi"), "repeated")
    pairs = kept.groupBy("anchor", "seg").agg(
        F.count("*").alias("n"), F.min(F.struct("d", "pos")).alias("_at")
    )
    pairs = materialize(pairs.select("anchor", "seg", "n", "_at.d", "_at.pos"), "pairs")
    size = F.col("pos").bitwiseAND(F.lit((1 << 21) - 1)) + length
    total = pairs.agg(F.sum(size)).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    crowded = materialize(
        pairs.groupBy("anchor").agg(F.count("*").alias("_n")).where(F.col("_n") > hot).select("anchor"), "hot"
    )
    block = F.pmod(F.xxhash64("anchor"), F.lit(blocks)).alias("block")
    if gram == length:
        windows = F.col("pos").bitwiseAND(F.lit((1 << 21) - 1))
        ranges = pairs.where("n > 1").select("anchor", "seg", F.lit(0).cast("long").alias("at"), windows.alias("windows"))
    elif crowded.isEmpty():
        ranges = _search(_pieces(docs, pairs.select("*", block), length), length)
    else:
        usual = pairs.join(crowded, "anchor", "left_anti").select(*pairs.columns, block)
        others = pairs.join(crowded, "anchor", "left_semi").select(*pairs.columns)
        pieces = materialize(_pieces(docs, others, length), "hot")
        again = _again(pieces, length, block_bytes, hot, grams[1:], part)
        ranges = _search(_pieces(docs, usual, length), length).unionByName(again)
    start = F.shiftright("pos", 21) + F.col("at")
    spans = kept.join(ranges, ["anchor", "seg"]).select(
        "d", F.struct(start.alias("start"), (start + F.col("windows") + length - 1).alias("end")).alias("s")
    )
    return spans.groupBy("d").agg(F.collect_list("s").alias("spans"))


def _again(pieces: DataFrame, length: int, block_bytes: int, hot: int, grams: tuple[int, ...], part: int) -> DataFrame:
    """Runs of repeated windows of segments that are texts of their own now; segments that occur
    more than once are repeated as a whole."""
    key = F.xxhash64("anchor", "seg").alias("d")
    own = pieces.select(key, F.col("seg").alias("doc_id"), F.col("piece").alias("text"))
    spans = repeats(own, length, block_bytes, hot, grams, part)
    told = pieces.where("n = 1").select("anchor", "seg", key).join(spans, "d").select("anchor", "seg", F.explode("spans").alias("s"))
    windows = F.col("s.end") - F.col("s.start") - (length - 1)
    once = told.select("anchor", "seg", F.col("s.start").alias("at"), windows.alias("windows"))
    often = pieces.where("n > 1").select("anchor", "seg", F.lit(0).cast("long"), (F.octet_length("piece") - (length - 1)).cast("long"))
    return once.unionAll(often)


def row_key(docs: DataFrame) -> Column:
    """A long that tells rows apart: doc_id if it does, else a hash of id and text, which gives
    rows that repeat as a whole the same number."""
    whole = dict(docs.dtypes)["doc_id"] in ("tinyint", "smallint", "int", "bigint")
    unique = whole and docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty()
    return F.col("doc_id").cast("long") if unique else F.xxhash64("doc_id", whole_text())


def strip(
    docs: DataFrame,
    length: int = LENGTH,
    block_bytes: int = BLOCK_BYTES,
    hot: int = HOT_SEGMENTS,
    grams: tuple[int, ...] = GRAMS,
    part: int = anchors.PART,
) -> DataFrame:
    """``docs`` with ``kept`` (binary), ``n_bytes``, ``n_removed`` and ``n_spans``.

    Every byte of a text's UTF-8 that lies in a string of ``length`` bytes which also starts
    anywhere else, in the same or another row, is removed; strings are judged on the input.
    Null texts count as empty, and shorter ones stay as they are; very long ones are looked at
    whole, in parts. Rows that repeat as a whole are
    copies of each other. What is kept is bytes, as a cut can fall inside a character. Columns named
    like the results are replaced. An empty table gives no rows.
    """
    results = ["kept", "n_bytes", "n_removed", "n_spans"]
    base = without(docs, [*results, "d", "spans"])
    keyed = base.withColumn("d", row_key(base))
    # Both joins below ask for the same rows and columns by ``d``, so the texts travel once.
    texts = keyed.select("d", "doc_id", whole_text().alias("text")).where("d is not null")
    spans = repeats(texts, length, block_bytes, hot, grams, part)
    plain = base.columns == ["doc_id", "text"]
    joined = (texts if plain else keyed).join(spans, "d", "left")

    def make():
        def row(text: str | None, spans: list | None):
            raw = (text or "").encode()
            kept, end, count, at = [], 0, 0, 0
            for s in sorted((s["start"], s["end"]) for s in spans or []):
                if not count or s[0] > end:
                    kept.append(raw[at : s[0]])
                    count += 1
                    at = s[1]
                end = max(end, s[1])
                at = max(at, end)
            kept.append(raw[at:])
            left = b"".join(kept)
            return left, len(raw), len(raw) - len(left), count

        return row

    fields = [
        StructField("kept", BinaryType(), False),
        StructField("n_bytes", LongType(), False),
        StructField("n_removed", LongType(), False),
        StructField("n_spans", LongType(), False),
    ]
    return add_columns(joined, ["text", "spans"], fields, make).drop("d", "spans")


def report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Counts and a digest of what is kept, one row per row of ``docs``."""
    found = strip(docs.select("doc_id", "text"), length)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
