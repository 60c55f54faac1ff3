"""Passages that repeat across documents, found through one compressed index per shard.

Documents are cut into segments at anchors, runs of a few words that equal windows agree on, so
all places of a window carry one anchor. Segments whose anchor stands in other documents too
are gathered in shards of whole anchors, different ones once each with the first document they
stand in. A shard is indexed, and its segments are streamed through the index backwards; the
interval of each window tells the first document that has it.

An anchor may stand in too many different segments for one shard. Those segments are cut again
at anchors of more words, and in the end at whole windows, of which equal ones need no search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from hazardlens.llm.common import CHUNK, add_columns, whole_text, without
from hazardlens.llm.fmindex import FmIndex
from hazardlens.llm.suffixes import row_key, runs
from hazardlens.session import materialize

LENGTH = 50
#: Words of an anchor, at first and for segments whose anchor is too common; last, whole windows.
GRAMS = (8, 24)
#: Words of segments in a shard, on average.
SHARD_WORDS = 200_000
#: An anchor with more different segments is cut again.
CROWD = 5_000
#: Windows whose anchors are looked for together; bounds memory only.
PART = 1 << 22
_PLACE_BITS = 23
_SPAN_BITS = 21
_TIMES = np.random.default_rng(7).integers(1, 1 << 62, 2, np.uint64) * np.uint64(2) + np.uint64(1)
_LAST = (1 << 63) - 1


def _grams(words: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of the ``gram`` words from each place."""
    mixed = np.full(len(words) - gram + 1, gram, np.uint64)
    for i in range(gram):
        mixed = (mixed + words[i : len(words) - gram + 1 + i]) * _TIMES[0]
        mixed ^= mixed >> np.uint64(29)
    return mixed * _TIMES[1]


def _anchored(words: np.ndarray, inside: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first window and number of windows of the segments of ``words``; windows start
    where ``inside``."""
    hashes = _grams(words, gram)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    best = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    span, width = length - gram + 1, 1
    while width < span:
        step = min(width, span - width)
        best = np.minimum(best[:-step], best[step:])
        width += step
    at = np.flatnonzero(inside[: len(best)])
    place = (best[at] & low).astype(np.int64)
    fresh = np.append(True, (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1))[: len(at)]
    first = np.flatnonzero(fresh)
    return hashes[place[first]].view(np.int64), at[first], np.diff(np.append(first, len(at)))


def _segments(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``anchor``, ``seg`` (hash of its words), ``d``, ``o`` and ``pos`` (first word and number of
    windows) of the segments of ``docs``."""
    names = ["anchor", "seg", "d", "o", "pos"]

    def cut(ids: list[int], ranks: list[int], texts: list[str]) -> pa.RecordBatch | None:
        parts = [t.encode().split() for t in texts]
        sizes = np.array([len(p) for p in parts], np.int64)
        starts = np.cumsum(sizes) - sizes
        words = np.fromiter((xxhash.xxh64_intdigest(w) for p in parts for w in p), np.uint64, int(sizes.sum()))
        inside = np.zeros(len(words) + 1, np.int64)
        some = sizes >= length
        inside[starts[some]] += 1
        inside[starts[some] + sizes[some] - length + 1] -= 1
        inside = np.cumsum(inside)[:-1] > 0
        out: list[list] = [[], [], []]
        for at in range(0, len(words) - length + 1, PART):
            to = at + PART + length - 1
            anchor, first, count = _anchored(words[at:to], inside[at : at + PART], length, gram)
            for kept, own in zip(out, (anchor, first + at, count), strict=True):
                kept.append(own)
        if not any(map(len, out[0])):
            return None
        anchor, first, count = map(np.concatenate, out)
        ends = (first + count + length - 1).tolist()
        seg = [xxhash.xxh3_64_intdigest(words[a:b].tobytes()) for a, b in zip(first.tolist(), ends, strict=True)]
        doc = np.searchsorted(starts, first, "right") - 1
        pos = ((first - starts[doc]) << _SPAN_BITS) | count
        columns = [anchor, np.array(seg, np.uint64).view(np.int64), np.array(ids)[doc], np.array(ranks)[doc], pos]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ranks = (batch.column(n).to_pylist() for n in ("d", "o"))
            texts, first, size = [], 0, 0
            for i, text in enumerate(batch.column("text")):
                texts.append(text.as_py())
                size += len(texts[-1])
                if size > CHUNK or i + 1 == batch.num_rows:
                    made = cut(ids[first : i + 1], ranks[first : i + 1], texts)
                    if made is not None:
                        yield made
                    texts, first, size = [], i + 1, 0

    return docs.select("d", "o", "text").mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _pieces(docs: DataFrame, chosen: DataFrame, length: int) -> DataFrame:
    """The words, as text, of the ``chosen`` segments (d, pos and others): ``piece`` and the others."""
    others = [f for f in chosen.schema.fields if f.name not in ("d", "pos")]
    names = [f.name for f in others]
    by_doc = chosen.groupBy("d").agg(F.collect_list(F.struct("pos", *names)).alias("_segs"))
    joined = docs.select("d", "o", "text").join(by_doc, "d")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.column("text"), batch.column("_segs")
            rows, size = [], 0
            for i in range(batch.num_rows):
                words = texts[i].as_py().encode().split()
                for s in lists[i].as_py():
                    start, count = s["pos"] >> _SPAN_BITS, s["pos"] & ((1 << _SPAN_BITS) - 1)
                    s["piece"] = b" ".join(words[start : start + count + length - 1]).decode()
                    size += len(s["piece"])
                    rows.append(s)
                if rows and (size > 4_000_000 or i + 1 == batch.num_rows):
                    arrays = [pa.array([r[n] for r in rows]) for n in names]
                    arrays.append(pa.array([r["piece"] for r in rows], pa.string()))
                    yield pa.RecordBatch.from_arrays(arrays, names=[*names, "piece"])
                    rows, size = [], 0

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in others) + ", piece string"
    return joined.mapInArrow(run, schema)


def earlier(pieces: list[str], ranks: list[int], length: int) -> list[list[tuple[int, int]]]:
    """For each piece the runs of windows (first and number) that a piece of a smaller rank has too."""
    ids: dict[bytes, int] = {}
    parts = [p.encode().split() for p in pieces]
    sizes = np.array([len(p) for p in parts], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    text = np.zeros(int(sizes.sum()) + len(parts), np.int64)
    for own, at in zip(parts, starts.tolist(), strict=True):
        text[at : at + len(own)] = [ids.setdefault(w, len(ids) + 1) for w in own]
    index = FmIndex(text, length)
    of = np.repeat(np.array(ranks, np.int64), sizes + 1)
    groups = np.flatnonzero(np.append(True, index.group[1:] != index.group[:-1]))
    least = np.minimum.reduceat(of[index.order], groups)
    at, suffix = index.matches(starts, sizes)
    told = np.zeros(len(text), bool)
    told[at] = least[index.group[suffix]] < of[at]
    return [runs(told[s : s + n]) for s, n in zip(starts.tolist(), sizes.tolist(), strict=True)]


def _searched(pieces: DataFrame, length: int) -> DataFrame:
    """``anchor``, ``seg`` and ``early``, the words that stand in a document before the first one of
    the segment, of the pieces of each ``shard``."""

    def search(group: pa.Table) -> pa.Table:
        anchor, seg, rank, piece = (group.column(n).to_pylist() for n in ("anchor", "seg", "first", "piece"))
        rows = [
            (a, s, [dict(start=x, end=x + n + length - 1) for x, n in found])
            for a, s, found in zip(anchor, seg, earlier(piece, rank, length), strict=True) if found
        ]
        made = list(zip(*rows, strict=True)) or [[], [], []]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        arrays = [pa.array(c, k) for c, k in zip(made, kinds, strict=True)]
        return pa.Table.from_arrays(arrays, names=["anchor", "seg", "early"])

    return pieces.groupBy("shard").applyInArrow(search, _EARLY)


_EARLY = "anchor long, seg long, early array<struct<start:bigint,end:bigint>>"


def repeats(docs: DataFrame, length: int = LENGTH, shard_words: int = SHARD_WORDS, crowd: int = CROWD, grams: tuple[int, ...] = GRAMS) -> DataFrame:
    """``d`` and ``spans`` (start and end of words) of the texts with windows of ``length`` words that
    a text of a smaller ``o`` has too.

    ``docs`` has ``d``, which tells rows apart, ``o`` and ``text``, none of them null. Spans may
    touch or overlap.
    """
    gram = min(grams[0], length) if grams else length
    found = materialize(_segments(docs, length, gram), "segments")
    # Written, so that the joins below deal out both sides anew and Spark can split hot anchors.
    ends = found.groupBy("anchor").agg(F.min("o").alias("low"), F.max("o").alias("high"))
    again = materialize(ends.where("low < high").select("anchor"), "again")
    kept = materialize(found.join(again, "anchor", "left_semi"), "repeated")
    pairs = kept.groupBy("anchor", "seg").agg(F.min(F.struct("o", "d", "pos")).alias("_at"))
    pairs = materialize(pairs.select("anchor", "seg", F.col("_at.o").alias("first"), "_at.d", "_at.pos"), "pairs")
    many = materialize(pairs.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "many")
    size = F.col("pos").bitwiseAND(F.lit((1 << _SPAN_BITS) - 1)) + length
    open_pairs = pairs.join(many, "anchor")
    total = open_pairs.where(F.col("n") <= crowd).agg(F.sum(size)).first()[0] or 0
    shard = F.pmod(F.xxhash64("anchor"), F.lit(max(1, -(-total // shard_words)))).alias("shard")
    usual = open_pairs.where(F.col("n") <= crowd).select(*pairs.columns, shard)
    early = _searched(_pieces(docs, usual, length), length)
    if gram < length and not many.where(F.col("n") > crowd).isEmpty():
        crowded = open_pairs.where(F.col("n") > crowd).select(*pairs.columns)
        pieces = materialize(_pieces(docs, crowded, length), "crowded")
        own = pieces.select(F.xxhash64("anchor", "seg").alias("d"), F.col("first").alias("o"), F.col("piece").alias("text"))
        inner = repeats(own, length, shard_words, crowd, grams[1:])
        named = pieces.select("anchor", "seg", F.xxhash64("anchor", "seg").alias("d"))
        early = early.unionByName(named.join(inner, "d").select("anchor", "seg", F.col("spans").alias("early")))
    settled = materialize(pairs.select("anchor", "seg", "first").join(early, ["anchor", "seg"], "left"), "settled")
    start = F.shiftright("pos", _SPAN_BITS)
    end = start + F.col("pos").bitwiseAND(F.lit((1 << _SPAN_BITS) - 1)) + length - 1
    whole = F.array(F.struct(start.alias("start"), end.alias("end")))
    moved = F.transform("early", lambda s: F.struct((s["start"] + start).alias("start"), (s["end"] + start).alias("end")))
    told = kept.join(settled, ["anchor", "seg"]).where("o > first or early is not null")
    spans = told.select("d", F.explode(F.when(F.col("o") > F.col("first"), whole).otherwise(moved)).alias("s"))
    return spans.groupBy("d").agg(F.collect_list("s").alias("spans"))


def strip(docs: DataFrame, length: int = LENGTH, shard_words: int = SHARD_WORDS, crowd: int = CROWD, grams: tuple[int, ...] = GRAMS) -> DataFrame:
    """``docs`` with ``kept`` (the words that stay, joined by spaces), ``n_words`` and ``n_removed``.

    Words are runs of anything but ASCII white space, compared as they are. Every word that lies in
    a window of ``length`` words which also starts in a document with a smaller doc_id is removed;
    windows are judged on the input. Null texts have no words; shorter ones stay as they are. A null
    doc_id counts as the largest; rows with one doc_id take nothing from each other. Columns
    named like the results are replaced. An empty table gives no rows.
    """
    base = without(docs, ["kept", "n_words", "n_removed", "d", "o", "spans"])
    keyed = base.withColumn("d", F.coalesce(row_key(base), F.lit(_LAST)))
    rank = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("o")
    # Both joins below ask for the same rows and columns by ``d``, so the texts travel once.
    texts = keyed.select("d", "doc_id", rank, whole_text().alias("text"))
    spans = repeats(texts.select("d", "o", "text"), length, shard_words, crowd, grams)
    plain = base.columns == ["doc_id", "text"]
    joined = (texts.select("d", "o", "text", "doc_id") if plain else keyed).join(spans, "d", "left")

    def make():
        def row(text: str | None, spans: list | None):
            words = (text or "").encode().split()
            kept, at = [], 0
            for start, end in sorted((s["start"], s["end"]) for s in spans or []):
                kept += words[at : max(at, start)]
                at = max(at, end)
            kept += words[at:]
            return b" ".join(kept).decode(), len(words), len(words) - len(kept)

        return row

    fields = [StructField("kept", StringType(), False), StructField("n_words", LongType(), False), StructField("n_removed", LongType(), False)]
    return add_columns(joined, ["text", "spans"], fields, make).drop("d", "o", "spans")


def report(docs: DataFrame) -> DataFrame:
    """Counts and a digest of what is kept, one row per row of ``docs``."""
    found = strip(docs.select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


#: The report as SQL: every window of every document as a row.
SQL = """
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t-\\r]+'), lambda x: x <> '') AS w
    FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS s FROM
    (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w WHERE len(w) >= 50)),
firsts AS (SELECT s, min(doc_id) AS d FROM windows GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM windows JOIN firsts USING (s), range(50) r(k) WHERE d < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, i)
    GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""
