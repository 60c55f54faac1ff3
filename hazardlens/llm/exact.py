"""Exact duplicates by deterministic block naming.

A normalised text is cut into blocks of a fixed number of bytes. Equal blocks get equal
integer names by sorting, then adjacent names are paired and the pairs named in turn, until
each text has a single name. Names are handed out for whole blocks and whole pairs, never
for their hashes, so two texts share a name only if they are identical.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardlens.llm.common import SPACES, packed, whole_text
from hazardlens.session import materialize

BLOCK_BYTES = 4096
_KEY = ["doc_id", "_text", "_chars"]


def normalised(text: Column) -> Column:
    """The text without the characters of ``SPACES``."""
    for space in SPACES:
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


def _named(distinct: DataFrame, by: list[str]) -> DataFrame:
    """One row per value with an integer ``name``: its place in sorted order within its
    partition, partition number first. Written once, so names stay as they are."""
    ordered = distinct.sortWithinPartitions(*by)
    return materialize(ordered.withColumn("name", F.monotonically_increasing_id()), "names")


def _block_names(facts: DataFrame) -> DataFrame:
    """``_KEY``, ``pos`` and ``name`` for each block of ``facts``.

    Blocks travel once, to be sorted; names come back by the hash of the block. Should one
    hash belong to several blocks, these are told apart by the blocks themselves.
    """
    names = _named(facts.select("block").distinct(), ["block"])
    names = names.withColumn("h", F.xxhash64("block"))
    shared = names.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    by_hash = facts.withColumn("h", F.xxhash64("block"))
    columns = [*_KEY, "pos", "name"]
    if shared.isEmpty():
        return by_hash.drop("block").join(names.select("h", "name"), "h").select(*columns)
    alone = names.join(shared, "h", "left_anti").select("h", "name")
    others = names.join(shared, "h", "left_semi").select("block", "name")
    plain = by_hash.drop("block").join(alone, "h").select(*columns)
    return plain.unionByName(facts.join(others, "block").select(*columns))


def _gather(named: DataFrame, *also: Column) -> DataFrame:
    """One row per text with its ``names`` in order; a text has one name per block."""
    listed = F.sort_array(F.collect_set(F.struct("pos", "name")))
    gathered = named.groupBy(*_KEY).agg(listed.alias("_l"), *also)
    return gathered.withColumn("names", F.col("_l.name")).drop("_l")


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per different (doc_id, text, length): its identity and number of ``copies``.

    Columns ``doc_id``, ``_text`` (digest of the normalised text, to find the rows again),
    ``_chars`` (code points of the original), ``copies``, ``n_blocks`` and ``name``; equal
    (``n_blocks``, ``name``) means equal normalised texts.
    """
    text = whole_text()
    letters = normalised(text).cast("binary")
    base = docs.select(
        "doc_id",
        F.length(text).cast("long").alias("_chars"),
        letters.alias("_letters"),
        F.sha2(letters, 256).alias("_text"),
    )
    last = F.floor(F.greatest(F.octet_length("_letters") - 1, F.lit(0)) / block_bytes)
    blocks = F.transform(
        F.sequence(F.lit(0), last.cast("int")),
        lambda i: F.substring(F.col("_letters"), i * block_bytes + 1, F.lit(block_bytes)),
    )
    facts = base.select("doc_id", "_text", "_chars", F.posexplode(blocks).alias("pos", "block"))
    longest = base.agg(F.max(F.octet_length("_letters"))).first()[0] or 0
    copies = F.sum(F.when(F.col("pos") == 0, 1).otherwise(0)).alias("copies")
    state = _gather(_block_names(facts), copies).withColumn("n_blocks", F.size("names"))
    state = materialize(state, "blocks")
    for _ in range(math.ceil(math.log2(max(1, math.ceil(longest / block_bytes))))):
        state = materialize(_pair_up(state), "pairs")
    return state.withColumn("name", F.element_at("names", 1)).drop("names")


def _pair_up(state: DataFrame) -> DataFrame:
    """``state`` with each two adjacent names replaced by the name of the pair."""
    pair = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("names") - 1) / 2).cast("int")),
        lambda i: F.struct(
            F.get("names", i * 2).alias("a"),
            F.coalesce(F.get("names", i * 2 + 1), F.lit(-1)).alias("b"),
        ),
    )
    open_ = state.where(F.size("names") > 1)
    facts = open_.select(*_KEY, F.posexplode(pair).alias("pos", "p")).select(
        *_KEY, "pos", "p.a", "p.b"
    )
    names = _named(facts.select("a", "b").distinct(), ["a", "b"])
    merged = _gather(facts.join(names, ["a", "b"]).select(*_KEY, "pos", "name"))
    same = F.lit(True)
    for key in _KEY:
        same = same & F.col(f"o.{key}").eqNullSafe(F.col(f"m.{key}"))
    renamed = (
        open_.drop("names").alias("o").join(merged.alias("m"), same)
        .select("o.*", "m.names")
    )
    return state.where(F.size("names") <= 1).unionByName(renamed)


def groups(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs`` with the row of its group that stays.

    Columns ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, ``n_chars``.
    Null texts count as empty, and empty texts are equal to each other. The longest original
    text stays, then the smallest doc_id, nulls last; of rows that are repeated as a whole
    one stays. An empty table gives no rows. Only doc_id and text are read.
    """
    rows = identities(docs, block_bytes)
    rank = F.struct(
        (-F.col("_chars")).alias("longest"), F.col("doc_id").isNull().alias("none"), "doc_id"
    )
    best = rows.groupBy("n_blocks", "name").agg(
        F.sum("copies").alias("group_size"), F.min(rank).alias("_best")
    )
    # Written, so that the join deals out both sides anew and Spark can split hot groups.
    best = materialize(best, "best")
    is_best = rank == F.col("_best")
    is_best = is_best | (
        F.col("doc_id").isNull() & F.col("_best.none") & (-F.col("_chars") == F.col("_best.longest"))
    )
    joined = rows.join(best, ["n_blocks", "name"])
    copy = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")
    return joined.select(
        "doc_id",
        F.col("_best.doc_id").alias("keep_id"),
        "group_size",
        F.coalesce(is_best, F.lit(False)).alias("_is_best"),
        F.col("_text").alias("text_sha256"),
        F.col("_chars").alias("n_chars"),
        copy,
    ).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("_is_best") & (F.col("_copy") == 1)).alias("kept"),
        "text_sha256",
        "n_chars",
    )


def keep_one(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Of rows with the same doc_id and
    text, the one whose further columns sort first as JSON stays."""
    keys = ["id", "text_sha256", "n_chars"]
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("id")
    stay = groups(docs, block_bytes).where("kept").select(name, "text_sha256", "n_chars")
    text = whole_text()
    digest = F.sha2(normalised(text).cast("binary"), 256).alias("text_sha256")
    keyed = packed(docs, name, digest, F.length(text).cast("long").alias("n_chars"))
    found = keyed.join(stay, keys, "left_semi")
    others = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() != "text"]
    order = [F.to_json(F.struct(*others)), F.col("row.text")]
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return found.withColumn("place", first).where("place = 1").select("row.*")


SQL = r"""
with n as (
  select doc_id, length(coalesce(text, '')) as n_chars,
         regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]', '', 'g') as norm
  from documents)
select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by norm) as group_size,
       doc_id = first_value(doc_id) over w as kept, sha256(norm) as text_sha256
from n window w as (partition by norm order by n_chars desc, doc_id)"""
