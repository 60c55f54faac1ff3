"""Document fingerprints: SimHash of weighted terms, and their neighbours by block tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardlens.llm.common import whole_text
from hazardlens.session import materialize

RADIUS, BLOCKS = 3, 5
_SPACES = r"[\x20\x09-\x0D]+"
#: Two counters of 32 bits in one long: for bit j and bit j + 32 of the hashes.
_PAIR = (1 << 32) + 1


def with_fingerprints(texts: DataFrame, keys: list[str], text: str, out: str = "fp") -> DataFrame:
    """``keys`` and ``out``, the 64-bit SimHash of each text of ``texts``, one row per key.

    Terms are runs of anything but ASCII white space, lower-cased. Each occurrence votes with
    the number of its code points, so that long, rare terms count for more: for a bit if
    the term's XXH64 has it set, else against it. A bit is set if the votes for it win.
    Texts without terms get zero. The votes of a text are summed where the text is, two bits
    per long; a counter holds as many votes as a text has code points.
    """
    words = F.split(F.lower(F.col(text)), _SPACES)
    terms = texts.select(*keys, F.explode(words).alias("term"))
    hashed = terms.select(
        *keys, F.length("term").cast("long").alias("w"), F.xxhash64("term").alias("h")
    )
    votes = [
        F.sum(F.shiftrightunsigned("h", j).bitwiseAND(F.lit(_PAIR)) * F.col("w")).alias(f"v{j}")
        for j in range(32)
    ]
    summed = hashed.groupBy(*keys).agg(F.sum("w").alias("w"), *votes)
    fp = F.lit(0).cast("long")
    for j in range(32):
        low = F.col(f"v{j}").bitwiseAND(F.lit((1 << 32) - 1))
        high = F.shiftrightunsigned(f"v{j}", 32)
        for count, bit in ((low, j), (high, j + 32)):
            mask = (1 << bit) - (1 << 64 if bit == 63 else 0)
            fp = fp.bitwiseOR(F.when(count * 2 > F.col("w"), F.lit(mask).cast("long")).otherwise(F.lit(0).cast("long")))
    return summed.select(*keys, fp.alias(out))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def _tables(prints: DataFrame, blocks: int, radius: int) -> Column:
    """The permuted tables: each leads with another choice of ``blocks - radius`` blocks."""
    ends = [64 * i // blocks for i in range(blocks + 1)]
    rows = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << ends[c + 1]) - 1) ^ ((1 << ends[c]) - 1) for c in chosen)
        mask -= 1 << 64 if mask >> 63 else 0
        lead = F.col("fp").bitwiseAND(F.lit(mask).cast("long"))
        rows.append(F.struct(F.lit(number).alias("t"), lead.alias("lead")))
    return F.inline(F.array(*rows))


def neighbours(
    queries: DataFrame, prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS
) -> DataFrame:
    """All pairs ``fp``, ``near`` of different fingerprints of ``queries`` and of ``prints``
    (each with a column ``fp``) that differ in at most ``radius`` bits.

    Such fingerprints agree in ``blocks - radius`` blocks at least, so they meet in the table
    that leads with these; whole distances are verified.
    """
    asked = queries.select("fp").distinct().select(F.col("fp").alias("q"), "fp")
    stored = prints.select("fp").distinct()
    asked = asked.select("q", _tables(asked, blocks, radius))
    stored = stored.select(F.col("fp").alias("near"), _tables(stored, blocks, radius))
    met = asked.join(stored, ["t", "lead"]).where("q <> near")
    close = met.where(F.bit_count(F.col("q").bitwiseXOR(F.col("near"))) <= radius)
    return close.select(F.col("q").alias("fp"), "near").distinct()


def successors(keys: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """``key`` and ``next``, the key that follows in ``order``; the first follows the last.

    Keys are unique. They are dealt out by ranges; only the first key of each range, one per
    partition, is looked at together with the others.
    """
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = keys.repartitionByRange(parts, *order).withColumn("_p", F.spark_partition_id())
    ranged = materialize(ranged, "order")
    within = Window.partitionBy("_p").orderBy(*order)
    placed = ranged.select(
        key, "_p", F.lead(key).over(within).alias("_n"), F.row_number().over(within).alias("_r")
    )
    firsts = placed.where("_r = 1").select("_p", F.col(key).alias("_first"))
    every = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wrap = F.coalesce(F.lead("_first").over(Window.orderBy("_p")), F.first("_first").over(every))
    after = firsts.select("_p", wrap.alias("_after"))
    return placed.join(after, "_p").select(key, F.coalesce("_n", "_after").alias("next"))


def with_edits(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Fingerprints of every text of ``docs`` (doc_id, text) and of its edited text.

    Of the edited text, the last third of the code points, rounded down, are replaced by as
    many first ones of the next document, or all it has; documents follow each other by
    descending doc_id, nulls last, ties by their texts' MD5, and the first follows the last.
    Null texts count as empty. Rows that repeat as a whole follow each other and stay. Columns:
    ``doc_id``, ``n_chars``, ``edited_sha256``, ``fp``, ``edited_fp``, ``near_edited``,
    ``near_next`` and, for ids divisible by 100, ``n_near``: the number of other rows within
    ``radius`` bits, else null. An empty table gives no rows.
    """
    text = whole_text()
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(text.cast("binary")))
    base = docs.select(key.alias("k"), "doc_id", text.alias("text"))
    size = F.length("text").cast("long").alias("n_chars")
    rows = base.groupBy("k").agg(
        F.first("doc_id").alias("doc_id"), F.first(size).alias("n_chars"), F.count("*").alias("n")
    )
    rows = materialize(rows, "keys")
    follow = successors(
        rows.select("k", "doc_id"), "k", [F.col("doc_id").desc_nulls_last(), F.col("k")]
    )
    # A row that repeats is followed by itself, its last copy by the next document.
    plan = rows.join(follow, "k").select(
        "*",
        F.inline(
            F.array(
                F.struct(F.col("next").alias("to"), F.lit(1).cast("long").alias("times")),
                F.struct(F.col("k").alias("to"), (F.col("n") - 1).alias("times")),
            )
        ),
    )
    plan = materialize(plan.where("times > 0").drop("next", "n"), "follow")
    last = F.floor(F.col("n_chars") / 3).cast("int")
    once = base.dropDuplicates(["k"]).select("k", "text")
    asked = plan.select(F.col("to").alias("k"), F.col("k").alias("for"), last.alias("take"))
    heads = asked.join(once, "k").select(
        F.col("for").alias("k"), F.col("k").alias("to"), F.left(F.col("text"), F.col("take")).alias("head")
    )
    whole = plan.join(heads, ["k", "to"]).join(once, "k")
    edited = F.concat(F.left(F.col("text"), F.col("n_chars").cast("int") - last), F.col("head"))
    both = whole.select("k", "to", "text", edited.alias("edited")).select(
        "k", "to", F.inline(F.array(
            F.struct(F.lit(False).alias("is_edit"), F.col("text").alias("t")),
            F.struct(F.lit(True).alias("is_edit"), F.col("edited").alias("t")),
        )),
    )
    digest = both.select("*", F.when(F.col("is_edit"), F.sha2(F.col("t").cast("binary"), 256)).alias("sha"))
    prints = materialize(with_fingerprints(digest, ["k", "to", "is_edit", "sha"], "t"), "prints")
    own = prints.where("not is_edit").select("k", "to", "fp")
    ed = prints.where("is_edit").select("k", "to", F.col("fp").alias("edited_fp"), F.col("sha").alias("edited_sha256"))
    of_key = own.select(F.col("k").alias("to"), F.col("fp").alias("next_fp")).distinct()
    found = plan.join(own, ["k", "to"]).join(ed, ["k", "to"]).join(of_key, "to")
    found = materialize(found.drop("k", "to"), "found")
    counts = found.groupBy("fp").agg(F.sum("times").alias("rows"))
    asked = found.where(F.col("doc_id") % 100 == 0)
    near = neighbours(asked, counts, radius).join(
        counts.select(F.col("fp").alias("near"), "rows"), "near"
    )
    near = near.groupBy("fp").agg(F.sum("rows").alias("others"))
    sums = asked.select("fp").distinct().join(counts, "fp").join(near, "fp", "left").select(
        "fp", (F.col("rows") - 1 + F.coalesce("others", F.lit(0))).alias("near_rows")
    )
    joined = found.join(sums, "fp", "left")
    return joined.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fp",
        "edited_fp",
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        F.when(F.col("doc_id") % 100 == 0, F.col("near_rows")).alias("n_near"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("_copy"),
    ).drop("_copy")
