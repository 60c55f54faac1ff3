"""Personal data: patterns for what has a form, co-occurrence for what gives it away.

Addresses and numbers are found by patterns. A word in a text with such an entity gives it away
as far as seeing the word predicts the entity: its pointwise mutual information with the entity,
as a share of the entity's whole information content. Words above a threshold are spans too,
wherever they stand; spans are generalised to their kind, or removed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardlens.llm.common import packed, whole_text
from hazardlens.session import materialize

# The patterns of the four kinds. Possessive repeats and the look-behind
# change no match; they only keep long runs of letters or digits from being tried from
# every one of their places.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(PATTERNS)
#: What a text must hold for a kind to be looked for at all.
_SIGNS = {"email": "@", "ip": ".", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": "+"}
TERM = "term"
#: Code points on either side of an entity that tell passages apart.
NEAR = 80
#: Words are spans if they give away this share of an entity, in so many different passages.
SHARE, SUPPORT = 0.8, 2
_WORD, _BETWEEN = r"[\p{L}\p{M}\p{N}]++", r"[^\p{L}\p{M}\p{N}]++"


def bound(value: Column, make: Callable[[Column], Column]) -> Column:
    """``make`` of a value that is worked out once, however often and wherever it is used."""
    return F.element_at(F.transform(F.array(value), make), 1)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(from_right: Column):
        def step(total: Column, i: Column) -> Column:
            digit = F.substring(from_right, i, F.lit(1)).cast("int")
            doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
            return total + F.when(i % 2 == 0, doubled).otherwise(digit)

        return step

    places = F.sequence(F.lit(1), F.length(digits))
    return bound(F.reverse(digits), lambda d: F.aggregate(places, F.lit(0), add(d)) % 10 == 0)


def _valid(kind: Column, match: Column) -> Column:
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    size = F.length(_digits(match))
    return (
        F.when(kind == "ip", F.rlike(match, F.lit(rf"^{part}(?:\.{part}){{3}}$")))
        .when(kind == "card", F.when(size.between(13, 19), _luhn(_digits(match))).otherwise(False))
        .when(kind == "phone", size.between(9, 15))
        .otherwise(True)
    )


def _looked_for(kind: str, text: Column) -> Column:
    sign = _SIGNS[kind]
    return F.rlike(text, F.lit(sign)) if kind == "card" else F.contains(text, F.lit(sign))


def _cut(text: Column, pattern: str) -> Column:
    """The matches of a pattern, with what stands before and after each, and the text's end."""

    def zipped(cut: Column) -> Column:
        n = F.size(cut["hits"])
        before, after = (F.slice(cut["gaps"], F.lit(i), n) for i in (1, 2))
        lines = F.arrays_zip(cut["hits"].alias("hit"), before.alias("before"), after.alias("after"))
        return F.struct(lines.alias("lines"), F.element_at(cut["gaps"], -1).alias("rest"))

    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return bound(F.struct(gaps.alias("gaps"), hits.alias("hits")), zipped)


def _matches(text: Column) -> Column:
    """All matches of all kinds: kind, place among its kind, code points since the match
    before, the match and what stands on either side."""
    found = []
    for number, (kind, pattern) in enumerate(PATTERNS.items()):
        listed = F.transform(_cut(text, pattern)["lines"], _match_of(number, kind))
        found.append(F.when(_looked_for(kind, text), listed))
    return F.concat(*[F.coalesce(f, F.array().cast(_MATCH)) for f in found])


def _match_of(number: int, kind: str):
    def match(line: Column, i: Column) -> Column:
        return F.struct(
            F.lit(number).alias("k"),
            F.lit(kind).alias("kind"),
            i.alias("i"),
            F.length(line["before"]).cast("long").alias("gap"),
            line["hit"].alias("value"),
            F.right(line["before"], F.lit(NEAR + 1)).alias("left"),
            F.left(line["after"], F.lit(NEAR + 1)).alias("right"),
        )

    return match


_MATCH = (
    "array<struct<k:int,kind:string,i:int,gap:bigint,value:string,left:string,right:string>>"
)


def looked_at(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` gone through once: ``row``, which tells rows apart, ``doc_id``,
    ``digest`` of the text, ``m``, its matches, and ``said``, its different words outside base matches,
    lower-cased, joined by spaces. Words are runs of letters and digits of any length."""
    words = F.split(F.lower(blanked(whole_text())), _BETWEEN)
    said = F.array_join(F.array_remove(F.array_distinct(words), ""), " ")
    row = F.monotonically_increasing_id().alias("row")
    found = docs.select(row, "doc_id", _digest(), _matches(whole_text()).alias("m"), said.alias("said"))
    return materialize(found, "looked")


def entities(looked: DataFrame) -> DataFrame:
    """The valid base matches: ``row``, ``doc_id``, ``digest``, ``k``, ``kind``, ``start``, ``end``, ``value``,
    ``left``, ``right``. A row without any has one line with a null kind. Places are code points from 0."""
    lines = looked.select("row", "doc_id", "digest", F.inline_outer("m"))
    spread = lines.repartition("row")
    so_far = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("value")).over(so_far)
    placed = spread.withColumn("end", end).withColumn("start", F.col("end") - F.length("value"))
    bad = F.col("kind").isNotNull() & ~F.coalesce(_valid(F.col("kind"), F.col("value")), F.lit(True))
    empty = [F.when(~bad, F.col(c)).alias(c) for c in ("kind", "start", "end", "value", "left", "right")]
    return placed.select("row", "doc_id", "digest", "k", *empty)


def word_sets(looked: DataFrame) -> DataFrame:
    """Each different text once: ``digest`` and ``said``. Copies are left out by their row, so what is
    said need not be dealt out to find them."""
    often = looked.groupBy("digest").agg(F.min("row").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = looked.select("row", "digest").join(often, "digest").where("row != first").select("row")
    return looked.select("row", "digest", "said").join(materialize(copies, "copies"), "row", "left_anti").drop("row")


def _digest() -> Column:
    return F.md5(whole_text().cast("binary")).alias("digest")


def blanked(text: Column) -> Column:
    """The text with spaces in place of its base matches, so that places stay. The kinds take
    turns: each is looked for in what the ones before it left."""

    def without_kind(kind: str, pattern: str):
        def piece(line: Column) -> Column:
            blank = F.repeat(F.lit(" "), F.length(line["hit"]))
            return F.concat(line["before"], F.when(_valid(F.lit(kind), line["hit"]), blank).otherwise(line["hit"]))

        def joined(cut: Column) -> Column:
            return F.array_join(F.concat(F.transform(cut["lines"], piece), F.array(cut["rest"])), "")

        return lambda t: F.when(_looked_for(kind, t), bound(_cut(t, pattern), joined)).otherwise(t)

    for kind, pattern in PATTERNS.items():
        text = bound(text, without_kind(kind, pattern))
    return text


def _words(sets: DataFrame, *others: str) -> DataFrame:
    return sets.where("said <> ''").select(*others, F.explode(F.split("said", " ")).alias("term"))


def _rarest(of_value: Column, total: int, share: float) -> Column:
    """In more texts than so many a term cannot give away ``share`` of an entity that ``of_value`` of
    ``total`` texts hold, as it stands with the entity in those at most."""
    return float(total) * F.pow(of_value / float(total), F.lit(share)) * (1 + 1e-9)


def _classes(found: DataFrame, support: int) -> DataFrame:
    """The texts (``digest``) and passages (``context``) of entities in ``support`` passages or more:
    ``kind``, ``value`` and ``of_value``, the number of texts.

    Entities with the same texts, of which the same ones share a passage, cannot be told apart by
    words. They are one class, of which the first is named; so a list of addresses that stands in
    several texts counts as one entity.
    """
    some = found.where(F.col("kind").isNotNull())
    own = some.groupBy("digest", "kind", F.lower("value").alias("value")).agg(
        F.min(F.xxhash64("left", "right")).alias("context")
    )
    by_context = own.groupBy("kind", "value", "context").agg(F.count("*").alias("n"), F.min("digest").alias("first"))
    often = by_context.groupBy("kind", "value").agg(F.sum("n").alias("of_value"), F.count("*").alias("passages"))
    often = often.where(F.col("passages") >= support).select("kind", "value", "of_value")
    asked = materialize(by_context.join(often, ["kind", "value"]).select("kind", "value", "context", "first", "of_value"), "often")
    places = materialize(own.join(asked, ["kind", "value", "context"]), "places")
    place = F.xxhash64("digest", "first")
    alike = places.groupBy("kind", "value").agg(
        F.count("*").alias("n"), F.sum(place.cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64("first", "digest")).alias("x")
    )
    named = alike.groupBy("n", "s", "x").agg(F.min(F.struct("kind", "value")).alias("e")).select("e.*")
    return materialize(places.join(named, ["kind", "value"]).drop("first"), "classes")


def revealing(found: DataFrame, sets: DataFrame, share: float = SHARE, support: int = SUPPORT) -> DataFrame:
    """``kind``, ``value``, ``term`` and ``given``: what share of the entity the term gives away.

    Probabilities are of the different texts in ``sets``, so a text that is copied counts once on
    every side. A term must stand by the entity in ``support`` different passages as well: copying
    a passage into different texts gives nothing away. Of entities that always stand together, the
    first is named. Terms too common to give an entity of their text away are left out before words
    and entities meet; an entity that all texts have gives nothing away.
    """
    total = sets.count()
    often = _classes(found, support).where(F.col("of_value") < total)
    asked = often.groupBy("digest").agg(F.max("of_value").alias("most"))
    most = often.agg(F.max(_rarest(F.col("of_value"), total, share))).first()[0] or 0.0
    every = _words(sets).groupBy("term").agg(F.count("*").alias("of_term"))
    rare = materialize(every.where(F.col("of_term").between(support, most)), "rare")
    words = _words(sets.join(asked, "digest"), "digest", "most").join(rare, "term")
    words = materialize(words.where(F.col("of_term") <= _rarest(F.col("most"), total, share)), "words")
    met = often.join(words, "digest").where(F.col("of_term") <= _rarest(F.col("of_value"), total, share))
    both = met.groupBy("kind", "value", "of_value", "term", "of_term", "context").agg(F.count("*").alias("n"))
    pairs = both.groupBy("kind", "value", "of_value", "term", "of_term")
    pairs = pairs.agg(F.sum("n").alias("both"), F.count("*").alias("passages")).where(F.col("passages") >= support)
    mutual = F.log2(F.col("both") * float(total) / (F.col("of_term") * F.col("of_value")))
    content = F.log2(float(total) / F.col("of_value"))
    given = F.least(F.lit(1.0), mutual / content).alias("given")
    return materialize(pairs.select("kind", "value", "term", given).where(F.col("given") >= share), "given")


def term_places(docs: DataFrame, sets: DataFrame, given: DataFrame) -> DataFrame:
    """``digest``, ``start`` and ``end`` of every occurrence of a given term in all texts, once for
    texts that are equal."""
    terms = materialize(given.select("term").distinct(), "terms")
    hit = materialize(_words(sets, "digest").join(terms, "term").select("digest").distinct(), "hit")
    texts = docs.select(_digest(), whole_text().alias("text")).join(hit, "digest", "left_semi").dropDuplicates(["digest"])

    def steps(cut: Column) -> Column:
        return F.transform(cut["lines"], lambda m, i: F.struct(
            i.alias("i"), F.lower(m["hit"]).alias("term"), F.length(m["hit"]).alias("size"),
            (F.length(m["before"]) + F.length(m["hit"])).alias("step"),
        ))

    lines = texts.select("digest", F.inline(bound(_cut(blanked(F.col("text")), _WORD), steps)))
    so_far = Window.partitionBy("digest").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = lines.withColumn("end", F.sum("step").over(so_far)).join(terms, "term")
    return placed.select("digest", (F.col("end") - F.col("size")).alias("start"), "end")


def spans(docs: DataFrame, share: float = SHARE, support: int = SUPPORT) -> DataFrame:
    """One row per row of ``docs`` with ``spans``: an array of place of the kind, start, end and kind.

    Base kinds come first, in their order, then the words that give entities away, each by
    start; those are marked in every text, with the entity or without. Null texts count as
    empty and have none; rows that repeat stay; an empty table gives no rows. Further columns
    are not read. Columns ``row``, ``doc_id``, ``digest`` (of the text), ``spans``.
    """
    own = docs.select("doc_id", "text")
    looked = looked_at(own)
    found, sets = materialize(entities(looked), "entities"), word_sets(looked)
    terms = term_places(own, sets, revealing(found, sets, share, support))
    line = F.struct(F.lit(len(KINDS)).alias("k"), "start", "end", F.lit(TERM).alias("kind"))
    terms = terms.groupBy("digest").agg(F.sort_array(F.collect_list(line)).alias("told"))
    line = F.when(F.col("kind").isNotNull(), F.struct("k", "start", "end", "kind"))
    base = found.groupBy("row", "digest").agg(
        F.max("doc_id").alias("doc_id"), F.sort_array(F.collect_list(line)).alias("base")
    )
    every = F.when(F.col("told").isNull(), F.col("base")).otherwise(F.concat("base", "told"))
    return base.join(terms, "digest", "left").select("row", "doc_id", "digest", every.alias("spans"))


def _joined(found: Column) -> Column:
    return F.array_join(
        F.transform(
            found,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def report(docs: DataFrame) -> DataFrame:
    """Counts by kind, a digest of the base spans, and all spans as text."""
    found = spans(docs)
    base = F.filter("spans", lambda s: s["kind"] != TERM)
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
        for kind in KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def _marks(found: DataFrame) -> DataFrame:
    """``digest`` and ``marks``: the spans of each text by place, with where the one before ends.
    Spans that overlap are one, of the kind of the first."""
    lines = found.select("digest", F.inline("spans")).distinct()
    order = [F.col("start"), F.col("end").desc(), F.col("k")]
    line = Window.partitionBy("digest").orderBy(*order)
    reached = F.coalesce(F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lines = lines.withColumn("reached", reached)
    fresh = F.when(F.col("start") >= F.col("reached"), 1).otherwise(0)
    lines = lines.withColumn("mark", F.sum(fresh).over(line.rowsBetween(Window.unboundedPreceding, 0)))
    first = F.struct("start", -F.col("end"), "k")
    marks = lines.groupBy("digest", "mark").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("reached").alias("after"), F.min_by("kind", first).alias("kind")
    )
    mark = F.struct("start", "end", "after", "kind")
    return marks.groupBy("digest").agg(F.sort_array(F.collect_list(mark)).alias("marks"))


#: Code points of the parts that a text is cut into, so that a place is found without going
#: through all before it.
_PART = 1024


def _between(parts: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` up to ``end`` of a text in parts."""
    first, last = F.floor(start / _PART).cast("int"), F.floor(end / _PART).cast("int")
    at, to = (start % _PART).cast("int"), (end % _PART).cast("int")
    inner = F.when(last - first > 1, F.array_join(F.slice(parts, first + 2, last - first - 1), "")).otherwise("")
    rest = F.when(to > 0, F.substring(F.get(parts, last), F.lit(1), to)).otherwise("")
    across = F.concat(F.substring(F.get(parts, first), at + 1, F.lit(_PART)), inner, rest)
    inside = F.substring(F.get(parts, first), at + 1, to - at)
    return F.when(start >= end, "").when(first == last, inside).otherwise(across)


def sanitised(text: Column, marks: Column, remove: tuple[str, ...] = (TERM,)) -> Column:
    """The text with its marks replaced by their kind in brackets, those of the kinds in
    ``remove`` by nothing."""

    def piece(parts: Column):
        def of(mark: Column) -> Column:
            tag = F.concat(F.lit("["), F.upper(mark["kind"]), F.lit("]"))
            tag = F.when(mark["kind"].isin(*remove), "").otherwise(tag)
            return F.concat(_between(parts, mark["after"], mark["start"]), tag)

        return of

    def joined(parts: Column) -> Column:
        rest = _between(parts, F.element_at(marks, -1)["end"], F.length(text).cast("long"))
        return F.array_join(F.concat(F.transform(marks, piece(parts)), F.array(rest)), "")

    return bound(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PART}}}"), F.lit(0)), joined)


def sanitise(
    docs: DataFrame, share: float = SHARE, support: int = SUPPORT, remove: tuple[str, ...] = (TERM,)
) -> DataFrame:
    """``docs`` with personal data taken out of ``text``: spans of the kinds in ``remove`` are removed,
    others generalised to their kind.

    All rows, repeated ones included, and all other columns stay, whatever their names; equal texts
    are cleaned alike. Null texts stay null; an empty table gives no rows.
    """
    marks = _marks(spans(docs, share, support).where(F.size("spans") > 0))
    joined = packed(docs, whole_text().alias("text"), _digest()).join(marks, "digest", "left")
    clean = F.when(F.col("marks").isNotNull(), sanitised(F.col("text"), F.col("marks"), remove))
    others = [F.coalesce(clean, F.col("row.text")).alias(c) if c.lower() == "text" else F.col(f"row.`{c}`") for c in docs.columns]
    return joined.select(*others)
