"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted per cell of source, language and topic. The weights of the cells are
raked to one margin after the other, and cut at what a cell can give, in turn, until all three
margins of what is drawn fit their targets. No target asks for more than its value has. Documents
are drawn with the probabilities that give each cell its weight of the token budget.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.llm.common import packed, whole_text, without
from hazardlens.session import materialize

DIMS = ["source", "lang", "topic"]
#: Words that speak for a topic; the first topic with the most different ones is taken.
TOPICS = {
    "legal": ["licensed", "license", "copyright", "warranty", "trademark", "liability"],
    "security": ["token =", "password", "secret", "api_key", "private key"],
    "contact": ["@", "phone", "e-mail", "tel:", "+1 ("],
    "hostile": ["idiot", "stupid", "pathetic", "disgusting", "scum", "clown"],
}
#: Cells up to so many are sent to every task; more are joined by a shuffle.
SENT_CELLS = 20_000


@dataclass(frozen=True)
class Targets:
    """Each value's share of a margin is its tokens to a power, times a factor, normalised."""

    powers: Mapping[str, float] = field(
        default_factory=lambda: {"source": 0.5, "lang": 0.7, "topic": 0.9}
    )
    factors: Mapping[str, Mapping[str, float]] = field(
        default_factory=lambda: {"topic": {"hostile": 0.25}}
    )
    #: Share of all tokens that is drawn.
    budget: float = 0.7
    #: Rounds of raking and cutting, and of passing on what a value or cell cannot give.
    rounds: int = 12
    fills: int = 6
    topics: Mapping[str, list[str]] = field(default_factory=lambda: TOPICS)


def topic_of(text: Column, topics: Mapping[str, list[str]] = TOPICS) -> Column:
    """The topic with the most different words in the text, ``general`` if there are none."""
    lowered = F.lower(text)
    hits = {t: sum((F.contains(lowered, F.lit(w)).cast("int") for w in ws), F.lit(0)) for t, ws in topics.items()}
    most = F.greatest(F.lit(0), *hits.values()) if hits else F.lit(0)
    out = F.lit("general")
    for topic, count in reversed(hits.items()):
        out = F.when((count == most) & (most > 0), topic).otherwise(out)
    return out


def n_tokens(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def draw(doc_id: Column) -> Column:
    """A number from 0 to 1 that depends on the id alone; ids that repeat draw alike."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 48))


def described(docs: DataFrame, topics: Mapping[str, list[str]] = TOPICS) -> DataFrame:
    """``docs`` with ``_source``, ``_lang``, ``_topic`` and ``_n``, the number of tokens."""
    text = whole_text()
    return docs.select(
        "*",
        F.coalesce(F.col("source").cast("string"), F.lit("unknown")).alias("_source"),
        F.coalesce(F.col("lang").cast("string"), F.lit("unknown")).alias("_lang"),
        topic_of(text, topics).alias("_topic"),
        n_tokens(text).alias("_n"),
    )


def _bounded(margin: DataFrame, dim: str, targets: Targets, total: float) -> DataFrame:
    """The targets of a margin (``dim``, ``_m``): no value is asked for more than it has, the others
    for what is left over, in proportion."""
    raw = F.pow("_m", F.lit(targets.powers[dim]))
    for value, factor in targets.factors.get(dim, {}).items():
        raw = F.when(F.col(dim) == value, raw * factor).otherwise(raw)
    own = materialize(margin.select(dim, raw.alias("_r"), (F.col("_m") / (total * targets.budget)).alias("_most")), "margin")
    scale = 1.0 / (own.agg(F.sum("_r")).first()[0] or 1.0)
    for _ in range(targets.fills):
        full = F.col("_r") * scale >= F.col("_most")
        held, rest = own.agg(F.sum(F.when(full, F.col("_most")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("_r")))).first()
        scale = max(1.0 - (held or 0.0), 0.0) / rest if rest else scale
    return own.select(dim, F.least(F.col("_r") * scale, F.col("_most")).alias(f"_t_{dim}"))


def rates(docs: DataFrame, targets: Targets) -> DataFrame:
    """``source``, ``lang``, ``topic``, ``weight`` and ``p`` for every cell with tokens.

    ``docs`` has the columns of ``described``. ``weight`` is the cell's raked share of all
    tokens drawn, ``p`` the probability of its documents, so that the cell gives its tokens times
    ``p``. Where margins contradict each other or what the cells have, the last one raked fits
    best; what full cells cannot give is then spread over the others, ``fills`` times.
    """
    cells = docs.groupBy(*[F.col(f"_{d}").alias(d) for d in DIMS]).agg(F.sum("_n").cast("double").alias("n"))
    cells = materialize(cells.where("n > 0"), "cells")
    total = cells.agg(F.sum("n")).first()[0] or 1.0
    wanted = total * targets.budget
    state = cells.withColumn("weight", F.col("n") / total)
    for dim in DIMS:
        margin = cells.groupBy(dim).agg(F.sum("n").alias("_m"))
        state = state.join(_bounded(margin, dim, targets, total), dim)
    state = materialize(state, "rake")
    for _ in range(targets.rounds):
        for dim in DIMS:
            sums = state.groupBy(dim).agg(F.sum("weight").alias("_now"))
            raked = F.col("weight") * F.col(f"_t_{dim}") / F.col("_now")
            state = state.join(sums, dim).withColumn("weight", F.least(raked, F.col("n") / wanted)).drop("_now")
        state = materialize(state, "rake")
    scale = wanted
    for _ in range(targets.fills):
        p = F.least(F.lit(1.0), F.col("weight") * scale / F.col("n"))
        full, rest = state.agg(
            F.sum(F.when(p >= 1, F.col("n")).otherwise(0.0)),
            F.sum(F.when(p >= 1, 0.0).otherwise(F.col("weight"))),
        ).first()
        scale = max(wanted - (full or 0.0), 0.0) / rest if rest else scale
    p = F.least(F.lit(1.0), F.col("weight") * scale / F.col("n"))
    return materialize(state.select(*DIMS, "weight", p.alias("p")), "rates")


def _drawn(own: DataFrame, found: DataFrame) -> DataFrame:
    """Described rows with the rates of their cells and whether they are drawn."""
    cells = found.select(*[F.col(d).alias(f"_{d}") for d in DIMS], "weight", "p")
    if found.count() <= SENT_CELLS:
        cells = F.broadcast(cells)
    joined = own.join(cells, [f"_{d}" for d in DIMS], "left").fillna(0.0, ["weight", "p"])
    drawn = draw(F.col("doc_id")) < F.col("p")
    named = joined.select("*", drawn.alias("sampled"), F.col("_topic").alias("topic"), F.col("_n").alias("n_tokens"))
    return named.drop("_source", "_lang", "_topic", "_n")


def mixed(docs: DataFrame, targets: Targets) -> DataFrame:
    """``docs`` with ``topic``, ``n_tokens``, ``weight``, ``p`` and ``sampled``.

    Null sources and languages count as ``unknown``, null texts as empty. Texts without a token
    are drawn like the others of their cell; a cell without any token has weight and p zero and
    is not drawn. Rows that repeat stay and are drawn alike; columns named like the results are
    replaced. An empty table gives no rows.
    """
    results = ["topic", "n_tokens", "weight", "p", "sampled"]
    own = described(without(docs, [*results, "_source", "_lang", "_topic", "_n"]), targets.topics)
    facts = materialize(own.select("_source", "_lang", "_topic", "_n"), "facts")
    return _drawn(own, rates(facts, targets))


def report(docs: DataFrame, targets: Targets | None = None) -> DataFrame:
    """One row per document with its cell, weight, probability and draw."""
    targets = targets or Targets()
    # No text is needed any more, so each is gone through once.
    facts = materialize(described(docs.select("doc_id", "text", "lang", "source"), targets.topics).drop("text"), "facts")
    found = _drawn(facts, rates(facts, targets))
    unknown = [F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias(c) for c in ("source", "lang")]
    return found.select(
        "doc_id", *unknown, "topic", "n_tokens",
        F.round("weight", 8).alias("weight"), F.round("p", 8).alias("p"), "sampled",
    )


def keep_sampled(docs: DataFrame, targets: Targets | None = None) -> DataFrame:
    """The rows of ``docs`` that are drawn, with their own columns."""
    own = packed(docs, "doc_id", "text", "lang", "source")
    return mixed(own, targets or Targets()).where("sampled").select("row.*")


def sql(targets: Targets | None = None) -> str:
    """The same for DuckDB."""
    t = targets or Targets()
    hits = {
        name: " + ".join(f"contains(lower(coalesce(text, '')), '{w}')::int" for w in words)
        for name, words in t.topics.items()
    }
    cases = " ".join(f"when h{i} = m and m > 0 then '{name}'" for i, name in enumerate(hits))
    columns = ", ".join(f"{e} as h{i}" for i, e in enumerate(hits.values()))
    most = "greatest(" + ", ".join(f"h{i}" for i in range(len(hits))) + ")"
    steps = [
        f"""hits as (select *, {columns} from documents),
facts as (select doc_id, coalesce(source, 'unknown') as source, coalesce(lang, 'unknown') as lang,
  case {cases} else 'general' end as topic,
  len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) as n_tokens
  from (select *, {most} as m from hits)),
cells as (select source, lang, topic, sum(n_tokens)::double as n from facts group by all having n > 0)"""
    ]
    last = "cells"
    for dim in DIMS:
        raw = f"pow(sum(n), {t.powers[dim]})"
        for value, factor in t.factors.get(dim, {}).items():
            raw = f"case when {dim} = '{value}' then {raw} * {factor} else {raw} end"
        steps.append(
            f"m_{dim} as (select {dim}, {raw} as r, sum(n) / ({t.budget} * (select sum(n) from cells)) as most from cells group by {dim})"
        )
        steps.append(f"f_{dim}0 as materialized (select 1 / sum(r) as f from m_{dim})")
        for i in range(t.fills):
            steps.append(
                f"""f_{dim}{i + 1} as materialized (select greatest(1 - sum(case when r * f >= most then most else 0 end), 0)
  / sum(case when r * f >= most then 0 else r end) as f from m_{dim}, f_{dim}{i})"""
            )
        steps.append(f"t_{dim} as materialized (select {dim}, least(r * f, most) as t_{dim} from m_{dim}, f_{dim}{t.fills})")
    joins = " ".join(f"join t_{d} using ({d})" for d in DIMS)
    steps.append(f"r0 as materialized (select *, n / sum(n) over () as w, n / ({t.budget} * sum(n) over ()) as u from {last} {joins})")
    last, number = "r0", 0
    for _ in range(t.rounds):
        for dim in DIMS:
            number += 1
            steps.append(
                f"r{number} as materialized (select * replace (least(w * t_{dim} / sum(w) over (partition by {dim}), u) as w) from {last})"
            )
            last = f"r{number}"
    steps.append(f"s0 as materialized (select {t.budget} * sum(n) as wanted, {t.budget} * sum(n) as scale from {last})")
    for i in range(t.fills):
        steps.append(
            f"""s{i + 1} as materialized (select any_value(wanted) as wanted,
  greatest(any_value(wanted) - sum(case when w * scale / n >= 1 then n else 0 end), 0)
    / sum(case when w * scale / n >= 1 then 0 else w end) as scale from {last}, s{i})"""
        )
    return (
        "with " + ",\n".join(steps) + f""",
p as (select source, lang, topic, w, least(1, w * scale / n) as p from {last}, s{t.fills})
select doc_id, source, lang, topic, n_tokens, round(coalesce(w, 0), 8) as weight,
  round(coalesce(p, 0), 8) as p,
  ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 12))::ubigint / pow(2, 48) < coalesce(p, 0) as sampled
from facts left join p using (source, lang, topic)"""
    )
