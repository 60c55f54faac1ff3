"""Reviews through de-duplication, batches, gates, both label passes and the merge."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlens.functions.text import has_control_chars, strip
from hazardlens.operators import batching, dedup, gates, merging, reports
from hazardlens.plans.labelling import rule_cascade, run_cascade, run_pass
from hazardlens.plans.rubric import (
    DEFAULT_RUBRIC,
    MARK,
    NO_WORD_OR_COMMA,
    Rubric,
    Rule,
    benign_class,
    hazard_class,
    python_scorer,
    rewrites,
    terms,
    trie,
)
from hazardlens.plans.scoring import FIRST_PASS, ask_batches, score_batches
from hazardlens.session import materialize, work_dir
from hazardlens.sources.writers import append_labels
from registry.base import (
    REVIEWS_SQL,
    keyed_reviews,
    pass_labels,
    query,
    reviews,
    table,
)

FILE_ORDER_SQL = "category, try_cast(product_id as bigint) nulls last, product_id, arrival"

# --- filters and de-duplication ------------------------------------------------


@query("project_reviews", f"select product_id, subcategory, review_text from ({REVIEWS_SQL})")
def project_reviews(spark, sf_dir):
    return reviews(spark, sf_dir).select("product_id", "subcategory", "review_text")


@query("filter_nonempty", f"select doc_id, review_text from ({REVIEWS_SQL}) where doc_id % 3 <> 0")
def filter_nonempty(spark, sf_dir):
    blank = F.lit(" \xa0 \x1f")
    padded = F.concat(blank, "review_text", blank)
    text = F.when(F.col("doc_id") % 3 == 0, blank).otherwise(padded)
    stripped = reviews(spark, sf_dir).select("doc_id", strip(text).alias("review_text"))
    return stripped.where(F.col("review_text") != "")


@query(
    "filter_control_chars",
    f"select doc_id, review_text || chr(127) as review_text from ({REVIEWS_SQL}) where doc_id % 5 <> 0",
)
def filter_control_chars(spark, sf_dir):
    mark = F.when(F.col("doc_id") % 5 == 0, "\x0b").otherwise("\x7f")
    marked = reviews(spark, sf_dir).select(
        "doc_id", F.concat("review_text", mark).alias("review_text")
    )
    return marked.where(~has_control_chars(F.col("review_text")))


_DEDUP_SQL = f"""
r as ({REVIEWS_SQL}),
d as (select * exclude (n) from (
        select *, row_number() over (partition by category, product_id, review_text
                                     order by arrival) as n from r) where n = 1)"""


@query("dedup_reviews", f"with {_DEDUP_SQL} select doc_id, category, product_id from d")
def dedup_reviews(spark, sf_dir):
    first = dedup.dedup_reviews(reviews(spark, sf_dir))
    return first.select("doc_id", "category", "product_id")


@query(
    "dedup_text",
    f"""select doc_id, product_id from (
          select *, row_number() over (partition by review_text order by {FILE_ORDER_SQL}) as n
          from ({REVIEWS_SQL})) where n = 1""",
)
def dedup_text(spark, sf_dir):
    return dedup.dedup_text(reviews(spark, sf_dir)).select("doc_id", "product_id")


@query(
    "merge_reviews",
    f"""with r as (
          select *, case when doc_id % 3 = 0 then 1 else 0 end as source_rank
          from ({REVIEWS_SQL}))
        select doc_id, category, product_id, cast(source_rank as int) as source_rank from (
          select *, row_number() over (partition by category, product_id, review_text
                                       order by source_rank, arrival) as n from r)
        where n = 1""",
)
def merge_reviews(spark, sf_dir):
    rows = reviews(spark, sf_dir)
    later = F.col("doc_id") % 3 == 0
    merged = dedup.merge_reviews(rows.where(~later), rows.where(later))
    return merged.select("doc_id", "category", "product_id", "source_rank")


# --- batches ----------------------------------------------------------------------

_BATCHES_SQL = f"""
b as (select *, (n - 1) // 40 as batch_id, cast((n - 1) % 40 + 1 as int) as idx from (
        select *, row_number() over (partition by category order by arrival) as n
        from ({REVIEWS_SQL})))"""


@query(
    "assign_batches",
    f"with {_BATCHES_SQL} select doc_id, category, cast(batch_id as bigint) as batch_id, idx from b",
)
def assign_batches(spark, sf_dir):
    batched = batching.assign_batches(reviews(spark, sf_dir))
    return batched.select("doc_id", "category", "batch_id", "idx")


@query(
    "batch_prompt",
    f"""with {_BATCHES_SQL}
        select category, cast(batch_id as bigint) as batch_id,
               string_agg(idx || '. ' || review_text, chr(10) order by idx) as prompt
        from b group by all""",
)
def batch_prompt(spark, sf_dir):
    batched = batching.assign_batches(reviews(spark, sf_dir))
    return batching.batch_prompts(batched)


@query(
    "batch_prompt_whole_texts",
    f"""with {_BATCHES_SQL}
        select category, cast(batch_id as bigint) as batch_id,
               string_agg(idx || '. ' || review_text, chr(10) order by idx) as prompt
        from b group by all""",
)
def batch_prompt_whole_texts(spark, sf_dir):
    batched = batching.assign_batches(reviews(spark, sf_dir))
    return batching.batch_prompts(batched)


@query(
    "zip_labels",
    f"""with {_BATCHES_SQL},
        s as (select *, max(idx) over (partition by category, batch_id) as size from b)
        select doc_id, category, cast(batch_id as bigint) as batch_id, idx,
               cast(case when batch_id % 4 = 3 then -1
                         when batch_id % 4 = 1 and idx > size - 2 then -1
                         else doc_id % 2 end as int) as label
        from s""",
)
def zip_labels(spark, sf_dir):
    batched = batching.assign_batches(reviews(spark, sf_dir))
    batches = materialize(batching.gather_batches(batched, key="doc_id"), "batches")
    labels = F.transform("items", lambda item: (item["key"] % 2).cast("int"))
    kind = F.col("batch_id") % 4
    shorter = F.slice(labels, F.lit(1), F.greatest(F.size(labels) - 2, F.lit(0)))
    response = (
        F.when(kind == 0, F.to_json(labels))
        .when(kind == 1, F.to_json(shorter))
        .when(kind == 2, F.to_json(F.concat(labels, F.array(F.lit(1), F.lit(0)))))
        .otherwise("no labels today")
    )
    answers = batches.select("category", "batch_id", response.alias("response"))
    rows = batching.join_answers(batches, answers)
    return rows.select(
        F.col("key").alias("doc_id"),
        "category",
        "batch_id",
        "idx",
        F.coalesce("label", F.lit(-1)).alias("label"),
    )


@query(
    "batch_progress",
    f"""with {_BATCHES_SQL}
        select category, cast(batch_id as bigint) as batch_id, count(*) as n,
               count(quality) as done, cast(batch_id + 1 as bigint) as batch_number,
               (select max(x.batch_id) + 1 from b x where x.category = b.category) as batches
        from b left join labels using (doc_id) group by all""",
)
def batch_progress(spark, sf_dir):
    labels = pass_labels(spark, sf_dir, "quality").select("doc_id", "label")
    batched = batching.assign_batches(reviews(spark, sf_dir)).join(labels, "doc_id", "left")
    return batching.batch_progress(batched)


# --- labels, gates ------------------------------------------------------------------


@query("drop_unlabelled", "select doc_id from documents where doc_id in (select doc_id from labels)")
def drop_unlabelled(spark, sf_dir):
    labels = pass_labels(spark, sf_dir, "quality").select("doc_id", "label")
    labelled = reviews(spark, sf_dir).join(labels, "doc_id", "left")
    return labelled.dropna(subset=["label"]).select("doc_id")


@query(
    "hazard_only",
    "select doc_id from documents join labels using (doc_id) where quality = 1",
)
def hazard_only(spark, sf_dir):
    labels = pass_labels(spark, sf_dir, "quality").select("doc_id", "label")
    labelled = reviews(spark, sf_dir).join(labels, "doc_id", "left")
    return labelled.where(F.col("label") == 1).select("doc_id")


@query(
    "resume_unlabelled",
    "select doc_id from documents where doc_id not in (select doc_id from labels)",
)
def resume_unlabelled(spark, sf_dir):
    labels = pass_labels(spark, sf_dir, "quality")
    return batching.unlabelled(reviews(spark, sf_dir), labels, "doc_id").select("doc_id")


def _grouped(spark, sf_dir, column="quality"):
    labels = pass_labels(spark, sf_dir, column).select("doc_id", "label")
    return (
        reviews(spark, sf_dir)
        .join(labels, "doc_id", "left")
        .withColumn("pair", F.floor(F.col("doc_id") / 2))
    )


_GROUPS_SQL = """
g as (select d.doc_id, lang as category, cast(d.doc_id // 2 as bigint) as pair, quality as label
      from documents d left join labels using (doc_id)),
c as (select pair from g group by pair having count(label) = count(*))"""


@query("complete_groups", f"with {_GROUPS_SQL} select pair from c")
def complete_groups(spark, sf_dir):
    return gates.complete_groups(_grouped(spark, sf_dir), ["pair"], mode="coverage")


@query(
    "complete_groups_nulls",
    """select cast(d.doc_id // 4 as bigint) as pair from documents d join labels using (doc_id)
       group by all having count(case when quality + toxic > 0 then 1 end) = count(*)""",
)
def complete_groups_nulls(spark, sf_dir):
    """Only rows in the label table are looked at; answers of 0 and 0 stand for missing labels."""
    answers = table(spark, sf_dir, "labels").select(
        "doc_id",
        F.when(F.col("quality") + F.col("toxic") > 0, F.col("quality")).alias("label"),
        F.lit(True).alias("attempted"),
    )
    rows = (
        reviews(spark, sf_dir)
        .join(answers, "doc_id", "left")
        .withColumn("attempted", F.coalesce("attempted", F.lit(False)))
        .withColumn("pair", F.floor(F.col("doc_id") / 4))
    )
    return gates.complete_groups(rows, ["pair"], mode="nulls")


@query(
    "gated_hazards",
    f"with {_GROUPS_SQL} select doc_id, pair from g where label = 1 and pair in (select pair from c)",
)
def gated_hazards(spark, sf_dir):
    hazards = gates.gated_hazards(_grouped(spark, sf_dir), ["pair"], mode="coverage")
    return hazards.select("doc_id", "pair")


@query(
    "hazard_counts",
    f"""with {_GROUPS_SQL}
        select coalesce(category, 'TOTAL') as category, count(*) as hazards
        from g where label = 1 group by rollup (category)""",
)
def hazard_counts(spark, sf_dir):
    hazards = _grouped(spark, sf_dir).where(F.col("label") == 1)
    counts = gates.hazard_counts(hazards)
    return counts.select(F.coalesce("category", F.lit("TOTAL")).alias("category"), "hazards")


# --- the two passes ------------------------------------------------------------------


def _merged(spark, sf_dir, policy):
    first = dedup.dedup_reviews(reviews(spark, sf_dir))
    merged = merging.merge_passes(
        first,
        batching.current_labels(pass_labels(spark, sf_dir, "quality"), "doc_id"),
        batching.current_labels(pass_labels(spark, sf_dir, "toxic"), "doc_id"),
        policy,
        "doc_id",
    )
    return merging.final_hazards(merged).select(
        "doc_id",
        "category",
        "product_id",
        "subcategory",
        "review_text",
        F.coalesce("hazard_label_classified", F.lit(-1)).alias("hazard_label_classified"),
        F.coalesce("hazard_label_validated", F.lit(-1)).alias("hazard_label_validated"),
        "hazard_final",
    )


def _merged_sql(condition):
    return f"""
        with {_DEDUP_SQL},
        m as (select *, row_number() over (partition by review_text order by {FILE_ORDER_SQL}) as n
              from d join labels using (doc_id) where {condition})
        select doc_id, category, product_id, subcategory, review_text,
               quality as hazard_label_classified, toxic as hazard_label_validated,
               cast(1 as int) as hazard_final
        from m where n = 1"""


@query("merge_union", _merged_sql("quality = 1 or toxic = 1"))
def merge_union(spark, sf_dir):
    return _merged(spark, sf_dir, "union")


@query("merge_intersection", _merged_sql("quality = 1 and toxic = 1"))
def merge_intersection(spark, sf_dir):
    return _merged(spark, sf_dir, "intersection")


@query("merge_second_pass", _merged_sql("toxic = 1"))
def merge_second_pass(spark, sf_dir):
    return _merged(spark, sf_dir, "second_pass")


# --- scoring ---------------------------------------------------------------------------
# The texts of the test tables are invented prose, so the rubrics of the queries name
# words that occur in them.

WORD_RUBRIC = Rubric(
    hazards=(
        Rule(1, "licence talk", (terms("license, licenses, licence, under the"),)),
        Rule(2, "hands", (terms("hand, hands"),)),
        Rule(3, "thin and short", (terms("thin"), terms("is, the"))),
    ),
    harmless=terms("the hand, the hands, no hand, no hands"),
)
STRICT_RUBRIC = Rubric(hazards=(Rule(1, "licence talk", (terms("license"),)),))


def _class_sql(rubric, column="review_text", rules=None):
    """The classes by regular expressions on lists of sentences."""
    spaced = f"regexp_replace(regexp_replace(s, '{NO_WORD_OR_COMMA}', ' ', 'g'), ' *, *', ' , ', 'g')"
    step = f"regexp_replace(' ' || {spaced} || ' ', ' +', ' ', 'g')"
    split = f"string_split_regex(lower({column}), '[.!?;' || chr(10) || chr(13) || ']+')"
    sentences = f"list_transform({split}, lambda s: {step})"
    for needs, pattern in rewrites(rubric):
        replaced = f"regexp_replace(s, '{pattern}', '{MARK}', 'g')"
        if needs is not None:
            replaced = f"case when regexp_matches(s, '{needs}') then {replaced} else s end"
        sentences = f"list_transform({sentences}, lambda s: {replaced})"
    pairs = "list_transform(z, lambda s, i: s || coalesce(z[i + 1], ''))"

    def hit(rule):
        groups = " and ".join(f"regexp_matches(s, ' {trie(g)} ')" for g in rule.all_of)
        where = "z" if len(rule.all_of) == 1 else pairs
        return f"len(list_filter({where}, lambda s: {groups})) > 0"

    whens = " ".join(f"when {hit(r)} then {r.class_id}" for r in rules or rubric.hazards)
    return f"(select cast(case {whens} else 0 end as int) from (select {sentences} as z))"


_WORD_CLASS_SQL = _class_sql(WORD_RUBRIC)


@query(
    "score_rules",
    f"""select doc_id, {_WORD_CLASS_SQL} as hazard_class,
               cast({_WORD_CLASS_SQL} > 0 as int) as hazard_label
        from ({REVIEWS_SQL})""",
)
def score_rules(spark, sf_dir):
    scored = reviews(spark, sf_dir).select(
        "doc_id", hazard_class(F.col("review_text"), WORD_RUBRIC).alias("hazard_class")
    )
    return scored.withColumn("hazard_label", (F.col("hazard_class") > 0).cast("int"))


# What a reviewer says in front of each text, with the hazard class it must get.
PHRASES = (
    ("Gave my son a rash.", 1),
    ("He almost choked.", 2),
    ("The charger sparked and caught fire!", 3),
    ("Much too hot to touch.", 4),
    ("It melted and there was smoke", 3),
    ("The smell gave me a headache", 6),
    ("Rusty, not for food.", 7),
    ("Wrong voltage, it died.", 8),
    ("The bottle burst.", 9),
    ("Stopped working, want a refund.", 0),
    ("Phone gets warm.", 0),
    ("It melted without any smoke or fire.", 0),
    ("Bad smell.", 0),
    ("The blood pressure monitor is inaccurate, want a refund.", 0),
    ("Fire pit cover too small, returned it.", 0),
    ("Spark plug does not fit my mower.", 0),
    ("The smoke colored vase arrived broken.", 0),
    ("The toy fire truck broke, cheap quality.", 0),
    ("Overheated and shut down, nothing burned", 0),
    ("Painful price for a cheap fake.", 0),
    ("The pen melted a bit, color of fire red", 0),
    ("Too tight, painful after an hour.", 0),
    ("Got burned by this scam.", 0),
    ("No smoke, flames or sparks, but it shocked me.", 3),
    ("My blood pressure cuff left blisters.", 1),
    ("The smell is awful. Gave me a headache.", 6),
)


def _said_sql(phrases):
    """Reviews with ``said``: one of the phrases in front of the whole text."""
    values = ", ".join(f"({i}, '{phrase}')" for i, (phrase, _) in enumerate(phrases))
    return f"""(select doc_id, phrase || chr(10) || text as said from documents
                join (values {values}) p(i, phrase) on doc_id % {len(phrases)} = i)"""


def _said(spark, sf_dir, phrases):
    texts = F.array(*[F.lit(phrase) for phrase, _ in phrases])
    phrase = F.get(texts, F.col("doc_id") % len(phrases))
    return reviews(spark, sf_dir).select(
        "doc_id", F.concat(phrase, F.lit("\n"), F.col("review_text")).alias("said")
    )


_DEFAULT_CLASS_SQL = _class_sql(DEFAULT_RUBRIC, "said")


@query(
    "score_rules_default",
    f"select doc_id, {_DEFAULT_CLASS_SQL} as hazard_class from {_said_sql(PHRASES)}",
)
def score_rules_default(spark, sf_dir):
    said = _said(spark, sf_dir, PHRASES)
    return said.select("doc_id", hazard_class(F.col("said"), DEFAULT_RUBRIC).alias("hazard_class"))


BENIGN_PHRASES = (
    ("Stopped working.", 1),
    ("It ruined my printer.", 2),
    ("Want a refund.", 3),
    ("Very uncomfortable.", 4),
    ("This is a scam.", 5),
    ("Gets warm.", 6),
    ("It overheats.", 7),
    ("Warped in the sun.", 8),
    ("Bad odor.", 9),
    ("Caught fire, stopped working.", 0),
)
_BENIGN_CLASS_SQL = _class_sql(DEFAULT_RUBRIC, "said", DEFAULT_RUBRIC.benign)


@query(
    "benign_rules",
    f"""select doc_id, case when {_DEFAULT_CLASS_SQL} > 0 then cast(0 as int)
                            else {_BENIGN_CLASS_SQL} end as benign_class
        from {_said_sql(BENIGN_PHRASES)}""",
)
def benign_rules(spark, sf_dir):
    said = _said(spark, sf_dir, BENIGN_PHRASES)
    return said.select("doc_id", benign_class(F.col("said"), DEFAULT_RUBRIC).alias("benign_class"))


@query(
    "score_pandas",
    f"select doc_id, cast({_WORD_CLASS_SQL} > 0 as int) as label from ({REVIEWS_SQL})",
)
def score_pandas(spark, sf_dir):
    batched = batching.assign_batches(reviews(spark, sf_dir))
    batches = batching.gather_batches(batched, key="doc_id")
    scored = score_batches(batches, python_scorer(WORD_RUBRIC), FIRST_PASS)
    return batching.zip_labels(scored).select(F.col("key").alias("doc_id"), "label")


@query(
    "ask_model",
    f"""with {_BATCHES_SQL},
        s as (select *, max(idx) over (partition by category, batch_id) as size from b)
        select doc_id, cast(case when size < 3 then -1 else (idx + size) % 2 end as int) as label
        from s""",
)
def ask_model(spark, sf_dir):
    """A stand-in model sees only the prompt and answers with a fenced list.

    It labels line i of n with (i + n) % 2 and has no answer to fewer than 3 lines.
    """

    def make_model():
        def model(prompt):
            numbers = [0]
            for line in prompt.split("\n"):
                if line.startswith(f"{len(numbers)}. "):
                    numbers.append(len(numbers))
            n = numbers[-1]
            if n < 3:
                return "I cannot tell"
            return "```json\n" + str([(i + n) % 2 for i in numbers[1:]]) + "\n```"

        return model

    batched = materialize(batching.assign_batches(reviews(spark, sf_dir)), "batched")
    answered = ask_batches(batching.batch_prompts(batched), make_model)
    rows = batching.join_answers(batching.gather_batches(batched, key="doc_id"), answered)
    return rows.select(F.col("key").alias("doc_id"), F.coalesce("label", F.lit(-1)).alias("label"))


@query(
    "label_pass_resume",
    f"""with {_DEDUP_SQL}
        select doc_id, coalesce(quality, cast({_WORD_CLASS_SQL} > 0 as int)) as label
        from d left join labels using (doc_id)""",
)
def label_pass_resume(spark, sf_dir):
    """Labels that exist stay as they are; what has none is scored, written and read back."""
    raw = dedup.dedup_reviews(keyed_reviews(spark, sf_dir))
    path = work_dir(spark, "labels")
    earlier = raw.join(pass_labels(spark, sf_dir, "quality"), "doc_id")
    append_labels(earlier.select("review_key", "label", "labelled_at"), path)
    table_ = run_pass(spark, raw, path, python_scorer(WORD_RUBRIC), FIRST_PASS)
    labels = batching.current_labels(table_)
    return raw.join(labels, "review_key").select("doc_id", "label")


_STRICT_CLASS_SQL = _class_sql(STRICT_RUBRIC)
_CASCADE_SQL = f"""
with {_DEDUP_SQL},
s as (select *, {_WORD_CLASS_SQL} as c1, {_STRICT_CLASS_SQL} as c2 from d),
h as (select *, row_number() over (partition by review_text order by {FILE_ORDER_SQL}) as n
      from s where c1 > 0)
select doc_id, cast(1 as int) as hazard_label_classified,
       cast(c2 > 0 as int) as hazard_label_validated
from h where n = 1"""


@query("cascade", _CASCADE_SQL)
def cascade(spark, sf_dir):
    raw = dedup.dedup_reviews(reviews(spark, sf_dir))
    final = rule_cascade(raw, WORD_RUBRIC, STRICT_RUBRIC)
    return final.select("doc_id", "hazard_label_classified", "hazard_label_validated")


@query("cascade_with_checkpoints", _CASCADE_SQL)
def cascade_with_checkpoints(spark, sf_dir):
    raw = materialize(dedup.dedup_reviews(keyed_reviews(spark, sf_dir)), "raw")
    final = run_cascade(
        spark,
        raw,
        work_dir(spark, "cascade"),
        python_scorer(WORD_RUBRIC),
        python_scorer(STRICT_RUBRIC),
    )
    return final.select("doc_id", "hazard_label_classified", "hazard_label_validated")


# --- reports ------------------------------------------------------------------------------


@query(
    "volume_report",
    """with r as (select lang, regexp_extract(source, '[0-9]+') as product_id, quality
                  from documents left join labels using (doc_id))
       select 'reviews' as metric, lang as group_name, count(*) as n from r group by all
       union all
       select 'products', lang, count(distinct product_id) from r group by all
       union all
       select 'labelled', lang, count(quality) from r group by all
       union all
       select 'ids', l_returnflag, count(distinct l_partkey) from lineitem group by all""",
)
def volume_report(spark, sf_dir):
    labels = pass_labels(spark, sf_dir, "quality").select("doc_id", "label")
    volume = reports.review_volume(reviews(spark, sf_dir).join(labels, "doc_id", "left"))
    parts = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("category"), F.col("l_partkey").alias("id")
    )
    ids = reports.id_volume(parts.distinct(), ["category"])
    return reports.stacked(volume, "category").unionByName(reports.stacked(ids, "category"))


@query(
    "run_elapsed",
    """with s as (select user_id, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 as seconds
                  from events group by user_id)
       select user_id, seconds, case when seconds >= 3600
                then cast(seconds // 3600 as varchar) || 'h ' else '' end
              || cast(seconds % 3600 // 60 as varchar) || 'm '
              || cast(seconds % 60 as varchar) || 's' as elapsed
       from s""",
)
def run_elapsed(spark, sf_dir):
    return reports.run_elapsed(table(spark, sf_dir, "events"), "user_id", "ts")
