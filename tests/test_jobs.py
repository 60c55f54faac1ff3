"""Sources, sinks, label passes and streams, end to end in temporary folders."""

import json
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from hazardlens import schemas
from hazardlens.functions.text import review_key
from hazardlens.operators import batching, dedup
from hazardlens.operators.envelopes import read_review_envelopes
from hazardlens.plans.collect import collect_reviews, usable_review_pages
from hazardlens.plans.labelling import IncompletePassError, rule_cascade, run_cascade, run_pass
from hazardlens.plans.rubric import DEFAULT_RUBRIC, Rubric, Rule, hazard_label, python_scorer, terms
from hazardlens.plans.scoring import ScorerConfig, ask_batches, score_batches
from hazardlens.session import discard, materialize, work_dir
from hazardlens.sources import files, writers
from hazardlens.streaming.dedup import distinct_stream, stream_distinct_ids
from hazardlens.streaming.ingest import stream_merge
from registry import ORACLES, QUERIES


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def reviews(spark, data):
    df = spark.createDataFrame(
        data, "category string, product_id string, subcategory string, review_text string, arrival bigint"
    )
    return df.withColumn("review_key", review_key(*map(F.col, ("category", "product_id", "review_text"))))


def numbered(spark, n, category="c"):
    return reviews(spark, [(category, "1", "s", f"review {i}", i) for i in range(n)])


TRICKY = [
    ("1", "a", 'quote " and ""'), ("2", "", " edges \t"), ("3", "x,y", "two\nlines"),
    ("007", "NA", "null"), ("5", "s", "back\\slash"), ("6", "s", "nan"),
]


def test_csv_keeps_text(spark, tmp_path):
    path = str(tmp_path / "csv")
    writers.write_reviews_csv(spark.createDataFrame(TRICKY, schemas.RAW_REVIEWS), path)
    assert rows(files.read_reviews_csv(spark, path).drop("file_name")) == sorted(TRICKY)


def test_optional_and_required(spark, tmp_path):
    assert files.read_optional(spark, str(tmp_path / "no"), schemas.LABELS).count() == 0
    (tmp_path / "toys_ids.json").write_text('["1",\n {"id": "2", "subcategory": "s"}]')
    got = files.read_id_lists(spark, str(tmp_path))
    name = "toys_ids.json"
    assert rows(got) == [("toys", 0, "1", "", name), ("toys", 1, "2", "s", name)]
    with pytest.raises(FileNotFoundError):
        files.read_id_lists(spark, str(tmp_path), "nothing_*.json")


def landed_search_pages(spark, n):
    key = F.col("id")
    body = F.format_string('{"ret":["x"],"data":{"result":{"mods":{"itemList":{"content":[{"productId":%d}]}}}}}', key)
    return spark.range(0, n, 1, 1).select(
        F.lit("C").alias("category"), key.cast("string").alias("subcategory"), key.cast("int").alias("sub_ord"),
        F.lit(1).alias("page"), F.lit(1).alias("attempt"), body.alias("body"),
    )


def test_landed_pages_are_compressed_in_files_of_some_rows(spark, tmp_path):
    pages = landed_search_pages(spark, 25).union(spark.sql("select 'C', null, null, 2, null, 'two\\nlines \U0001f525'"))
    writers.write_landed(pages, str(tmp_path / "landed"), rows_per_file=10)
    names = [p.name for p in (tmp_path / "landed").glob("part-*")]
    assert len(names) == 4 and all(n.endswith(".json.gz") for n in names)
    back = files.read_search_pages(spark, str(tmp_path / "landed"))
    assert sorted(map(repr, back.collect())) == sorted(map(repr, pages.collect()))


def test_landing_search_pages_takes_little_disk(spark, tmp_path):
    """All rows of the SQL, from a folder of landed pages that has a fraction of their text."""
    n, key = 20_000, F.col("id")
    lines = spark.range(n).select(
        F.pmod(F.xxhash64(key, F.lit(1)), n).alias("l_orderkey"), F.pmod(F.xxhash64(key, F.lit(2)), n).alias("l_partkey"),
        F.pmod(F.xxhash64(key, F.lit(3)), 1000).alias("l_suppkey"), (key % 7 + 1).cast("int").alias("l_linenumber"),
    )
    odd = spark.sql("select null, 5L, 20L, 1 union all select 7L, 5L, null, 1 union all select 8L, 10L, 20L, null")
    lines.union(odd).union(odd).write.parquet(str(tmp_path / "lineitem.parquet"))
    base = Path(spark.conf.get("spark.checkpoint.dir")) / "hazardlens"
    before = set(base.glob("search_pages-*"))
    got = QUERIES["land_search_pages"](spark, str(tmp_path))
    (landed,) = set(base.glob("search_pages-*")) - before
    text = spark.read.text(str(landed)).agg(F.sum(F.length("value"))).first()[0]
    assert sum(p.stat().st_size for p in landed.glob("part-*")) < text / 5
    db = duckdb.connect()
    db.execute(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet/*.parquet'")
    want = db.sql(ORACLES["land_search_pages"]).fetchall()
    assert len(want) > n / 2
    assert sorted(map(repr, map(tuple, got.select("subcategory", "page", "ids").collect()))) == sorted(map(repr, want))


def test_query_map_file(spark, tmp_path):
    (tmp_path / "map.json").write_text('{"Toys": {"subcategories": {"Cars":\n "toy cars"}}}')
    got = files.read_query_map(spark, str(tmp_path / "map.json"))
    assert rows(got) == [("Toys", 1, "Cars", "toy cars")]


def test_merged_reviews_are_written_in_numeric_order(spark, tmp_path):
    old = reviews(spark, [("c", "10", "s", "a", 1), ("c", "9", "s", "b", 2)])
    new = reviews(spark, [("c", "9", "n", "b", 1), ("c", "100", "n", "d", 2)])
    writers.write_merged_reviews(old, new, str(tmp_path / "out"))
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r.product_id, r.subcategory) for r in got] == [("9", "s"), ("10", "s"), ("100", "n")]


def test_id_and_tree_exports(spark, tmp_path):
    ids = spark.createDataFrame([("Toys & Co", "1", "s")], "category string, id string, subcategory string")
    writers.write_id_lists(ids, str(tmp_path / "ids"))
    assert (tmp_path / "ids" / "slug=toys_co").is_dir()
    tree = spark.createDataFrame([("b", ["x", "y"]), ("a", ["é"])], "category string, subcategories array<string>")
    writers.write_category_tree(tree, str(tmp_path / "tree"))
    assert [r.value for r in spark.read.text(str(tmp_path / "tree")).collect()] == ['{"a":["é"]}', '{"b":["x","y"]}']


def test_compaction_keeps_the_earliest_label(spark, tmp_path):
    labels = [("k1", 1, 20), ("k1", 0, 10), ("k2", None, 5), ("k2", 1, 30), ("k3", None, 1)]
    df = spark.createDataFrame(labels, "review_key string, label int, s int").select(
        "review_key", "label", F.timestamp_seconds("s").alias("labelled_at")
    )
    writers.append_labels(df, str(tmp_path / "labels"))
    assert spark.read.parquet(str(tmp_path / "labels")).count() == 5
    writers.compact_labels(spark, str(tmp_path / "labels"), str(tmp_path / "small"))
    assert rows(spark.read.parquet(str(tmp_path / "small"))) == [("k1", 0), ("k2", 1)]


# --- label passes ------------------------------------------------------------------


def test_short_answers_are_found_again_by_key(spark, tmp_path):
    """80 reviews, two missing labels in the first batch: the next run asks for just these."""
    raw, path = numbered(spark, 80), str(tmp_path / "labels")
    config = ScorerConfig("p", 40)

    def short():
        return lambda texts: [1] * (38 if texts[0] == "review 0" else 40)

    def zeros():
        return lambda texts: [0] * len(texts)

    first = run_pass(spark, raw, path, short, config)
    assert first.count() == 80 and first.where("label is null").count() == 2
    left = batching.unlabelled(raw, first)
    assert rows(left, "review_text") == [("review 38",), ("review 39",)]
    second = batching.current_labels(run_pass(spark, raw, path, zeros, config))
    assert rows(second.groupBy("label").count()) == [(0, 2), (1, 78)]
    third = run_pass(spark, raw, path, lambda: lambda texts: 1 / 0, config)
    assert third.count() == 82


def test_failing_batches_converge(spark, tmp_path):
    raw, path = numbered(spark, 50), str(tmp_path / "labels")
    config = ScorerConfig("p", 5, attempts=2)

    def fails_on(word):
        def make():
            def score(texts):
                if any(t.endswith(word) for t in texts):
                    raise OSError("no answer")
                return [1] * len(texts) + [0]

            return score

        return make

    assert run_pass(spark, raw, path, fails_on("7"), config).count() == 25
    assert run_pass(spark, raw, path, fails_on("nothing"), config).count() == 50


def test_retries_within_a_batch(spark):
    raw = numbered(spark, 4)
    batches = batching.gather_batches(batching.assign_batches(raw, 4))

    def make():
        calls = []

        def score(texts):
            calls.append(1)
            if len(calls) < 3:
                raise OSError("not yet")
            return [len(calls)] * len(texts)

        return score

    scored = score_batches(batches, make, ScorerConfig("p", 4, attempts=3)).first()
    assert scored.labels == [3] * 4


def test_a_model_sees_the_prompt_and_is_asked_again_without_json(spark):
    raw = reviews(spark, [("c", "1", "s", "x" * 400, 0), ("c", "1", "s", "short", 1)])
    batched = batching.assign_batches(raw)

    def make():
        prompts = []

        def model(prompt):
            prompts.append(prompt)
            if len(prompts) == 1:
                return "let me think"
            first, second = prompt.split("\n")
            return f"[{int(len(first) == 403)}, {int(second == '2. short')}]"

        return model

    answered = ask_batches(batching.batch_prompts(batched), make, ScorerConfig("p", 40))
    got = batching.join_answers(batching.gather_batches(batched), answered)
    assert rows(got, "idx", "label") == [(1, 1), (2, 1)]


def test_trial_limit(spark, tmp_path):
    raw = numbered(spark, 30)
    labels = run_pass(spark, raw, str(tmp_path / "l"), lambda: lambda t: [0] * len(t), ScorerConfig("p", 4), limit=10)
    assert labels.count() == 10


def test_cascades_agree_with_each_other(spark, tmp_path):
    texts = [
        ("c", "it caught fire"), ("c", "it caught fire"), ("c", "broken"), ("c", "gave me a rash"),
        ("d", "it caught fire"), ("d", "nothing"), ("d", "no smoke"),
    ]
    raw = dedup.dedup_reviews(reviews(spark, [(c, str(i), "s", t, i) for i, (c, t) in enumerate(texts)]))
    strict = Rubric(hazards=(Rule(1, "fire", (terms("fire"),)),))
    for policy, want in (("union", [0, 3]), ("intersection", [0]), ("second_pass", [0])):
        native = rule_cascade(raw, DEFAULT_RUBRIC, strict, policy)
        stored = run_cascade(
            spark, raw, str(tmp_path / policy), python_scorer(), python_scorer(strict), policy=policy
        )
        assert rows(native, "arrival") == rows(stored, "arrival") == [(i,) for i in want]


def test_cascade_skips_incomplete_categories(spark, tmp_path):
    """In d the answer is too short, in e a whole batch has none."""
    raw = reviews(spark, [
        ("c", "1", "s", "fire", 0),
        ("d", "1", "s", "fire too", 1), ("d", "1", "s", "odd", 2),
        ("e", "1", "s", "fire as well", 3), ("e", "1", "s", "x", 4), ("e", "1", "s", "silent", 5),
    ])

    def make():
        def score(texts):
            return [] if "silent" in texts else [1] * (len(texts) - ("odd" in texts))

        return score

    def run(mode):
        first = ScorerConfig("first_pass", 2)
        folder = str(tmp_path / mode)
        final = run_cascade(spark, raw, folder, make, python_scorer(), first, mode=mode)
        columns = ("category", "hazard_label_classified", "hazard_label_validated")
        return rows(final, *columns)

    assert run("coverage") == [("c", 1, 1)]
    assert run("nulls") == [("c", 1, 1), ("e", 1, 0), ("e", 1, 1)]


# --- streams -----------------------------------------------------------------------------

STREAM_SCHEMA = (
    "category string, product_id string, subcategory string, review_text string, arrival bigint, review_key string"
)


def test_stream_equals_batch(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    data = [("c", str(i % 7), "s", f"t{i % 11}", i) for i in range(60)]
    for start in range(0, 60, 20):
        reviews(spark, data[start : start + 20]).coalesce(1).write.mode("append").parquet(source)
        got = stream_merge(spark, source, STREAM_SCHEMA, target, checkpoint, max_files=1)
    want = dedup.dedup_reviews(reviews(spark, data))
    assert rows(got, "arrival") == rows(want, "arrival")


def test_stream_distinct_ids(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = "category string, id string"
    for data in ([("c", "1"), ("c", "2"), ("c", "1")], [("c", "2"), ("d", "1")]):
        spark.createDataFrame(data, schema).write.mode("append").parquet(source)
        got = stream_distinct_ids(spark, source, schema, target, checkpoint)
    assert rows(got) == [("c", "1"), ("c", "2"), ("d", "1")]


def test_bounded_state_forgets_keys_by_event_time(spark, tmp_path):
    schema = "id string, ts timestamp"
    source = str(tmp_path / "in")
    spark.sql("select '1' as id, timestamp'2024-01-01 00:00:00' as ts").write.parquet(source)
    stream = distinct_stream(spark.readStream.schema(schema).parquet(source), ["id"], "ts", "1 hour")
    query = (
        stream.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


class FakeSession:
    """A session without ``spark.checkpoint.dir``."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return "file:/warehouse" if key == "spark.sql.warehouse.dir" else default

    class sparkContext:
        folder = None
        master = "local[2]"

        @classmethod
        def getCheckpointDir(cls):
            return cls.folder

        @classmethod
        def setCheckpointDir(cls, folder):
            cls.folder = folder


def test_work_dir(spark):
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or first.startswith(configured)
    assert work_dir(FakeSession, "x").startswith(FakeSession.sparkContext.folder)


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    monkeypatch.setattr(FakeSession.sparkContext, "folder", None)
    monkeypatch.setattr(FakeSession.sparkContext, "master", "spark://host:7077")
    with pytest.raises(ValueError):
        work_dir(FakeSession, "x")


def test_a_new_checkpoint_keeps_what_an_earlier_stream_wrote(spark, tmp_path):
    target = str(tmp_path / "out")
    for name, texts in (("a", ["one", "two"]), ("b", ["two", "three"])):
        source = str(tmp_path / f"in_{name}")
        data = [("c", "1", "s", t, i) for i, t in enumerate(texts)]
        reviews(spark, data).write.parquet(source)
        got = stream_merge(spark, source, STREAM_SCHEMA, target, str(tmp_path / f"cp_{name}"))
    assert rows(got, "review_text") == [("one",), ("three",), ("two",)]
    assert got.select("stream").distinct().count() == 2


def test_nothing_has_landed_yet(spark, tmp_path):
    got = stream_merge(spark, str(tmp_path / "no"), STREAM_SCHEMA, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert got.count() == 0 and "review_key" in got.columns


def test_a_pass_that_stops_half_way_keeps_its_labels(spark, tmp_path):
    raw, path = numbered(spark, 40), str(tmp_path / "l")
    config = ScorerConfig("p", 4, attempts=1, batches_per_commit=2)
    asked = spark.sparkContext.accumulator(0)

    def failing():
        def score(texts):
            if any(t.endswith("7") for t in texts):
                raise RuntimeError("model is down")
            return [1] * len(texts)

        return score

    try:
        run_pass(spark, raw, path, failing, config)
    except RuntimeError as error:
        assert "model is down" in str(error)
    first = files.read_optional(spark, path, schemas.LABELS)
    done = first.count()
    assert 0 < done < 40

    def counting():
        def score(texts):
            asked.add(len(texts))
            return [1] * len(texts)

        return score

    assert run_pass(spark, raw, path, counting, config).count() == 40
    assert asked.value == 40 - done


def test_scorer_tasks_follow_the_batches_up_to_a_limit(spark):
    batched = batching.gather_batches(batching.assign_batches(numbered(spark, 400), 4))

    def tasks(**config):
        return score_batches(batched, lambda: lambda t: [0] * len(t), ScorerConfig("p", 4, **config)).rdd.getNumPartitions()

    assert tasks(batches_per_task=10) == 10
    assert tasks(batches_per_task=10, tasks=3) == 3
    assert tasks(batches_per_task=1000) == 1


def counted(asked):
    def make():
        def score(texts):
            asked.add(len(texts))
            return [int("fire" in t) for t in texts]

        return score

    return make


def test_equal_texts_are_scored_once(spark, tmp_path):
    texts = [f"text {i % 17}" + (" fire" if i % 3 else "") for i in range(120)]
    raw = reviews(spark, [(f"c{i % 4}", str(i), "s", t, i) for i, t in enumerate(texts)])
    config, cache = ScorerConfig("p", 4, batches_per_commit=3), str(tmp_path / "cache")
    asked = spark.sparkContext.accumulator(0)
    for run in ("a", "b"):
        table = run_pass(spark, raw, str(tmp_path / run), counted(asked), config, cache=cache)
        got = table.join(raw, "review_key").select("review_text", "label").collect()
        assert len(got) == 120 and all(r.label == ("fire" in r.review_text) for r in got)
        assert asked.value == len(set(texts))
    more = reviews(spark, [("d", "1", "s", "text 1 fire", 0), ("d", "2", "s", "new fire", 1), ("d", "3", "s", None, 2)])
    more = more.withColumn("review_key", F.col("product_id"))
    run_pass(spark, more.fillna(""), str(tmp_path / "c"), counted(asked), config, cache=cache)
    assert asked.value == len(set(texts)) + 2
    # another version of the scorer has scores of its own
    run_pass(spark, raw, str(tmp_path / "d"), counted(asked), ScorerConfig("p", 4, version="2"), cache=cache)
    assert asked.value == 2 * len(set(texts)) + 2


def test_a_cascade_with_a_cache_gives_the_same_result(spark, tmp_path):
    raw = reviews(spark, [(f"c{i % 3}", str(i), "s", f"it caught fire {i % 5}" if i % 2 else f"fine {i}", i) for i in range(60)])
    scorer = python_scorer(DEFAULT_RUBRIC)
    plain = run_cascade(spark, raw, str(tmp_path / "a"), scorer, scorer)
    cached = run_cascade(spark, raw, str(tmp_path / "b"), scorer, scorer, cache=str(tmp_path / "cache"))
    columns = ("category", "product_id", "review_text", "hazard_final")
    assert rows(cached, *columns) == rows(plain, *columns) and plain.count() > 0


def test_errors_are_told(spark):
    def down():
        raise_it = RuntimeError("no such model")

        def score(texts):
            raise raise_it

        return score

    batched = batching.gather_batches(batching.assign_batches(numbered(spark, 8), 4))
    scored = score_batches(batched, down, ScorerConfig("p", 4, attempts=1))
    assert {(r.labels, r.error) for r in scored.collect()} == {(None, "RuntimeError: no such model")}


@pytest.mark.parametrize("policy", ["union", "intersection", "second_pass"])
def test_no_result_while_second_labels_are_missing(spark, tmp_path, policy):
    raw = reviews(spark, [("c", "1", "s", "it caught fire", 0), ("c", "2", "s", "fire again", 1)])

    def first():
        return lambda texts: [1] * len(texts)

    def short():
        return lambda texts: [1] * (len(texts) - 1)

    def run(**more):
        return run_cascade(spark, raw, str(tmp_path / "c"), first, short, policy=policy, **more)

    with pytest.raises(IncompletePassError):
        run()
    second = run_cascade(spark, raw, str(tmp_path / "c"), first, first, policy=policy)
    assert second.count() == 2


def test_hazards_beyond_the_first_300_characters_are_found(spark, tmp_path):
    far = "fine " * 100 + "then it caught fire"
    raw = reviews(spark, [("c", "1", "s", "it caught fire", 0), ("c", "2", "s", far, 1)])
    scorer = python_scorer(DEFAULT_RUBRIC)
    assert run_cascade(spark, raw, str(tmp_path / "c"), scorer, scorer).count() == 2


def test_steps_connect_through_files(spark, tmp_path):
    """Ids to written lists, to reviews, to labels, to the final sheet."""
    found = spark.createDataFrame(
        [("Toys & Co", "7", 0, "s", 1, 0), ("Toys & Co", "12", 0, "s", 1, 1), ("Toys & Co", "9", 1, "t", 1, 0)],
        "category string, id string, sub_ord int, subcategory string, page int, pos int",
    )
    existing = spark.createDataFrame([("Toys & Co", "12", "old", 0)], "category string, id string, subcategory string, ordinal long")
    writers.write_id_lists(dedup.merge_ids(found, existing), str(tmp_path / "ids"))
    ids = files.read_id_lists(spark, str(tmp_path / "ids"))
    assert rows(ids, "category", "ordinal", "id", "subcategory") == [
        ("toys_co", 0, "12", "old"), ("toys_co", 1, "7", "s"), ("toys_co", 2, "9", "t"),
    ]
    bodies = [(p, "1", 1, 1, page_body([f"product {p} caught fire", "same words, smoke"])) for p in ("7", "9", "12")]
    pages = spark.createDataFrame(bodies, "product_id string, star string, page int, attempt int, body string")
    raw = collect_reviews(pages, ids)
    raw = materialize(raw, "raw")
    scorer = python_scorer(DEFAULT_RUBRIC)
    final = run_cascade(spark, raw, str(tmp_path / "labels"), scorer, scorer)
    # the text that all share stays with the smallest numeric id
    assert rows(final, "product_id", "review_text") == [
        ("12", "product 12 caught fire"), ("7", "product 7 caught fire"), ("7", "same words, smoke"), ("9", "product 9 caught fire"),
    ]
    writers.write_final(final, str(tmp_path / "final"))
    sheet = files.read_reviews_csv(spark, str(tmp_path / "final"), schemas.LABELLED_REVIEWS + ", hazard_final int")
    assert sheet.count() == 4


def page_body(texts):
    return "mtopjsonp1(" + json.dumps({"ret": ["SUCCESS"], "data": {"reviewList": [{"content": t} for t in texts]}}) + ")"


@pytest.mark.parametrize("value", ["", 0, {}, [], None, False])
def test_missing_values_fall_through_one_by_one(spark, value):
    def wrap(data):
        return "mtopjsonp1(" + json.dumps({"ret": ["SUCCESS"], "data": data}) + ")"

    full = [{"reviewContent": value, "content": "read this"}]
    bodies = [wrap({"reviewList": value, "reviews": full, "totalPage": value, "maxPage": "3"}), wrap(value)]
    parsed = read_review_envelopes(spark.createDataFrame([(b,) for b in bodies], "body string"))
    assert rows(parsed, "status", "texts", "total_pages") == [("OK", [], 1), ("OK", ["read this"], 3)]


def test_an_error_settles_a_page_and_an_expired_token_does_not(spark):
    good = page_body(["text"])
    error = "mtopjsonp1(" + json.dumps({"ret": ["X"]}) + ")"
    expired = "mtopjsonp1(" + json.dumps({"ret": ["TOKEN_EXOIRED"]}) + ")"
    data = [("a", 1, error), ("a", 2, good), ("b", 1, expired), ("b", 2, "<html>"), ("b", 3, good)]
    pages = spark.createDataFrame([(p, "1", 1, n, b) for p, n, b in data], "product_id string, star string, page int, attempt int, body string")
    assert rows(usable_review_pages(pages), "product_id") == [("b",)]


@pytest.mark.parametrize(
    "text",
    [
        "My Fire tablet stopped working, want a refund", "A pain to assemble, uncomfortable",
        "Phone overheated and shut down, no burning", "It burned out after a week, poor quality",
    ],
)
def test_sayings_are_no_hazards(spark, text):
    df = spark.createDataFrame([(text,), ("It caught fire, Überhitzung größer",)], "t string")
    assert [r[0] for r in df.select(hazard_label(F.col("t"), DEFAULT_RUBRIC)).collect()] == [0, 1]
    assert python_scorer(DEFAULT_RUBRIC)()([text]) == [0]


def test_working_tables_can_be_deleted(spark, tmp_path):
    table = materialize(spark.range(5), "short lived")
    folder = table.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    assert folder_exists(folder)
    discard(table.where("id > 2").unionAll(table))
    assert not folder_exists(folder)
    spark.range(3).write.parquet(str(tmp_path / "own"))
    with pytest.raises(ValueError):
        discard(spark.read.parquet(str(tmp_path / "own")))


def folder_exists(folder):
    from pathlib import Path
    from urllib.parse import unquote

    return Path(unquote(folder)).is_dir()


def test_arrival_is_the_place_in_the_file(spark, tmp_path):
    for part in (2, 1):
        lines = "\n".join(f'{i},s,"text {part}\n{i}"' for i in range(50))
        (tmp_path / f"toys{part}_reviews_raw.csv").write_text(f"product_id,subcategory,review_text\n{lines}\n")
    keyed = files.keyed_reviews(files.read_reviews_csv(spark, str(tmp_path), pattern="*_reviews_raw.csv"))
    line = [(r.category, r.review_text) for r in keyed.orderBy("arrival").collect()]
    assert line == [(f"toys{part}", f"text {part}\n{i}") for part in (1, 2) for i in range(50)]
