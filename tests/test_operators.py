"""Operators on hand-made rows and against brute force on small random ones."""

import json
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from hazardlens.functions.text import review_key
from hazardlens.operators import batching, dedup, envelopes, gates, merging, ordering, paging, worklist
from hazardlens.plans.collect import collect_ids, collect_reviews, collect_tree
from hazardlens.sources.files import explode_id_lists, explode_query_map
from registry import ORACLES, QUERIES


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def wrapped(obj):
    return "mtopjsonp1(" + json.dumps(obj) + ")"


def page(texts=(), total=1, ret="SUCCESS::ok", field="reviewList"):
    reviews = [{"reviewContent": t} for t in texts]
    return wrapped({"ret": [ret], "data": {field: reviews, "totalPage": total}})


# --- envelopes ---------------------------------------------------------------


@pytest.mark.parametrize(
    "body, status",
    [
        (wrapped({"ret": ["SUCCESS::x"]}), "OK"),
        (wrapped({"ret": ["FAIL_SYS_TOKEN_EXOIRED::"]}), "TOKEN_EXPIRED"),
        (wrapped({"ret": ["TOKEN_ILLEGAL"]}), "TOKEN_EXPIRED"),
        (wrapped({"ret": ["X"]}), "ERROR"),
        (wrapped({"data": {}}), "ERROR"),
        (wrapped({"ret": ["SUCCESS", "TOKEN_ILLEGAL"]}), "OK"),
        (wrapped({}), "NO_RESPONSE"),
        ("mtopjsonp1({broken)", "NO_RESPONSE"),
        ("<html>", "NO_RESPONSE"),
        (None, "NO_RESPONSE"),
    ],
)
def test_review_status(spark, body, status):
    pages = spark.createDataFrame([(body,)], "body string")
    assert envelopes.read_review_envelopes(pages).first()["status"] == status


def test_parse_reviews(spark):
    review_rows = [
        {"reviewContent": "", "content": "bad"},
        {"reviewContent": "  ", "content": "dropped"},
        {"buyerFeedback": "\u001cok\u001f"},
        {"content": "a\u000bb"},
        {"content": "a\tb\nc"},
        {"content": "x\u007fy"},
        {"other": 1},
    ]
    body = wrapped(
        {"ret": ["SUCCESS"], "data": {"reviewList": [], "reviews": review_rows, "maxPage": 7, "totalPage": 0}}
    )
    pages = spark.createDataFrame([("1", body)], "product_id string, body string")
    parsed = envelopes.read_review_envelopes(pages)
    assert rows(parsed, "n_valid", "total_pages") == [(4, 7)]
    found = rows(envelopes.explode_reviews(parsed), "pos", "review_text")
    assert found == [(0, "bad"), (1, "ok"), (2, "a\tb\nc"), (3, "x\x7fy")]


@pytest.mark.parametrize(
    "obj, status",
    [
        ({"ret": ["FAIL::RGV587"]}, "BLOCKED"),
        ({"ret": ["ok"], "x5step": 1}, "BLOCKED"),
        ({"x5step": 0, "rgv587_flag": "sm"}, "BLOCKED"),
        ({"x5step": 0, "rgv587_flag": ""}, "DATA"),
        ({"ret": ["FAIL_AUTH"]}, "AUTH"),
        ({"ret": ["x", "USER_VALIDATE"]}, "AUTH"),
        ({"ret": ["OTHER"]}, "DATA"),
        ({"ret": ["RGV587", "ILLEGAL"]}, "BLOCKED"),
        ({}, "NO_RESPONSE"),
    ],
)
def test_search_status(spark, obj, status):
    pages = spark.createDataFrame([(json.dumps(obj),)], "body string")
    assert envelopes.read_search_envelopes(pages).first()["status"] == status


def search_body(ids, stream="", fallback=""):
    result = {
        "mods": {"itemList": {"content": [{"productId": i} for i in ids]}},
        "pageInfo": {"streamId": stream},
        "streamId": fallback,
    }
    return json.dumps({"data": {"result": result}})


def test_extract_ids(spark):
    bodies = [search_body([5, "7", 0, "", None], "s1", "s2"), search_body([], "", "s2"), "{\"data\": {}}"]
    pages = spark.createDataFrame(list(enumerate(bodies)), "page int, body string")
    parsed = envelopes.read_search_envelopes(pages)
    assert rows(parsed, "page", "n_ids", "next_stream") == [(0, 2, "s1"), (1, 0, "s2"), (2, 0, "")]
    assert rows(envelopes.explode_ids(parsed), "page", "pos", "id") == [(0, 0, "5"), (0, 1, "7")]


def test_category_tree(spark):
    def body(*modules, ret="SUCCESS"):
        return json.dumps(
            {"ret": [ret], "data": {"data": {"modules": [{"data": {"items": m}} for m in modules]}}}
        )

    def item(i, t):
        return {"id": i, "title": t}

    tabs_listed = {
        "ret": ["SUCCESS"],
        "data": {"data": {"categoryTabs": {"items": [
            item("t1", "Toys"), item("t2", "Home"), item("t3", "Toys"), item("", "none"),
            {"id": "t4"}, item("t5", "Gone"), item("t6", "Toys"), item("t7", ""),
        ]}}},
    }
    landed = [
        ("t1", body([item("a", "x")], [item("b#1", "old")])),
        ("t2", body([item("a#", "b"), item("c", "a"), item("d", "")], [item("e#", "late")])),
        ("t3", body([item("a#", "new"), item("b", "Z")])),
        ("t4", body([], [item("q#", "one")])),
        ("t5", body([item("a#", "x")], ret="FAIL")),
        ("t6", body([item("a#", "")], [item("b#", "not reached")])),
        ("t7", body([item("a#", "kept")])),
    ]
    first = spark.createDataFrame([(json.dumps(tabs_listed),)], "body string")
    tabs = spark.createDataFrame(landed, "tab_id string, body string")
    tree = {r.category: r.subcategories for r in collect_tree(first, tabs).collect()}
    assert tree == {"Toys": ["Z", "new"], "Home": ["a", "b"], "t4": ["one"], "": ["kept"]}


# --- pagination --------------------------------------------------------------------


def read(spark, pages):
    df = spark.createDataFrame(
        [("p", "1", n, total, valid) for n, total, valid in pages],
        "product_id string, star string, page int, total_pages int, n_valid int",
    )
    return [r[0] for r in rows(paging.review_pages_read(df), "page")]


def test_take_while(spark):
    assert read(spark, [(1, 3, 5), (2, 3, 0), (3, 3, 4)]) == [1, 2]
    assert read(spark, [(1, 1, 5), (2, 1, 5), (3, 1, 5)]) == [1]
    assert read(spark, [(1, 4, 5), (3, 4, 5)]) == [1]
    assert read(spark, [(2, 4, 5), (3, 4, 5)]) == []
    assert read(spark, [(1, 4, 5), (2, 2, 1), (3, 4, 5)]) == [1, 2]


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("bits, levels", [(10, 0), (1, 1), (1, 2), (2, 3), (10, 2)])
def test_take_while_equals_brute_force(spark, bits, levels, inclusive):
    rng = random.Random(bits * 10 + levels)
    data, want = [], []
    for key in range(60):
        pages = [n for n in range(1, rng.randint(2, 40)) if rng.random() > 0.03]
        stops = {n: rng.random() < 0.04 for n in pages}
        data += [(key, n, stops[n]) for n in pages]
        n = 1
        while n in stops and (inclusive or not stops[n]):
            want.append((key, n))
            if stops[n]:
                break
            n += 1
    df = spark.createDataFrame(data, "key int, page int, stop boolean")
    got = paging.take_while(df, ["key"], "page", "stop", inclusive, bits, levels)
    assert rows(got, "key", "page") == sorted(want)


def test_first_usable_attempt(spark):
    df = spark.createDataFrame(
        [("p", 1, 1, "OK"), ("p", 2, 1, "TOKEN_EXPIRED"), ("p", 2, 2, "OK"), ("p", 2, 3, "OK"), ("p", 3, 1, "ERROR")],
        "product_id string, page int, attempt int, status string",
    )
    got = paging.first_usable_attempt(df, ["product_id", "page"], ["attempt"], F.col("status") == "OK")
    assert rows(got, "page", "attempt") == [(1, 1), (2, 2)]


def test_collect_reviews(spark):
    landed = [
        ("10", "1", 1, 1, page(["a", "b"], 3)),
        ("10", "1", 2, 1, page([], 3, ret="FAIL_SYS_TOKEN_EXOIRED")),
        ("10", "1", 2, 2, page(["c", "a"], 3)),
        ("10", "1", 3, 1, page(["  "], 3)),
        ("10", "1", 4, 1, page(["never"], 9)),
        ("10", "2", 1, 1, page(["d", "b"], 1)),
        ("10", "5", 1, 1, page(["praise"], 1)),
        ("9", "1", 1, 1, page(["a"], 1)),
        ("8", "1", 1, 1, page(["unlisted"], 1)),
    ]
    ids = [("toys", 0, "10", "first"), ("toys", 1, "9", "x"), ("toys", 2, "10", "second"), ("home", 0, "10", "h")]
    pages = spark.createDataFrame(landed, "product_id string, star string, page int, attempt int, body string")
    listed = spark.createDataFrame(ids, "category string, ordinal bigint, id string, subcategory string")
    raw = collect_reviews(pages, listed)
    toys = raw.where("category = 'toys'").orderBy("arrival")
    assert [tuple(r) for r in toys.select("product_id", "subcategory", "review_text").collect()] == [
        ("10", "first", "a"), ("10", "first", "b"), ("10", "first", "c"), ("10", "first", "d"), ("9", "x", "a"),
    ]
    assert raw.where("category = 'home'").count() == 4
    assert raw.select("review_key").distinct().count() == 9


def test_collect_ids(spark):
    landed = [
        ("c", "s", 0, 1, 1, search_body([5, 7, 5])),
        ("c", "s", 0, 2, 1, json.dumps({"ret": ["RGV587"]})),
        ("c", "s", 0, 2, 2, search_body([7, 9])),
        ("c", "s", 0, 3, 1, search_body([])),
        ("c", "s", 0, 4, 1, search_body([99])),
        ("c", "t", 1, 1, 1, search_body([7, 11])),
        ("d", "s", 0, 1, 1, search_body([5])),
    ]
    pages = spark.createDataFrame(
        landed, "category string, subcategory string, sub_ord int, page int, attempt int, body string"
    )
    existing = spark.createDataFrame(
        [("c", "9", "old"), ("c", "9", "old"), ("d", "1", "")], "category string, id string, subcategory string"
    )
    merged = collect_ids(pages, existing)
    assert rows(merged, "category", "id", "subcategory", "source_rank") == [
        ("c", "11", "t", 1), ("c", "5", "s", 1), ("c", "7", "s", 1), ("c", "9", "old", 0),
        ("c", "9", "old", 0), ("d", "1", "", 0), ("d", "5", "s", 1),
    ]
    listed = dedup.listed_ids(merged).where("category = 'c'")
    assert rows(listed, "ordinal", "id") == [(0, "9"), (1, "9"), (2, "5"), (3, "7"), (4, "11")]


def test_running_new_ids(spark):
    found = spark.createDataFrame(
        [("c", "s", 1, 0, "5"), ("c", "s", 1, 1, "7"), ("c", "s", 2, 0, "7"), ("c", "s", 3, 0, "8")],
        "category string, subcategory string, page int, pos int, id string",
    ).withColumn("sub_ord", F.lit(0))
    got = paging.running_new_ids(found, dedup.first_seen_ids(found))
    assert rows(got, "page", "new_ids", "new_so_far") == [(1, 2, 2), (2, 0, 2), (3, 1, 3)]


# --- order -----------------------------------------------------------------------------


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_ordinal_equals_brute_force(spark, most):
    rng = random.Random(7)
    data = [(c, n) for c in ("a", "b", None) for n in rng.sample(range(10**6), 50)]
    df = spark.createDataFrame(data, "c string, n bigint")
    got = {(r.c, r.n): r.o for r in ordering.ordinal(df, ["c"], ["n"], "o", most).collect()}
    assert got == {(c, n): 1 + sum(d == c and m < n for d, m in data) for c, n in data}


def test_ordinal_of_one_group_over_many_ranges(spark):
    df = spark.range(5000).withColumn("c", F.lit("hot"))
    got = ordering.ordinal(df, ["c"], ["id"], "o", 0)
    assert got.where("o <> id + 1").count() == 0 and got.count() == 5000


def test_no_task_numbers_a_large_group_alone(spark):
    df = spark.range(60_000).withColumn("c", F.lit("hot"))
    got = ordering.ordinal(df, ["c"], ["id"], "o")
    of_task = got.groupBy(F.spark_partition_id()).count()
    assert of_task.agg(F.max("count")).first()[0] <= 2 * ordering.WINDOW_ROWS
    assert got.where("o <> id + 1").count() == 0 and got.count() == 60_000


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_ordinal_with_three_columns_and_nulls(spark, most):
    rng = random.Random(8)
    data = [(c, a, b, n) for c in "xy" for a in (0, 1, None) for b in range(-2, 3) for n in rng.sample(range(99), 4)]
    df = spark.createDataFrame(data, "c string, a bigint, b int, n int")
    three = ordering.ordinal(df, ["c"], ["a", "b", "n"], "o", most)
    got = {(r.c, r.a, r.b, r.n): r.o for r in three.collect()}
    for g in "xy":
        line = sorted((r for r in data if r[0] == g), key=lambda r: (r[1] is None, r[1] or 0, r[2], r[3]))
        assert [got[r] for r in line] == list(range(1, len(line) + 1))


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_structs_are_orders_too(spark, most):
    keys = [(p, s, g, i) for p in (0, 1) for s in "12" for g in (1, 2**40) for i in (0, 2**12)]
    df = spark.createDataFrame(keys[::-1], "p bigint, s string, g bigint, i int")
    one = df.select(F.lit("c").alias("c"), F.struct("p", "s", "g", "i").alias("arrival"))
    got = sorted((r.o, tuple(r.arrival)) for r in ordering.ordinal(one, ["c"], ["arrival"], "o", most).collect())
    assert [k for _, k in got] == sorted(keys)


@pytest.mark.parametrize("most", [0, 5, 1_000_000])
def test_running_total(spark, most):
    df = spark.createDataFrame([("a", n, n * n) for n in range(20)] + [(None, 3, 5), (None, 4, 6)], "c string, n int, v int")
    got = ordering.running_total(df, ["c"], "n", "v", "t", most)
    assert rows(got.where("c = 'a'"), "n", "t") == [(n, sum(i * i for i in range(n))) for n in range(20)]
    assert rows(got.where("c is null"), "n", "t") == [(3, 0), (4, 5)]


def test_numeric_sort(spark):
    df = spark.createDataFrame([("10", 1), ("x", 3), ("9", 2), ("9", 0)], "product_id string, arrival int")
    got = [tuple(r) for r in ordering.sort_by_numeric_id(df).collect()]
    assert got == [("9", 0), ("9", 2), ("10", 1), ("x", 3)]


def test_null_groups_stay(spark):
    df = spark.createDataFrame([(None, 1, 1), (None, 2, 1), (None, 3, 0), ("a", 4, 1), ("b", 5, None)], "category string, n int, label int")
    assert rows(ordering.skip_per_group(df, ["category"], "n", 1), "n") == [(2,), (3,)]
    assert rows(gates.gated_hazards(df, mode="coverage"), "n") == [(1,), (2,), (4,)]
    listed = df.withColumn("subcategory", F.lit("s")).withColumnRenamed("n", "ordinal")
    assert worklist.start_from(listed, "s").count() == 5
    late = spark.createDataFrame([("c", None, "x"), ("c", 1, "y")], "category string, ordinal bigint, id string")
    assert rows(worklist.product_batches(late), "id", "idx") == [("x", 2), ("y", 1)]



# --- ids, work lists -----------------------------------------------------------------------


def test_id_lists(spark):
    lists = spark.createDataFrame([('["12", 34, {"id": 3, "subcategory": "x"}, {"id": "5"}]',)], "value string")
    assert rows(explode_id_lists(lists)) == [(0, "12", ""), (1, "34", ""), (2, "3", "x"), (3, "5", "")]


def test_query_map(spark):
    value = json.dumps({"T": {"subcategories": {"b": "q1", "a": "q2"}}, "U": {"subcategories": {}}})
    got = explode_query_map(spark.createDataFrame([(value,)], "value string"))
    assert rows(got) == [("T", 1, "b", "q1"), ("T", 2, "a", "q2")]


def test_start_from(spark):
    df = spark.createDataFrame([("a", i, s) for i, s in enumerate("xyz")] + [("b", 0, "q"), ("b", 1, "r")],
                               "category string, ordinal bigint, subcategory string")
    assert rows(worklist.start_from(df, "y"), "category", "ordinal") == [("a", 1), ("a", 2), ("b", 0), ("b", 1)]
    assert worklist.start_from(df, "nowhere").count() == 5


def test_select(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "category string")
    known = ["a", "b", "c"]
    assert rows(worklist.select_numbered(df, "1 3", known)) == [("a",), ("c",)]
    assert worklist.select_numbered(df, " ALL ", known).count() == 3
    assert worklist.select_categories(df, None, known).count() == 3
    for wrong in ("0", "4", "1 x", ""):
        with pytest.raises(ValueError):
            worklist.select_numbered(df, wrong, known)
    with pytest.raises(ValueError):
        worklist.select_categories(df, ["z"], known)


# --- de-duplication --------------------------------------------------------------------------

REVIEW = "category string, product_id string, subcategory string, review_text string, arrival bigint"


def reviews(spark, data):
    df = spark.createDataFrame(data, REVIEW)
    return df.withColumn("review_key", review_key(*map(F.col, ("category", "product_id", "review_text"))))


def test_dedup(spark):
    df = reviews(spark, [
        ("c", "1", "b", "t", 2), ("c", "1", "a", "t", 1), ("d", "1", "z", "t", 3), ("c", "2", "a", "t", 4),
    ])
    assert rows(dedup.dedup_reviews(df), "category", "product_id", "subcategory") == [
        ("c", "1", "a"), ("c", "2", "a"), ("d", "1", "z"),
    ]
    assert rows(dedup.dedup_text(df), "arrival") == [(1,)]


def test_merge_keeps_existing_rows_and_is_idempotent(spark):
    old = reviews(spark, [("c", "1", "old", "t", 5)])
    new = reviews(spark, [("c", "1", "new", "t", 1), ("c", "1", "new", "u", 2), ("c", "1", "new", "u", 3)])
    once = dedup.merge_reviews(old, new)
    assert rows(once, "subcategory", "review_text", "arrival") == [("new", "u", 2), ("old", "t", 5)]
    twice = dedup.merge_reviews(once.drop("source_rank"), new)
    assert rows(twice, "subcategory", "review_text") == rows(once, "subcategory", "review_text")
    assert rows(dedup.new_reviews(new, old), "review_text", "arrival") == [("u", 2)]


# --- batches and gates ---------------------------------------------------------------------------


def test_batches(spark):
    df = reviews(spark, [("c", str(i), "s", f"t{i}", i * 7) for i in range(45)] + [("d", "1", "s", "x", 1)])
    batched = batching.assign_batches(df, 20)
    sizes = rows(batched.groupBy("category", "batch_id").count())
    assert sizes == [("c", 0, 20), ("c", 1, 20), ("c", 2, 5), ("d", 0, 1)]
    prompt = batching.batch_prompts(batched).where("category = 'c' and batch_id = 2").first().prompt
    assert prompt == "1. t40\n2. t41\n3. t42\n4. t43\n5. t44"


@pytest.mark.parametrize("name", ["batch_prompt", "batch_prompt_whole_texts"])
def test_prompts_hold_whole_texts(spark, tmp_path, name):
    """Texts beyond the 300 characters that model calls were once cut to are in the prompt to their end."""
    long, wide = "a" * 299 + " fire at the end", "\U0001f525" * 301
    data = [(1, long, "en", "s1"), (2, "short", "en", "s2"), (3, wide, "en", "s3"), (4, None, "en", "s4")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    want = [("en", 0, f"1. {long}\n2. short\n3. {wide}")]
    assert rows(QUERIES[name](spark, str(tmp_path)), "category", "batch_id", "prompt") == want
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert db.sql(ORACLES[name]).fetchall() == want


@pytest.mark.parametrize(
    "response, want",
    [
        ("[1,0]", [(1, 1), (2, 0), (3, None)]),
        ("[1,0,1,1]", [(1, 1), (2, 0), (3, 1)]),
        ("oops", [(1, None), (2, None), (3, None)]),
        (None, [(1, None), (2, None), (3, None)]),
    ],
)
def test_zip_labels(spark, response, want):
    df = reviews(spark, [("c", str(i), "s", f"t{i}", i) for i in range(3)])
    batches = batching.gather_batches(batching.assign_batches(df))
    answers = spark.createDataFrame([("c", 0, response)], "category string, batch_id bigint, response string")
    got = batching.join_answers(batches, answers).select("idx", "label").collect()
    assert sorted(map(tuple, got), key=lambda r: r[0]) == want


def test_gate(spark):
    data = [("a", 1, 1, True), ("a", 2, 0, True), ("b", 3, 1, True), ("b", 4, None, True), ("c", 5, 1, True), ("c", 6, None, False)]
    df = spark.createDataFrame(data, "category string, review_key int, label int, attempted boolean")
    assert rows(gates.complete_groups(df, mode="coverage")) == [("a",)]
    assert rows(gates.complete_groups(df, mode="nulls")) == [("a",), ("c",)]
    assert rows(gates.gated_hazards(df, mode="nulls"), "review_key") == [(1,), (5,)]
    with pytest.raises(ValueError):
        gates.complete_groups(df, mode="other")


def test_gate_deals_no_hazards_by_group(spark):
    """The hazards of one large group stay in the tasks that have them."""
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.autoBroadcastJoinThreshold": "4k"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        hot = F.when(F.col("id") >= 0, "a").alias("category")
        df = spark.range(0, 8000, 1, 8).select("id", hot, F.lit(1).alias("label"))
        of_task = gates.gated_hazards(df, mode="coverage").groupBy(F.spark_partition_id()).count()
        assert sorted(r["count"] for r in of_task.collect()) == [1000] * 8
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_label_state_keeps_gaps(spark):
    data = [("a", None, 1), ("a", 1, 3), ("a", 0, 2), ("b", None, 1), ("b", None, 2)]
    labels = spark.createDataFrame(data, "review_key string, label int, labelled_at int")
    assert rows(batching.label_state(labels)) == [("a", 0), ("b", None)]
    assert rows(batching.current_labels(labels)) == [("a", 0)]


def test_merged_label(spark):
    df = spark.createDataFrame([(1, 0), (0, 1), (0, 0), (1, None), (None, None), (1, 1)], "a int, b int")

    def labels(policy):
        return [r[0] for r in df.select(merging.merged_label(F.col("a"), F.col("b"), policy)).collect()]

    assert labels("union") == [1, 1, 0, 1, 0, 1]
    assert labels("intersection") == [0, 0, 0, 0, 0, 1]
    assert labels("second_pass") == [0, 1, 0, 0, 0, 1]
    with pytest.raises(ValueError):
        labels("vote")
