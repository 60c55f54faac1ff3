"""Column functions on hand-made rows; expected values worked out by hand."""

import hashlib

import pytest
from pyspark.sql import functions as F

from hazardlens.functions import answers, text
from hazardlens.plans.rubric import hazard_label, instructions, python_scorer

FENCE = "`" * 3


def apply(spark, values, fn, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r.r for r in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


def test_strip_equals_python_for_every_character(spark):
    codes = [c for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    values = [chr(c) + "x" + chr(c) for c in codes]
    assert apply(spark, values, text.strip) == [v.strip() for v in values]


def test_strip_rows(spark):
    values = ["\x1cok\x1f", "  hi \xa0", "  ", "a b", " 　x\x85"]
    assert apply(spark, values, text.strip) == ["ok", "hi", "", "a b", "x"]


def test_control_characters(spark):
    values = ["a\x0bb", "a\tb\nc\rd", "x\x7fy", "\x00", "\x1f", "ok"]
    assert apply(spark, values, text.has_control_chars) == [True, False, False, True, True, False]


def test_text_chain_takes_a_blank_first_field(spark):
    rows = [("", "bad", "x"), ("  ", "bad", "x"), (None, None, "x"), (None, "", None)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    got = [r[0] for r in df.select(text.first_text(*map(F.col, "abc"))).collect()]
    assert got == ["bad", "  ", "x", ""]


def test_list_chain(spark):
    rows = [([], ["r"]), (["q"], ["r"]), (None, ["r"]), ([], None)]
    df = spark.createDataFrame(rows, "a array<string>, b array<string>")
    got = [r[0] for r in df.select(text.first_list(F.col("a"), F.col("b"))).collect()]
    assert got == [["r"], ["q"], ["r"], None]


def test_total_pages(spark):
    rows = [("0", "7"), (None, None), ("3", "7"), ("junk", "2"), ("junk", None)]
    df = spark.createDataFrame(rows, "a string, b string")
    got = [r[0] for r in df.select(text.total_pages(F.col("a"), F.col("b"))).collect()]
    assert got == [7, 1, 3, 2, 1]


def test_unwrap(spark):
    values = [
        'mtopjsonp1({"a":1})',
        'mtopjsonp12({"a":1})\n',
        'mtopjsonp1({"a":1});',
        'mtopjsonp1({"a":"x y"})',
        'mtopjsonp1({"a":"x\ry"})',
        'other({"a":1})',
        'junk mtopjsonp3({"a":")"})',
    ]
    assert apply(spark, values, text.unwrap_callback) == [
        '{"a":1}', '{"a":1}', None, '{"a":"x y"}', '{"a":"x\ry"}', None, '{"a":")"}',
    ]


def test_slug(spark):
    values = ["Toys & Hobbies (US)!", "__a--B__", "Über 9"]
    assert apply(spark, values, text.slug) == ["toys_hobbies_us", "a_b", "ber_9"]


def test_file_names(spark):
    got = apply(
        spark,
        ["shop_toys_ids", "toys_ids", "shop_toys", "shop_a_ids_ids"],
        lambda c: text.category_of_file(c, "shop_", "_ids"),
    )
    assert got == ["toys", "toys", "toys", "a_ids"]


def test_truncate_counts_code_points(spark):
    value = "\U0001f525" * 301
    assert apply(spark, [value, "ab"], text.truncate) == [value[:300], "ab"]


def test_elapsed(spark):
    got = apply(spark, [0, 59, 3600, 3661, 360000], text.format_elapsed, "v int")
    assert got == ["0m 0s", "0m 59s", "1h 0m 0s", "1h 1m 1s", "100h 0m 0s"]


def test_attribute_map(spark):
    values = ["a=1; b=x=y ; junk; a=2", "", " k = v ", "=e"]
    assert apply(spark, values, text.attribute_map) == [
        {"b": "x=y", "a": "2"}, {}, {"k": "v"}, {"": "e"},
    ]


def test_review_key_is_md5_of_the_joined_fields(spark):
    df = spark.createDataFrame([("A & b", "12", "hi"), ("c", None, None)], "c string, p string, t string")
    got = [r[0] for r in df.select(text.review_key(F.col("c"), F.col("p"), F.col("t"))).collect()]
    assert got == [hashlib.md5(s.encode()).hexdigest() for s in ("a_b&12&hi", "c&&")]


def test_any_contains(spark):
    df = spark.createDataFrame([(["a SUCCESS b"],), (["x"],), ([],), (None,)], "r array<string>")
    got = [r[0] for r in df.select(text.any_contains(F.col("r"), "NO", "SUCCESS")).collect()]
    assert got == [True, False, False, False]


def test_json_helpers(spark):
    df = spark.createDataFrame([('{"a":{"b":"x"}}', None)], "j string, n string")
    row = df.select(
        text.json_path(F.col("j"), "$.a.b"),
        text.json_path(F.col("j"), "$.a.c", "none"),
        text.compact_json(a=F.lit(1), b=F.col("n"), c=F.lit("x")),
    ).first()
    assert tuple(row) == ("x", "none", '{"a":1,"c":"x"}')


def test_label_answers(spark):
    values = [
        f"{FENCE}json\n[0,1]\n{FENCE}", f"{FENCE}[1]{FENCE}", "[1, 0]", "[1,1", '{"a":1}', None,
        "sorry", "[]", '["x"]',
    ]
    assert apply(spark, values, answers.parse_labels) == [
        [0, 1], [1], [1, 0], None, None, None, None, [], None,
    ]


REVIEWS = [
    ("charger sparked and caught fire", 1),
    ("gave my son a rash", 1),
    ("stopped working, want refund", 0),
    ("phone gets warm", 0),
    ("bad smell", 0),
    ("smell gave me a headache", 1),
    ("the case melted without any fire or smoke", 0),
    ("it melted and started to smoke", 1),
    ("no smoke, no sparks, no fire", 0),
    ("no smoke but it caught FIRE", 1),
    ("too hot to touch", 1),
    ("wrong voltage", 0),
    ("wrong voltage, it blew", 1),
    ("paints well, a crash course", 0),
    ("electric-shock!", 1),
    ("", 0),
    ("The blood pressure monitor is inaccurate, want a refund.", 0),
    ("Fire pit cover too small, returned it.", 0),
    ("Spark plug does not fit my mower.", 0),
    ("The smoke colored vase arrived broken.", 0),
    ("The toy fire truck broke, cheap quality.", 0),
    ("Overheated and shut down, nothing burned", 0),
    ("Painful price for a cheap fake.", 0),
    ("The pen melted a bit, color of fire red", 0),
    ("The fire truck caught fire", 1),
    ("Spark plug sparked and burned my hand", 1),
    ("It was not only smoking, it burned the table", 1),
    ("no fire, smoke or sparks", 0),
    ("no smoke; then a fire", 1),
    ("Never had any rash or swelling", 0),
    ("Too tight and painful to wear", 0),
    ("Too tight. Left painful blisters.", 1),
    ("It didn't burn me but my son got a rash", 1),
    ("The smell is strong. I have a headache", 1),
    ("The smell is strong. Nice. I had a headache before", 0),
    ("I got burned, a scam", 0),
    ("rusty and not for food", 1),
    ("This is not food safe, it is toxic", 1),
    ("Wrong voltage, no smoke but it died", 1),
]


def test_rules(spark):
    got = apply(spark, [t for t, _ in REVIEWS], hazard_label)
    assert list(zip([t for t, _ in REVIEWS], got)) == REVIEWS


def test_python_scorer_equals_the_rules():
    score = python_scorer()()
    assert score([t for t, _ in REVIEWS]) == [label for _, label in REVIEWS]


def test_instructions_name_every_class():
    prompt = instructions()
    assert prompt.count("\n- ") == 18


@pytest.mark.parametrize("n", [1, 40])
def test_numbered_line(spark, n):
    df = spark.createDataFrame([(n, "x")], "i int, t string")
    assert df.select(text.numbered_line(F.col("i"), F.col("t"))).first()[0] == f"{n}. x"
