"""Plan shapes: early limits, narrow scans, filters at the scan, parsing once."""

import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"


def plan(spark, name):
    df = entry.queries()[name](spark, SF_DIR)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["dedup_reviews", "dedup_text", "merge_reviews", "first_seen_ids", "limit_per_category"]
)
def test_first_rows_are_limited_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text, text


@pytest.mark.parametrize(
    "name, columns",
    [("first_seen_ids", "l_orderkey:bigint,l_partkey:bigint,"
     "l_suppkey:bigint,l_linenumber:int,l_returnflag:string")],
)
def test_only_needed_columns_are_read(spark, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan(spark, name)


@pytest.mark.parametrize("name, scans, shuffles", [("assign_batches", 2, 4), ("sort_numeric_id", 2, 8)])
def test_numbering_reads_rows_once_and_sums_once(spark, name, scans, shuffles):
    text = plan(spark, name)
    assert text.count("FileScan") <= scans and text.count("Exchange ") <= shuffles, text


def test_filters_reach_the_scan(spark):
    assert "In(lang, [de,fr])" in plan(spark, "select_categories").replace("fr,de", "de,fr")


@pytest.mark.parametrize("name", ["extract_ids", "parse_reviews", "status_search"])
def test_envelopes_are_parsed_once(spark, name):
    assert plan(spark, name).count("parseJson") == 1


@pytest.mark.parametrize("name", ["score_rules", "score_rules_default", "benign_rules"])
def test_rules_do_not_split_texts_into_words(spark, name):
    assert "arrays_overlap" not in plan(spark, name)
