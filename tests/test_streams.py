"""Streams with state: replay, restart, several streams of one table, pages in any order."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hazardlens.functions.text import review_key
from hazardlens.operators import dedup
from hazardlens.operators.paging import review_pages_read
from hazardlens.plans.collect import usable_review_pages
from hazardlens.streaming import ingest
from hazardlens.streaming.ingest import last_batches, merge_batch, stream_id, stream_merge
from hazardlens.streaming.paging import stream_review_pages

SCHEMA = "category string, product_id string, subcategory string, review_text string, arrival bigint, review_key string"


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def reviews(spark, data):
    df = spark.createDataFrame(data, "category string, product_id string, subcategory string, review_text string, arrival bigint")
    return df.withColumn("review_key", review_key(*map(F.col, ("category", "product_id", "review_text"))))


def data(start, end):
    return [("c", str(i % 7), f"s{i}", f"t{i % 11}", i) for i in range(start, end)]


def land(spark, source, start, end):
    reviews(spark, data(start, end)).coalesce(1).write.mode("append").parquet(source)


def forget_last_commit(checkpoint):
    """What a driver leaves that is lost after it has written a batch and before it says so."""
    commits = sorted((p for p in Path(checkpoint, "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    for path in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        path.unlink(missing_ok=True)


def test_a_batch_that_is_run_again_brings_the_same_rows(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for start in (0, 20, 50):
        land(spark, source, start, start + 40)
        got = stream_merge(spark, source, SCHEMA, target, checkpoint, buckets=8)
        before = rows(got, "arrival", "subcategory", "batch")
        forget_last_commit(checkpoint)
        again = stream_merge(spark, source, SCHEMA, target, checkpoint, buckets=8)
        assert rows(again, "arrival", "subcategory", "batch") == before
    assert rows(again, "arrival") == rows(dedup.dedup_reviews(reviews(spark, data(0, 90))), "arrival")


def test_the_first_in_order_stays_and_the_table_is_never_read(spark, tmp_path, monkeypatch):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    shuffled = data(0, 80) * 2
    random.Random(1).shuffle(shuffled)
    reviews(spark, shuffled).repartition(5).write.parquet(source)
    monkeypatch.setattr(ingest, "new_reviews", None)  # only other streams' rows are compared
    got = stream_merge(spark, source, SCHEMA, target, checkpoint, buckets=8)
    land(spark, source, 60, 100)
    got = stream_merge(spark, source, SCHEMA, target, checkpoint, buckets=8)
    assert rows(got, "arrival") == rows(dedup.dedup_reviews(reviews(spark, data(0, 100))), "arrival")


def test_streams_in_turn_share_a_table(spark, tmp_path):
    """a, then b, which begins with a's keys, then a again, which knows nothing of b's."""
    target = str(tmp_path / "out")
    portions = [("a", 0, 20), ("b", 10, 40), ("a", 30, 60), ("b", 50, 75), ("a", 60, 80)]
    for name, start, end in portions:
        source, checkpoint = str(tmp_path / f"in_{name}"), str(tmp_path / f"cp_{name}")
        reviews(spark, [("c", str(i), "s", "t", i) for i in range(start, end)]).coalesce(1).write.mode("append").parquet(source)
        got = stream_merge(spark, source, SCHEMA, target, checkpoint, buckets=8)
    assert rows(got, "product_id") == sorted((str(i),) for i in range(80))
    last = last_batches(spark, target)
    assert {stream_id(spark, str(tmp_path / f"cp_{n}")) for n in "ab"} == set(last) and max(last.values()) >= 1


def test_a_lost_first_batch_begins_with_the_same_keys(spark, tmp_path):
    target = str(tmp_path / "out")
    merge_batch(reviews(spark, data(0, 10)), "earlier", 0, target)
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    land(spark, source, 5, 30)
    before = rows(stream_merge(spark, source, SCHEMA, target, checkpoint, buckets=8), "arrival")
    forget_last_commit(checkpoint)
    assert rows(stream_merge(spark, source, SCHEMA, target, checkpoint, buckets=8), "arrival") == before
    assert before == rows(dedup.dedup_reviews(reviews(spark, data(0, 30))), "arrival")


def test_null_keys_and_other_column_types(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "k bigint, big bigint, at struct<a:int,b:string>, tags array<string>"
    lines = [(None, (1 << 62) + 1, (2, None), ["x", None]), (None, 5, (1, "z"), []), (7, None, (1, None), None), (7, 1, (None, "a"), [])]
    spark.createDataFrame(lines, schema).coalesce(1).write.parquet(source)
    got = stream_merge(spark, source, schema, target, str(tmp_path / "cp"), key="k", order="at", buckets=4)
    found = {r.k: (r.big, tuple(r["at"]), r.tags) for r in got.collect()}
    assert found == {None: (5, (1, "z"), []), 7: (None, (1, None), None)}


# --- pages ------------------------------------------------------------------------------


def body(ret, texts=(), total=3):
    reply = {"ret": [ret], "data": {"reviewList": [{"content": t} for t in texts], "totalPage": total}}
    return f"mtopjsonp1({json.dumps(reply)})"


def landed(seed):
    """Attempts of pages of some products: retries, errors, gaps, blank pages, last pages."""
    rng, out = random.Random(seed), []
    for product in range(25):
        total = rng.randrange(1, 6)
        for page in range(1, rng.randrange(2, 8)):
            if rng.random() < 0.08:
                continue
            attempt = 1
            while rng.random() < 0.3:
                retry = body("TOKEN_EXOIRED") if rng.random() < 0.5 else "<html>"
                out.append((str(product), "1", page, attempt, None, retry))
                attempt += 1
            kind = rng.random()
            texts = [] if kind < 0.1 else [f"p{product} {page} ü   '\"", "more"]
            out.append((str(product), "1", page, attempt, None, body("FAIL" if kind > 0.93 else "SUCCESS", texts, total)))
            if rng.random() < 0.1:
                out.append((str(product), "1", page, attempt + 1, None, body("SUCCESS", ["too late"], total)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_pages_in_any_order_are_read_as_by_the_batch_rule(spark, tmp_path, seed):
    schema = "product_id string, star string, page int, attempt int, ingest_ts timestamp, body string"
    every = landed(seed)
    want = review_pages_read(usable_review_pages(spark.createDataFrame(every, schema)))
    columns = ["product_id", "star", "page", "attempt", "texts", "n_valid"]
    random.Random(seed).shuffle(every)
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for part in range(3):
        own = every[part::3] + every[:4]  # some land twice
        spark.createDataFrame(own, schema).coalesce(2).write.mode("append").json(source)
        got = stream_review_pages(spark, source, target, checkpoint, max_files=1, buckets=8)
        if part == 1:
            partly = rows(got, *columns)
    assert rows(got, *columns) == rows(want, *columns)
    assert set(map(repr, partly)) < set(map(repr, rows(want, *columns)))
