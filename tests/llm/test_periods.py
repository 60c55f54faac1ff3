"""Runs of repeated words against a search of all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazardlens.llm import periods
from tests.llm.cases import ROWS, docs, empty, order


def runs_by_hand(words, least=6, times=4):
    found, n = set(), len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, times * q):
                own = words[i : i + size]
                if not any(own[p:] == own[:-p] for p in range(1, q)):
                    found.add((i, size, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def report_by_hand(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    found = runs_by_hand(words)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    exponent = best[1] * 1000 // best[2] if found else None
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *best, exponent, *[hashlib.sha256(b).hexdigest() for b in (lines.encode(), kept)])


def loops(count):
    rng, rows = random.Random(3), []
    for i in range(count):
        few, size = rng.choice([1, 2, 3, 40]), rng.randrange(90)
        words = [f"w{rng.randrange(few)}" for _ in range(size)]
        if words and rng.random() < 0.6:
            at, p = rng.randrange(size), rng.randrange(1, 1 + size // 3 + 1)
            words = words[:at] + (words[at : at + p] * size)[: size - at]
        rows.append((5000 + i, rng.choice([" ", "\n", " \t"]).join(words), "en", "a", 0))
    return rows


def test_report_against_all_periods(spark):
    rows = [r for r in ROWS if len(r[1] or "") < 25_000] + loops(300)
    table = docs(spark, rows).withColumn("runs", F.lit("x")).withColumn("collapsed", F.lit(1))
    got = [tuple(r) for r in periods.report(table).collect()]
    assert order(got) == order(report_by_hand(r[0], r[1]) for r in rows)
    assert any(r[1] for r in got) and any(r[1] > 1 for r in got)


@pytest.mark.parametrize("chunk", [1, 700])
def test_texts_do_not_touch_in_a_chunk(spark, chunk):
    rows = [(i, "a b a b", "en", "a", 0) for i in range(40)] + [(50, "a b " * 9, "en", "a", 0)]
    found = periods.runs(docs(spark, rows).coalesce(1), chunk=chunk).collect()
    assert {r.doc_id: [tuple(x) for x in r.runs] for r in found if r.runs} == {50: [(0, 18, 2)]}
    assert {r.collapsed for r in found} == {"a b a b", "a b"}


def test_long_texts(spark):
    rng = random.Random(9)
    plain = [f"v{rng.randrange(4000)}" for _ in range(60_000)]
    texts = ["x " * 40_000, " ".join(plain[:40_000] + plain[1000:1700] * 30), " ".join(plain)]
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    found = {r.doc_id: [tuple(x) for x in r.runs] for r in periods.runs(docs(spark, rows)).collect()}
    assert found[0] == [(0, 40_000, 1)] and found[2] == []
    assert (40_000, 21_000, 700) in found[1] or [r for r in found[1] if r[2] == 700 and r[1] >= 21_000]


def test_other_thresholds_and_nothing(spark):
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(["a b a b c", "a a", "a b c a b c a"])]
    found = periods.runs(docs(spark, rows), least=2, times=2).orderBy("doc_id").collect()
    assert [[tuple(x) for x in r.runs] for r in found] == [[(0, 4, 2)], [(0, 2, 1)], [(0, 7, 3)]]
    assert periods.report(empty(spark)).collect() == []
    assert len(periods.report(empty(spark)).columns) == 8


def test_extensions_against_comparing():
    rng = np.random.default_rng(1)
    for size, few in ((1, 1), (2, 1), (30, 1), (200, 2), (400, 3)):
        words = np.append(rng.integers(0, few, size), 99)
        own = periods.Extensions(words)
        a, b = rng.integers(0, size, 300), rng.integers(0, size + 1, 300)
        a, b = a[a != b], b[a != b]
        want = [next(k for k in range(size + 2) if max(x, y) + k > size or words[x + k] != words[y + k]) for x, y in zip(a, b)]
        assert own.of(a, b).tolist() == want
