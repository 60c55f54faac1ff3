"""Passages that repeat across documents, against a table of all windows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazardlens.llm import fmindex, passages
from tests.llm.cases import ROWS, docs, empty, order


def strip_by_hand(rows, length):
    """Rows of id, words, removed words and what is kept; a null id counts as the largest."""
    texts = [(r[0], (r[1] or "").encode().split()) for r in rows]
    rank = lambda key: 1 << 62 if key is None else key
    first = {}
    for key, words in texts:
        for i in range(len(words) - length + 1):
            own = tuple(words[i : i + length])
            first[own] = min(first.get(own, 1 << 62), rank(key))
    out = []
    for key, words in texts:
        gone = set()
        for i in range(len(words) - length + 1):
            if first[tuple(words[i : i + length])] < rank(key):
                gone.update(range(i, i + length))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((key, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def digests(found):
    kept = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return order(tuple(r) for r in found.select("doc_id", "n_words", "n_removed", kept).collect())


def test_report_against_all_windows(spark):
    rows = [r for r in ROWS if len(r[1] or "") < 25_000]
    table = docs(spark, rows).withColumn("kept", F.lit("x")).withColumn("d", F.lit(1)).withColumn("o", F.lit(2))
    got = order(tuple(r) for r in passages.report(table).collect())
    assert got == order(strip_by_hand(rows, 50))
    assert any(r[2] for r in got)
    assert passages.strip(table).columns[:-3] == [c for c in table.columns if c not in ("kept", "d", "o")]


def shared(seed, count):
    """Texts that share passages, an often used phrase among them, in changing surroundings."""
    rng = random.Random(seed)
    pool = [[f"p{i}x{j}" for j in range(rng.randrange(5, 60))] for i in range(8)]
    phrase, rows = [f"f{j}" for j in range(14)], []
    for i in range(count):
        words = []
        for _ in range(rng.randrange(1, 6)):
            kind = rng.random()
            if kind < 0.4:
                words += rng.choice(pool)
            elif kind < 0.7:
                words += [f"own{i}x{rng.randrange(99)}" for _ in range(rng.randrange(12))] + phrase
            else:
                words += [f"w{rng.randrange(3)}" for _ in range(rng.randrange(30))]
        rows.append((rng.randrange(count), rng.choice([" ", "\n", "\t "]).join(words), "en", "a", 0))
    return rows


@pytest.mark.parametrize(("length", "crowd", "grams", "shard"), [
    (20, 5_000, (8,), 200_000), (20, 5_000, (4, 8), 300), (20, 5, (3, 8), 300), (12, 2, (12,), 300), (9, 1, (), 300),
])
def test_crowds_and_shards_against_all_windows(spark, length, crowd, grams, shard):
    rows = shared(length + crowd, 150) + [(None, "a " * 30, "en", "a", 0)] * 2
    found = passages.strip(docs(spark, rows), length, shard, crowd, grams)
    assert digests(found) == order(strip_by_hand(rows, length))


def test_long_texts(spark):
    rng = random.Random(2)
    words = [f"v{rng.randrange(3000)}" for _ in range(90_000)]
    rows = [(5, " ".join(words), "en", "a", 0), (6, " ".join(words[70_000:] + words[:200]), "en", "a", 0)]
    rows += [(7, "same " * 60_000, "en", "a", 0), (8, "same " * 70, "en", "a", 0)]
    assert digests(passages.strip(docs(spark, rows))) == order(strip_by_hand(rows, 50))


def test_windows_looked_for_in_parts():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 60, 400, np.uint64)
    inside = np.append(np.ones(351, bool), np.zeros(50, bool))
    anchor, first, count = passages._anchored(words, inside, 50, 8)
    assert first[0] == 0 and (first[1:] == (first + count)[:-1]).all() and count.sum() == 351
    part, at, _ = passages._anchored(words[100:], inside[100:], 50, 8)
    assert part[-1] == anchor[-1] and at[-1] + 100 == first[-1]


def test_no_documents(spark):
    found = passages.report(empty(spark))
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"] and found.collect() == []


def test_counts_of_the_wavelet_tree():
    rng = np.random.default_rng(3)
    for few, size in ((1, 1), (2, 64), (37, 1000), (3, 4097)):
        symbols = rng.integers(0, few, size)
        tree = fmindex.WaveletTree(symbols, few - 1)
        own, at = rng.integers(0, few, 200), rng.integers(0, size + 1, 200)
        assert tree.rank(own, at).tolist() == [int((symbols[:y] == x).sum()) for x, y in zip(own, at)]


def test_a_shard_against_all_windows():
    rng = random.Random(1)
    for length in (1, 2, 5, 8, 50):
        for _ in range(30):
            parts = [[str(rng.randrange(rng.choice([1, 3]))) for _ in range(rng.randrange(1, 80))] for _ in range(9)]
            ranks, first = [rng.randrange(5) for _ in parts], {}
            for p, o in zip(parts, ranks):
                for i in range(len(p) - length + 1):
                    first[tuple(p[i : i + length])] = min(first.get(tuple(p[i : i + length]), 9), o)
            found = passages.earlier([" ".join(p) for p in parts], ranks, length)
            for p, o, spans in zip(parts, ranks, found):
                want = [i for i in range(len(p) - length + 1) if first[tuple(p[i : i + length])] < o]
                assert [i for s, n in spans for i in range(s, s + n)] == want
