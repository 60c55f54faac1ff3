"""Exact copies, near copies and repeated strings against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from hazardlens.llm import anchors, components, exact, simhash, suffixes
from tests.llm.cases import ROWS, docs, empty, listed, order

# --- exact copies --------------------------------------------------------------


def exact_by_hand(rows):
    groups = defaultdict(list)
    for i, (doc_id, text, *_) in enumerate(rows):
        groups[re.sub("[ \t-\r]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, i))
    out = []
    for norm, members in groups.items():
        best = min(members)
        keep = None if best[1] else best[2]
        for m in members:
            kept = m == best
            sha = hashlib.sha256(norm.encode()).hexdigest()
            out.append((rows[m[3]][0], keep, len(members), kept, sha))
    return order(out)


@pytest.mark.parametrize("block", [4096, 7])
def test_exact_groups(spark, block):
    rows = [r for r in ROWS if block == 4096 or len(r[1] or "") < 500]
    found = exact.groups(docs(spark, rows), block).drop("n_chars")
    assert listed(found) == exact_by_hand(rows)


def test_exact_keeps_one_row_of_each_group_with_all_columns(spark):
    df = docs(spark).withColumn("name", F.lit("own")).withColumn("_text", F.lit("clash"))
    kept = exact.keep_one(df)
    assert kept.columns == df.columns
    assert kept.count() == len({re.sub("[ \t-\r]", "", r[1] or "") for r in ROWS})
    assert exact.keep_one(empty(spark)).count() == 0
    assert exact.groups(empty(spark)).count() == 0


def test_blocks_that_share_a_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(exact.F, "xxhash64", lambda *c: F.lit(1).cast("long"))
    rows = [r for r in ROWS if len(r[1] or "") < 500]
    assert listed(exact.groups(docs(spark, rows), 16).drop("n_chars")) == exact_by_hand(rows)


# --- near copies ---------------------------------------------------------------


def fingerprint_by_hand(text, words=3):
    parts = re.findall(rb"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "").encode())
    if not parts:
        return 0
    shingles = [b" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a in nodes:
        for b in nodes:
            if linked(a, b):
                root[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def test_near_groups(spark):
    rows = [r for r in ROWS if len(r[1] or "") < 25_000]
    prints = [fingerprint_by_hand(r[1]) for r in rows]
    roots = components_by_hand(set(prints), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for row, fp in zip(rows, prints, strict=True):
        ids = [i for i in (least.get(roots[fp]), row[0]) if i is not None]
        least[roots[fp]] = min(ids) if ids else None
    signed = [fp - (1 << 64 if fp >> 63 else 0) for fp in prints]
    want = order((r[0], s, least[roots[p]]) for r, s, p in zip(rows, signed, prints, strict=True))
    assert listed(simhash.groups(docs(spark, rows))) == want
    kept = simhash.keep_one(docs(spark, rows).withColumn("fp", F.lit("clash")))
    assert kept.columns[-1] == "fp"
    assert kept.count() == len(set(roots.values()))
    assert simhash.groups(empty(spark)).count() == 0


@pytest.mark.parametrize("radius, crowd", [(1, 512), (3, 512), (3, 1), (5, 2)])
def test_links_lose_no_pair(spark, radius, crowd):
    rng = np.random.default_rng(radius)
    base = rng.integers(-(1 << 63), 1 << 63, 12, np.int64)
    prints = set(base.tolist()) | {-1, 0, -(1 << 63)}
    for value in base.tolist():
        for _ in range(12):
            mask = sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 7), replace=False))
            changed = (value ^ mask) & ((1 << 64) - 1)
            prints.add(changed - (1 << 64 if changed >> 63 else 0))
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    want = {
        (a, b) for a in prints for b in prints
        if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= radius
    }
    assert {tuple(r) for r in simhash.links(df, radius, crowd=crowd).collect()} == want


def test_components_of_paths_stars_and_loops(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    pairs += [(200, 201), (201, 200), (201, 201), (300, 300)]
    found = components.components(spark.createDataFrame(pairs, "a long, b long"))
    roots = {r.node: r.root for r in found.collect()}
    want = {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)} | {201: 200}
    assert roots == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- repeated strings ----------------------------------------------------------


def repeats_by_hand(rows, length):
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for row, t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        edges = int(np.diff(np.concatenate([[0], gone.astype(int)])).clip(0).sum())
        left = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((row[0], len(t), int(gone.sum()), edges, hashlib.sha256(left).hexdigest()))
    return order(out)


def test_interval_expansion_finds_all_repeats():
    rng = np.random.default_rng(0)
    for _ in range(60):
        length = int(rng.integers(1, 14))
        text = rng.integers(97, 97 + rng.integers(1, 4), rng.integers(1, 300)).astype(np.uint8).tobytes() + b"\xfe"
        seen = Counter(text[i : i + length] for i in range(len(text)))
        want = [seen[text[i : i + length]] > 1 for i in range(len(text) - length + 1)]
        assert suffixes.repeated(np.frombuffer(text, np.uint8), length)[: len(want)].tolist() == want


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(1)
    common = rng.integers(97, 123, 260).astype(np.uint8)
    texts = [np.concatenate([rng.integers(97, 123, n).astype(np.uint8), common, rng.integers(97, 123, 90).astype(np.uint8)]) for n in (13, 401)]
    found = []
    for text, lead in zip(texts, (13, 401), strict=True):
        hashes, first, count = anchors.segments(text, 200)
        of = np.repeat(hashes, count)
        assert len(of) == len(text) - 199 and first[0] == 0
        found.append(of[lead : lead + 61].tolist())
    assert found[0] == found[1]


@pytest.mark.parametrize(("hot", "grams"), [(15_000, (32, 96, 160)), (3, (32, 96, 160)), (2, (64,)), (1, ())])
def test_strip(spark, hot, grams):
    extra = [
        (300, "ab" * 400, "en", "a", None), (301, "q" * 199, "en", "a", None), (302, "é" * 150, "en", "a", None),
        (303, "x" + "é" * 150, "en", "a", None), (304, "z" * 200, "en", "a", None), (305, "k" + "z" * 200, "en", "a", None),
    ]
    passage = " ".join(f"word{i}" for i in range(60))
    shared = [(400 + i, f"{i} begins {passage} ends {i * 7}", "en", "a", None) for i in range(25)]
    rows = [r for r in ROWS if len(r[1] or "") < 25_000] + extra + shared
    got = suffixes.strip(docs(spark, rows).withColumn("kept", F.lit(1)), hot=hot, block_bytes=20_000, grams=grams)
    found = got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert listed(found) == repeats_by_hand(rows, 200)


def test_strip_of_nothing(spark):
    assert suffixes.strip(empty(spark)).count() == 0


def test_long_texts_are_cut_into_parts(spark):
    rows = [(1, "".join(chr(97 + (i * i + i // 7) % 26) for i in range(4000)), "en", "a", 0)]
    rows += [(2, "head " + rows[0][1][500:2500] + " tail", "en", "a", 0)]
    for part in (700, 100):
        found = suffixes.strip(docs(spark, rows), part=part)
        got = found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
        assert listed(got) == repeats_by_hand(rows, 200)


def test_very_long_texts(spark):
    rng = np.random.default_rng(6)
    plain = "".join(rng.choice(list("abcdefgh "), 1_300_000))
    rows = [(1, plain, "en", "a", 0), (2, "own start " + plain[1_048_400:1_048_900] + " own end", "en", "a", 0)]
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in suffixes.strip(docs(spark, rows)).collect()}
    assert found == {1: (1_300_000, 500, 1), 2: (518, 500, 1)}
