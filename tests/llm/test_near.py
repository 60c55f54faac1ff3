"""The near-duplicate stage against brute-force Jaccard similarity."""

import random
import re

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F
from hazardlens.llm import components, shingles, simhash
from tests.llm.cases import ROWS, docs, empty, listed, prose
from tests.llm.test_dedup import components_by_hand


def shingles_by_hand(text):
    parts = (text or "").encode().lower().split()
    return frozenset(tuple(parts[i : i + 5]) for i in range(max(1, len(parts) - 4)) if parts)


def similar(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def changed(text, seed, count):
    rng, parts = random.Random(seed), text.split()
    for k in range(count):
        parts[rng.randrange(len(parts))] = f"new{seed}x{k}"
    return " ".join(parts)


def near_rows():
    rng = random.Random(5)
    bases = [" ".join(f"w{rng.randrange(500)}" for _ in range(150)) for _ in range(12)]
    texts = [(i, changed(t, 10 * i + k, k)) for i, t in enumerate(bases) for k in range(9)]
    rows = [(1000 + n, t, "en", "a", 0) for n, (_, t) in enumerate(texts)]
    hot = [(2000 + i, changed(bases[0], 500 + i, 2), "en", "a", 0) for i in range(60)]
    return [*ROWS, *rows, *hot, *[(3000 + i, prose(i, 80), "en", "a", 0) for i in range(60)]]


def test_near_copies_against_brute_force(spark):
    rows = near_rows()
    sets = {shingles_by_hand(r[1]) for r in rows}
    roots = components_by_hand(sets, similar)
    least = {}
    for r in rows:
        root = roots[shingles_by_hand(r[1])]
        least[root] = min(least.get(root, 1 << 60), 1 << 60 if r[0] is None else r[0])
    kept = corpus_pipeline.near_copies(spark, docs(spark, rows), "").collect()
    assert sorted(1 << 60 if r.doc_id is None else r.doc_id for r in kept) == sorted(least.values())
    by_prints = simhash.keep_one(docs(spark, rows)).count()
    assert len(kept) < by_prints  # fingerprints within 3 bits leave near copies


def test_fingerprints_find_near_copies_first(spark, monkeypatch):
    base = [f"w{i}" for i in range(900)]
    texts = [" ".join([*base, f"n{i}"]) for i in range(12)] + [" ".join(random.Random(i).sample(base, 300)) for i in range(9)]
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    prints = {simhash.text_fingerprint(t, 5) for t in texts}
    roots = components_by_hand(prints, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
    own = shingles._prefixes(shingles._keyed(docs(spark, rows)), 5, 0.8)
    found = [tuple(r) for r in shingles._near_prints(own).select("a", "b").collect()]
    by_node = {r.node: r.fp for r in own.select("node", "fp").collect()}
    assert len(found) == len(by_node) - len(set(roots.values())) >= 8
    assert all(roots[by_node[a]] == roots[by_node[b]] for a, b in found)
    monkeypatch.setattr(shingles, "_pairs", lambda now, least: now.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0))
    kept = corpus_pipeline.near_copies(spark, docs(spark, rows), "").collect()
    assert len(kept) < 21 and {r.doc_id for r in kept} >= {0, *range(12, 21)}


def test_near_copies_of_odd_tables(spark):
    assert listed(corpus_pipeline.near_copies(spark, empty(spark), "")) == []
    table = docs(spark, ROWS[:9])
    kept = corpus_pipeline.near_copies(spark, table, "")
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 7, 8]
    assert {re.sub(r"\s", "", r.text or "") for r in kept.collect()} == {"HelloWorld,thisisonetext", "", "x"}


def test_texts_of_one_template_are_not_compared_all_with_all(spark):
    rng = random.Random(8)
    template = [f"t{i}" for i in range(200)]
    rows = []
    for n in range(400):
        own = [f"o{n}x{i}" for i in range(rng.randrange(30, 80))]
        rows.append((n, " ".join(own[:15] + template + own[15:]), "en", "a", 0))
    own = shingles._prefixes(shingles._keyed(docs(spark, rows)), 5, 0.8)
    met = shingles._meetings(own).withColumn("root", F.col("node"))
    assert shingles._pairs(met, 0.8).count() < 2_000
    assert corpus_pipeline.near_copies(spark, docs(spark, rows), "").count() == 400


def test_repeated_rows_and_other_columns(spark):
    rows = [(1, "a b c d e f g", "en", "a", 0)] * 3 + [(2, "a b c d e f g", "de", "b", 1), (None, "q r s", "en", "a", 0)] * 2
    table = docs(spark, rows).withColumn("key", F.lit(1)).withColumn("row", F.lit("x")).withColumn("node", F.lit(2))
    kept = corpus_pipeline.near_copies(spark, table, "")
    assert kept.columns == table.columns
    assert sorted((r.doc_id or 0, r.text, r.row) for r in kept.collect()) == [(0, "q r s", "x"), (1, "a b c d e f g", "x")]


def test_long_texts_and_small_sketch(spark, monkeypatch):
    monkeypatch.setattr(shingles, "_TEXTS", 5)
    words = [f"v{i * 7919 % 60_013}" for i in range(60_000)]
    texts = [" ".join(words), " ".join([*words[:59_000], *(f"n{i}" for i in range(1000))]), " ".join(words[:40_000])]
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)] + [(10 + i, f"own {i} " * 9, "en", "a", 0) for i in range(20)]
    kept = corpus_pipeline.near_copies(spark, docs(spark, rows), "")
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, *range(10, 30)]


def test_bitmaps_differ_by_no_more_than_the_sets():
    rng = np.random.default_rng(2)
    for size, other, both in ((600, 700, 500), (2000, 1500, 1500), (5000, 9000, 10), (80_000, 70_000, 65_000)):
        pool = np.unique(rng.integers(-(1 << 62), 1 << 62, size + other - both))
        a, b = pool[:size], pool[size - both :]
        apart = len(np.setxor1d(a, b))
        assert shingles._unlike(shingles._wide(a), shingles._wide(b)) <= apart
        x, y = shingles._odd(a, 512), shingles._odd(b, 512)
        assert int(np.bitwise_count(x ^ y).sum()) <= apart
    assert shingles._unlike(shingles._wide(pool[:3000]), shingles._wide(pool[3000:6000])) > 1500


def test_a_round_of_components_reads_its_links_a_few_times(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(0, 40, 2)] + [(i + 1, i) for i in range(1, 20)], "a long, b long")
    plan = components._inward(components._outward(chain))._jdf.queryExecution().optimizedPlan()
    assert plan.collectLeaves().size() <= 4  # each scan is a stage whose plan the driver keeps
    roots = {r.node: r.root for r in components.components(chain).collect()}
    assert roots == {i: 0 if i <= 21 else i - 1 for i in range(1, 40) if i <= 21 or i % 2}


def test_sketch_reaches_the_driver_in_parts(spark, monkeypatch):
    table = docs(spark, near_rows())
    order = spark.sparkContext.broadcast((np.zeros(0, np.int64), np.zeros(0, np.int64)))
    # Its rows at once would be held beside the result, in the JVM as well.
    monkeypatch.delattr(type(table), "toArrow")
    many = shingles._sketch(table, 5, 0.8, order, 1)
    assert many.nbytes == 1 << 25
    held = [shingles._slots(shingles._prefix(shingles.text_shingles(r[1]), *order.value, 0.8)) for r in near_rows()]
    slots, counts = np.unique(np.concatenate(held), return_counts=True)
    assert np.array_equal(np.flatnonzero(np.unpackbits(many)), slots[counts > 1])


def planned(monkeypatch):
    """What the plans of written tables hold in all, by label, from now on."""
    lines = {}
    for module in (components, shingles, simhash):

        def write(table, label, f=module.materialize):
            plan = table._jdf.queryExecution().optimizedPlan().toString()
            lines[label] = lines.get(label, []) + [len(plan.strip().split("\n"))]
            return f(table, label)

        monkeypatch.setattr(module, "materialize", write)
    return lines


def test_components_that_are_stars_take_no_round(spark, monkeypatch):
    lines = planned(monkeypatch)
    star, path = [(1, 2), (3, 1), (1, 1), (4, 9), (9, 4)], [(1, 2), (2, 3)]
    for pairs, want, rounds in (star, {2: 1, 3: 1, 9: 4}, 0), (path, {2: 1, 3: 1}, 1), ([(1, 3), (2, 3)], {2: 1, 3: 1}, 1), ([], {}, 0):
        lines.clear()
        found = components.components(spark.createDataFrame(pairs, "a long, b long")).collect()
        assert {r.node: r.root for r in found} == want
        assert len(lines["links"]) == 1 + rounds  # one more before, to see that it changes nothing


def test_the_driver_plans_little_for_near_copies(spark, monkeypatch):
    lines = planned(monkeypatch)
    corpus_pipeline.near_copies(spark, docs(spark, near_rows()), "")
    assert max(map(max, lines.values())) <= 60
    assert sum(map(sum, lines.values())) <= 560
