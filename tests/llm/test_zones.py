"""Clusters over zone maps against a plain loop."""

import hashlib
import math
import random

import numpy as np

from hazardlens.llm import zones
from tests.llm.cases import listed

SCHEMA = "vec_id long, embedding array<float>, cluster string"


def clusters_by_hand(rows, dims, clusters=16, rounds=3):
    """Distances and clusters of ``rows`` (id, vector) one by one, in Python's integers."""
    kept = []
    for key, vector in rows:
        if vector is not None and len(vector) == dims and all(x is not None and math.isfinite(x) for x in vector):
            own = [math.floor(64 * float(np.float32(x))) for x in vector]
            kept.append((key, [max(-(1 << 60), min(1 << 60, x)) for x in own]))
    name = lambda k: hashlib.sha256(f"1:{'' if k is None else k}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:clusters]]

    def judge(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(judge(v)[1], []).append(v)
        for j, own in groups.items():
            centroids[j] = [sum(x) // len(own) for x in zip(*own)]
    found = [(k, judge(v)[1], min(judge(v)[0], (1 << 63) - 1)) for k, v in kept]
    return found, centroids


def vectors(seed, count, dims, groups=12):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(groups)]
    return [(i, [m + rng.gauss(0, 0.1) for m in rng.choice(middles)]) for i in range(count)]


def same(spark, rows, dims):
    table = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
    found, centroids = zones.cluster(table, dims=dims)
    want, by_hand = clusters_by_hand(rows, dims)
    assert centroids == by_hand
    assert listed(found) == sorted(want, key=lambda r: [(v is not None, str(type(v)), v) for v in r])


def test_against_a_plain_loop(spark):
    same(spark, vectors(1, 700, 64), 64)


def test_copies_ties_and_vectors_that_do_not_count(spark):
    rows = vectors(2, 60, 8) + [(100 + i, [0.5] * 8) for i in range(400)] + [(7, [0.25] * 8)] * 3
    rows += [(None, [1.0] * 8), (None, [1.0] * 8), (900, None), (901, []), (902, [1.0] * 7)]
    rows += [(903, [1.0] * 7 + [None]), (904, [1.0] * 7 + [float("nan")]), (905, [float("-inf")] + [1.0] * 7)]
    same(spark, rows, 8)


def test_components_of_any_size(spark):
    rows = vectors(3, 40, 4) + [(500, [3e38] * 4), (501, [-3e38, 0.0, 0.0, 1.0]), (502, [5e7, 1.0, 2.0, 3.0])]
    same(spark, rows + [(510 + i, [1e9 + i * 1e3, 0.0, 1.0, 0.0]) for i in range(5)], 4)


def test_few_vectors_and_none(spark):
    same(spark, vectors(4, 5, 64), 64)
    found, centroids = zones.cluster(spark.createDataFrame([(1, None, "x")], SCHEMA))
    assert found.collect() == [] and found.columns == ["vec_id", "cluster", "distance"] and centroids == []
    nothing = zones.report(spark.createDataFrame([], SCHEMA))
    assert nothing.collect() == [] and len(nothing.columns) == 6


def test_curve_visits_every_cell_by_single_steps():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        side = 1 << bits
        cells = np.stack(np.meshgrid(*[np.arange(side)] * dims), -1).reshape(-1, dims)
        order = sorted(range(len(cells)), key=lambda i: zones.hilbert(cells, bits)[i].tobytes())
        steps = np.abs(np.diff(cells[order], axis=0)).sum(1)
        assert (steps == 1).all()


def test_boxes_leave_out_far_centroids_only():
    rng = np.random.default_rng(5)
    middles = rng.integers(-500, 500, (16, 8))
    points = np.concatenate([m + rng.integers(-9, 9, (32, 8)) for m in middles])
    low, high = (np.stack([f(points[i : i + 32], axis=0) for i in range(0, 512, 32)]) for f in (np.min, np.max))
    possible = zones.bounds(low, high, middles)
    assert possible.sum() < 40
    away = ((points[:, None] - middles[None]) ** 2).sum(2)
    assert possible[np.arange(512) // 32, away.argmin(1)].all()
    cluster, best = zones.nearest(points, np.full(16, 32), (low, high), middles)
    assert (cluster == away.argmin(1)).all() and (best == away.min(1)).all()
