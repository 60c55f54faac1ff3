"""Clustering around centroids over zone maps: blocks of vectors in the order of a Hilbert curve.

Vectors of integers are put into the order of a space-filling curve and cut into small blocks,
each with the box of its smallest and largest components. The nearest and the farthest a box
can be from a centroid bound the distances of all its vectors, so a block is compared only with
the centroids whose nearest bound does not exceed the least farthest one; these comparisons are
exact, and done for all vectors of many blocks at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StructField, StructType

from hazardlens.session import materialize

DIMS, SCALE, CLUSTERS, ROUNDS = 64, 64, 16, 3
#: Vectors of a block, and bits of each component in its place on the curve.
BLOCK, BITS = 32, 2
#: Components are held to this size, distances and their sums to the largest long.
MOST, _LONG = 1 << 60, (1 << 63) - 1
#: Up to this size squared distances of vectors fit 64 bits; beyond, Python's integers are used.
_NARROW = 1 << 27


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the curve of each row of ``cells`` (integers of ``bits`` bits), as bytes that
    sort like it: Skilling's transform of the axes, then the bits of all axes level by level."""
    x = cells.astype(np.int64).T.copy()
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for axis in x:
            flips = (axis & bit) != 0
            swap = np.where(flips, 0, (x[0] ^ axis) & low)
            axis ^= swap
            x[0] ^= np.where(flips, low, swap)
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    last = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        last ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    x ^= last
    flat = [(axis >> level) & 1 for level in range(bits - 1, -1, -1) for axis in x]
    return np.packbits(np.array(flat, np.uint8).T, axis=1)


def bounds(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Which centroids (columns) can be nearest to a vector of each box (rows)."""
    out = np.empty((len(low), len(centroids)), bool)
    near = np.empty((len(low), len(centroids)), low.dtype)
    far = near.copy()
    for j, c in enumerate(centroids):
        gap = np.maximum(np.maximum(low - c, c - high), 0)
        reach = np.maximum(high - c, c - low)
        near[:, j], far[:, j] = (gap * gap).sum(1), (reach * reach).sum(1)
    out[:] = near <= far.min(1)[:, None]
    return out


def nearest(vectors: np.ndarray, sizes: np.ndarray, boxes: tuple, centroids: np.ndarray) -> tuple:
    """Cluster and squared distance of each vector; ``sizes`` and ``boxes`` are those of the
    blocks the vectors come in. Of equally near centroids the first counts."""
    possible = np.repeat(bounds(*boxes, centroids), sizes, axis=0)
    cluster = np.full(len(vectors), -1, np.int32)
    best = np.zeros(len(vectors), vectors.dtype)
    for j, c in enumerate(centroids):
        rows = np.flatnonzero(possible[:, j])
        off = vectors[rows] - c
        away = (off * off).sum(1)
        nearer = (cluster[rows] < 0) | (away < best[rows])
        cluster[rows[nearer]] = j
        best[rows[nearer]] = away[nearer]
    return cluster, best


def _integers(name: str, scale: int) -> Column:
    value = F.transform(F.col(name), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return F.transform(value, lambda x: F.greatest(F.least(x, F.lit(MOST)), F.lit(-MOST)))


def kept(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``key`` and ``v``, the integer components, of the vectors that have ``dims`` components,
    none of them null, infinite or NaN."""
    finite = F.forall(F.col(column), lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    whole = vectors.select(key, column).where((F.size(column) == dims) & finite)
    return whole.select(F.col(key).alias("key"), _integers(column, scale).alias("v"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def blocks(vectors: DataFrame, dims: int, block: int = BLOCK, bits: int = BITS) -> DataFrame:
    """The vectors in blocks along the curve: ``keys``, ``wide``, ``vectors``, ``low``, ``high``.

    Cells of the curve are cut at the quartiles that a normal distribution of each component's
    mean and deviation would have; where they are cut changes only which vectors share a block.
    Vectors that are equal are told apart by a hash of the key, so copies fill as many ranges
    as they need.
    """
    stats = [f(F.get("v", F.lit(i))) for i in range(dims) for f in (F.avg, F.stddev_pop)]
    found = vectors.agg(*[s.cast("double").alias(f"s{i}") for i, s in enumerate(stats)]).first()
    middle, spread = np.array(found[::2], float), np.array(found[1::2], float)
    cuts = [middle + z * spread for z in (np.arange(1, 1 << bits) / (1 << bits) * 2 - 1) * 1.35]

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column("v"), dims)
            cells = sum((rows > cut).astype(np.int64) for cut in cuts)
            made = pa.array([r.tobytes() for r in hilbert(cells, bits)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=["key", "v", "place"])

    placed = StructType([*vectors.schema.fields, StructField("place", BinaryType())])
    # Written, because dealing out by ranges reads its input twice.
    lined = materialize(vectors.mapInArrow(places, placed), "places")
    salt = F.xxhash64("key")
    lined = lined.repartitionByRange("place", salt).sortWithinPartitions("place", salt)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = _matrix(batch.column("v"), dims), []
            for at in range(0, len(rows), block):
                part = rows[at : at + block]
                low, high = part.min(0), part.max(0)
                wide = bool(max(high.max(), -low.min()) > _NARROW)
                kind = np.int64 if wide else np.int32
                out.append((wide, *[a.astype(kind).tobytes() for a in (part, low, high)]))
            starts = pa.array([*range(0, len(rows), block), len(rows)], pa.int32())
            keys = pa.ListArray.from_arrays(starts, batch.column("key"))
            made = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.bool_(), *[pa.binary()] * 3], strict=True)]
            if out:
                yield pa.RecordBatch.from_arrays([keys, *made], names=["keys", "wide", "vectors", "low", "high"])

    schema = StructType([
        StructField("keys", ArrayType(vectors.schema["key"].dataType)), StructField("wide", BooleanType()),
        *[StructField(n, BinaryType()) for n in ("vectors", "low", "high")],
    ])
    return materialize(lined.select("key", "v").mapInArrow(cut, schema), "blocks")


def _judged(batch: pa.RecordBatch, centroids: list[list[int]], dims: int) -> Iterator[tuple]:
    """Rows of the batch, their vectors, clusters and distances, narrow blocks and wide ones apart."""
    wide = np.array(batch.column("wide").to_pylist(), bool)
    far = any(abs(x) > _NARROW for c in centroids for x in c)
    for kind, rows in ((np.int32, np.flatnonzero(~wide)), (np.int64, np.flatnonzero(wide))):
        if not len(rows):
            continue
        own = batch.take(pa.array(rows))
        read = lambda n: np.frombuffer(b"".join(own.column(n).to_pylist()), kind).reshape(-1, dims)  # noqa: B023, E731
        exact = object if far or kind is np.int64 else np.int64
        vectors, low, high = (read(n).astype(exact) for n in ("vectors", "low", "high"))
        sizes = np.array([len(b) // (dims * np.dtype(kind).itemsize) for b in own.column("vectors").to_pylist()])
        yield rows, vectors, *nearest(vectors, sizes, (low, high), np.array(centroids, exact))


def _moved(found: DataFrame, centroids: list[list[int]], dims: int) -> list[list[int]]:
    """The floor of the mean of each cluster's vectors; clusters without any stay.

    Each task sums up its own vectors, so a few rows a task are shuffled; as many rows as there
    are centroids come back.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = [[0] * dims for _ in centroids], [0] * len(centroids)
        for batch in batches:
            for _, vectors, cluster, _ in _judged(batch, centroids, dims):
                for j in np.unique(cluster):
                    own = vectors[cluster == j]
                    count[j] += len(own)
                    total[j] = [a + int(b) for a, b in zip(total[j], own.sum(0), strict=True)]
        rows = [j for j, n in enumerate(count) if n]
        if rows:
            totals = [[Decimal(x) for x in total[j]] for j in rows]
            made = [pa.array(rows, pa.int32()), pa.array([count[j] for j in rows], pa.int64())]
            made.append(pa.array(totals, pa.list_(pa.decimal128(38, 0))))
            yield pa.RecordBatch.from_arrays(made, names=["cluster", "n", "total"])

    parts = found.select("wide", "vectors", "low", "high").mapInArrow(sums, "cluster int, n long, total array<decimal(38,0)>")
    own = [F.sum(F.get("total", F.lit(i))).alias(f"t{i}") for i in range(dims)]
    moved = list(centroids)
    for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *own).collect():
        moved[row.cluster] = [int(row[f"t{i}"]) // row.n for i in range(dims)]
    return moved


def _assigned(found: DataFrame, centroids: list[list[int]], dims: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, _, cluster, away in _judged(batch, centroids, dims):
                keys = batch.column("keys").take(pa.array(rows)).flatten()
                held = pa.array([min(int(d), _LONG) for d in away], pa.int64())
                yield pa.RecordBatch.from_arrays([keys, pa.array(cluster, pa.int32()), held], names=["key", "cluster", "distance"])

    key = found.schema["keys"].dataType.elementType
    schema = StructType([
        StructField("key", key), StructField("cluster", IntegerType()), StructField("distance", LongType()),
    ])
    return found.select("keys", "wide", "vectors", "low", "high").mapInArrow(run, schema)


def cluster(
    vectors: DataFrame,
    key: str = "vec_id",
    column: str = "embedding",
    dims: int = DIMS,
    scale: int = SCALE,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    block: int = BLOCK,
) -> tuple[DataFrame, list[list[int]]]:
    """``key``, ``cluster`` and ``distance`` (squared) of every vector that counts, and the final
    centroids.

    Vectors with other than ``dims`` components, or with a null, infinite or NaN one, are left
    out. Components become ``floor(scale * x)``, held to 2 ** 60 on either side. The first
    centroids are the vectors with the smallest SHA-256 of ``1:<key>`` (a null key counts as
    empty), of equal ones those with the smallest components; there are fewer of them if the
    table has fewer vectors. Ties go to the smaller number. Rows that repeat stay; further
    columns are not read; an empty table gives no rows and no centroids.
    """
    own = materialize(kept(vectors, key, column, dims, scale), "vectors")
    name = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("key").cast("string"), F.lit(""))).cast("binary"), 256)
    first = own.select("v", name.alias("name")).orderBy("name", "v").limit(clusters).collect()
    centroids = [list(r.v) for r in first]
    if not centroids:
        schema = StructType([own.schema["key"], StructField("cluster", IntegerType()), StructField("distance", LongType())])
        return own.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key), []
    found = blocks(own, dims, block)
    for _ in range(rounds):
        centroids = _moved(found, centroids, dims)
    return _assigned(found, centroids, dims).withColumnRenamed("key", key), centroids


def report(vectors: DataFrame) -> DataFrame:
    """Every vector with its cluster, its distance, the inertia of its cluster and of all, and a
    digest of its centroid. One row per centroid is sent to the tasks."""
    found, centroids = cluster(vectors)
    found = materialize(found, "assigned")
    away = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {r.cluster: int(r.away) for r in found.groupBy("cluster").agg(away.alias("away")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    every = min(sum(sums.values()), _LONG)
    rows = [(j, min(n, _LONG), every, digest[j]) for j, n in sorted(sums.items())]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    of = vectors.sparkSession.createDataFrame(rows, schema)
    joined = found.join(F.broadcast(of), "cluster")
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def sql(rounds: int = ROUNDS) -> str:
    """The report as SQL: every vector is compared with every centroid."""

    def judged(number: int) -> str:
        away = "list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
        return f"""a{number} AS (SELECT id, vec_id, v, arg_min(c, (d, c)) AS cluster, min(d) AS distance FROM
            (SELECT k.*, c.c, {away} AS d FROM k, c{number} c) GROUP BY id, vec_id, v)"""

    steps = []
    for i in range(rounds):
        steps.append(judged(i))
        steps.append(f"""m{i} AS (SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM
            (SELECT cluster, i, sum(v[i])::HUGEINT AS s, count(*) AS n
             FROM a{i}, generate_series(1, 64) g(i) GROUP BY cluster, i) GROUP BY cluster)""")
        steps.append(f"c{i + 1} AS (SELECT c.c, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m ON c.c = m.cluster)")
    steps.append(judged(rounds))
    return f"""
    WITH k AS (SELECT row_number() OVER () AS id, vec_id,
            list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings WHERE len(embedding) = 64
            AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
    c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v
        FROM k QUALIFY c < 16),
    {", ".join(steps)}
    SELECT vec_id, cluster::INT AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
        sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
    FROM a{rounds} a JOIN c{rounds} c ON a.cluster = c.c"""
