"""Connected components of a table of links, without gathering any of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlens.session import discard, materialize


def _each(rows: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """``a`` and ``b``: the ``pairs`` of columns of each row, one after the other.

    A union of the pairs would hold the plan of ``rows`` once for each, and a round nests several:
    the driver keeps and compiles all of it.
    """
    return rows.select(F.inline(F.array(*[F.struct(F.col(a).alias("a"), F.col(b).alias("b")) for a, b in pairs])))


def _smallest(links: DataFrame) -> DataFrame:
    """``links`` (a, b) with the smallest of b and its neighbours among the a as ``m``."""
    best = links.groupBy("b").agg(F.least("b", F.min("a")).alias("m"))
    return links.join(best, "b")


def _outward(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    joined = _smallest(_each(links, ("a", "b"), ("b", "a"))).where("a > b")
    return joined.select(F.col("m").alias("a"), F.col("a").alias("b")).where("a < b").distinct()


def _inward(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    return _each(_smallest(links), ("m", "a"), ("m", "b")).where("a < b").distinct()


def _settled(links: DataFrame) -> bool:
    """Whether each link leads from the smallest node of its component: no node has two smaller
    neighbours, or a smaller one and a larger one. A further round would change nothing."""
    ends = F.array(*[F.struct(F.col(n).alias("node"), F.lit(n == "b").cast("int").alias("low")) for n in ("a", "b")])
    nodes = links.select(F.inline(ends)).groupBy("node").agg(F.sum("low").alias("low"), F.count("*").alias("n"))
    return nodes.where("low > 0 and n > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for every node that has a link.

    ``links`` has two long columns ``a`` and ``b`` without nulls, in any direction; repeated
    links and links of a node to itself change nothing. No links, no rows. Links of a hot
    node are joined to one row, so Spark can split them. The rounds grow with the logarithm
    of the longest path; each is written, so a lost executor repeats one round at most.
    """
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    now = materialize(links.select(low, high).where("a < b").distinct(), "links")
    while not _settled(now):
        last, now = now, materialize(_inward(_outward(now)), "links")
        discard(last)
    return now.select(F.col("b").alias("node"), F.col("a").alias("root"))
