"""Connected components of an edge table by alternating large-star and small-star steps.

First each task replaces its share of the edges (at most ``CONTRACT_EDGES``) by the stars of their
components; as many tasks do so as the edge count asks for. If there is more than one share, star steps
follow: each is a minimum per node and a join, with a hub's edges salted so that no task holds them all.
Edges never reach the driver, which only sees one count per round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm.util import materialise

_SALTS = 8
#: Edges that one task contracts.
CONTRACT_EDGES = 500_000


def _contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for pdf in batches:
        for u, v in zip(pdf["u"].tolist(), pdf["v"].tolist(), strict=True):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > 1_000_000:  # hand on what is known and start anew
            yield pd.DataFrame([(root(x), x) for x in parent if root(x) != x], columns=["u", "v"], dtype=np.int64)
            parent.clear()
    yield pd.DataFrame([(root(x), x) for x in list(parent) if root(x) != x], columns=["u", "v"], dtype=np.int64)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: link every larger neighbour to the least of the neighbourhood; small star: every smaller."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.filter("v < u")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("w"), F.least("u", "m").alias("m"),
        F.explode(F.array(*[F.lit(i) for i in range(_SALTS)])).alias("s"))
    sided = both.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(_SALTS)).cast("int"))
    linked = sided.join(least, (F.col("u") == F.col("w")) & (F.col("salt") == F.col("s")))
    if large:
        out = linked.filter("v > u").select(F.col("m").alias("u"), "v")
    else:
        out = linked.select(F.col("m").alias("u"), "v").unionByName(
            least.filter("s = 0").select(F.col("m").alias("u"), F.col("w").alias("v")))
    return out.filter("u < v").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60, share: int = CONTRACT_EDGES) -> DataFrame:
    """``node, component`` (least node id) for every node with an edge; ``edges`` has long ``u`` and ``v``."""
    pairs = materialise(edges.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")), "edges")
    shares = -(-pairs.count() // share)
    dealt = pairs.coalesce(1) if shares <= 1 else pairs.repartition(shares, "u")
    now = materialise(dealt.mapInPandas(_contract, "u long, v long"), "edges")
    for _ in range(max_rounds if shares > 1 else 0):
        # finished when every node hangs on one node that hangs on none
        parents = now.select("u").distinct()
        broken = now.groupBy("v").agg(F.count("*").alias("n")).join(
            parents.select(F.col("u").alias("p")), F.col("v") == F.col("p"), "left").filter("n > 1 OR p IS NOT NULL")
        if broken.isEmpty():
            break
        now = materialise(_star(_star(now, True), False), "edges")
    else:
        if shares > 1:
            raise RuntimeError("components did not settle")
    return now.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(
        now.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
