"""Approximate nearest neighbours by largest inner product: inverted lists with an adaptive dimension scan.

Vectors get one more component so that Euclidean order equals inner-product order, and are rotated at
random, so that any leading columns give an unbiased estimate of the distance. A list is scanned in
blocks of columns: after each block a hypothesis test compares every candidate's partial distance with
the query's bound and abandons those that are too far with high confidence. Survivors of all blocks are
scored exactly, in double precision, on the original vectors.

Fitting (list centres, the number of lists to probe, each query's first bound) uses a bounded sample of
``sample`` vectors of smallest hash; every vector is indexed. The number of probed lists is the least
that reaches ``target`` recall on the sample, so it follows the data's structure. Equal vectors are one
entry of the index with the ids they stand for (the ``top + 1`` smallest suffice for any query). Lists
and query sets are cut into blocks of bounded size, so a list with a third of all rows is many tasks.

Defined results: null, zero or non-finite vectors, and those whose length is not the most frequent one,
take no part; of rows repeated under one id the least vector counts; with fewer candidates than ``top``
all are returned; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.util import materialise

BLOCK_DIMS = 16
LIST_BLOCK, QUERY_BLOCK = 4096, 1024


@dataclass
class Index:
    rotation: np.ndarray  # (d + 1, d + 1)
    centres: np.ndarray  # (lists, d + 1), rotated
    probes: int
    reach: float  # largest norm
    sample: np.ndarray  # (m, d), for the queries' first bounds and candidates
    sample_ids: np.ndarray
    epsilon: float = 2.1

    def lift(self, x: np.ndarray, base: bool) -> np.ndarray:
        """Rotated vectors with the component that makes distance order equal inner-product order."""
        x = x.astype(np.float64)
        extra = np.sqrt(np.maximum(self.reach ** 2 - (x * x).sum(1), 0.0)) if base else np.zeros(len(x))
        return (np.hstack([x, extra[:, None]]) @ self.rotation).astype(np.float32)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T), 0)


def _centres(x: np.ndarray, lists: int, rounds: int = 10) -> np.ndarray:
    rng = np.random.default_rng(3)
    c = x[rng.choice(len(x), lists, replace=False)].copy()
    for _ in range(rounds):
        near = np.concatenate([_distances(x[i:i + 4096], c).argmin(1) for i in range(0, len(x), 4096)])
        n = np.bincount(near, minlength=lists)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c).astype(np.float32)
    return c


def fit(sample: np.ndarray, sample_ids: np.ndarray, total: int, top: int, reach: float, target: float = 0.985, max_lists: int = 4096) -> Index:
    """Centres and the number of probes from a sample of distinct vectors; ``total`` vectors will be indexed."""
    d = sample.shape[1]
    rotation = np.linalg.qr(np.random.default_rng(5).normal(size=(d + 1, d + 1)))[0]
    index = Index(rotation, np.zeros((1, d + 1), np.float32), 1, reach, sample, sample_ids)
    base = index.lift(sample, True)
    lists = int(max(1, min(max_lists, round(np.sqrt(total)), len(base) // 8)))
    index.centres = _centres(base, lists)
    own = np.concatenate([_distances(base[i:i + 4096], index.centres).argmin(1) for i in range(0, len(base), 4096)])
    picks = np.arange(0, len(base), max(1, len(base) // 256))
    queries = index.lift(sample[picks], False)
    scores = sample[picks].astype(np.float64) @ sample.T.astype(np.float64)
    scores[np.arange(len(picks)), picks] = -np.inf
    best = np.argsort(-scores, axis=1)[:, :min(top, len(base) - 1)]
    if best.size:
        order = np.argsort(_distances(queries, index.centres), axis=1)
        place = np.argsort(order, axis=1)  # of every list, for every query
        needed = np.sort(place[np.arange(len(picks))[:, None], own[best]].ravel())
        index.probes = int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))))]) + 1
    return index


def sample_nearest(index: Index, queries: np.ndarray, top: int) -> tuple[np.ndarray, list, list]:
    """Per query: a bound on the squared distance of its (top + 1)-th nearest, and its nearest sample vectors.

    The bound is that of the sample, which is no smaller than the true one; the sample's own nearest vectors
    are candidates as well, so that every query gets its full number of results.
    """
    s = index.sample.astype(np.float64)
    n = min(top + 1, len(s))
    bounds, names, scores = np.full(len(queries), np.inf), [], []
    for at in range(0, len(queries), 512):
        q = queries[at:at + 512].astype(np.float64)
        dots = q @ s.T
        best = np.argpartition(-dots, n - 1, axis=1)[:, :n]
        if n > top:
            kth = np.take_along_axis(dots, best, 1).min(1)
            bounds[at:at + 512] = (q * q).sum(1) + index.reach ** 2 - 2 * kth
        names += list(index.sample_ids[best])
        scores += [np.einsum("j,ij->i", x, s[b]) for x, b in zip(q, best, strict=True)]
    return bounds, names, scores


def scan(index: Index, q: np.ndarray, bounds: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, candidate) pairs of one list block that survive the hypothesis test of every column block."""
    dims = x.shape[1]
    rows, cols = np.arange(len(q)), np.arange(len(x))
    partial = np.zeros((len(q), len(x)), dtype=np.float32)
    alive = np.ones(partial.shape, dtype=bool)
    for at in range(0, dims, BLOCK_DIMS):
        stop = min(at + BLOCK_DIMS, dims)
        partial += _distances(q[rows, at:stop], x[cols, at:stop])
        limit = bounds[rows] * 1.000001 + 1e-9
        if stop < dims:  # the estimate is the partial distance scaled to all columns
            limit = limit * (stop / dims) * (1 + index.epsilon / np.sqrt(stop)) ** 2
        alive &= partial <= limit[:, None]
        r, c = alive.any(1), alive.any(0)
        if not r.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if r.mean() < 0.8 or c.mean() < 0.8:  # drop abandoned rows and columns of the tile
            rows, cols = rows[r], cols[c]
            partial, alive = partial[np.ix_(r, c)], alive[np.ix_(r, c)]
    i, j = np.nonzero(alive)
    return rows[i], cols[j]


def _matrix(column, dims: int) -> np.ndarray:
    if isinstance(column, pd.Series):
        return np.stack([np.asarray(v, dtype=np.float32) for v in column]) if len(column) else np.zeros((0, dims), np.float32)
    return np.asarray(column.flatten(), dtype=np.float32).reshape(-1, dims)


def usable(vector: str) -> Column:
    """Vectors that take part: no nulls, only finite components, not all zero."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return F.col(vector).isNotNull() & ~bad & F.exists(vector, lambda v: v != 0)


def search(rows: DataFrame, is_query: Column, *, key: str = "vec_id", vector: str = "embedding", top: int = 20,
           sample: int = 16384, target: float = 0.985) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest ``top`` rows of every row for which ``is_query`` holds."""
    spark = rows.sparkSession
    out_schema = "query_id long, rank int, vec_id long, score double"
    good = rows.filter(F.col(key).isNotNull() & usable(vector)).select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("x"), is_query.alias("asks"))
    lengths = good.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], out_schema)
    dims = lengths[0]["d"]
    good = good.filter(F.size("x") == dims).groupBy("id").agg(F.min("x").alias("x"), F.max("asks").alias("asks"))
    # one entry a distinct vector, with the smallest ids it stands for
    entries = materialise(good.groupBy("x").agg(F.min("id").alias("e"), F.max("asks").alias("asks")), "entries")
    firsts = good.withColumn("r", F.row_number().over(Window.partitionBy("x").orderBy("id"))).filter(F.col("r") <= top + 1)
    members = materialise(firsts.join(entries.select(F.col("x").alias("y"), "e"), F.col("x") == F.col("y")).select("e", "id"),
                          "members")
    norm2 = F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    total, reach = entries.agg(F.count("*"), F.sqrt(F.max(norm2))).first()
    picked = entries.orderBy(F.xxhash64("e", F.lit(17)), "e").limit(sample).select("e", "x").collect()
    index = fit(np.array([r["x"] for r in picked], dtype=np.float32), np.array([r["e"] for r in picked]), total, top, reach, target)
    shared = spark.sparkContext.broadcast(vars(index))  # plain arrays: executors need no copy of this module

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = Index(**shared.value)
        for b in batches:
            lifted = ix.lift(_matrix(b.column(1), dims), True)
            lists = [_distances(lifted[i:i + 4096], ix.centres).argmin(1) for i in range(0, len(lifted), 4096)]
            lists = np.concatenate(lists) if lists else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(lists.astype(np.int32)), b.column(0), b.column(1)],
                                             names=["list", "e", "x"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = Index(**shared.value)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                q = _matrix(part.column(1), dims)
                far = _distances(ix.lift(q, False), ix.centres)
                n = min(ix.probes, far.shape[1])
                lists = np.argpartition(far, n - 1, axis=1)[:, :n].astype(np.int32)
                bounds, names, scores = sample_nearest(ix, q, top)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(bounds), pa.array(list(lists), pa.list_(pa.int32())),
                     pa.array(names, pa.list_(pa.int64())), pa.array(scores, pa.list_(pa.float64()))],
                    names=["q", "y", "bound", "lists", "known", "known_scores"])

    placed = materialise(entries.select("e", "x").mapInArrow(place, "list int, e long, x array<float>"), "lists")
    asked = entries.filter("asks").select(F.col("e").alias("q"), F.col("x").alias("y")).mapInArrow(
        probe, "q long, y array<float>, bound double, lists array<int>, known array<long>, known_scores array<double>")
    asked = materialise(asked, "queries")
    # cut long lists and large query sets of a list into blocks (one row a list: at most max_lists)
    vectors = dict(placed.groupBy("list").count().collect())
    probes = dict(asked.select(F.explode("lists").alias("list")).groupBy("list").count().collect())
    plan = [(k, -(-n // LIST_BLOCK), -(-probes[k] // QUERY_BLOCK)) for k, n in vectors.items() if k in probes]
    if not plan:
        return spark.createDataFrame([], out_schema)
    blocks = F.broadcast(spark.createDataFrame(plan, "list int, vb int, qb int"))
    base = placed.join(blocks, "list").select(
        "list", F.pmod(F.xxhash64("e"), F.col("vb")).cast("int").alias("vblock"), "qb", "e", "x").select(
        "list", "vblock", F.explode(F.sequence(F.lit(0), F.col("qb") - 1)).alias("qblock"), "e", "x")
    ask = asked.select("q", "y", "bound", F.explode("lists").alias("list")).join(blocks, "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("vb") - 1)).alias("vblock"),
        F.pmod(F.xxhash64("q"), F.col("qb")).cast("int").alias("qblock"), "q", "y", "bound")

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        ix = Index(**shared.value)
        x, q = _matrix(left["x"], dims), _matrix(right["y"], dims)
        frames = []
        if len(x) and len(q):
            lifted, e, ids = ix.lift(x, True), left["e"].to_numpy(), right["q"].to_numpy()
            for at in range(0, len(q), QUERY_BLOCK):
                part = slice(at, at + QUERY_BLOCK)
                i, j = scan(ix, ix.lift(q[part], False), right["bound"].to_numpy()[part], lifted)
                score = np.einsum("ij,ij->i", q[part][i].astype(np.float64), x[j].astype(np.float64))
                order = np.lexsort((e[j], -score, i))
                i, j, score = i[order], j[order], score[order]
                place_in = np.arange(len(i)) - np.searchsorted(i, i)
                keep = place_in <= top
                frames.append(pd.DataFrame({"q": ids[part][i[keep]], "e": e[j[keep]], "score": score[keep]}))
        return pd.concat(frames) if frames else pd.DataFrame({"q": [], "e": [], "score": []})

    keys = ["list", "vblock", "qblock"]
    met = base.groupBy(*keys).cogroup(ask.groupBy(*keys)).applyInPandas(compare, "q long, e long, score double")
    known = asked.select("q", F.explode(F.arrays_zip("known", "known_scores")).alias("k")).select(
        "q", F.col("k.known").alias("e"), F.col("k.known_scores").alias("score"))
    met = met.unionByName(known).groupBy("q", "e").agg(F.max("score").alias("score"))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "e")
    near = met.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= top + 1).select("q", "e", "score")
    ranked = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    lists = near.join(members, "e").withColumn("r", F.row_number().over(ranked)).filter(F.col("r") <= top + 1)
    found = materialise(lists.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("r", "id", "score"))).alias("near")),
                        "nearest")
    askers = good.filter("asks").select("id", "x").join(entries.select(F.col("x").alias("y"), F.col("e").alias("q")),
                                                       F.col("x") == F.col("y")).select(F.col("id").alias("asker"), "q")
    others = F.filter("near", lambda v: v["id"] != F.col("asker"))
    return askers.join(found, "q").select("asker", F.posexplode(F.slice(others, 1, top)).alias("pos", "v")).select(
        F.col("asker").alias("query_id"), (F.col("pos") + 1).cast("int").alias("rank"),
        F.col("v.id").alias("vec_id"), F.col("v.score").alias("score"))
