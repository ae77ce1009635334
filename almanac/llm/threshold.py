"""Exact top-k by integer inner product: Fagin's threshold algorithm over sorted per-dimension lists.

Rows are dealt into blocks of bounded size. A block sorts its rows once per dimension. For a query every list is read
in parallel from the end that its weight favours: sorted access gives rows, random access gives their full scores,
and the threshold, the score of a row that stood at the present place of every list, bounds every row not yet
met. Reading stops as soon as the threshold is below the k-th best score. That score is at least the query's k-th best
in a bounded sample of rows, so a block that cannot contribute stops after its first places. While the threshold
ties with the k-th score reading goes on, for an unseen row of a smaller id may tie; results are exact.

Every block is one task's work: its rows arrive first, then the queries stream past in Arrow batches, so a task holds
one block and one batch. Rows are shuffled once; a query goes to every block (the query set against all rows, in
blocks). Equal vectors of a block are one entry with the ``top + 1`` smallest ids it stands for, which suffice for
any query, so a very common vector is read once.

Defined results: null vectors and those with a null or non-finite component take no part, nor do those with a
component so large that a score might not fit a long (2^28 after scaling, for 64 dimensions). Missing components of
a shorter vector count as 0. Rows without an id take no part; of rows repeated under one id the least vector counts.
With fewer candidates than ``top`` all are returned; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from almanac.llm.subvectors import scaled, whole, within
from almanac.llm.util import materialise

#: Components a block holds (rows times dimensions), first step of a list, sampled rows for the first bounds.
BLOCK_CELLS, FIRST_STEP, SAMPLE = 1 << 20, 16, 4096
#: Fewest rows that are worth a block of their own while cores are idle.
LEAST_ROWS = 1024
EXACT = 2.0 ** 53

FOUND = "q long, id long, score long"


def padded(column, dims: int) -> np.ndarray:
    """An Arrow list column as a matrix; missing components are 0."""
    flat = np.asarray(column.flatten(), dtype=np.int64)
    ends = np.cumsum(np.diff(np.asarray(column.offsets)))
    sizes = np.diff(np.concatenate([[0], ends]))
    out = np.zeros((len(sizes), dims), dtype=np.int64)
    if len(flat) == len(sizes) * dims:
        return flat.reshape(-1, dims)
    at = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), at] = flat
    return out


class Block:
    """Rows of one block, sorted once per dimension."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, top: int):
        order = np.lexsort((ids, *x.T[::-1])) if x.shape[1] else np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        fresh = np.ones(len(ids), dtype=bool)
        fresh[1:] = (x[1:] != x[:-1]).any(1)
        firsts = np.flatnonzero(fresh)
        ends = np.append(firsts[1:], len(ids))
        self.top, self.read = top, 0  # read: places of every list that the last search took
        #: ascending ids of an entry: enough of them for any query, its own id left out
        self.members = [ids[a:min(b, a + top + 1)] for a, b in zip(firsts, ends, strict=True)]
        rows = x[firsts]
        self.places = np.argsort(rows, axis=0, kind="stable").T.astype(np.int32).copy()
        self.sorted = np.take_along_axis(rows, self.places.T, 0).T.copy()
        self.reach = float(np.abs(rows).max(initial=0))
        self.rows, self.exact = rows, rows.astype(np.float64)
        self.exact_sorted = self.sorted.astype(np.float64)

    def search(self, own: int, y: np.ndarray, floor: float) -> list[tuple[int, int]]:
        """Best ``top`` (id, score) of the rows that are not ``own`` and score ``floor`` or more."""
        m = len(self.rows)
        if not y.any():  # no list has a weight: every row scores 0
            ids = np.sort(np.concatenate(self.members))
            return [(int(i), 0) for i in ids[ids != own][:self.top]]
        small = self.reach * float(np.abs(y).max()) * len(y) < EXACT  # then doubles are exact
        rows, values, y = (self.exact, self.exact_sorted, y.astype(np.float64)) if small else (self.rows, self.sorted, y)
        up, down = np.flatnonzero(y > 0), np.flatnonzero(y < 0)
        seen = np.zeros(m, dtype=bool)
        pool: list[tuple[int, int]] = []  # (score, entry)
        depth, step = 0, FIRST_STEP
        while depth < m:
            stop = min(depth + step, m)
            met = np.zeros(m, dtype=bool)
            met[self.places[up, m - stop:m - depth]] = True
            met[self.places[down, depth:stop]] = True
            new = np.flatnonzero(met & ~seen)
            seen[new] = True
            scores = (rows @ y)[new] if 4 * len(new) > m else rows[new] @ y
            self.read = stop
            good = np.flatnonzero(scores >= floor)
            if good.size:
                pool += [(int(scores[g]), int(new[g])) for g in good]
                pool, floor = self.best(pool, own, floor)
            if stop == m or y[up] @ values[up, m - stop] + y[down] @ values[down, stop - 1] < floor:
                break
            depth, step = stop, 2 * step
        return sorted(((int(i), s) for s, e in pool for i in self.members[e] if i != own),
                      key=lambda v: (-v[1], v[0]))[:self.top]

    def best(self, pool: list, own: int, floor: float) -> tuple[list, float]:
        """Entries that may still be among the best, and the k-th score where there are k rows."""
        pool.sort(reverse=True)
        rows = 0
        for score, entry in pool:
            ids = self.members[entry]
            rows += len(ids) - bool((ids == own).any())
            if rows >= self.top:
                return [p for p in pool if p[0] >= score], max(floor, score)
        return pool, floor


def search(rows: DataFrame, is_query: Column, *, key: str = "vec_id", vector: str = "embedding", top: int = 5,
           scale: int = 256, sample: int = SAMPLE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``top`` rows of highest score of every row for which ``is_query`` holds."""
    spark = rows.sparkSession
    out_schema = "query_id long, rank int, vec_id long, score long"
    good = rows.filter(F.col(key).isNotNull() & whole(vector)).select(
        F.col(key).cast("long").alias("id"), F.col(vector).alias("x"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    dims = good.agg(F.max(F.size("x"))).first()[0]
    if dims is None:
        return spark.createDataFrame([], out_schema)
    limit = float(int((2.0 ** 62 / max(dims, 1)) ** 0.5))
    good = good.filter(within("x", scale, limit)).withColumn("x", scaled("x", scale))
    repeated = materialise(good.groupBy("id").count().filter("count > 1").select("id"), "repeated-ids")
    if not repeated.isEmpty():
        one = good.join(repeated, "id", "left_semi").groupBy("id").agg(F.min("x").alias("x"), F.max("asks").alias("asks"))
        good = good.join(repeated, "id", "left_anti").unionByName(one)
    good = materialise(good, "vectors")
    total = good.count()
    per_block = max(1, BLOCK_CELLS // max(dims, 1))
    blocks = max(1, -(-total // per_block), min(spark.sparkContext.defaultParallelism, -(-total // LEAST_ROWS)))
    # the sample: least hashes. A share of twice the sample is kept first, so that tasks send few rows to the driver
    size, place = min(sample, per_block), F.xxhash64("id", F.lit(29))
    share = int(2.0 ** 63 * min(1.0, 2.0 * size / max(total, 1)))
    near = good.filter(F.shiftrightunsigned(place, 1) <= F.lit(min(share, 2 ** 63 - 1)))
    picked = near.orderBy(place, "id").limit(size).select("id", "x").collect()
    first = np.array([r["id"] for r in picked], dtype=np.int64), np.zeros((len(picked), dims), dtype=np.int64)
    for place, r in enumerate(picked):
        first[1][place, :len(r["x"])] = r["x"]
    shared = spark.sparkContext.broadcast(first)  # at most ``sample`` rows and BLOCK_CELLS components

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, x = shared.value
        for b in batches:
            y = padded(b.column(1), dims)
            scores = y @ x.T  # integers: exact
            found = []
            for own, row in zip(b.column(0).to_pylist(), scores, strict=True):
                row = row[ids != own]
                found.append(int(np.partition(row, len(row) - top)[len(row) - top]) if len(row) >= top else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.int64())],
                                             names=["id", "x", "floor"])

    asked = good.filter("asks").select("id", "x").mapInArrow(bounds, "id long, x array<long>, floor long")
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("kind", F.lit(1))
    base = good.select("id", "x", F.lit(None).cast("long").alias("floor"),
                       F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"))
    dealt = base.unionByName(asked).repartition(blocks, "block").sortWithinPartitions("block", "kind", "id")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, block = None, [], None
        for b in batches:
            ids, floors = b.column(0).to_numpy(zero_copy_only=False), b.column(2).to_pylist()
            where, kind = b.column(3).to_numpy(), b.column(4).to_numpy()
            x, found = padded(b.column(1), dims), []
            cuts = np.flatnonzero((where[1:] != where[:-1]) | (kind[1:] != kind[:-1])) + 1
            for run in np.split(np.arange(len(ids)), cuts):
                if not run.size:
                    continue
                if where[run[0]] != at:
                    at, parts, block = where[run[0]], [], None
                if kind[run[0]] == 0:
                    parts.append((ids[run], x[run]))
                    continue
                if block is None and parts:
                    block = Block(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), top)
                    parts = []
                if block is not None:
                    for i in run:
                        floor = -np.inf if floors[i] is None else floors[i]
                        found += [(int(ids[i]), *v) for v in block.search(int(ids[i]), x[i], floor)]
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["q", "id", "score"])

    near = dealt.mapInArrow(answer, FOUND)
    best = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    return near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).select(
        F.col("q").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


def oracle_sql(every: int = 50, top: int = 5, scale: int = 256, dims: int = 64) -> str:
    """The same results in DuckDB SQL over the ``embeddings`` view, by scoring every pair."""
    limit = float(int((2.0 ** 62 / dims) ** 0.5)) - 1
    return f"""
WITH v AS (SELECT vec_id, min(x) AS x FROM (
             SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
             FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
               AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x)
                                                     OR abs({scale} * CAST(x AS DOUBLE)) >= {limit})) = 0) u GROUP BY vec_id),
     e AS (SELECT vec_id, generate_subscripts(x, 1) AS j, unnest(x) AS x FROM v),
     s AS (SELECT q.vec_id AS query_id, e.vec_id, CAST(sum(q.x * e.x) AS BIGINT) AS score
           FROM e q JOIN e ON q.j = e.j WHERE q.vec_id % {every} = 0 AND q.vec_id <> e.vec_id GROUP BY ALL),
     p AS (SELECT q.vec_id AS query_id, v.vec_id, coalesce(s.score, 0) AS score
           FROM v q JOIN v ON q.vec_id <> v.vec_id AND q.vec_id % {every} = 0
           LEFT JOIN s ON s.query_id = q.vec_id AND s.vec_id = v.vec_id)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM p
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= {top}"""
