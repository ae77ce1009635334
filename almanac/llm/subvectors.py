"""Exact k-means on integer vectors through subvector dictionaries.

Vectors are gathered into chunks of bounded size. Each chunk cuts its vectors into blocks of a few dimensions
and keeps, per block, the distinct subvectors (a dictionary, like a Parquet page's) and one code a vector: the
encoding is lossless. A round computes the exact squared distance of every dictionary entry to every centroid
once, and a vector's distance is the sum of its codes' partial distances. The sums of a cluster come from the same
dictionaries: how often a code occurs in it, times the entry. A task sends one row per centroid and dimension, so a
round shuffles and collects ``centroids * dimensions`` totals, however large the table is.

All arithmetic is on 64-bit integers. Chunks are written once to the shared folder and read by every round, so a
lost executor repeats only its own chunks of the round.

Defined results: vectors that are null, of another length, or with a null or non-finite component take no part,
nor do those with a component of 2^27 or more after scaling, as their distances would not fit a long. Rows
repeated under one id are kept as they are. A row without an id is clustered but is never a starting centroid.
With fewer rows than centroids there are as many centroids as rows with an id; without any, and for an empty table,
there are no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.llm.util import materialise

#: Rows of a chunk (codes are 16-bit) and dimensions of a block.
CHUNK_ROWS, BLOCK_DIMS = 16_384, 2
LIMIT = 2.0 ** 27

CHUNK = "ids array<long>, entries array<binary>, codes array<binary>"


def whole(vector: str) -> Column:
    """Neither null nor holding a null or non-finite component."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return F.col(vector).isNotNull() & ~bad


def scaled(vector: str, scale: int) -> Column:
    """Components as ``floor(scale * x)``, x as double."""
    return F.transform(vector, lambda v: F.floor(v.cast("double") * F.lit(float(scale))).cast("long"))


def within(vector: str, scale: int, limit: float) -> Column:
    """No scaled component reaches ``limit``."""
    return ~F.exists(vector, lambda v: F.abs(v.cast("double") * F.lit(float(scale))) >= F.lit(limit - 1))


def encode_chunk(ids: list, x: np.ndarray, dims: int) -> tuple[list, list, list]:
    """Per block of dimensions the distinct subvectors and every row's code."""
    entries, codes = [], []
    for at in range(0, dims, BLOCK_DIMS):
        part = np.ascontiguousarray(x[:, at:at + BLOCK_DIMS])
        width = part.shape[1]
        # lexicographic order of the rows, then runs of equal ones
        order = np.lexsort(part.T[::-1])
        ordered = part[order]
        fresh = np.ones(len(part), dtype=bool)
        fresh[1:] = (ordered[1:] != ordered[:-1]).any(1)
        code = np.empty(len(part), dtype=np.uint16)
        code[order] = (np.cumsum(fresh) - 1).astype(np.uint16)
        entries.append(ordered[fresh].astype("<i8").reshape(-1, width).tobytes())
        codes.append(code.astype("<u2").tobytes())
    return ids, entries, codes


def decode_chunk(entries: list, codes: list, dims: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Dictionaries (entries, block width) and codes of a chunk."""
    widths = [min(BLOCK_DIMS, dims - at) for at in range(0, dims, BLOCK_DIMS)]
    return ([np.frombuffer(e, dtype="<i8").reshape(-1, w) for e, w in zip(entries, widths, strict=True)],
            [np.frombuffer(c, dtype="<u2") for c in codes])


def distances(tables: list[np.ndarray], codes: list[np.ndarray], centroids: np.ndarray) -> np.ndarray:
    """Squared distance of every vector to every centroid: partial distances per entry, summed by code."""
    total = np.zeros((len(codes[0]) if codes else 0, len(centroids)), dtype=np.int64)
    at = 0
    for table, code in zip(tables, codes, strict=True):
        own = centroids[:, at:at + table.shape[1]]
        away = table[:, None, :] - own[None, :, :]
        total += (away * away).sum(2)[code]
        at += table.shape[1]
    return total


def encode(rows: DataFrame, key: str, vector: str, dims: int, scale: int) -> DataFrame:
    """Every vector that takes part, in dictionary-encoded chunks."""
    kept = rows.filter(whole(vector) & (F.size(vector) == dims)).filter(within(vector, scale, LIMIT)).select(
        F.col(key).cast("long").alias("id"), scaled(vector, scale).alias("x"))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts = [], []

        def emit():
            found = encode_chunk(ids[:CHUNK_ROWS], np.concatenate(parts)[:CHUNK_ROWS], dims)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(found, types)],
                                              names=["ids", "entries", "codes"])

        types = (pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.binary()))
        for b in batches:
            ids += b.column(0).to_pylist()
            parts.append(np.asarray(b.column(1).flatten(), dtype=np.int64).reshape(-1, dims))
            while len(ids) >= CHUNK_ROWS:
                yield emit()
                ids, parts = ids[CHUNK_ROWS:], [np.concatenate(parts)[CHUNK_ROWS:]]
        if ids:
            yield emit()

    return kept.mapInArrow(chunks, CHUNK)


def starts(rows: DataFrame, key: str, vector: str, dims: int, scale: int, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors of least SHA-256 of ``seed:id``, in that order (ties: least vector)."""
    kept = rows.filter(F.col(key).isNotNull() & whole(vector) & (F.size(vector) == dims)).filter(
        within(vector, scale, LIMIT))
    first = kept.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("long").cast("string")), 256).alias("h"),
                        scaled(vector, scale).alias("x")).orderBy("h", "x").limit(k)
    return np.array([r["x"] for r in first.collect()], dtype=np.int64).reshape(-1, dims)


def totals(chunks: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
    """Per centroid the number of its vectors and their componentwise sums (Python integers, exact)."""
    k, dims = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64)
        for b in batches:
            for entries, codes in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                tables, codes = decode_chunk(entries, codes, dims)
                near = distances(tables, codes, centroids).argmin(1)
                counts += np.bincount(near, minlength=k)
                at = 0
                for table, code in zip(tables, codes, strict=True):
                    met = np.bincount(near * len(table) + code, minlength=k * len(table)).reshape(k, len(table))
                    sums[:, at:at + table.shape[1]] += met @ table
                    at += table.shape[1]
        where = np.repeat(np.arange(k, dtype=np.int32), dims + 1)
        place = np.tile(np.arange(dims + 1, dtype=np.int32), k)
        yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(place),
                                          pa.array(np.hstack([counts[:, None], sums]).ravel())], names=["c", "j", "v"])

    # centroids * (dimensions + 1) totals, whatever the number of rows
    found = chunks.mapInArrow(add, "c int, j int, v long").groupBy("c", "j").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    counts, sums = [0] * k, [[0] * dims for _ in range(k)]
    for r in found:
        if r["j"] == 0:
            counts[r["c"]] = int(r["v"])
        else:
            sums[r["c"]][r["j"] - 1] = int(r["v"])
    return counts, sums


def cluster(rows: DataFrame, *, key: str = "vec_id", vector: str = "embedding", dims: int = 64, scale: int = 64,
            k: int = 16, rounds: int = 3, seed: int = 1) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``: one row per vector that takes part."""
    spark = rows.sparkSession
    rows = rows.select(F.col(key), F.col(vector))
    schema = (f"{key} long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = starts(rows, key, vector, dims, scale, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], schema)
    chunks = materialise(encode(rows, key, vector, dims, scale), "subvectors")
    for _ in range(rounds):
        counts, sums = totals(chunks, centroids)
        # floor division of Python integers is exact
        centroids = np.array([[s // n for s in own] if n else list(old) for n, own, old in
                              zip(counts, sums, centroids.tolist(), strict=True)], dtype=np.int64)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, entries, codes in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                found = distances(*decode_chunk(entries, codes, dims), centroids)
                near = found.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(near.astype(np.int32)),
                     pa.array(found[np.arange(len(near)), near])], names=["id", "c", "d"])

    assigned = materialise(chunks.mapInArrow(assign, "id long, c int, d long"), "assigned")
    inertia = {r["c"]: int(r["v"]) for r in  # a row per centroid
               assigned.groupBy("c").agg(F.sum(F.col("d").cast("decimal(38,0)")).alias("v")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    own = F.array(*[F.struct(F.lit(inertia.get(c, 0)).cast("long").alias("i"), F.lit(n).alias("h"))
                    for c, n in enumerate(names)])
    of = assigned.withColumn("own", F.element_at(own, F.col("c") + 1))
    return of.select(F.col("id").alias(key), F.col("c").alias("cluster"), F.col("d").alias("distance"),
                     F.col("own.i").alias("cluster_inertia"), F.lit(sum(inertia.values())).cast("long").alias("inertia"),
                     F.col("own.h").alias("centroid_sha256"))


def oracle_sql(dims: int = 64, scale: int = 64, k: int = 16, rounds: int = 3, seed: int = 1) -> str:
    """The same clustering in DuckDB SQL over the ``embeddings`` view, one row per vector and dimension."""
    steps = [f"""
v AS (SELECT row_number() OVER () AS rid, vec_id,
             list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
      FROM embeddings WHERE len(embedding) = {dims}
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x) OR abs({scale} * CAST(x AS DOUBLE)) >= {LIMIT - 1})) = 0),
e AS (SELECT rid, generate_subscripts(x, 1) AS j, unnest(x) AS x FROM v),
s AS (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || CAST(vec_id AS VARCHAR)), x) - 1 AS c, x FROM v
      WHERE vec_id IS NOT NULL QUALIFY c < {k}),
c0 AS (SELECT c, generate_subscripts(x, 1) AS j, unnest(x) AS x FROM s)"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS (SELECT rid, c, d FROM (SELECT rid, c, CAST(sum((e.x - c{r}.x) * (e.x - c{r}.x)) AS BIGINT) AS d
                                FROM e JOIN c{r} ON e.j = c{r}.j GROUP BY ALL)
         QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (SELECT a{r}.c, e.j, CAST(sum(e.x) AS BIGINT) AS t, count(*) AS n FROM e JOIN a{r} ON e.rid = a{r}.rid GROUP BY ALL),
c{r + 1} AS (SELECT c{r}.c, c{r}.j, CASE WHEN n IS NULL THEN c{r}.x ELSE (t - ((t % n) + n) % n) // n END AS x
             FROM c{r} LEFT JOIN m{r} ON c{r}.c = m{r}.c AND c{r}.j = m{r}.j)""")
    return f"""WITH {",".join(steps)},
h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256 FROM c{rounds} GROUP BY c),
i AS (SELECT c, CAST(sum(d) AS BIGINT) AS cluster_inertia FROM a{rounds} GROUP BY c)
SELECT v.vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance, i.cluster_inertia,
       CAST((SELECT sum(cluster_inertia) FROM i) AS BIGINT) AS inertia, h.centroid_sha256
FROM v JOIN a{rounds} a ON v.rid = a.rid JOIN h ON h.c = a.c JOIN i ON i.c = a.c"""
