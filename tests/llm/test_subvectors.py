"""Exact clustering through subvector dictionaries: against DuckDB and a plain Python k-means."""

import hashlib
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from almanac.llm import subvectors

SCHEMA = "vec_id long, embedding array<float>, label int, x int, c int"


def rows_of(n=300, dims=6, seed=4):
    rng = np.random.default_rng(seed)
    rows = [(int(i * 3), [float(v) for v in rng.normal(size=dims).astype(np.float32)], 1, 2, 3) for i in range(n)]
    rows += [(9000 + i, rows[5][1], 1, 2, 3) for i in range(100)]  # a very common vector
    rows += [(7, None, 1, 2, 3), (8, [1.0] * (dims - 1), 1, 2, 3), (10, [float("nan")] + [0.0] * (dims - 1), 1, 2, 3),
             (11, [None] + [0.0] * (dims - 1), 1, 2, 3), (13, [float("-inf")] * dims, 1, 2, 3), (14, [3e38] * dims, 1, 2, 3),
             (3, [0.0] * dims, 1, 2, 3), (3, [0.5] * dims, 1, 2, 3), (16, [0.0] * dims, None, 2, 3), (17, [-0.0078125] * dims, 1, 2, 3)]
    return rows


def plain(rows, dims, k, rounds, scale=64, seed=1):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v, *_ in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(scale * x) < 2 ** 27 - 1 for x in v)]
    named = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cents = [v for _, v in named[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in range(len(cents)):
            mine = [v for (_, v), c in zip(kept, own) if c == j]
            if mine:
                cents[j] = [sum(col) // len(mine) for col in zip(*mine)]
    got = [(i, *near(v)[::-1]) for i, v in kept]
    total = {j: sum(d for _, c, d in got if c == j) for j in range(len(cents))}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted((-1 if i is None else i, c, d, total[c], sum(total.values()), names[c]) for i, c, d in got)


def taken(df):
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in df.collect())


@pytest.mark.parametrize("chunk", [16_384, 7])
def test_against_plain_python(spark, monkeypatch, chunk):
    monkeypatch.setattr(subvectors, "CHUNK_ROWS", chunk)
    rows = rows_of() + [(None, [0.25] * 6, 1, 2, 3)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert taken(subvectors.cluster(frame, dims=6, k=5)) == plain(rows, 6, 5, 3)
    # odd number of dimensions: the last block is narrower
    odd = [(i, v[:5] if v is not None and len(v) == 6 else v, *r) for i, v, *r in rows_of() if v is None or len(v) == 6]
    assert taken(subvectors.cluster(spark.createDataFrame(odd, SCHEMA), dims=5, k=9, rounds=2)) == plain(odd, 5, 9, 2)


def test_against_duckdb(spark, tmp_path):
    frame = spark.createDataFrame(rows_of(), SCHEMA)
    frame.repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = sorted(con.execute(subvectors.oracle_sql(dims=6, k=5)).fetchall())
    assert taken(subvectors.cluster(spark.read.parquet(f"{tmp_path}/embeddings.parquet"), dims=6, k=5)) == want


def test_few_rows_and_none(spark):
    few = rows_of()[:3]
    got = subvectors.cluster(spark.createDataFrame(few, SCHEMA), dims=6)
    assert {r["distance"] for r in got.collect()} == {0} and got.columns[0] == "vec_id"
    for none in ([], [(1, None, 1, 2, 3)], [(None, [1.0] * 6, 1, 2, 3)]):
        assert subvectors.cluster(spark.createDataFrame(none, SCHEMA), dims=6).collect() == []


def test_dictionaries_are_lossless(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(-5, 6, size=(500, 7)) * 10 ** 6
    ids, entries, codes = subvectors.encode_chunk(list(range(500)), x, 7)
    tables, codes = subvectors.decode_chunk(entries, codes, 7)
    assert np.array_equal(np.hstack([t[c] for t, c in zip(tables, codes)]), x)
    assert all(len(np.unique(t, axis=0)) == len(t) <= 121 for t in tables)
    centroids = rng.integers(-10 ** 7, 10 ** 7, size=(4, 7))
    want = ((x[:, None, :] - centroids[None]) ** 2).sum(2)
    assert np.array_equal(subvectors.distances(tables, codes, centroids), want)


def test_chunks_hold_every_row_once(spark, monkeypatch):
    monkeypatch.setattr(subvectors, "CHUNK_ROWS", 16)
    frame = spark.createDataFrame(rows_of(), SCHEMA).repartition(3)
    chunks = subvectors.encode(frame, "vec_id", "embedding", 6, 64)
    ids = [r["id"] for r in chunks.select(F.explode("ids").alias("id")).collect()]
    assert sorted(ids) == [p[0] for p in plain(rows_of(), 6, 1, 0)]
    assert chunks.filter(F.size("ids") > 16).count() == 0
