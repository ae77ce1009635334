"""Exact top-k by the threshold algorithm against brute force."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from almanac.llm import threshold

SCHEMA = "vec_id long, embedding array<float>, score long, block int, kind int"


def made(n=400, dims=8, seed=6):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(v) for v in np.round(rng.normal(size=dims) / 2, 1).astype(np.float32)]) for i in range(n)]
    rows += [(1000 + i, rows[50][1]) for i in range(120)]  # a very common vector, one of them a query
    rows += [(2000 + i, [0.0] * dims) for i in range(12)] + [(3000, [1.0, -1.0]), (3001, []), (3050, [0.5] * (dims + 3))]
    rows += [(4000, None), (4050, [float("nan")] * dims), (4100, [None] + [1.0] * (dims - 1)), (4150, [float("inf")] * dims),
             (4200, [3e38] * dims), (None, [1.0] * dims), (100, [0.25] * dims), (100, [-9.0] * dims), (100, [-9.0] * dims)]
    return rows


def plain(rows, every=50, top=5, scale=256):
    limit = int((2.0 ** 62 / max(len(v or []) for _, v in rows)) ** 0.5) - 1
    kept = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) or abs(scale * x) >= limit for x in v):
            continue
        y = [math.floor(scale * x) for x in v]
        kept[i] = min(kept.get(i, y), y)
    out = []
    for q in (i for i in kept if i % every == 0):
        scored = sorted((-sum(a * b for a, b in zip(kept[q], v)), i) for i, v in kept.items() if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:top])]
    return sorted(out)


def frame_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], SCHEMA)


@pytest.mark.parametrize("cells, sample", [(1 << 20, 4096), (300, 3), (300, 40)])
def test_against_brute_force(spark, monkeypatch, cells, sample):
    monkeypatch.setattr(threshold, "BLOCK_CELLS", cells)
    got = threshold.search(frame_of(spark, made()).repartition(4), F.col("vec_id") % 50 == 0, sample=sample)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == plain(made())


def test_against_duckdb(spark, tmp_path):
    rows = [r for r in made(150) if r[0] not in (3050,)]
    frame_of(spark, rows).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    got = threshold.search(spark.read.parquet(f"{tmp_path}/embeddings.parquet"), F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(threshold.oracle_sql(dims=8)).fetchall())


def test_few_rows_and_none(spark):
    assert threshold.search(frame_of(spark, []), F.col("vec_id") % 50 == 0).collect() == []
    assert threshold.search(frame_of(spark, [(1, None)]), F.col("vec_id") % 50 == 0).collect() == []
    assert threshold.search(frame_of(spark, [(0, [1.0])]), F.col("vec_id") % 50 == 0).collect() == []
    few = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (50, [-1.0, 0.0])]
    got = threshold.search(frame_of(spark, few), F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == plain(few)


def test_reading_stops_at_the_threshold():
    rng = np.random.default_rng(1)
    x = rng.integers(-20, 21, size=(5000, 6))
    x[17] = x[4001] = 100  # two rows beat every other
    block = threshold.Block(np.arange(5000), x, 2)
    y = np.array([1, 2, 1, 3, 1, 2])
    assert block.search(-1, y, -np.inf) == [(17, 1000), (4001, 1000)]
    assert block.read < 200  # of 5,000 places
    # a bound from elsewhere that this block cannot reach ends the search in its first step
    assert block.search(-1, y, 1001) == [] and block.read == threshold.FIRST_STEP
    # a tie with the threshold is read to its end: the least ids count
    same = threshold.Block(np.arange(100, 0, -1), np.ones((100, 3), dtype=np.int64), 3)
    assert same.search(2, np.array([1, 0, 2]), -np.inf) == [(1, 3), (3, 3), (4, 3)]


def test_large_components_stay_exact():
    big = 1 << 27
    x = np.array([[big, 1], [big, 2], [-big, 5]], dtype=np.int64)
    block = threshold.Block(np.array([5, 6, 7]), x, 2)
    assert block.search(-1, np.array([big, 1]), -np.inf) == [(6, big * big + 2), (5, big * big + 1)]
