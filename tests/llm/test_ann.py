"""Nearest neighbours against brute force: recall, order, copies, edge rows."""

import numpy as np
from pyspark.sql import functions as F

from almanac.llm import ann


def brute(rows, top):
    good = [(i, np.array(v, dtype=np.float64)) for i, v in rows
            if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)]
    ids = np.array([i for i, _ in good])
    x = np.array([np.float32(v) for _, v in good], dtype=np.float64)
    out = {}
    for k in np.flatnonzero(ids % 20 == 0):
        s = x @ x[k]
        s[k] = -np.inf
        order = [j for j in np.lexsort((ids, -np.round(s, 10))) if j != k][:top]
        out[int(ids[k])] = [int(ids[j]) for j in order]
    return out


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, x int")
    got = {}
    for r in sorted(ann.search(df, F.col("vec_id") % 20 == 0, **options).collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    return got


def test_recall_with_a_small_sample(spark):
    rng = np.random.default_rng(0)
    rows = [(i, (rng.normal(size=24) * rng.uniform(0.5, 2)).tolist(), 1) for i in range(2500)]
    want = brute([r[:2] for r in rows], 20)
    got = run(spark, rows, sample=600)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits >= 0.9 * 20 * len(want)


def test_copies_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(1)
    same = rng.normal(size=8).tolist()
    rows = [(i, same if i % 3 == 0 else rng.normal(size=8).tolist(), 1) for i in range(300)]
    rows += [(1000, None, 1), (1020, [0.0] * 8, 1), (1040, [float("nan")] * 8, 1), (1060, [None] * 8, 1),
             (1080, [float("inf")] + [1.0] * 7, 1), (1100, [1.0, 2.0], 1), (None, same, 1), (20, rows[20][1], 1)]
    want = brute([r[:2] for r in rows if r[0] is None or r[0] < 1000][:300], 20)
    assert run(spark, rows) == want


def test_fewer_candidates_than_wanted(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, [-1.0, 0.0], 1)]
    assert run(spark, rows) == {0: [1, 2]}
    assert run(spark, rows[:1]) == {}
    assert run(spark, []) == {}


def test_abandoned_candidates_are_far():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 64)).astype(np.float32)
    index = ann.fit(x, np.arange(len(x)), len(x), 20, float(np.linalg.norm(x, axis=1).max()))
    q = rng.normal(size=(20, 64)).astype(np.float32)
    bounds = ann.sample_nearest(index, q, 20)[0]
    i, j = ann.scan(index, index.lift(q, False), bounds, index.lift(x, True))
    true = np.argsort(-(q.astype(np.float64) @ x.T.astype(np.float64)), axis=1)[:, :20]
    found = set(zip(i.tolist(), j.tolist()))
    kept = sum((a, b) in found for a in range(20) for b in true[a].tolist())
    assert kept >= 0.98 * 400 and len(found) < 0.5 * 20 * 3000
