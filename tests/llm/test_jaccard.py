"""N-gram Jaccard join against brute force, with skew and edge rows."""

import random
import re

import numpy as np
import pyarrow as pa

from almanac.llm import components, jaccard, shingles


def brute_sets(texts):
    out = []
    for t in texts:
        t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    return out


def brute_components(ids, texts, percent=75):
    sets = brute_sets(texts)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(ids[a]), find(ids[b])
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}, {i: len(s) for i, s in zip(ids, sets)}


def edited(rng, words, share):
    return [rng.choice("abcdefgh") * 3 if rng.random() < share else w for w in words]


def corpus():
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(300)]
    hot = " ".join(rng.choice(vocab) for _ in range(25))
    texts = []
    for g in range(12):
        base = [rng.choice(vocab) for _ in range(rng.randint(10, 120))]
        for _ in range(rng.randint(1, 9)):
            texts.append(" ".join(edited(rng, base, rng.choice([0, 0.005, 0.02, 0.05]))))
    big = [rng.choice(vocab) for _ in range(80)]
    texts += [" ".join(edited(rng, big, 0.02)) for _ in range(40)]  # one large group of near copies
    texts += ["same text again and again here"] * 25  # one large group of copies
    texts += [hot + " " + " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 30))) for _ in range(25)]
    texts += ["", "   ", "one", "ONE", "one two", "One  two", " ", "x " * 3000, None, None, "É é", "é é"]
    return texts


def rows_of(spark, ids, texts, extra=False):
    data = [(i, t, "d") for i, t in zip(ids, texts)]
    return spark.createDataFrame(data, "doc_id long, text string, digest string" if extra else "doc_id long, text string, c string")


def test_shingle_sets_match_brute_force():
    texts = corpus()
    found = list(shingles.sets_of(pa.array(texts), batch_bytes=500))
    assert [len(s) for s in found] == [len(s) for s in brute_sets(texts)]
    by_hash = {}
    for s, b in zip(found, brute_sets(texts)):
        assert by_hash.setdefault(frozenset(b), s.tobytes()) == s.tobytes()
    assert len({v for v in by_hash.values()}) == len(by_hash)


def test_long_words_and_slices():
    texts = ["skip", "a" * 40_000 + " b " + "c" * 70_000, "a" * 40_000 + " b " + "c" * 70_000, "tail words here"]
    sliced = pa.array(texts).slice(1, 2)
    one, two = shingles.sets_of(sliced)
    assert one.tobytes() == two.tobytes() and len(one) == 1


def test_components_match_brute_force(spark):
    texts = corpus()
    ids = [7 * i + 3 for i in range(len(texts))]
    want, sizes = brute_components(ids, texts)
    for extra in (False, True):  # extra columns that clash with names the operator uses
        got = jaccard.jaccard_components(rows_of(spark, ids, texts, extra)).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == want
        assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes
        if not extra:
            assert len(got) == len(texts)


def test_null_ids_repeated_rows_and_empty_table(spark):
    df = rows_of(spark, [5, 5, None, 9], ["a b c d e f", "a b c d e f", "a b c d e f", "a b c d e f"])
    got = sorted(((r["doc_id"] or 0), r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(df).collect())
    assert got == [(0, 2, None), (5, 2, 5), (5, 2, 5), (9, 2, 5)]
    assert jaccard.jaccard_components(df.limit(0)).collect() == []


def test_prefixes_of_linked_sets_meet():
    rng = np.random.default_rng(1)
    ranks = rng.permutation(1 << jaccard.ORDER_BITS).astype(np.int32)
    for _ in range(200):
        n = int(rng.integers(1, 80))
        s = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        cut = np.delete(s, rng.choice(len(s), int(rng.integers(0, len(s) // 4 + 1)), replace=False))
        t = np.unique(np.concatenate((cut, rng.integers(0, 1 << 63, int(rng.integers(0, 3))).astype(np.uint64))))
        both = len(np.intersect1d(s, t))
        if 100 * both >= 75 * (len(s) + len(t) - both):
            assert len(np.intersect1d(jaccard.prefix_of(s, ranks, 75), jaccard.prefix_of(t, ranks, 75)))


def test_components_in_many_shares(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + k) for k in range(1, 200)] + \
        [(rng.randint(2000, 2400), rng.randint(2000, 2400)) for _ in range(250)] + [(5000, 5000)]
    rng.shuffle(edges)
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "u long, v long")
    for share in (40, 1_000_000):
        got = {r["node"]: r["component"] for r in components.connected_components(df, share=share).collect()}
        assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert components.connected_components(df.limit(0)).collect() == []
