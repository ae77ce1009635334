"""Piece sampling: lossless, reproducible, and in the right proportions."""

import collections
import math

import numpy as np
import pytest

from almanac.llm import pieces
from almanac.llm.shingles import mix


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load_vocabulary()


TEXTS = ["", " ", "hello world", "  two  blanks\n\ttab ", "▁ ▁▁x <0x41> <s>", "é日本🤦🏼‍♂️", "x" * 20_000, "\x00\uffff", "a b " * 4000]


def test_lossless(vocabulary):
    lat = pieces.Lattices(vocabulary, 1.0)
    ids, n = pieces.encode_texts(lat, TEXTS * 2, np.arange(2 * len(TEXTS)).astype(np.uint64), chunk=3000)
    ends = np.cumsum(n)
    for t, a, b in zip(TEXTS * 2, ends - n, ends):
        assert pieces.decode_pieces(vocabulary, ids[a:b]).tobytes().decode() == t


def test_sampled_in_proportion(vocabulary):
    word, alpha, segmentations = "therein", 0.5, {}

    def walk(at, ids, log_p):
        if at == len(word):
            segmentations[tuple(ids)] = log_p
        for end in range(at + 1, len(word) + 1):
            i = vocabulary["pieces"].get(word[at:end])
            if i is not None:
                walk(end, [*ids, i], log_p + alpha * vocabulary["log_p"][i])

    walk(0, [], 0.0)
    total, n = sum(map(math.exp, segmentations.values())), 20_000
    ids, sizes = pieces.encode_texts(pieces.Lattices(vocabulary, alpha), [word] * n, mix(np.arange(n).astype(np.uint64)))
    ends = np.cumsum(sizes)
    seen = collections.Counter(tuple(ids[a:b].tolist()) for a, b in zip(ends - sizes, ends))
    assert set(seen) <= set(segmentations)
    assert all(abs(seen[s] / n - math.exp(p) / total) < 0.02 for s, p in segmentations.items())


def test_rows_do_not_depend_on_neighbours(vocabulary):
    seeds = mix(np.arange(len(TEXTS)).astype(np.uint64))
    ids, n = pieces.encode_texts(pieces.Lattices(vocabulary, 1.0), TEXTS, seeds)
    ends = np.cumsum(n)
    for k in (2, 3, 5):
        alone, _ = pieces.encode_texts(pieces.Lattices(vocabulary, 1.0), [TEXTS[k]], seeds[k:k + 1])
        assert alone.tolist() == ids[ends[k] - n[k]:ends[k]].tolist()


def test_dropped_lattices_are_made_again(vocabulary):
    words = [f"{a}{b}ing {b}{a}" for a in "abcdefghij" for b in ("the", "ver", "un", "re")] * 3
    seeds = mix(np.arange(len(words)).astype(np.uint64))
    want = pieces.encode_texts(pieces.Lattices(vocabulary, 0.4), words, seeds)[0]
    lat = pieces.Lattices(vocabulary, 0.4, kept=7)
    got = pieces.encode_texts(lat, words, seeds, chunk=20)[0]
    assert got.tolist() == want.tolist() and len(lat.number) < 20


def test_operator_round_trip(spark):
    rows = [(i, t, [1]) for i, t in enumerate(TEXTS)] + [(50, None, [2]), (None, "no key", [3]), (2, "hello world", [4])]
    df = spark.createDataFrame(rows, "doc_id long, text string, pieces array<int>")
    coded = pieces.encode(df)
    got = coded.collect()
    assert all(r["lossless"] for r in got if r["doc_id"] != 50)
    assert [(r["pieces"], r["lossless"]) for r in got if r["doc_id"] == 50] == [(None, None)]
    assert len({tuple(r["pieces"]) for r in got if r["doc_id"] == 2}) == 1
    assert sorted(map(str, [r["text"] for r in pieces.decode(coded).collect()])) == sorted(str(t) for _, t, _ in rows)
    again = {str(r["doc_id"]): r["pieces"] for r in pieces.encode(df.repartition(3)).collect()}
    assert all(again[str(r["doc_id"])] == r["pieces"] for r in got)
    words = spark.createDataFrame([(1, "segmentation of uncommonly lengthy words " * 20)], "doc_id long, text string")
    one, two = (pieces.encode(words, seed=s, alpha=0.3).first()["pieces"] for s in (1, 2))
    assert one != two
    assert pieces.encode(df.limit(0)).collect() == []
