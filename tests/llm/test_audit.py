"""Filter audit: the transducer against plain Python, the counts against brute force and DuckDB."""

import re
from itertools import permutations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from almanac.llm import audit

TEXTS = ["", None, "one", "A b a A", "x\x0by\x0cz\x85w v", "日本語 テキスト 日本語", "É É é Ü", "a\x00b a\x00b a", "#$%&*| CAPS CAPS",
         " lead  and trail \n", "w " * 60, "w" * 70 + " " + "w" * 70 + " " + "w" * 71, " ".join(f"u{i}" for i in range(55)),
         "😀 😀 B", "\t\n\r ", "same " * 49 + "same", "Ab " * 51]


def plain(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0D]+", text) if w]
    return (len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text)))


def measured(texts):
    return [tuple(int(v) for v in row) for row in zip(*audit.measure_texts(pa.array(texts, pa.string())), strict=True)]


def test_transducer_on_known_texts():
    texts = [t or "" for t in TEXTS]
    assert measured(texts) == [plain(t) for t in texts]
    assert measured(texts[4:9]) == [plain(t) for t in texts[4:9]]
    sliced = pa.array(texts, pa.large_string()).slice(3, 7)
    assert [tuple(map(int, r)) for r in zip(*audit.measure_texts(sliced))] == [plain(t) for t in texts[3:10]]
    assert measured([]) == [] and measured(["", ""]) == [plain("")] * 2


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAb \t\n#é日😀\x0b\x1c"), max_size=120), max_size=8))
def test_transducer_on_any_text(texts):
    assert measured(texts) == [plain(t) for t in texts]


def test_hits_of_the_table_are_verified(monkeypatch):
    """With one hash for every word, equal bytes alone decide."""
    monkeypatch.setattr(audit, "span_hashes", lambda data, begin, size, salt: np.full(len(begin), 7, dtype=np.uint64))
    texts = ["ab ba ab abc", "ab ab", "x" * 80 + " " + "x" * 79 + "y " + "x" * 80]
    assert measured(texts) == [plain(t) for t in texts]


def test_long_texts_are_measured_in_pieces(monkeypatch):
    rng = np.random.default_rng(3)
    text = "".join(rng.choice(list("abcA \n日#"), size=30_000)) + "z" * 70_000 + " end"
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    for piece in (64, 1000, 10 ** 6):
        assert audit.measure_long(raw, piece) == plain(text)
    monkeypatch.setattr(audit, "SLICE_BYTES", 512)
    batch = pa.RecordBatch.from_arrays([pa.array([text, "a", "b " * 200, "c", text])], names=["t"])
    got = [tuple(map(int, r)) for b in audit.text_slices(batch, 0) for r in zip(*audit.measure_texts(b.column(0)))]
    assert got == [plain(t) for t in batch.column(0).to_pylist()]


def brute(docs, labels):
    """Every order applied to the rows themselves."""
    def fails(i, text):
        words, distinct, caps, points, symbols = plain(text)
        found = {"A": words < 50, "B": 100 * distinct < 65 * words, "C": 100 * caps > 5 * points, "D": symbols > 0,
                 "E": i is not None and any(j is not None and j < i and (t or "") == (text or "") for j, t, *_ in docs)}
        return {f for f in found if found[f]}
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = [(i, s or "", fails(i, t)) for i, t, s in docs]
    out = {}
    for part in {s for _, s, _ in rows}:
        own = [(i, f) for i, s, f in rows if s == part]
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [(i, f) for i, f in left if letter in f]
                left = [(i, f) for i, f in left if letter not in f]
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(letter in f for _, f in own) - len(gone), sum(f == {letter} for _, f in own),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
    shapley = {}
    for (part, order, step), v in out.items():
        shapley[part, order[step - 1]] = shapley.get((part, order[step - 1]), 0) + v[1]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def rows_of():
    docs = [(3 * i, t, ["s0", "s0", "s1", None, ""][i % 5]) for i, t in enumerate(TEXTS * 2)]
    docs += [(500 + i, "one common text", "s0") for i in range(40)] + [(10_000, "w " * 60, "s2")]
    docs += [(None, "one", "s1"), (None, None, None), (6, "A b a A", "s1"), (6, "one", "s0"), (6, "one", "s0")]
    labels = [(3 * i, i % 2, i % 3 // 2) for i in range(20)] + [(0, 1, None), (3, None, 1), (501, 1, 1), (None, 1, 1), (99_999, 1, 1)]
    return docs, labels


@pytest.fixture(scope="module")
def frames(spark):
    docs, labels = rows_of()
    return (spark.createDataFrame([(*d, 1, 2, 3) for d in docs], "doc_id long, text string, source string, mask int, n int, id int").repartition(4),
            spark.createDataFrame([(*x, "a") for x in labels], "doc_id long, quality int, toxic int, part string"))


def test_against_brute_force(frames):
    got = audit.audit(*frames)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                           "toxic_lost", "shapley"]
    rows = got.collect()
    found = {tuple(r[:3]): tuple(r[3:]) for r in rows}
    assert found == brute(*rows_of()) and len(rows) == len(found) == 600 * 4


def test_against_duckdb(frames, tmp_path):
    con = duckdb.connect()
    for name, frame in zip(("documents", "labels"), frames):
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    assert sorted(con.execute(audit.oracle_sql()).fetchall()) == sorted(map(tuple, audit.audit(*frames).collect()))


def test_empty_tables(spark, frames):
    none = frames[0].limit(0)
    assert audit.audit(none, frames[1]).collect() == []
    assert {r["good_lost"] for r in audit.audit(frames[0], frames[1].limit(0)).collect()} == {0}
