"""Byte GRU: gradients, held-out accuracy, edge rows."""

import numpy as np
from pyspark.sql import functions as F

from almanac.llm import langid
from almanac.llm.queries import held_out
from almanac.llm.util import table


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    n, k, width, batch = 3, 2, 6, 4
    seq = rng.integers(1, 256, (batch, width)).astype(np.uint8)
    e = rng.normal(0, 0.3, (256, 3 * n))
    u = rng.normal(0, 0.3, (n, 3 * n))
    v = rng.normal(0, 1, (n, k))

    def loss(e, u):
        kept = langid._scan(seq, e, u, range(width))
        return sum(float((s[4] @ v)[:, 0].sum()) for s in kept)

    kept = langid._scan(seq, e, u, range(width))
    d_out = [np.tile(v[:, 0], (batch, 1)) for _ in range(width)]
    grad_e, grad_u = np.zeros_like(e), np.zeros_like(u)
    langid._back(seq, u, kept, d_out, range(width), grad_e, grad_u)
    for i, j in [(0, 0), (1, 4), (2, 8), (0, 7)]:
        step = np.zeros_like(u)
        step[i, j] = 1e-3
        assert abs((loss(e, u + step) - loss(e, u - step)) / 2e-3 - grad_u[i, j]) < 5e-2 * max(1, abs(grad_u[i, j]))


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = langid.fit(docs, ~held_out())
    rows = langid.identify(docs, model).filter(held_out()).collect()
    right = sum(r["lang"] == r["lang_pred"] for r in rows)
    assert len(rows) > 150 and right >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_scores_do_not_depend_on_batching():
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("abcdefgh "), 700)) for _ in range(40)]
    model = langid.train(texts, ["x", "y"] * 20, steps=5)
    together = langid.predict(model, texts, tile=16)
    alone = [langid.predict(model, [t]) for t in texts]
    assert together[0] == [a[0][0] for a in alone]
    assert np.allclose(together[1], [a[1][0] for a in alone], atol=1e-5)


def test_edge_rows(spark):
    rows = [(1, "le la les des", "fr", 1), (2, "the of and to", "en", 1), (3, None, "en", 1), (4, "", None, 1),
            (5, "123 !!", "fr", 1), (None, "le la", None, 1), (2, "the of and to", "en", 1), (7, "the " * 30_000, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int").drop("score")
    model = langid.fit(df, F.lit(True), steps=40)
    got = langid.identify(df, model, keep=("doc_id",)).collect()
    assert len(got) == len(rows)
    assert [(r["lang_pred"], r["score"]) for r in got if r["doc_id"] in (3, 4, 5)] == [("und", 0.0)] * 3
    assert {r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 7)} <= {"en", "fr"}
    assert langid.fit(df.limit(0), F.lit(True)) is None
    assert {r["lang_pred"] for r in langid.identify(df, None).collect()} == {"und"}
    assert langid.identify(df.limit(0), model).collect() == []


def test_number_signs_are_no_letters(spark):
    """A text of digits, fractions, superscripts or Roman numeral signs has no language."""
    rows = [(i, t, None) for i, t in enumerate(["½", "² 3", "Ⅷ", "٣٤", "1_2", "½ a", "ǅ", "ª"])]
    rows += [(10 + i, t, x) for i, (t, x) in enumerate([("le la les", "fr"), ("the of and", "en")] * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in langid.identify(df, langid.fit(df, F.lit(True), steps=10)).collect()}
    assert [got[i]["lang_pred"] == "und" for i in range(8)] == [True] * 5 + [False] * 3
    assert [got[i]["score"] for i in range(5)] == [0.0] * 5


def test_ids_that_repeat_are_sampled(spark):
    """Every row of a language under one id has the same hash: the bound on hashes must not lose the language."""
    rows = [(i, "the of and to", "en") for i in range(300)] + [(k, "le la les des", "fr") for k in (1, 2) for _ in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, F.lit(True), per_lang=3, steps=5)
    assert sorted(model.langs) == ["en", "fr"]
