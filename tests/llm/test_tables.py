"""SQL-expressible operators against DuckDB on edge rows, licence scan and fingerprints on small cases."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from almanac.llm import license, mixing, spotsigs, urltree
from almanac.llm.queries import QUERIES, SQL

TEXTS = ["the " * 60_000, "of cat the the " * 20_000 + "the", "| " * 40_000, "The cat of the house is on a mat and it was not to be found for the dog", "the of and to in a is",
         "one", "", "!!!", "a | b | c | d", "Über die Häuser und den Wald ging der Mann mit dem Hund im Regen",
         "Mail me: a.b@c.org for the thing", "x " * 5000, "the cat " * 3000, "All rights reserved.\nthe end of it",
         "The cat of the house is on a mat and it was not to be found for the cat", "日本語 テキスト", "un deux trois le quatre"]


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    docs = [(3 * i + 1, t, ["en", "de", None][i % 3], ["s0", "s0", "s1", None][i % 4], 7) for i, t in enumerate(TEXTS * 3)]
    docs += [(900, None, "en", "s0", 0), (901, "the end of the line is at the door", None, None, 1)]
    write(spark, d, "documents", docs, "doc_id long, text string, lang string, source string, n_chars long")
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/1?x://y", "https://example.net", "ftp://x.net/", "x://org/fr/a",
            "http://b.org/fr/2#t", "http://casino-win.org/en/1", "http://c.example.com/de/", "http://e.com?q=/de/",
            "http://e.com/a/b/c/d/e/f/g/h/i/j/k", "http://net.org/de/7"] + [f"http://h.com/item/{i}/view" for i in range(30)] + \
        [f"http://h.com/{w}/{i}" for w in ("spam", "good", "fine") for i in range(12)] + \
        [f"http://big.org/u/name{i:c}x" for i in range(97, 110)]
    pages = [(i, u, ["<p>x</p>", None, "", f"<p>{i}</p>"][i % 4]) for i, u in enumerate(urls)]
    write(spark, d, "pages", pages, "page_id long, url string, html string")
    write(spark, d, "labels", [(3 * i + 1, i % 2, i % 5 // 4) for i in range(20)] + [(1, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    vectors = [(i, [((i * 7 + j * j) % 23 - 11) / 16 for j in range(64)]) for i in range(130)]
    vectors += [(200, vectors[50][1]), (250, [0.0] * 64), (251, None), (252, [None] * 64), (253, [float("nan")] * 64), (254, [1.0] * 64)]
    write(spark, d, "embeddings", vectors, "vec_id long, embedding array<float>")
    return d


def rounded(v):
    if isinstance(v, float):
        return round(v, 7)
    return [rounded(x) for x in v] if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_duckdb(spark, folder, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    cur = con.execute(SQL[name])
    columns = [c[0] for c in cur.description]
    want = sorted((rounded(list(r)) for r in cur.fetchall()), key=str)
    got = QUERIES[name](spark, folder)
    assert sorted(got.columns) == sorted(columns)
    assert sorted((rounded(list(r)) for r in got.select(*columns).collect()), key=str) == want


@pytest.mark.parametrize("name", ["op1_warc", "op2_source_mix", "op3_license_scan", "op4_url_filter", "op9_fingerprints"])
def test_empty_tables(spark, tmp_path, name):
    write(spark, str(tmp_path), "documents", [], "doc_id long, text string, lang string, source string, n_chars long")
    write(spark, str(tmp_path), "pages", [], "page_id long, url string, html string")
    assert QUERIES[name](spark, str(tmp_path)).collect() == []


def test_raked_shares_meet_their_targets(spark):
    cells = spark.createDataFrame([(s, x, t, 1 + 13 * i, 1) for i, (s, x, t) in enumerate(
        (s, x, t) for s in "abcd" for x in "uv" for t in "pqr")], "source string, lang string, topic string, tokens long, docs long")
    targets = {"source": {"a": 4, "b": 3, "c": 2, "d": 1}, "lang": {"u": 0.5, "v": 0.5}}
    rows = mixing.rake(cells, targets, {"topic": 1.0}, rounds=30).collect()
    for dim, goal in targets.items():
        for value, x in goal.items():
            assert math.isclose(sum(r["raked"] for r in rows if r[dim] == value), x / sum(goal.values()), abs_tol=1e-6)
    for t in "pqr":
        assert math.isclose(sum(r["raked"] for r in rows if r["topic"] == t),
                            sum(r["present"] for r in rows if r["topic"] == t), abs_tol=1e-6)
    rated = mixing.rates(mixing.rake(cells, targets), 0.4).collect()
    assert math.isclose(sum(r["present"] * r["rate"] for r in rated), 0.4, abs_tol=0.03) and all(0 <= r["rate"] <= 1 for r in rated)


def test_mix_is_reproducible_and_keeps_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("rate", F.lit(1)).withColumn("raked", F.lit(2))
    a = mixing.mix(docs, keep=0.5)
    assert set(docs.columns) <= set(a.columns)
    ids = sorted(r["doc_id"] for r in a.collect())
    assert ids == sorted(r["doc_id"] for r in mixing.mix(docs.repartition(5), keep=0.5).collect())
    assert len(set(ids)) == len(ids) and set(ids) < {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_url_templates(spark):
    urls = [f"http://h.com/item/{i}/view" for i in range(30)] + [f"http://h.com/spam/{i}" for i in range(40)] + \
        [f"http://h.com/news/{i}" for i in range(40)]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r["page_id"]: r for r in urltree.filter_urls(df, ()).collect()}
    assert got[0]["template"].endswith("/*/view") and got[0]["verdict"] == "allow" and got[0]["rule"] is None
    assert got[35]["template"] == "/spam/*" and got[35]["verdict"] == "block"
    assert got[80]["verdict"] == "allow"


def test_licence_families(spark):
    rng = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor".split()
    plain = [" ".join(rng[(i + k * k) % len(rng)] for k in range(5 + i % 9)) for i in range(150)]
    noted = {"Apache": "Licensed under the Apache License, Version 2.0.", "MIT": "released under the  MIT license",
             "GPL": "This work is licensed under the GNU General Public License, version 2.",
             "CC-BY-NC": "lorem Licensed under CC BY-NC 3.0. dolor sit", "Reserved": "All rights reserved."}
    rows = [(i, f"{p}\n\n{p}", "x") for i, p in enumerate(plain)] + \
        [(1000 + k, f"{plain[k]}\n{t}\n{plain[k + 1]}", "x") for k, t in enumerate(noted.values())] + [(2000, None, "x"), (2001, "", "x"), (None, noted["MIT"], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words string")
    got = license.scan(docs, license.train(docs, copies=12)).collect()
    found = sorted(((r["doc_id"] or 0), r["paragraph"], r["family"], r["confirmed"]) for r in got)
    assert found == sorted([(1000 + k, 1, f, True) for k, f in enumerate(noted)] + [(0, 0, "MIT", True)])


def test_next_row_over_many_ranges(spark):
    rows = [(i * i - 40 * i, f"t{i}") for i in range(41, 500)] + [(None, "loose")]
    df = spark.createDataFrame(rows, "id long, t string").repartition(5)
    for per_range in (1, 3, 1000):
        got = {r["id"]: r["next_t"] for r in spotsigs.with_next(df, "id", ["t"], ["t"], per_range).collect()}
        ordered = sorted(r for r in rows if r[0] is not None)
        assert got == {a: t for (a, _), (_, t) in zip(ordered, ordered[1:] + ordered[:1])}


def test_fingerprint_edges(spark):
    rows = [(1, "the cat sat on the mat in the house", "a"), (1, "the cat sat on the mat in the house", "a"), (None, "the dog", "a"), (7, None, "b")]
    got = spotsigs.fingerprints(spark.createDataFrame(rows, "doc_id long, text string, sig string")).collect()
    assert len(got) == 4
    loose = next(r for r in got if r["doc_id"] is None)
    assert loose["edited_sha256"] is None and loose["near_next"] is None and loose["fingerprint"]
    assert next(r for r in got if r["doc_id"] == 7)["fingerprint"] == ""
    assert len({r["fingerprint"] for r in got if r["doc_id"] == 1}) == 1
    alone = spotsigs.fingerprints(spark.createDataFrame(rows[:1], "doc_id long, text string, sig string")).collect()
    assert alone[0]["near_next"] == 1.0


def test_similar_documents(spark):
    import random
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(200)]
    docs, sets = [], {}
    for i in range(60):
        if i % 3 == 0:
            base = [w for _ in range(40) for w in ("the", rng.choice(vocab), rng.choice(vocab))]
        docs.append((i, " ".join(rng.choice(vocab) if w != "the" and rng.random() < (0.03 if i % 3 else 0) else w for w in base)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    sets = {r["doc_id"]: set(r["sig"]) for r in spotsigs.with_signatures(frame, "text", "sig").collect()}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b])}
    got = spotsigs.similar(frame, 0.6).collect()
    found = {(min(r["a"], r["b"]), max(r["a"], r["b"])) for r in got}
    same = {frozenset(s): min(i for i in sets if sets[i] == s) for s in sets.values()}
    assert found == {(a, b) for a, b in want if same[frozenset(sets[a])] == a and same[frozenset(sets[b])] == b and sets[a] != sets[b]}


def test_wrapped_licence_notices(spark):
    rng = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor".split()
    plain = [" ".join(rng[(i + k * k) % len(rng)] for k in range(5 + i % 9)) for i in range(150)]
    mit = "# Permission is hereby granted, free of\n# charge, to any person obtaining a\n# copy of this software."
    gpl = ("You can redistribute it\nand/or modify it under\nthe terms of the GNU\nGeneral Public License\nas published by the\n"
           "Free Software\nFoundation.")
    mpl = " * This Source Code Form is subject to the terms\n * of the Mozilla Public License, v. 2.0."
    docs = [(i, f"{p}\n\n{p}") for i, p in enumerate(plain)] + [
        (1000, f"{plain[0]}\n{mit}\n{plain[1]}"), (1001, gpl), (1001, gpl), (None, f"/*\n{mpl}\n */\n\nAll rights reserved.\n{plain[3]}"),
        # a blank line ends a notice
        (1002, "Permission is hereby granted, free of\n\n\n\nperson obtaining a copy")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = license.scan(frame, license.train(frame, copies=12)).collect()
    found = sorted((r["doc_id"] or 0, r["paragraph"], r["family"], r["text"]) for r in got if r["confirmed"])
    assert found == sorted([(1000, 1, "MIT", mit), (1001, 0, "GPL", gpl), (1001, 0, "GPL", gpl), (0, 1, "MPL", mpl),
                            (0, 5, "Reserved", "All rights reserved.")])
    assert not [r for r in got if not r["confirmed"] and r["doc_id"] != 1002]
