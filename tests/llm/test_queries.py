"""Registered queries that SQL cannot express, against brute force on the smallest tables."""

import html
import re

import duckdb
import numpy as np
import pandas as pd

import corpus_pipeline
from almanac.llm import mixing, pieces
from almanac.llm.queries import QUERIES
from almanac.llm.util import table
from test_jaccard import brute_components

SF = "/root/testdata/sf0.001"


def test_licence_scan_finds_every_notice(spark):
    found = {(r["doc_id"], r["paragraph"]) for r in QUERIES["op3_license_scan"](spark, SF).collect() if r["confirmed"]}
    notice = re.compile(r"licen[cs]ed under|released under|all rights reserved", re.I)
    want = {(r["doc_id"], i) for r in table(spark, SF, "documents").collect()
            for i, line in enumerate((r["text"] or "").split("\n")) if notice.search(line)}
    assert found == want and want


def test_language_of_every_document(spark):
    rows = QUERIES["op5_language_id"](spark, SF).collect()
    docs = {r["doc_id"]: r for r in table(spark, SF, "documents").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    held = [r for r in rows if r["held_out"]]
    assert 0 < len(held) < len(rows) and sum(docs[r["doc_id"]]["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)


def test_pieces_spell_every_document(spark):
    rows = QUERIES["op6_piece_sampling"](spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    vocabulary = pieces.load_vocabulary()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["lossless"] and r["n_pieces"] == len(r["pieces"])
        assert b"".join(vocabulary["forms"][i] for i in r["pieces"]).decode() == texts[r["doc_id"]]


def test_components_of_every_document(spark):
    docs = table(spark, SF, "documents").collect()
    want, sizes = brute_components([r["doc_id"] for r in docs], [r["text"] for r in docs])
    got = QUERIES["op7_jaccard_join"](spark, SF).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {i: (sizes[i], want[i]) for i in want}


def test_neighbours_of_every_query(spark):
    rows = sorted(table(spark, SF, "embeddings").collect(), key=lambda r: r["vec_id"])
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=np.float64)
    got = pd.DataFrame(QUERIES["op8_nearest_neighbours"](spark, SF).collect(), columns=["q", "rank", "v", "score"])
    hits = 0
    for k in np.flatnonzero(ids % 20 == 0):
        s = x @ x[k]
        s[k] = -np.inf
        own = got[got["q"] == ids[k]].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 21))
        assert np.allclose(own["score"], s[np.searchsorted(ids, own["v"])], atol=1e-12)
        hits += len(set(own["v"]) & set(ids[np.argsort(-s)[:20]].tolist()))
    assert hits >= 0.9 * len(got)


def test_main_text_of_every_page(spark):
    pages = {r["page_id"]: r["html"] for r in table(spark, SF, "pages").collect()}
    rows = QUERIES["op10_html_extraction"](spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:  # the tables' pages hold one article element of headings and paragraphs
        inner = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_pipeline_against_plain_steps(spark):
    docs = table(spark, SF, "documents").toPandas()
    kept = docs[[bool(t) and bool(re.search(r"[^\W\d_]", t)) for t in docs["text"]]]
    component, _ = brute_components(kept["doc_id"].tolist(), kept["text"].tolist())
    kept = kept[[component[i] == i for i in kept["doc_id"]]]
    con = duckdb.connect()
    con.register("documents", kept)
    want = sorted(r[0] for r in con.execute(mixing.oracle_sql()).fetchall())
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == want and want
    texts = dict(zip(kept["doc_id"], kept["text"], strict=True))
    vocabulary = pieces.load_vocabulary()
    assert all(b"".join(vocabulary["forms"][i] for i in r["pieces"]).decode() == texts[r["doc_id"]] for r in got)
