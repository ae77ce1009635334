"""Seekable bundles: round trips, random access, duplicates, edge rows."""

import base64
import hashlib
import io

import zstandard

from almanac.llm import warc


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, __url string")


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


ROWS = [(1, "http://a/x", "<p>same</p>", "k"), (2, "http://a/y", "<p>same</p>", "k"), (9, "http://b\r\nX: y", "<p>é ü</p>", "k"),
        (3, None, None, None), (4, "http://c", "", "k"), (5, "u", "x" * 300_000, "k"), (6, "u", "\r\n\r\nWARC/1.1\r\n", "k")]


def test_round_trip(spark, tmp_path):
    index = warc.write_bundles(pages(spark, ROWS), f"file://{tmp_path}/w", frame_bytes=1000, bundle_bytes=2000)
    back = {r["page_id"]: r for r in warc.read_bundles(index).collect()}
    assert sorted(back) == sorted(r[0] for r in ROWS)
    for pid, _, html, _ in ROWS:
        r = back[pid]
        data = (html or "").encode()
        assert r["payload_bytes"] == len(data) and r["payload_digest"] == sha(html)
        if r["record_type"] == "response":
            assert bytes(r["payload"]) == data and r["refers_to"] is None
    assert {k: (r["record_type"], r["refers_to"]) for k, r in back.items()} == {
        1: ("revisit", 2), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None), 5: ("response", None),
        6: ("response", None), 9: ("response", None)}


def test_random_access_and_dedup_limit(spark, tmp_path):
    index = warc.write_bundles(pages(spark, ROWS), f"file://{tmp_path}/w", frame_bytes=1000, dedup_min_bytes=12)
    for r in index.collect():
        head, block = warc.read_record(r["bundle"], r["frame"], r["record_offset"])
        assert head["warc-record-id"] == f"<{r['record_id']}>" and r["record_type"] == "response"
        want = next(x[2] or "" for x in ROWS if x[0] == r["page_id"]).encode()
        assert block.partition(b"\r\n\r\n")[2] == want


def test_frames_are_independent_and_whole_stream_decodes():
    out = io.BytesIO()
    out.close, kept = (lambda: None), out
    w = warc.BundleWriter(kept, frame_bytes=50)
    records = [warc.record_bytes(f"urn:page:{i}", "u", b"p" * i, "D", i, None) for i in range(5)]
    places = [w.add(r) for r in records]
    w.close()
    assert [p[0] for p in places] == list(range(5))
    table = warc.seek_table(kept)
    data = kept.getvalue()
    for (at, packed, plain), r in zip(table, records):
        assert zstandard.ZstdDecompressor().decompress(data[at:at + packed], max_output_size=plain) == r
    stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True)
    assert stream.read() == b"".join(records)


def test_repeated_rows_null_id_and_empty_table(spark, tmp_path):
    df = pages(spark, [(1, "u", "a", "k"), (1, "u", "a", "k"), (None, "u", "b", "k")])
    got = warc.read_bundles(warc.write_bundles(df, f"file://{tmp_path}/w")).collect()
    assert sorted((r["page_id"] or 0, r["record_type"]) for r in got) == [(0, "response"), (1, "response"), (1, "response")]
    assert warc.read_bundles(warc.write_bundles(df.limit(0), f"file://{tmp_path}/e")).collect() == []
