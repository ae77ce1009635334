"""The corpus pipeline stage by stage on a small table."""

import corpus_pipeline
from almanac.llm.util import materialise, table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    edge = spark.createDataFrame([(10_001, None, "en", "src0", 0), (10_002, "", None, None, 0), (10_003, "123 456", "en", "src0", 7),
                                  (None, "the end of the line and of it", "en", "src1", 9)], docs.schema)
    docs, seen = docs.unionByName(edge), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = materialise(stage(spark, docs, SF), "test")
        seen.append(docs.count())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    assert seen[0] == 201 and seen[0] > seen[1] > seen[2] == seen[3] > 0
    assert all(r["lossless"] for r in docs.select("lossless").collect())


def test_near_duplicates_keep_the_first(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(4, text, "en", "a", 1), (2, text + " x", "en", "a", 1), (9, "other words here", "en", "a", 1), (9, "other words here", "en", "a", 1),
            (5, "", "en", "a", 1), (6, None, "en", "a", 1), (None, text, "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicate_stage(spark, docs, SF).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["2", "5", "6", "9", "None"]


def test_run_and_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, SF).count() > 0
    table(spark, SF, "documents").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_near_duplicates_are_told_apart_by_id_and_text(spark):
    a = "one two three four five six seven eight nine ten eleven twelve"
    b = "quite another text about the weather of last week in the hills"
    rows = [(3, a, "en", "z", 1), (9, a + " x", "en", "a", 1), (9, b, "en", "a", 1), (9, b, "de", "b", 1), (9, None, "en", "a", 1),
            (12, b + " y", "en", "a", 1), (20, "alone under its id, first", "en", "a", 1), (20, "alone under its id, second", "en", "a", 1),
            (30, a + " z", "en", "a", 1), (30, a + " w", "en", "a", 1), (None, a, "en", "a", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    want = sorted([(3, a, "z"), (9, b, "b"), (9, None, "a"), (20, rows[6][1], "a"), (20, rows[7][1], "a"), (None, a, "a")], key=str)
    for order in (rows, rows[::-1]):
        got = corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(order, schema).repartition(4), SF)
        assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert sorted(((r["doc_id"], r["text"], r["source"]) for r in got.collect()), key=str) == want
    same = [(7, a, lang, "a", 1) for lang in ("fr", "de", "en")]
    got = corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(same, schema).repartition(3), SF).collect()
    assert [(r["doc_id"], r["lang"]) for r in got] == [(7, "de")]
