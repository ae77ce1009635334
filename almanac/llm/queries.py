"""Registered queries of the training-data operators, with DuckDB SQL where SQL can express them.

Each query applies its operator with production parameters to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm import (ann, audit, htmltext, jaccard, langid, license, mixing, pieces, spotsigs, subvectors, threshold,
                         urltree, warc)
from almanac.llm.util import materialise, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return deco


# -------------------------------------------------------------------------------- 1 WARC

@register("op1_warc", """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                  sha1(coalesce(html, '')) AS hex FROM pages),
     d AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS last FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 +
           ((CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS INTEGER), 5) AS BIGINT)
             >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM d""")
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page to seekable bundles, read all bundles back, one row per record read."""
    index = warc.write_bundles(table(spark, sf_dir, "pages"), warc.archive_folder(spark))
    return warc.read_bundles(index, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# -------------------------------------------------------------------------------- 2 source mix

@register("op2_source_mix", mixing.oracle_sql())
def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the corpus's tokens, drawn with rates raked to source, language and topic targets."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    narrow = materialise(mixing.measure(docs).drop("text"), "measured")
    return mixing.sample(narrow).select("doc_id", "source", "lang", F.col("mix_topic").alias("topic"),
                                        F.col("mix_tokens").alias("tokens"), F.round("mix_rate", 9).alias("rate"))


# -------------------------------------------------------------------------------- 3 licence scan

@register("op3_license_scan")
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paragraph of every document that is predicted to be of a licence family."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license.scan(docs, license.train(docs))


# -------------------------------------------------------------------------------- 4 URL filter

URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow"))


@register("op4_url_filter", urltree.oracle_sql(URL_RULES))
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page's url: the longest fitting rule's, else the template tree's."""
    return urltree.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


# -------------------------------------------------------------------------------- 5 language ID

def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


@register("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on the documents that are not held out, predict every document."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, ~held_out())
    found = langid.identify(docs.select("doc_id", "text"), model, keep=("doc_id",))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


# -------------------------------------------------------------------------------- 6 SentencePiece

@register("op6_piece_sampling")
def op6_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled pieces of every document, with their number and whether they decode to its text."""
    coded = pieces.encode(table(spark, sf_dir, "documents"))
    return coded.select("doc_id", F.size("pieces").alias("n_pieces"), "pieces", "lossless")


# -------------------------------------------------------------------------------- 7 N-gram Jaccard join

@register("op7_jaccard_join", jaccard.oracle_sql())
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets have a Jaccard similarity of 0.75 or more."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


# -------------------------------------------------------------------------------- 8 nearest neighbours

@register("op8_nearest_neighbours")
def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    return ann.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)


# -------------------------------------------------------------------------------- 9 fingerprints

@register("op9_fingerprints", spotsigs.ORACLE_SQL)
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SpotSigs fingerprint of every text and of its edited text, with their likeness."""
    return spotsigs.fingerprints(table(spark, sf_dir, "documents"))


# -------------------------------------------------------------------------------- 10 HTML extraction

@register("op10_html_extraction")
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return htmltext.extract_main_text(table(spark, sf_dir, "pages"))


# -------------------------------------------------------------------------------- 11 centroid clustering

@register("op11_centroid_clusters", subvectors.oracle_sql())
def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three exact rounds of 16 integer centroids over every vector of 64 components."""
    return subvectors.cluster(table(spark, sf_dir, "embeddings"))


# -------------------------------------------------------------------------------- 12 exact top-k

@register("op12_exact_topk", threshold.oracle_sql())
def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest integer inner products of every vector whose id is divisible by 50."""
    return threshold.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


# -------------------------------------------------------------------------------- 13 filter audit

@register("op13_filter_audit", audit.oracle_sql())
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from every source's documents in each of their 120 orders."""
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
