"""Corpus pipeline: documents -> language ID -> near duplicates -> source mix -> piece sampling.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and reread as the next stage's ``docs``. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm import jaccard, langid, mixing, pieces
from almanac.llm.queries import held_out
from almanac.llm.util import materialise, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep every document whose text has a language; null texts and texts without letters go."""
    model = langid.fit(docs, ~held_out())
    return langid.identify(docs, model).filter("lang_pred <> 'und'").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies stays: the one of smallest id, then text digest.

    Rows are told apart by id and text: an unrelated text under the same id is a document of its own. Rows without
    an id and texts without words are in no group and stay.
    """
    digest = F.coalesce(F.md5("text"), F.lit(""))
    named = docs.withColumn("__digest", digest)
    several = named.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("__digest").alias("lo"), F.max("__digest").alias("hi")).filter("lo < hi").select(F.col("doc_id").alias("__id"))
    several = materialise(several, "repeated-ids")
    if several.isEmpty():  # every id names one text
        found = jaccard.jaccard_components(docs)
        drop = found.filter("component_id < doc_id").select(F.col("doc_id").alias("__copy")).distinct()
        kept = named.join(drop, F.col("doc_id") == F.col("__copy"), "left_anti")
    else:  # texts that share an id are nodes of their own, named by a 64-bit hash
        named = named.join(several, F.col("doc_id") == F.col("__id"), "left").withColumn("__node", F.when(
            F.col("__id").isNull(), F.col("doc_id").cast("long")).otherwise(F.xxhash64("doc_id", "__digest"))).drop("__id")
        found = jaccard.jaccard_components(named.select("__node", "text"), key="__node").select("__node", "component_id")
        names = named.filter("doc_id IS NOT NULL").select("__node", "doc_id", "__digest").distinct()
        members = materialise(found.distinct().join(names, "__node"), "members")
        first = members.groupBy(F.col("component_id").alias("__c")).agg(
            F.min(F.struct("doc_id", "__digest", "__node")).alias("first"))
        drop = members.join(first, F.col("component_id") == F.col("__c")).filter(
            F.col("first.__node") != F.col("__node")).select(F.col("__node").alias("__copy"))
        kept = named.join(drop, F.col("__node") == F.col("__copy"), "left_anti")
    # rows of one id and text: the least of them stays
    others = [c for c in docs.columns if c not in ("doc_id", "text")] + ["text"]
    least = kept.filter("doc_id IS NOT NULL").groupBy("doc_id", "__digest").agg(
        F.min(F.struct(*[F.col(c) for c in others])).alias("__row"))
    once = least.select("doc_id", *[F.col("__row")[c].alias(c) for c in others]).select(*docs.columns)
    return kept.filter("doc_id IS NULL").select(*docs.columns).unionByName(once)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Half of the tokens, drawn with rates raked to the source, language and topic targets."""
    return mixing.mix(docs).select(*docs.columns)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled pieces of every remaining document. Fewer lattices are kept: the workers of earlier stages live on."""
    return pieces.encode(docs, keep=("doc_id", "lang", "source"), kept_units=60_000)


STAGES = [("language ID", language_stage), ("near duplicates", near_duplicate_stage), ("source mix", mix_stage),
          ("piece encoding", encode_stage)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"stage{k}")
    return docs
