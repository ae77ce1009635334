"""Mixing sources to target weights by iterative proportional fitting, in DataFrame functions only.

Documents are counted into cells (source, language, topic) with one aggregate of their token weights.
The cell table is raked: its weights are scaled in turn so that the sums by source, by language and by
topic meet their targets, for a fixed number of rounds. A document's sampling rate is its cell's raked share over
its present share, times the part of the corpus wanted; rates above 1 are taken whole and the others
scaled up for what that leaves out, so clipped cells miss the targets. The draw compares the rate with a hash of the document's id, so it
is the same on every run and for every partitioning.

Targets are given by value; a dimension without given targets uses its present shares raised to a power
(below 1 this moves weight from large sources to small ones) and normalised. Weight of values without a
target is raked to zero; targets without any weight are left out and the others normalised.

Defined results: null dimension values are a value of their own; null texts weigh 0 and keep their cell's
rate; a corpus without tokens has rate 0 everywhere; rows with a null id draw by their text's hash.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.util import materialise

ROUNDS = 12
TRIMS = 4
DIMENSIONS = ("source", "lang", "topic")
#: Default powers of the present shares that serve as targets.
POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.8}
KEEP = 0.5
SEED = "mix-1"
#: A text's topic is the first whose pattern it holds; else ``prose``. Patterns work alike in Java and RE2.
TOPICS = (("legal", r"[Ll]icen[cs]ed? under|[Aa]ll rights reserved|[Rr]eleased under"),
          ("contact", r"@[A-Za-z0-9-]+\.[A-Za-z]"),
          ("tabular", r" \| [^|]+ \| "))


def topic(text: str) -> Column:
    found = None
    for name, pattern in TOPICS:
        hit = F.col(text).rlike(pattern)
        found = F.when(hit, name) if found is None else found.when(hit, name)
    return found.otherwise("prose")


def tokens(text: str) -> Column:
    """Token weight of a text: its words, counted as blanks between them plus one."""
    t = F.trim(F.coalesce(F.col(text), F.lit("")))
    return F.when(F.length(t) == 0, 0).otherwise(F.length(t) - F.length(F.translate(t, " \n\t", "")) + 1).cast("long")


def cells(docs: DataFrame, weight: str, dims: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """Token weight and number of documents of every cell."""
    return docs.groupBy(*dims).agg(F.sum(weight).alias("tokens"), F.count("*").alias("docs"))


def rake(table: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None,
         powers: Mapping[str, float] = POWERS, rounds: int = ROUNDS, dims: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """Cells with ``present`` and ``raked`` shares. The table is one row a cell, never the documents."""
    targets = targets or {}
    everything = Window.partitionBy(F.lit(1))
    now = table.withColumn("present", F.col("tokens") / F.nullif(F.sum("tokens").over(everything), F.lit(0)))
    now = now.withColumn("present", F.coalesce("present", F.lit(0.0)))
    for d in dims:
        own = F.sum("present").over(Window.partitionBy(d))
        if d in targets:
            goal = F.coalesce(*[F.when(F.col(d).eqNullSafe(F.lit(v)), F.lit(float(x))) for v, x in targets[d].items()],
                              F.lit(0.0))
        else:
            goal = F.when(own > 0, F.pow(own, F.lit(float(powers.get(d, 1.0))))).otherwise(0.0)
        now = now.withColumn(f"__own_{d}", own).withColumn(f"__goal_{d}", F.when(F.col(f"__own_{d}") > 0, goal).otherwise(0.0))
        first = F.row_number().over(Window.partitionBy(d).orderBy(*dims)) == 1
        now = now.withColumn("__first", first)
        total = F.sum(F.when(F.col("__first"), F.col(f"__goal_{d}")).otherwise(0.0)).over(everything)
        now = now.withColumn("__total", total).withColumn(
            f"__goal_{d}", F.coalesce(F.col(f"__goal_{d}") / F.nullif(F.col("__total"), F.lit(0.0)), F.lit(0.0)))
    now = materialise(now.withColumn("raked", F.col("present")).drop("__first", "__total"), "cells")
    for k in range(rounds):
        for d in dims:
            share = F.sum("raked").over(Window.partitionBy(d))
            now = now.withColumn("__sum", share).withColumn("raked", F.when(
                F.col("__sum") > 0, F.col("raked") * F.col(f"__goal_{d}") / F.col("__sum")).otherwise(0.0))
        if k % 4 == 3 or k == rounds - 1:
            now = materialise(now.drop("__sum"), "cells")
    return now.select(*table.columns, "present", "raked")


def rates(raked: DataFrame, keep: float = KEEP, trims: int = TRIMS) -> DataFrame:
    """Cells with ``rate``: the probability of taking each document, so that about ``keep`` of all tokens stay."""
    everything = Window.partitionBy(F.lit(1))
    ratio = F.when(F.col("present") > 0, F.col("raked") / F.col("present")).otherwise(0.0)
    now = raked.withColumn("__ratio", ratio).withColumn("rate", F.least(F.lit(1.0), keep * F.col("__ratio")))
    for _ in range(trims):  # share the part that full cells could not give among the others
        full = F.col("rate") >= 1.0
        taken = F.sum(F.when(full, F.col("present")).otherwise(0.0)).over(everything)
        rest = F.sum(F.when(full, 0.0).otherwise(F.col("raked"))).over(everything)
        now = now.withColumn("__taken", taken).withColumn("__rest", rest)
        scale = (F.lit(float(keep)) - F.col("__taken")) / F.col("__rest")
        now = now.withColumn("rate", F.when(F.col("rate") >= 1.0, 1.0).when(
            (F.col("__rest") > 0) & (F.col("__taken") < keep),
            F.least(F.lit(1.0), F.greatest(F.col("rate"), F.col("__ratio") * scale))).otherwise(F.col("rate")))
    return now.drop("__ratio", "__taken", "__rest")


def draw(key: str, text: str, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the row's id (or text) and the seed only."""
    name = F.coalesce(F.col(key).cast("string"), F.md5(F.coalesce(F.col(text), F.lit(""))))
    return F.conv(F.substring(F.md5(F.concat(name, F.lit(":" + seed))), 1, 12), 16, 10).cast("double") / float(1 << 48)


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds what mixing needs of a row: ``mix_topic``, ``mix_tokens`` and ``mix_draw``."""
    return docs.withColumns({"mix_topic": topic(text), "mix_tokens": tokens(text), "mix_draw": draw(key, text)})


def sample(measured: DataFrame, keep: float = KEEP, targets: Mapping[str, Mapping[str, float]] | None = None,
           powers: Mapping[str, float] = POWERS) -> DataFrame:
    """The rows of a measured table that are drawn, with their ``mix_rate``.

    ``measured`` is read twice (cells, draw), so a narrow table of it is best written first.
    """
    named = measured.select(F.col("source"), F.col("lang"), F.col("mix_topic").alias("topic"), "mix_tokens")
    table = materialise(cells(named, "mix_tokens"), "cells")
    rated = materialise(rates(rake(table, targets, powers), keep), "rates").select(
        F.col("source").alias("__s"), F.col("lang").alias("__l"), F.col("topic").alias("__t"), F.col("rate").alias("mix_rate"))
    # one row a cell: Spark broadcasts it while its size allows, else a splittable equi-join by cell
    joined = measured.join(
        rated, F.col("source").eqNullSafe(F.col("__s")) & F.col("lang").eqNullSafe(F.col("__l"))
        & (F.col("mix_topic") == F.col("__t")))
    return joined.filter("mix_draw < mix_rate").drop("__s", "__l", "__t")


def mix(docs: DataFrame, *, key: str = "doc_id", text: str = "text", keep: float = KEEP,
        targets: Mapping[str, Mapping[str, float]] | None = None, powers: Mapping[str, float] = POWERS) -> DataFrame:
    """The sampled rows of ``docs``, all their columns, with ``mix_topic``, ``mix_tokens`` and ``mix_rate``."""
    return sample(measure(docs, key, text), keep, targets, powers).drop("mix_draw")


def oracle_sql(keep: float = KEEP) -> str:
    """The same sample in DuckDB SQL over the ``documents`` view."""
    cases = " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{n}'" for n, p in TOPICS)
    out = [f"""
WITH d AS (SELECT doc_id, source, lang, CASE {cases} ELSE 'prose' END AS topic,
                  trim(coalesce(text, ''), ' ') AS t, coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, ''))) AS name
           FROM documents),
     w AS (SELECT doc_id, source, lang, topic, name, CAST(CASE WHEN length(t) = 0 THEN 0 ELSE
                  length(t) - length(translate(t, ' ' || chr(10) || chr(9), '')) + 1 END AS BIGINT) AS tokens FROM d),
     c AS (SELECT source, lang, topic, sum(tokens) AS tokens FROM w GROUP BY ALL),
     r0 AS (SELECT *, coalesce(tokens / nullif(sum(tokens) OVER (), 0), 0.0) AS present FROM c)"""]
    goals = []
    for d in DIMENSIONS:
        out.append(f"""
     g_{d} AS (SELECT {d} AS v, CASE WHEN sum(present) > 0 THEN pow(sum(present), {POWERS[d]}) ELSE 0.0 END AS x
               FROM r0 GROUP BY {d})""")
        goals.append(f"(SELECT coalesce(x / nullif((SELECT sum(x) FROM g_{d}), 0.0), 0.0) FROM g_{d} "
                     f"WHERE v IS NOT DISTINCT FROM {d}) AS goal_{d}")
    out.append(f"""
     s0 AS (SELECT *, present AS raked, {", ".join(goals)} FROM r0)""")
    k = 0
    for _ in range(ROUNDS):
        for d in DIMENSIONS:
            out.append(f"""
     s{k + 1} AS (SELECT * REPLACE (CASE WHEN sum(raked) OVER (PARTITION BY {d}) > 0 THEN
                  raked * goal_{d} / sum(raked) OVER (PARTITION BY {d}) ELSE 0.0 END AS raked) FROM s{k})""")
            k += 1
    out.append(f"""
     q0 AS (SELECT source, lang, topic, present, raked, CASE WHEN present > 0 THEN raked / present ELSE 0.0 END AS ratio,
                   least(1.0, {keep} * CASE WHEN present > 0 THEN raked / present ELSE 0.0 END) AS rate FROM s{k})""")
    for i in range(TRIMS):
        out.append(f"""
     q{i + 1} AS (SELECT * EXCLUDE (taken, rest) REPLACE (CASE WHEN rate >= 1.0 THEN 1.0 WHEN rest > 0 AND taken < {keep}
                  THEN least(1.0, greatest(rate, ratio * ({keep} - taken) / rest)) ELSE rate END AS rate)
                  FROM (SELECT *, sum(CASE WHEN rate >= 1.0 THEN present ELSE 0.0 END) OVER () AS taken,
                               sum(CASE WHEN rate >= 1.0 THEN 0.0 ELSE raked END) OVER () AS rest FROM q{i}))""")
    out.append(f"""
     z AS (SELECT w.*, rate, CAST(CAST('0x' || substr(md5(name || ':{SEED}'), 1, 12) AS BIGINT) AS DOUBLE)
                  / {float(1 << 48)} AS u
           FROM w JOIN q{TRIMS} q ON w.source IS NOT DISTINCT FROM q.source AND w.lang IS NOT DISTINCT FROM q.lang
                AND w.topic = q.topic)
SELECT doc_id, source, lang, topic, tokens, round(rate, 9) AS rate FROM z WHERE u < rate""")
    return ",".join(out)
