"""Licence scan: a trained paragraph classifier, in DataFrame functions and MLlib only.

Every line of a text is a paragraph, and so are neighbouring lines that hold a wrapped notice. Its word uni- and bigrams among those of the licence templates are
the sparse features of a multinomial logistic regression with an L1 penalty; the classes are the licence
families and ``unknown``. It is trained on the templates with words left out and with corpus words around
them, against a bounded sample of corpus paragraphs (``sample_docs`` documents of smallest hash, at most
``sample_lines`` lines). A temperature fitted on a held-out quarter calibrates the probabilities; a
paragraph is ``unknown`` if that class is the likeliest or no family reaches ``min_probability``. A
prediction is confirmed if the paragraph holds enough words of one of the family's templates.

Wrapped notices: neighbouring lines are joined as far as a template can reach (the lines between the
first and the last hold fewer words than the longest template; a line without letters or digits ends
the run). Joined lines are a paragraph if they are confirmed and hold more of a template than any of
them alone; where several do, the most similar counts, and the lines in it no longer count as fragments.

Scoring is a map over the paragraphs of all documents. Only documents that hold enough words of some
template have their lines joined; what is found there is settled by one small exchange, a group a
document. The model (a vocabulary of template n-grams) does not grow with the data.

Defined results: null and empty texts have no paragraphs; a paragraph without letters or digits is unknown;
joined lines have the number of the first, and their text keeps its line breaks.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.util import materialise

UNKNOWN = "unknown"
#: Notices as licences themselves word them.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache": ("Licensed under the Apache License, Version 2.0.",
               "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
               "compliance with the License."),
    "BSD": ("Redistribution and use in source and binary forms, with or without modification, are permitted.",
            "Use of this source code is governed by a BSD-style license."),
    "CC-BY": ("This work is licensed under a Creative Commons Attribution 4.0 International License.",
              "Licensed under CC BY 4.0."),
    "CC-BY-NC": ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
                 "Licensed under CC BY-NC 4.0."),
    "CC-BY-SA": ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
                 "Licensed under CC BY-SA 4.0."),
    "GPL": ("This work is licensed under the GNU General Public License, version 3.",
            "You can redistribute it and/or modify it under the terms of the GNU General Public License as published "
            "by the Free Software Foundation."),
    "MIT": ("Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    "MPL": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "Public-Domain": ("This work is released into the public domain.",
                      "To the extent possible under law, the author has waived all copyright under CC0 1.0 Universal."),
    "Reserved": ("All rights reserved.", "Copyright. All rights reserved."),
}


@dataclass
class LicenceModel:
    families: list[str]  # class order of the regression
    vectorizer: CountVectorizerModel
    regression: object
    temperature: float
    templates: dict[str, tuple[str, ...]]


def words(text: str | Column) -> Column:
    return F.filter(F.split(F.lower(F.col(text) if isinstance(text, str) else text), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def _words(text: str) -> list[str]:
    import re
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def _grams(df: DataFrame) -> DataFrame:
    """Adds ``grams``: the words and word pairs of ``words``."""
    pairs = NGram(n=2, inputCol="words", outputCol="pairs").transform(df)
    return pairs.withColumn("grams", F.concat("words", "pairs")).drop("pairs")


def _variants(templates: dict[str, tuple[str, ...]], around: list[str], copies: int, seed: int) -> list[tuple[str, str]]:
    """Templates whole, with words left out, with other numbers and with corpus words before and after."""
    rng = random.Random(seed)
    out = []
    for family, notices in templates.items():
        for notice in notices:
            base = notice.split()
            for k in range(copies):
                kept = [w for w in base if k == 0 or rng.random() > 0.08] or base
                kept = [str(rng.randint(1, 9)) + ".0" if w[:1].isdigit() and k % 3 == 1 else w for w in kept]
                before = rng.sample(around, min(len(around), rng.randint(0, 8))) if k % 2 else []
                after = rng.sample(around, min(len(around), rng.randint(0, 8))) if k % 4 == 3 else []
                out.append((family, " ".join(before + kept + after)))
    return out


def paragraphs(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id, paragraph, line``: every non-empty line of every text, counted from 0."""
    lines = docs.select(F.col(key).alias("id"), F.posexplode(F.split(F.col(text), "\n")).alias("paragraph", "line"))
    return lines.filter(F.trim("line") != "")


def similarity(word_col: str | Column, templates: tuple[str, ...]) -> Column:
    """Largest share of a template's distinct words that the paragraph holds."""
    shares, held = [], F.col(word_col) if isinstance(word_col, str) else word_col
    for notice in templates:
        own = sorted({w for w in _words(notice) if not w.isdigit()})
        shares.append(F.size(F.array_intersect(held, F.array(*[F.lit(w) for w in own]))) / len(own))
    return F.greatest(*shares) if len(shares) > 1 else shares[0]


def train(docs: DataFrame, *, key: str = "doc_id", text: str = "text", templates: dict[str, tuple[str, ...]] = TEMPLATES,
          sample_docs: int = 400, sample_lines: int = 3000, copies: int = 24, seed: int = 3) -> LicenceModel:
    spark: SparkSession = docs.sparkSession
    # the smallest hashes are found on ids alone; only the documents that have them are then read
    named = docs.select(F.col(key).alias("id"), F.col(text).alias("t")).filter("id IS NOT NULL")
    pick = F.xxhash64("id", F.lit(seed))
    last = named.select(pick.alias("h")).orderBy("h").limit(sample_docs).agg(F.max("h")).first()[0]
    some = named.filter(pick <= F.lit(last)) if last is not None else named.limit(0)
    lines = paragraphs(some, "id", "t").withColumn("words", words("line"))
    close = F.greatest(*[similarity("words", t) for t in templates.values()])
    clean = lines.filter(close < 0.5).orderBy(F.xxhash64("line", "id", "paragraph")).limit(sample_lines).select("line")
    negative = [r["line"] for r in clean.collect()]  # at most sample_lines rows
    around = sorted({w for x in negative[:300] for w in x.split()[:20]}) or ["text"]
    rows = _variants(templates, around, copies, seed) + [(UNKNOWN, x) for x in negative] + [(UNKNOWN, "")] * 8
    families = sorted(templates) + [UNKNOWN]
    data = spark.createDataFrame([(float(families.index(f)), x, i) for i, (f, x) in enumerate(rows)],
                                 "label double, line string, i long").coalesce(1)
    vocabulary = sorted({g for notices in templates.values() for n in notices for w in [_words(n)]
                         for g in w + [f"{a} {b}" for a, b in zip(w, w[1:])]})
    vectorizer = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features", minTF=1.0)
    vectorizer.setBinary(True)
    data = materialise(vectorizer.transform(_grams(data.withColumn("words", words("line")))).select("label", "features", "i"),
                       "licence-training")
    held = F.pmod(F.xxhash64("i", F.lit(seed)), F.lit(4)) == 0
    regression = LogisticRegression(family="multinomial", elasticNetParam=1.0, regParam=3e-4, maxIter=60).fit(
        data.filter(~held).coalesce(1))
    raw = regression.transform(data.filter(held)).select("label", vector_to_array("rawPrediction").alias("raw"))
    grid = [0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0]
    loss = raw.agg(*[F.avg(-F.log(F.greatest(F.element_at(_softmax("raw", t), F.col("label").cast("int") + 1), F.lit(1e-12))))
                     .alias(str(k)) for k, t in enumerate(grid)]).first()
    best = min(range(len(grid)), key=lambda k: (loss[k] if loss[k] is not None else 0.0, abs(grid[k] - 1.0)))
    return LicenceModel(families, vectorizer, regression, grid[best], templates)


def _softmax(raw: str, temperature: float) -> Column:
    top = F.array_max(raw)
    scaled = F.transform(raw, lambda x: F.exp((x - top) / temperature))
    return F.transform(scaled, lambda x: x / F.aggregate(scaled, F.lit(0.0), lambda a, y: a + y))


def _score(lines: DataFrame, model: LicenceModel, min_probability: float) -> DataFrame:
    """Of rows with ``words``, those predicted to be of a family, with ``family``, ``probability`` and ``similarity``."""
    kept = [F.col(c) for c in lines.columns]
    scored = model.regression.transform(model.vectorizer.transform(_grams(lines)))
    scored = scored.select(*kept, vector_to_array("rawPrediction").alias("raw"))
    unknown = len(model.families)  # its place, from 1
    top = F.array_position("raw", F.array_max("raw")).cast("int")
    found = scored.withColumn("top", top).filter(F.col("top") != unknown)
    found = found.withColumn("probability", F.array_max(_softmax("raw", model.temperature))).filter(
        F.col("probability") >= min_probability)
    family = F.element_at(F.array(*[F.lit(f) for f in model.families]), F.col("top"))
    return found.withColumn("family", family).withColumn("similarity", _family_similarity("words", model))


def _family_similarity(word_col: str | Column, model: LicenceModel) -> Column:
    """Similarity to the templates of the family at place ``top``."""
    alike = None
    for k, f in enumerate(model.families[:-1]):
        hit, value = F.col("top") == k + 1, similarity(word_col, model.templates[f])
        alike = F.when(hit, value) if alike is None else alike.when(hit, value)
    return alike


def _spans(docs: DataFrame, longest: int) -> DataFrame:
    """``row, id, start, span``: the lines of every run of neighbouring lines that a notice of ``longest`` words can fill.

    ``docs`` has ``row, id, lines`` and ``counts``, the words of each line. Every line that is not empty is a run of one.
    """
    def reach(counts: Column) -> Column:
        """Lines of the longest run that starts with the first count: 1 plus those taken from the others."""
        start = F.struct(F.lit(1).alias("lines"), F.lit(0).alias("between"), (F.get(counts, F.lit(0)) > 0).alias("open"))

        def take(state: Column, n: Column) -> Column:
            more = state["open"] & (n > 0) & (state["between"] < longest)
            return F.struct((state["lines"] + more.cast("int")).alias("lines"), (state["between"] + n).alias("between"),
                            more.alias("open"))
        return F.aggregate(F.slice(counts, 2, longest), start, take, lambda state: state["lines"])

    def ahead(i: Column) -> Column:
        return F.slice("lines", i + 1, reach(F.slice("counts", i + 1, longest + 1)))

    runs = docs.select("row", "id", F.posexplode(F.transform("lines", lambda _, i: ahead(i))).alias("start", "run"))
    return runs.select("row", "id", "start", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("run")), lambda k: F.slice("run", 1, k))).alias("span")).filter(
        F.trim(F.get("span", F.lit(0))) != "")


def _settle(found: DataFrame) -> DataFrame:
    """Of the paragraphs found in each ``row``, those that stand: confirmed ones by similarity, then other lines.

    Paragraphs of one family do not overlap, joined lines of two families share one line at most, and a line that is
    not confirmed stands only outside of joined lines.
    """
    item = F.struct((~F.col("confirmed")).alias("weak"), (-F.col("similarity")).alias("by"), "size", (-F.col("probability")).alias("then"), "start",
                    "family", "probability", "similarity", "confirmed", "line")
    grouped = found.groupBy("row", "id").agg(F.array_sort(F.collect_list(item)).alias("items"))

    def clash(x: Column, y: Column) -> Column:
        """Whether y, which stands, rules x out."""
        common = F.least(x["start"] + x["size"], y["start"] + y["size"]) - F.greatest(x["start"], y["start"])
        joined = (x["size"] > 1) & (y["size"] > 1)
        return (common > 0) & ((x["family"] == y["family"]) | (x["weak"] & (y["size"] > 1)) | (joined & (common > 1)))

    stands = F.aggregate("items", F.slice("items", 1, 0), lambda taken, x: F.when(
        F.exists(taken, lambda y: clash(x, y)), taken).otherwise(F.concat(taken, F.array(x))))
    return grouped.select("id", F.explode(stands).alias("x")).select(
        "id", F.col("x.start").alias("paragraph"), *[f"x.{c}" for c in ("family", "probability", "similarity", "confirmed", "line")])


def scan(docs: DataFrame, model: LicenceModel, *, key: str = "doc_id", text: str = "text", min_probability: float = 0.5,
         min_similarity: float = 0.6) -> DataFrame:
    """One row a paragraph that is predicted to be of a licence family."""
    notices = [n for own in model.templates.values() for n in own]
    everything = F.array(*[F.lit(w) for w in sorted({w for n in notices for w in _words(n)})])
    holds = F.coalesce(similarity("__held", tuple(notices)) >= min_similarity, F.lit(False))
    named = docs.select(F.col(key).alias("id"), F.col(text).alias("t"))
    told = named.withColumn("__held", F.array_intersect(words("t"), everything)).withColumn("__holds", holds)
    plain = paragraphs(told.filter("NOT __holds"), "id", "t").withColumn("words", words("line"))
    plain = _score(plain, model, min_probability).withColumn("confirmed", F.col("similarity") >= min_similarity)
    # rows are numbered before they are written, as ids may repeat
    near = told.filter("__holds").select(F.monotonically_increasing_id().alias("row"), "id", F.split("t", "\n").alias("lines"))
    near = materialise(near.withColumn("counts", F.transform("lines", lambda x: F.size(words(x)))), "licence-texts")
    spans = _spans(near, max(len(_words(n)) for n in notices)).withColumn("size", F.size("span")).withColumn(
        "line", F.array_join("span", "\n")).withColumn("words", words("line"))
    spans = spans.filter((F.col("size") == 1) | (similarity(F.array_intersect("words", everything), tuple(notices)) >= min_similarity))
    found = _score(spans, model, min_probability).withColumn("confirmed", F.col("similarity") >= min_similarity)
    alone = F.array_max(F.transform("span", lambda x: _family_similarity(words(x), model)))
    found = found.filter((F.col("size") == 1) | (F.col("confirmed") & (F.col("similarity") > alone)))
    columns = ["id", "paragraph", "family", "probability", "similarity", "confirmed", "line"]
    return plain.select(*columns).unionByName(_settle(found).select(*columns)).select(
        F.col("id").alias(key), *columns[1:-1], F.col("line").alias("text"))
