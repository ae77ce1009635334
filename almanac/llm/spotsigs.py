"""SpotSigs document fingerprints, in DataFrame functions only.

A text is lower-cased and cut into words. Common words (articles, conjunctions, prepositions of several
languages) are anchors; each run of anchors spots the two content words that follow. Passages without
anchors (tables, lists, other scripts) are covered by a fixed eighth of all pairs of neighbouring words,
chosen by the pair's own hash, and short texts by all their pairs. Every rule looks at a few words only,
so an edit changes the signatures near it and no others, unless it takes the text across 64 words. The distinct signatures, hashed to 32 bits, are
the text's set; its sorted list is the fingerprint. A text without pairs is its own signature.

Likeness is the Jaccard similarity of two sets. Sets whose sizes alone keep it under the wanted floor
are pruned without being compared; the join of similar documents uses the same bound to partition
documents by set length, so that only neighbouring length classes meet.

Defined results: a null text is empty; an empty text has an empty fingerprint, and two empty ones have
likeness 1; rows with a null id have no place in the order, so their edited columns are null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.util import materialise

#: Anchors: very common function words of English, German, French and Spanish.
ANCHORS = ("the of and to in a is that it for on was be with as at by this are or an he from not had "
           "der die das und ist ein eine zu den von mit im dem auf "
           "le la les de et un une des en que est pour dans qui du "
           "el los y se por con las lo es").split()
#: An anchor word with the blank before it; marks take its place.
ANCHOR = " (?:" + "|".join(ANCHORS) + ")(?= )"
#: Texts with fewer words use all their word pairs.
FEW_WORDS = 64
#: Last hash digits of the word pairs that are used in longer texts: an eighth.
CHOSEN = ("0", "8")
WORD_BREAKS = r"[^\p{L}\p{N}]+"


def _hash(x: Column) -> Column:
    return F.substring(F.md5(x), 1, 8)


def with_signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: the sorted distinct signatures (8 hex digits each) of the text column."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumn("__w", F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(t), WORD_BREAKS, " ")), F.lit(" ")))
    # anchors become marks one by one (a pattern of repeated groups would recurse once an anchor), then runs join
    marked = F.regexp_replace(F.regexp_replace("__w", ANCHOR, "~"), "~+ ", " ~")
    spots = F.regexp_extract_all(marked, F.lit("~(?=([^ ~]+ ~?[^ ~]+))"), F.lit(1))
    pairs = F.transform(F.regexp_extract_all("__w", F.lit(" (?=([^ ]+ [^ ]+))"), F.lit(1)), _hash)
    df = df.withColumn("__p", pairs)
    chosen = F.when(F.size("__p") < FEW_WORDS - 1, F.col("__p")).otherwise(
        F.filter("__p", lambda h: F.substring(h, 8, 1).isin(*CHOSEN)))
    df = df.withColumn("__s", F.concat(F.transform(spots, lambda x: _hash(F.translate(x, "~", ""))), chosen))
    whole = F.when(F.length(t) > 0, F.array(_hash(t))).otherwise(F.array().cast("array<string>"))
    return df.withColumn(out, F.when(F.size("__s") > 0, F.array_sort(F.array_distinct("__s"))).otherwise(whole)).drop(
        "__w", "__p", "__s")


def fingerprint(signatures: str) -> Column:
    """The fingerprint string of a signature set."""
    return F.array_join(signatures, "")


def likeness(a: str, b: str, floor: float = 0.0) -> Column:
    """Jaccard similarity; 0 without comparing when the sizes alone keep it under ``floor``."""
    na, nb = F.size(a), F.size(b)
    both = F.size(F.array_intersect(a, b))
    value = F.when((na == 0) & (nb == 0), 1.0).otherwise(both / (na + nb - both))
    return F.when(F.least(na, nb) < floor * F.greatest(na, nb), 0.0).otherwise(value) if floor > 0 else value


def with_next(df: DataFrame, key: str, carried: list[str], order: list[str], rows_per_range: int = 400) -> DataFrame:
    """Adds ``next_<c>``: each carried column of the next row by ascending key (after the last: the first).

    Rows are dealt to contiguous key ranges whose bounds are keys of the table; the first row of a range
    is also sent to the range before it, so one exchange is enough and no task orders the whole table.
    Bounds are at most 16,384 keys.
    """
    stats = df.agg(F.count(key).alias("n"), F.min(key).alias("least")).first()
    buckets = int(min(16_384, max(1, stats["n"] // rows_per_range)))
    bounds = []
    if stats["n"]:
        cuts = df.agg(F.percentile_approx(key, [i / buckets for i in range(1, buckets)] or [0.5],
                                          max(10_000, 4 * buckets))).first()[0]
        bounds = sorted({stats["least"], *(cuts if buckets > 1 else [])})
    if not bounds:
        bounds = [0]

    def array(values: list[int]) -> Column:
        return F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>")

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= F.col(key))) - 1

    # the range of a key: first among every 64th bound, then among the 64 from there
    ranges, step = array(bounds), 64
    coarse = F.greatest(below(array(bounds[::step])), F.lit(0))
    place = coarse * step + below(F.slice(ranges, coarse * step + 1, step))
    # where a row goes: its own range and, if it opens a range, the range before (the last, for the first)
    own = F.struct(F.col("__at").alias("range"), F.lit(0).alias("wrap"), F.lit(False).alias("extra"))
    before = F.struct(F.pmod(F.col("__at") - 1, F.lit(len(bounds))).cast("int").alias("range"),
                      F.when(F.col("__at") == 0, 1).otherwise(0).alias("wrap"), F.lit(True).alias("extra"))
    opens = F.array_contains(ranges, F.col(key).cast("long"))
    sent = df.filter(F.col(key).isNotNull()).withColumn("__at", place).withColumn(
        "__to", F.explode(F.when(opens, F.array(own, before)).otherwise(F.array(own))))
    w = Window.partitionBy("__range").orderBy("__wrap", key, "__extra", *order)
    sent = sent.withColumn("__range", F.col("__to.range")).withColumn("__wrap", F.col("__to.wrap")).withColumn(
        "__extra", F.col("__to.extra")).drop("__to", "__at")
    sent = sent.withColumn("__next", F.lead(F.struct(*carried)).over(w)).filter("NOT __extra")
    return sent.select(*df.columns, *[F.col(f"__next.{c}").alias(f"next_{c}") for c in carried])


def fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of every text and of its edited text, with their likeness and that to the next text's.

    The edited text has its last quarter replaced by as many characters from the start of the next document.
    """
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    # the set travels as four bytes a signature
    rows = with_signatures(rows, "t", "sig").withColumn("bits", F.unhex(fingerprint("sig"))).drop("sig")
    nxt = with_next(rows, "id", ["t", "bits"], ["t"])
    loose = rows.filter("id IS NULL").select("id", "t", "bits", F.lit(None).cast("string").alias("next_t"),
                                             F.lit(None).cast("binary").alias("next_bits"))
    both = nxt.unionByName(loose)
    for c in ("", "next_"):
        both = both.withColumn(c + "sig", F.regexp_extract_all(F.lower(F.hex(c + "bits")), F.lit("(.{8})"), F.lit(1)))
    n = F.length("t")
    cut = F.floor(n / 4).cast("int")
    both = both.withColumn("edited", F.concat(F.substring("t", F.lit(1), n - cut),
                                              F.substring("next_t", F.lit(1), cut)))
    both = with_signatures(both, "edited", "esig").withColumn(
        "esig", F.when(F.col("edited").isNotNull(), F.col("esig")))
    return both.select(
        F.col("id").alias(key), n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint("sig").alias("fingerprint"), fingerprint("esig").alias("edited_fingerprint"),
        likeness("sig", "esig").alias("near_edited"), likeness("sig", "next_sig").alias("near_next"))


def similar(docs: DataFrame, threshold: float = 0.75, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``a, b, likeness``: pairs of classes (texts with one fingerprint, named by their least id) at the threshold.

    Documents are partitioned by set length: length class i holds sizes within one factor of the
    threshold, so partners lie in the same or the next class. Within a pair of classes, sets meet on the
    signatures of their prefixes (rarest first), are pruned by size and then compared.
    """
    rows = with_signatures(docs.filter(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(text).alias("t")),
                           "t", "sig").filter(F.size("sig") > 0)
    classes = materialise(rows.groupBy("sig").agg(F.min("id").alias("c")), "spots")
    counts = classes.select(F.explode("sig").alias("g")).groupBy("g").agg(F.count("*").alias("df"))
    ranked = classes.select("c", F.size("sig").alias("n"), F.explode("sig").alias("g")).join(counts, "g")
    place = F.row_number().over(Window.partitionBy("c").orderBy("df", "g"))
    prefix = ranked.withColumn("p", place).filter(F.col("p") <= F.col("n") - F.ceil(F.lit(threshold) * F.col("n")) + 1)
    level = F.floor(F.log("n") / F.lit(math.log(1 / threshold)) + 1e-9).cast("int")
    prefix = prefix.withColumn("level", level).filter("df > 1")
    small = prefix.select("g", F.explode(F.array("level", F.col("level") + 1)).alias("level"), F.col("c").alias("a"),
                          F.col("n").alias("na"), F.col("level").alias("la"))
    large = prefix.select("g", "level", F.col("c").alias("b"), F.col("n").alias("nb"))
    met = small.join(large, ["g", "level"]).filter(
        (F.col("na") >= threshold * F.col("nb"))
        & ((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))))
    pairs = met.select("a", "b").distinct()
    sets = classes.select("c", "sig")
    compared = pairs.join(sets.select(F.col("c").alias("a"), F.col("sig").alias("sa")), "a").join(
        sets.select(F.col("c").alias("b"), F.col("sig").alias("sb")), "b")
    return compared.withColumn("likeness", likeness("sa", "sb", threshold)).filter(
        F.col("likeness") >= threshold).select("a", "b", "likeness")


def _sql_signatures(t: str) -> str:
    """The same signature set in DuckDB SQL, for the text expression ``t``."""
    run = "(?: (?:" + "|".join(ANCHORS) + "))+ "
    chosen = ", ".join(f"'{d}'" for d in CHOSEN)
    return f"""(SELECT CASE WHEN len(g) > 0 THEN list_sort(list_distinct(g))
                WHEN length({t}) > 0 THEN [substr(md5({t}), 1, 8)] ELSE [] END
        FROM (SELECT list_transform(spots, lambda x: substr(md5(x), 1, 8)) || CASE WHEN len(pairs) < {FEW_WORDS - 1} THEN pairs
                     ELSE list_filter(pairs, lambda h: substr(h, 8, 1) IN ({chosen})) END AS g
              FROM (SELECT list_transform(range(1, len(w)), lambda i: substr(md5(w[i] || ' ' || w[i + 1]), 1, 8)) AS pairs,
                           list_transform(list_filter(range(1, len(s)), lambda i: s[i][1] = '~' AND length(s[i]) > 1
                                  AND s[i + 1] <> '~'), lambda i: replace(s[i] || ' ' || s[i + 1], '~', '')) AS spots
                    FROM (SELECT string_split(trim(v), ' ') AS w, string_split(trim(
                                     regexp_replace(v, '{run}', ' ~', 'g')), ' ') AS s
                          FROM (SELECT ' ' || trim(regexp_replace(lower({t}), '{WORD_BREAKS}', ' ', 'g')) || ' ' AS v)))))"""


ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
     n AS (SELECT *, coalesce(lead(t) OVER (ORDER BY doc_id), first_value(t) OVER (ORDER BY doc_id)) AS nt FROM d),
     e AS (SELECT *, substr(t, 1, length(t) - length(t) // 4) || substr(nt, 1, length(t) // 4) AS ed FROM n),
     f AS (SELECT *, {_sql_signatures("t")} AS sig, {_sql_signatures("nt")} AS nsig, {_sql_signatures("ed")} AS esig FROM e)
SELECT doc_id, CAST(length(t) AS BIGINT) AS n_chars, sha256(ed) AS edited_sha256,
       array_to_string(sig, '') AS fingerprint, array_to_string(esig, '') AS edited_fingerprint,
       CASE WHEN len(sig) + len(esig) = 0 THEN 1.0 ELSE CAST(len(list_intersect(sig, esig)) AS DOUBLE)
            / (len(sig) + len(esig) - len(list_intersect(sig, esig))) END AS near_edited,
       CASE WHEN len(sig) + len(nsig) = 0 THEN 1.0 ELSE CAST(len(list_intersect(sig, nsig)) AS DOUBLE)
            / (len(sig) + len(nsig) - len(list_intersect(sig, nsig))) END AS near_next
FROM f"""
