"""URL filter: rules first, then a path-template tree per host, in DataFrame functions only.

Every host has a tree of path segments. Level by level, a node's variable segments (numbers, long
hexadecimal names, or a node with many rare children) become the wildcard ``*``, and branches whose
labelled share of bad urls does not differ from their node's (two-proportion z test) are merged into
the wildcard as well. What is left is a path's template. A template's purity is its share of bad among
labelled urls, smoothed with its host's, which is smoothed with the whole table's; a template above the
limit is rejected. Where rules fit a url, the longest decides and the tree does not.

All statistics come from one aggregate over (host, path) and small aggregates of it; a host with a third
of all urls is spread by path before it is ever joined, and the joins are splittable equi-joins.

Defined results: a null url, or one without ``://``, has an empty host and path; null labels count as
unlabelled; a template without labelled urls has its host's smoothed purity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.llm.util import materialise

MAX_DEPTH = 8
#: A node with at least MANY distinct children, met fewer than RARE times each on average, is variable.
MANY, RARE = 8, 3
Z = 1.96
PRIOR = 2.0
LIMIT = 0.5
#: Words that mark a host or path as bad; they label urls for learning, they do not decide a verdict.
BAD_WORDS = ("adult bet bets betting casino porn poker sex slots spam viagra warez xxx").split()
VARIABLE = r"^(?:\d+(?:\.\w{1,5})?|[0-9a-fA-F]{8,}|[0-9a-fA-F-]{32,})$"

Rule = tuple[str, str, str]  # host, path, verdict


def parse(url: str) -> tuple[Column, Column]:
    """Host and path of a url column."""
    u = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (size, rule, verdict) of the longest rule that fits, or null."""
    found = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                    F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
             for h, p, v in rules]
    if not found:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    return F.array_max(F.filter(F.array(*found), lambda x: x.isNotNull()))


def word_labels(host: Column, path: Column, words: Sequence[str] = BAD_WORDS) -> Column:
    """1 where a word of the host or path is a bad one, else 0."""
    text = F.concat(host, F.lit("/"), F.lower(path))
    return F.arrays_overlap(F.split(text, "[^a-z0-9]+"), F.array(*[F.lit(w) for w in words])).cast("int")


def template_tree(paths: DataFrame) -> DataFrame:
    """``host, path, template, purity`` for distinct (host, path) rows with counts ``n`` (urls), ``seen``, ``bad`` (labelled)."""
    segments = F.filter(F.split("path", "/"), lambda x: x != "")
    # what lies below the last level stays one segment
    deep = F.concat(F.slice("segs", 1, MAX_DEPTH - 1), F.array(F.array_join(F.slice("segs", MAX_DEPTH, 1_000_000), "/")))
    now = paths.withColumn("segs", segments).withColumn(
        "segs", F.when(F.size("segs") > MAX_DEPTH, deep).otherwise(F.col("segs"))).withColumn("template", F.lit(""))
    now = materialise(now, "paths")
    depth = now.agg(F.max(F.size("segs"))).first()[0] or 0
    for k in range(depth):
        here = now.filter(F.size("segs") > k).withColumn("seg", F.element_at("segs", k + 1))
        kids = here.groupBy("host", "template", "seg").agg(*[F.sum(c).alias(c) for c in ("n", "seen", "bad")])
        nodes = kids.groupBy(F.col("host").alias("h"), F.col("template").alias("t")).agg(
            F.count("*").alias("kids"), F.sum("n").alias("all_n"), F.sum("seen").alias("all_seen"), F.sum("bad").alias("all_bad"))
        share = F.col("all_bad") / F.col("all_seen")
        spread = F.sqrt(share * (1 - share) / F.col("seen"))
        alike = (F.col("kids") > 1) & ((F.col("seen") == 0) | (F.abs(F.col("bad") / F.col("seen") - share) <= Z * spread))
        variable = F.col("seg").rlike(VARIABLE) | ((F.col("kids") >= MANY) & (F.col("all_n") < RARE * F.col("kids")))
        named = kids.join(nodes, (F.col("host") == F.col("h")) & (F.col("template") == F.col("t"))).select(
            "h", "t", F.col("seg").alias("s"), F.when(variable | F.coalesce(alike, F.lit(True)), "*").otherwise(
                F.col("seg")).alias("name"))
        joined = now.withColumn("seg", F.when(F.size("segs") > k, F.get("segs", F.lit(k)))).join(
            named, (F.col("host") == F.col("h")) & (F.col("template") == F.col("t")) & (F.col("seg") == F.col("s")), "left")
        now = materialise(joined.withColumn("template", F.when(F.col("name").isNotNull(), F.concat(
            "template", F.lit("/"), "name")).otherwise(F.col("template"))).select(*now.columns), "paths")
    host = now.groupBy(F.col("host").alias("h")).agg(F.sum("seen").alias("hs"), F.sum("bad").alias("hb"))
    every = now.agg(F.coalesce(F.sum("bad") / F.nullif(F.sum("seen"), F.lit(0)), F.lit(0.0)).alias("p")).first()["p"]
    host = host.select("h", ((F.col("hb") + PRIOR * F.lit(float(every))) / (F.col("hs") + PRIOR)).alias("hp"))
    leaf = now.groupBy(F.col("host").alias("lh"), F.col("template").alias("lt")).agg(
        F.sum("seen").alias("ls"), F.sum("bad").alias("lb"))
    leaf = leaf.join(host, F.col("lh") == F.col("h")).select(
        "lh", "lt", ((F.col("lb") + PRIOR * F.col("hp")) / (F.col("ls") + PRIOR)).alias("purity"))
    leaf = materialise(leaf, "templates")
    return now.join(leaf, (F.col("host") == F.col("lh")) & (F.col("template") == F.col("lt"))).select(
        "host", "path", "template", "purity")


def filter_urls(pages: DataFrame, rules: Sequence[Rule], *, key: str = "page_id", url: str = "url",
                label=word_labels) -> DataFrame:
    """``key, host, path, rule, verdict, template, purity`` for every row."""
    host, path = parse(url)
    rows = pages.select(F.col(key).alias("id"), host.alias("host"), path.alias("path"))
    counted = rows.groupBy("host", "path").agg(F.count("*").alias("n"))
    lab = label(F.col("host"), F.col("path"))
    counted = counted.withColumn("seen", F.when(lab.isNull(), 0).otherwise(F.col("n"))).withColumn(
        "bad", F.coalesce(lab, F.lit(0)) * F.col("n"))
    tree = materialise(template_tree(counted).select(F.col("host").alias("th"), F.col("path").alias("tp"), "template",
                                                     "purity"), "tree")
    judged = rows.join(tree, (F.col("host") == F.col("th")) & (F.col("path") == F.col("tp")), "left").withColumn(
        "fit", fitting_rule(F.col("host"), F.col("path"), rules))
    method = F.when(F.col("purity") > LIMIT, "block").otherwise("allow")
    return judged.select(F.col("id").alias(key), "host", "path", F.col("fit.rule").alias("rule"),
                         F.coalesce("fit.verdict", method).alias("verdict"), "template", F.round("purity", 9).alias("purity"))


def oracle_sql(rules: Sequence[Rule]) -> str:
    """The same judgement in DuckDB SQL over the ``pages`` view."""
    words = ", ".join(f"'{w}'" for w in BAD_WORDS)
    fits = ", ".join(f"CASE WHEN (r.host = '{h}' OR ends_with(r.host, '.{h}')) AND starts_with(r.path, '{p}') THEN "
                     f"{{'size': {len(h + p)}, 'rule': '{h + p}', 'verdict': '{v}'}} END" for h, p, v in rules)
    out = [f"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
     r AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
     c AS (SELECT host, path, count(*) AS n FROM r GROUP BY ALL),
     l AS (SELECT *, n AS seen, CASE WHEN len(list_intersect(regexp_split_to_array(host || '/' || lower(path),
                  '[^a-z0-9]+'), [{words}])) > 0 THEN n ELSE 0 END AS bad,
                  list_filter(string_split(path, '/'), lambda x: x <> '') AS raw FROM c),
     p0 AS (SELECT host, path, n, seen, bad, '' AS template, CASE WHEN len(raw) > {MAX_DEPTH} THEN
                   raw[1:{MAX_DEPTH - 1}] || [array_to_string(raw[{MAX_DEPTH}:], '/')] ELSE raw END AS segs FROM l)"""]
    for k in range(MAX_DEPTH):
        out.append(f"""
     k{k} AS (SELECT host, template, segs[{k + 1}] AS seg, sum(n) AS n, sum(seen) AS seen, sum(bad) AS bad
              FROM p{k} WHERE len(segs) > {k} GROUP BY ALL),
     m{k} AS (SELECT *, count(*) OVER w AS kids, sum(n) OVER w AS an, sum(seen) OVER w AS s, sum(bad) OVER w AS b
              FROM k{k} WINDOW w AS (PARTITION BY host, template)),
     a{k} AS (SELECT host, template, seg, CASE WHEN regexp_matches(seg, '{VARIABLE}') OR (kids >= {MANY} AND an < {RARE} * kids)
              OR coalesce(kids > 1 AND (seen = 0 OR abs(bad / seen - b / s) <= {Z} * sqrt((b / s) * (1 - b / s) / seen)), true)
              THEN '*' ELSE seg END AS name FROM m{k}),
     p{k + 1} AS (SELECT p.host, path, n, seen, bad, CASE WHEN name IS NULL THEN p.template ELSE p.template || '/' || name END
              AS template, segs FROM p{k} p LEFT JOIN a{k} a ON p.host = a.host AND p.template = a.template
              AND len(segs) > {k} AND segs[{k + 1}] = a.seg)""")
    last = f"p{MAX_DEPTH}"
    out.append(f"""
     g AS (SELECT coalesce(sum(bad) / nullif(sum(seen), 0), 0.0) AS p FROM {last}),
     h AS (SELECT host, (sum(bad) + {PRIOR} * (SELECT p FROM g)) / (sum(seen) + {PRIOR}) AS hp FROM {last} GROUP BY host),
     t AS (SELECT x.host, template, (sum(bad) + {PRIOR} * any_value(hp)) / (sum(seen) + {PRIOR}) AS purity
           FROM {last} x JOIN h ON x.host = h.host GROUP BY x.host, template),
     j AS (SELECT page_id, r.host, r.path, {last}.template, purity, list_sort(list_filter([{fits}],
                  lambda x: x IS NOT NULL), 'DESC')[1] AS fit
           FROM r JOIN {last} ON r.host = {last}.host AND r.path = {last}.path
                  JOIN t ON t.host = {last}.host AND t.template = {last}.template)
SELECT page_id, host, path, fit.rule AS rule, coalesce(fit.verdict, CASE WHEN purity > {LIMIT} THEN 'block' ELSE 'allow' END)
       AS verdict, template, round(purity, 9) AS purity FROM j""")
    return ",".join(out)
