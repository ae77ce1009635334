"""Tree-structured Parzen search over a trial table (M1, J7): every group's next candidates in one job.

A trial table has one row per group and trial: the candidate as places on the search space's axes and its loss. Per
group the trials are split by loss into the best share and the rest; on every axis both sets become a kernel density
over the axis's values (a Gaussian over neighbouring places where the axis is ordered, counts where it is a choice,
each mixed with a uniform prior). Candidates are drawn from the good density and ranked by the ratio of both, so
values that did well and were not seen to do badly come first. Without trials both densities are the prior, so the
first round is a random one.

Everything is a function of the table, the seed and the round: draws come from hashes of (group, seed, round, draw,
axis), so a rerun task proposes the same. Groups are independent, so a search for one model is a table with one
group and a search per store is the same job with more rows. A batch is proposed at a time: its fits run side by side.

:func:`search` keeps the trial table of every round in a folder of its own. A round counts once its folder is
committed, so a search that was stopped goes on after the last whole round and ends with the same table.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.plans.tuning import _axis
from almanac.session import cut_lineage

PLACES = 8


def axes_sql(space: dict) -> str:
    """The axes as an array of ``p, places, ordered``: position, number of values, whether neighbours are alike."""
    rows = [f"named_struct('p', {p}, 'places', {len(_axis(spec))}, 'ordered', {str(spec[0] == 'quniform').lower()})"
            for p, spec in enumerate(space.values())]
    return f"array({', '.join(rows)})"


def decode(space: dict, at) -> dict:
    """The candidate at the given places."""
    return {name: _axis(spec)[i] for (name, spec), i in zip(space.items(), at, strict=True)}


def places_of(space: dict, column_of: dict[str, str]) -> F.Column:
    """Places of a trial whose parameters are columns; a value that is not on its axis is an error."""
    found = []
    for name, spec in space.items():
        c, values = f"`{column_of.get(name, name)}`", json.dumps(_axis(spec)).replace("'", "\\'")
        kind = "string" if any(isinstance(v, str) for v in _axis(spec)) else "double"
        at = f"array_position(from_json('{values}', 'array<{kind}>'), CAST({c} AS {kind}))"
        found.append(f"CASE WHEN {at} > 0 THEN CAST({at} - 1 AS INT) ELSE raise_error('a value of {name} is not on its axis') END")
    return F.expr(f"array({', '.join(found)})")


def densities(trials: DataFrame, groups: DataFrame, space: dict, keys: list[str], share: float = 0.25,
              prior: float = 1.0) -> DataFrame:
    """``keys, p, place, good, bad``: both densities on every axis value of every group of ``groups``.

    ``trials`` holds ``keys, trial, loss, at``; ``at`` are places in the order of ``space``. A trial without a loss
    ranks last. The best ``ceil(share * n)`` of a group's n trials are the good ones.
    """
    k = ", ".join(f"`{c}`" for c in keys)
    same = " AND ".join(f"a.`{c}` = w.`{c}`" for c in keys)
    return trials.sparkSession.sql(f"""
WITH ranked AS (
    SELECT {k}, trial, at, row_number() OVER (PARTITION BY {k} ORDER BY loss IS NULL OR isnan(loss), loss, trial) AS place,
           count(1) OVER (PARTITION BY {k}) AS n FROM {{trials}}),
parts AS (
    SELECT *, place <= ceil({share!r}D * n) AS is_good FROM ranked),
seen AS (
    SELECT {k}, is_good, count(1) OVER (PARTITION BY {k}, is_good) AS m, at, {axes_sql(space)} AS axes FROM parts),
one AS (
    SELECT {k}, is_good, m, axis.p, axis.places, axis.ordered, at[axis.p] AS here FROM seen LATERAL VIEW explode(axes) AS axis),
kernels AS (
    SELECT {k}, is_good, p, CASE WHEN ordered
        THEN transform(sequence(0, places - 1), i -> exp(-0.5D * power((i - here) / greatest(1D, places / (3D * sqrt(m))), 2)))
        ELSE transform(sequence(0, places - 1), i -> if(i = here, 1D, 0D)) END AS kernel FROM one),
weights AS (
    SELECT {k}, is_good, p, place, sum(v / aggregate(kernel, 0D, (s, x) -> s + x)) AS weight, CAST(count(1) AS DOUBLE) AS m
    FROM kernels LATERAL VIEW posexplode(kernel) AS place, v GROUP BY {k}, is_good, p, place),
every AS (
    SELECT {k}, axis.p, axis.places, place FROM {{groups}} LATERAL VIEW explode({axes_sql(space)}) AS axis
    LATERAL VIEW explode(sequence(0, axis.places - 1)) AS place),
both AS (
    SELECT {k}, p, place, max(CASE WHEN is_good THEN weight END) AS gw, max(CASE WHEN is_good THEN m END) AS gm,
           max(CASE WHEN NOT is_good THEN weight END) AS bw, max(CASE WHEN NOT is_good THEN m END) AS bm
    FROM weights GROUP BY {k}, p, place)
SELECT {', '.join(f'a.`{c}`' for c in keys)}, a.p, a.place,
       ({prior!r}D / a.places + coalesce(gw, 0D)) / ({prior!r}D + coalesce(gm, 0D)) AS good,
       ({prior!r}D / a.places + coalesce(bw, 0D)) / ({prior!r}D + coalesce(bm, 0D)) AS bad
FROM every a LEFT JOIN both w ON {same} AND a.p = w.p AND a.place = w.place""", trials=trials, groups=groups)


def proposals(density: DataFrame, trials: DataFrame, keys: list[str], batch: int, seed: int = 42, turn: int = 0,
              draws: int = 24) -> DataFrame:
    """``keys, rank, at, score``: up to ``batch`` new candidates of each group.

    ``draws`` candidates are drawn per group; those drawn twice or tried before do not count. ``score`` is the sum
    of log(good / bad) over the axes. The draws are dealt into ``batch`` heats and the best of each heat is proposed
    (ties: first drawn), so a batch is not many neighbours of one value; runners-up fill up heats without a candidate.
    """
    k = ", ".join(f"`{c}`" for c in keys)
    named = ", ".join(f"coalesce(CAST(`{c}` AS STRING), '')" for c in keys)
    u = f"CAST(conv(substring(md5(concat_ws('|', {named}, '{seed}', '{turn}', draw, p)), 1, 8), 16, 10) AS DOUBLE) / {2.0 ** 32!r}D"
    return density.sparkSession.sql(f"""
WITH summed AS (
    SELECT {k}, p, place, ln(good / bad) AS ratio, round(sum(good) OVER (PARTITION BY {k}, p ORDER BY place), 12) AS upto,
           max(place) OVER (PARTITION BY {k}, p) AS last FROM {{density}}),
drawn AS (
    SELECT {k}, draw, p, min(struct(place, ratio)) AS pick FROM summed LATERAL VIEW explode(sequence(0, {draws - 1})) AS draw
    WHERE upto > {u} OR place = last GROUP BY {k}, draw, p),
candidates AS (
    SELECT {k}, draw, transform(array_sort(collect_list(struct(p, pick))), x -> x.pick.place) AS at,
           round(aggregate(array_sort(collect_list(struct(p, pick))), 0D, (s, x) -> s + x.pick.ratio), {PLACES}) AS score
    FROM drawn GROUP BY {k}, draw),
once AS (
    SELECT {k}, at, min(draw) AS draw, max(score) AS score FROM candidates GROUP BY {k}, at),
fresh AS (
    SELECT o.* FROM once o LEFT ANTI JOIN {{trials}} t ON {' AND '.join(f'o.`{c}` = t.`{c}`' for c in keys)} AND o.at = t.at),
heats AS (
    SELECT *, row_number() OVER (PARTITION BY {k}, draw % {batch} ORDER BY score DESC, draw) AS heat FROM fresh)
SELECT * FROM (SELECT {k}, CAST(row_number() OVER (PARTITION BY {k} ORDER BY heat, score DESC, draw) AS INT) AS rank, at, score FROM heats)
WHERE rank <= {batch}""", density=density, trials=trials)


def _committed(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def search(groups: DataFrame, space: dict, evaluate: Callable[[DataFrame], DataFrame], keys: list[str], trials: int = 20,
           batch: int = 5, seed: int = 42, share: float = 0.25, draws: int = 24, path: str | None = None) -> DataFrame:
    """The trial table ``keys, trial, loss, at`` of ``trials`` trials per group (fewer where the space has fewer).

    ``evaluate`` gets ``keys, trial, at`` and returns ``keys, trial, loss``. With ``path`` every round's table is
    written to ``path/round=i`` and whole rounds found there are not run again.
    """
    spark = groups.sparkSession
    groups = groups.select(*keys).distinct()
    kinds = dict(groups.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keys) + ", trial int, loss double, at array<int>"
    table = spark.createDataFrame([], schema)
    for turn in range(-(-trials // batch)):
        folder = f"{path.rstrip('/')}/round={turn}" if path else None
        if folder and _committed(spark, folder):
            table = spark.read.schema(schema).parquet(folder)
            continue
        now = min(batch, trials - turn * batch)
        found = proposals(densities(table, groups, space, keys, share), table, keys, now, seed, turn, draws)
        asked = cut_lineage(found.selectExpr(*[f"`{c}`" for c in keys], f"CAST({turn * batch} + rank - 1 AS INT) AS trial", "at"))
        losses = evaluate(asked).selectExpr(*[f"`{c}` AS `_{c}`" for c in keys], "trial AS _trial", "loss")
        met = asked.join(losses, [F.col(c) == F.col(f"_{c}") for c in (*keys, "trial")], "left")
        grown = table.unionByName(met.selectExpr(*[f"`{c}`" for c in keys], "trial", "CAST(loss AS DOUBLE) AS loss", "at"))
        if folder:
            grown.write.mode("overwrite").parquet(folder)
            table = spark.read.schema(schema).parquet(folder)
        else:
            table = cut_lineage(grown)
    return table


def best_so_far(table: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, trial, loss, at``: the trial of least loss of each group (ties: the first; no loss ranks last)."""
    least = F.min(F.struct((F.col("loss").isNull() | F.isnan("loss")).alias("missing"), "loss", "trial", "at")).alias("w")
    return table.groupBy(*keys).agg(least).select(*keys, "w.trial", "w.loss", "w.at")


def search_one(spark: SparkSession, space: dict, losses_of: Callable[[list[dict]], list], trials: int = 20, batch: int = 5,
               seed: int = 42, path: str | None = None) -> list[tuple[int, dict, float | None]]:
    """One search whose candidates are fitted by the caller, a batch at a time: ``[(trial, candidate, loss)]``."""
    def evaluate(asked: DataFrame) -> DataFrame:
        rows = sorted((r["trial"], r["at"]) for r in asked.collect())  # a batch of candidates: control data
        found = losses_of([decode(space, at) for _, at in rows])
        return spark.createDataFrame([(0, t, None if v is None else float(v)) for (t, _), v in zip(rows, found, strict=True)],
                                     "search int, trial int, loss double")
    table = search(spark.range(1).selectExpr("CAST(id AS INT) AS search"), space, evaluate, ["search"], trials, batch, seed, path=path)
    return [(r["trial"], decode(space, r["at"]), r["loss"]) for r in table.orderBy("trial").collect()]
