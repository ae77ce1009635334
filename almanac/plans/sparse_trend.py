"""The piecewise trend and Fourier model of :mod:`almanac.plans.fourier` fitted without Python workers.

Per group, over the months it is fitted on (time scaled to 0..1 over their span):

    minimise  1/2 |y - X b|^2  +  sum_j |d_j| / changepoint_prior_scale  +  1/2 |s|^2 / seasonality_prior_scale^2

``d`` are the slope changes at evenly spaced places of the first 80 % of the span, ``s`` the Fourier coefficients;
intercept and slope are free. The absolute value makes the trend sparse: a change stays 0 unless the data ask for it.

* ``X'X`` and ``X'y`` are one partial and final aggregate per group: rows meet as sums, so a group may have any
  number of rows, and the sums of disjoint rows may be added up.
* Free and ridge-penalised coefficients are eliminated by sweeps of the Gram matrix; what remains is a small
  problem in the slope changes, solved by cyclic coordinate descent with soft thresholds. Both are array
  expressions: a group is one row of a few hundred numbers.
* All candidates of all groups are solved and scored on the validation months (MAPE) in one job; the best is
  fitted again on training and validation months.

The model has the columns that :func:`almanac.plans.fourier.score_fourier` reads.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.functions.scalar import month_index
from almanac.plans.fourier import ADDITIVE, MULTIPLICATIVE
from almanac.plans.tuning import candidate_grid
from almanac.session import cut_lineage
from almanac.sources.config import RunConfig

LABEL = "train_test_val_indicator"
PLACES = 8
SWEEPS = 100
#: A pivot or diagonal below this share of its first value is taken for zero: its coefficient stays 0.
SINGULAR = 1e-9


def places_of(n: int) -> list[float]:
    """Changepoints on the scaled time axis."""
    return [0.8 * j / (n + 1) for j in range(1, n + 1)]


def design_sql(n_changepoints: int, order: int) -> str:
    """The row of X as an array, from ``t, m`` and the group's ``t0, t1, n, icpt, line, mode``."""
    tau = "CASE WHEN t1 > t0 THEN (t - t0) / (t1 - t0) ELSE 0D END"
    bends = [f"CASE WHEN n >= 3 THEN greatest({tau} - {c!r}D, 0D) ELSE 0D END" for c in places_of(n_changepoints)]
    level = "CASE WHEN mode = 1 THEN icpt + line * t ELSE 1D END"
    waves = [f"({level}) * {f}({2 * math.pi * k / 12!r}D * m)" for k in range(1, order + 1) for f in ("sin", "cos")]
    return f"array({', '.join(['1D', tau, *bends, *waves])})"


def listed_sql(cands: list[dict]) -> str:
    """The candidates as a constant array of ``id, cps, sps, mode``."""
    rows = [f"named_struct('id', {i}, 'cps', {float(c.get('changepoint_prior_scale', 0.0))!r}D, 'sps', "
            f"{float(c['seasonality_prior_scale'])!r}D, 'mode', {int(c.get('seasonality_mode', ADDITIVE) == MULTIPLICATIVE)})"
            for i, c in enumerate(cands)]
    return f"array({', '.join(rows)})"


def statistics(rows: DataFrame, keys: list[str], fit: str) -> DataFrame:
    """``keys, n, t0, t1, icpt, line``: span and least-squares line of the rows that are fitted on."""
    return rows.filter(fit).groupBy(*keys).agg(
        F.expr("count(1) AS n"), F.expr("min(t) AS t0"), F.expr("max(t) AS t1"),
        F.expr("CASE WHEN max(t) > min(t) THEN regr_intercept(y, t) ELSE avg(y) END AS icpt"),
        F.expr("CASE WHEN max(t) > min(t) THEN regr_slope(y, t) ELSE 0D END AS line"))


def gram(rows: DataFrame, stats: DataFrame, keys: list[str], fit: str, modes: list[int], n_changepoints: int,
         order: int) -> DataFrame:
    """``keys, mode, tri``: the upper triangle of [X y]'[X y], row by row, per group and kind of seasonality."""
    q = 3 + n_changepoints + 2 * order
    k = ", ".join(f"`{c}`" for c in keys)
    return rows.sparkSession.sql(f"""
WITH designs AS (
    SELECT {k}, mode, concat({design_sql(n_changepoints, order)}, array(y)) AS z
    FROM {{rows}} JOIN {{stats}} USING ({k}) LATERAL VIEW explode(array({', '.join(map(str, modes))})) AS mode WHERE {fit}),
sums AS (
    SELECT {k}, mode, pos, sum(v) AS v FROM designs
    LATERAL VIEW posexplode(flatten(transform(z, (a, i) -> transform(slice(z, i + 1, {q} - i), b -> a * b)))) AS pos, v
    GROUP BY {k}, mode, pos)
SELECT {k}, mode, transform(array_sort(collect_list(struct(pos, v))), e -> e.v) AS tri FROM sums GROUP BY {k}, mode
""", rows=rows, stats=stats)


def solve(grams: DataFrame, keys: list[str], n_changepoints: int, order: int, sweeps: int = SWEEPS) -> DataFrame:
    """Add ``beta`` to rows of ``keys, mode, tri, cand`` (struct ``id, cps, sps, mode``)."""
    c, p = n_changepoints, 2 + n_changepoints + 2 * order
    k = ", ".join(f"`{x}`" for x in keys)
    eliminated = ", ".join(str(i) for i in [0, 1, *range(2 + c, p)])
    at = f"CAST(least(i, j) * {p + 1} - least(i, j) * (least(i, j) - 1) / 2 + abs(i - j) AS INT)"
    rest = f"aggregate(sequence(0, {c - 1}), 0D, (s, j) -> s + A[i][2 + j] * d[j])" if c else "0D"
    others = f"aggregate(sequence(0, {c - 1}), 0D, (s, i) -> s + CASE WHEN i = j THEN 0D ELSE A[2 + j][2 + i] * d[i] END)"
    rho, own = f"(A[2 + j][{p}] - {others})", "A[2 + j][2 + j]"
    descent = (f"aggregate(sequence(0, {sweeps * c - 1}), array_repeat(0D, {c}), (d, s) -> transform(d, (v, j) -> "
               f"CASE WHEN j <> s % {c} THEN v WHEN {own} <= {SINGULAR!r}D * M[2 + j][2 + j] THEN 0D "
               f"ELSE sign({rho}) * greatest(abs({rho}) - lambda1, 0D) / {own} + 0D END))") if c else "CAST(array() AS ARRAY<DOUBLE>)"
    return grams.sparkSession.sql(f"""
WITH matrices AS (
    SELECT {k}, mode, cand, CASE WHEN cand.cps > 0 THEN 1 / cand.cps ELSE 1e300D END AS lambda1,
           transform(sequence(0, {p - 1}), i -> transform(sequence(0, {p}), j -> tri[{at}]
               + CASE WHEN i = j AND i >= {2 + c} THEN 1 / greatest(cand.sps * cand.sps, 1e-12D) ELSE 0D END)) AS M FROM {{grams}}),
swept AS (
    SELECT *, aggregate(array({eliminated}), M, (A, r) -> CASE WHEN A[r][r] > {SINGULAR!r}D * M[r][r]
        THEN transform(A, (row, i) -> CASE WHEN i = r THEN transform(row, v -> v / A[r][r])
                                           ELSE zip_with(row, A[r], (v, w) -> v - row[r] / A[r][r] * w) END)
        ELSE transform(A, (row, i) -> CASE WHEN i = r THEN transform(row, v -> 0D) ELSE row END) END) AS A FROM matrices),
bent AS (SELECT *, {descent} AS d FROM swept)
SELECT {k}, mode, cand, transform(sequence(0, {p - 1}), i -> CASE WHEN i BETWEEN 2 AND {1 + c} THEN d[i - 2]
       ELSE A[i][{p}] - {rest} END) AS beta FROM bent""", grams=grams)


def fit_sparse(features: DataFrame, cfg: RunConfig = RunConfig(), keys=None, space: dict | None = None,
               n_changepoints: int = 5, order: int = 3, sweeps: int = SWEEPS) -> DataFrame:
    """One row per group: ``keys, cand_id, validation_loss, intercept, slope, changepoints, deltas, seasonal,
    season_level``. ``cand_id`` is -1 and the loss null where no candidate could be compared (the first is
    fitted then); the coefficients are null for a group with fewer than two usable rows. Ties: lowest ``cand_id``."""
    named = list(keys or cfg.keys)
    keys = [f"_key{i}" for i in range(len(named))]  # a key may have the name of a column used here
    c = n_changepoints
    cands = candidate_grid(space or cfg.hp_space_fourier, cfg.max_evals, "random", cfg.seed)
    listed, modes = listed_sql(cands), sorted({int(x.get("seasonality_mode", ADDITIVE) == MULTIPLICATIVE) for x in cands})
    k = ", ".join(f"`{x}`" for x in keys)
    rows = features.select(*[F.col(x).alias(y) for x, y in zip(named, keys, strict=True)], F.col("sales").cast("double").alias("y"), F.col("month").cast("double").alias("m"),
                           month_index(F.col("year"), F.col("month"), cfg.base_year).alias("t"), F.col(LABEL).alias("ind"))
    rows = rows.filter("y IS NOT NULL AND NOT isnan(y) AND t IS NOT NULL AND ind IS NOT NULL")
    spark = features.sparkSession

    train = statistics(rows, keys, "ind = 0").filter("n >= 2")
    tried = gram(rows, train, keys, "ind = 0", modes, c, order).selectExpr("*", f"explode({listed}) AS cand").filter("cand.mode = mode")
    solved = solve(tried, keys, c, order, sweeps)
    # written once: the second fit and the result both read it
    winners = cut_lineage(spark.sql(f"""
WITH predicted AS (
    SELECT {k}, cand.id, y, aggregate(zip_with({design_sql(c, order)}, beta, (x, b) -> x * b), 0D, (s, v) -> s + v) AS p
    FROM {{rows}} JOIN {{train}} USING ({k}) JOIN {{solved}} USING ({k}) WHERE ind = 1),
losses AS (SELECT {k}, id, round(100 * avg(abs(try_divide(y - p, y))), {PLACES}) AS loss FROM predicted GROUP BY {k}, id)
SELECT {k}, min(struct(loss, id)) AS best FROM losses WHERE loss IS NOT NULL GROUP BY {k}""",
                        rows=rows, train=train, solved=solved))

    full = statistics(rows, keys, "ind <= 1").filter("n >= 2")
    chosen = spark.sql(f"""SELECT g.*, best, element_at({listed}, coalesce(best.id, 0) + 1) AS cand
FROM {{grams}} g LEFT JOIN {{winners}} USING ({k})""", grams=gram(rows, full, keys, "ind <= 1", modes, c, order), winners=winners)
    refit = solve(chosen.filter("cand.mode = mode"), keys, c, order, sweeps)
    span = "(t1 - t0)"
    scaled = f"CASE WHEN t1 > t0 THEN {{}} / {span} ELSE 0D END"
    bends = f"slice(beta, 3, {c})"
    cps = f"transform(array({', '.join(f'{x!r}D' for x in places_of(c))}), x -> t0 + x * {span})" if c else "CAST(array() AS ARRAY<DOUBLE>)"
    groups = features.select(*[F.col(x).alias(y) for x, y in zip(named, keys, strict=True)]).distinct()
    return spark.sql(f"""
SELECT {', '.join(f'g.`{y}` AS `{x}`' for x, y in zip(named, keys, strict=True))}, coalesce(best.id, -1) AS cand_id, best.loss AS validation_loss,
       CASE WHEN t1 > t0 THEN beta[0] - beta[1] * t0 / {span} ELSE beta[0] END AS intercept,
       CASE WHEN beta IS NOT NULL THEN {scaled.format('beta[1]')} END AS slope, CASE WHEN beta IS NOT NULL THEN {cps} END AS changepoints,
       transform({bends}, x -> {scaled.format('x')}) AS deltas, slice(beta, {3 + c}, {2 * order}) AS seasonal,
       CASE WHEN beta IS NULL THEN NULL WHEN mode = 1 THEN array(icpt, line) ELSE array(1D, 0D) END AS season_level
FROM {{groups}} g LEFT JOIN {{winners}} USING ({k}) LEFT JOIN {{full}} USING ({k}) LEFT JOIN {{refit}} USING ({k})""",
                     groups=groups, winners=winners, full=full, refit=refit)
