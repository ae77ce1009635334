"""Second-order gradient boosting on DataFrames (M3): histogram trees with regularised gains.

Squared loss: a row's gradient is ``margin - label``, its hessian 1. A tree grows level by level. Each level is one
aggregate of gradient and hessian sums by (node, feature, bin), partial on the map side, so what is shuffled is at
most ``nodes * features * bins`` rows a task, however long the table is. Split gains come from running sums over a
feature's bins (a window of at most ``max_bins`` rows), and only the chosen splits, at most one a node, reach the
driver: they are the model.

* gain of a split: ``1/2 (GL^2/(HL+lambda) + GR^2/(HR+lambda) - G^2/(H+lambda)) - gamma``, allowed where both sides
  have a hessian of ``min_child_weight`` or more; leaf weight ``-G/(H+lambda)`` times the learning rate;
* rows are sampled per TREE by a hash of their key, columns per TREE by a hash of their name: a rerun task draws the
  same rows, on any partitioning;
* missing values (null, NaN) have a bin of their own and go to the side that gains more, learned per split;
* a feature with at most ``max_bins`` values may be cut at each of them, others at approximate quantiles.

Ties go to the first feature, then the least cut, then missing values to the right. Gains are rounded to 8 places
before they are ranked, so the order in which partial sums arrive cannot change a tree.
"""

from __future__ import annotations

import hashlib
import json
import math
from dataclasses import dataclass, field, replace

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.functions.metrics import mape
from almanac.session import cut_lineage, side_by_side

LABEL = "train_test_val_indicator"
PLACES = 8
#: Trees applied as expressions before the margins are written to the checkpoint folder again.
TREES_PER_CHECKPOINT = 8
#: A level's sums of up to this many rows (nodes * features * bins) are searched by one task.
ONE_TASK_ROWS = 1 << 18


@dataclass(frozen=True)
class BoostParams:
    n_trees: int = 20
    max_depth: int = 4
    learning_rate: float = 0.3
    reg_lambda: float = 1.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    subsample: float = 1.0
    colsample: float = 1.0
    max_bins: int = 64
    seed: int = 42


@dataclass
class Tree:
    """Nodes in heap order: children of ``i`` are ``2 i + 1`` (left) and ``2 i + 2``; ``feature`` is -1 in a leaf."""
    feature: list[int]
    bin: list[int]
    missing_left: list[bool]
    gain: list[float]
    weight: list[float]  # of the node as a leaf, before the learning rate

    @classmethod
    def of_depth(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls([-1] * n, [0] * n, [False] * n, [0.0] * n, [0.0] * n)

    def depth(self) -> int:
        """Levels of splits."""
        return max((int(math.log2(i + 1)) + 1 for i, f in enumerate(self.feature) if f >= 0), default=0)


# Expressions are SQL text: a level is a handful of calls to the JVM, not one per operator.

def number(c: str) -> str:
    """A feature as double, NaN as null."""
    x = f"CAST(`{c}` AS DOUBLE)"
    return f"CASE WHEN NOT isnan({x}) THEN {x} END"


def bin_edges(frame: DataFrame, features: list[str], max_bins: int) -> list[list[float]]:
    """Per feature the values at which it may be cut, ascending: all but the least of its values where there are
    at most ``max_bins``, else approximate quantiles. Two aggregates; at most ``max_bins`` numbers a feature return."""
    shares = ", ".join(repr(i / max_bins) + "D" for i in range(max_bins))
    slim = frame.selectExpr(*[f"{number(c)} AS x{j}" for j, c in enumerate(features)])
    first = slim.selectExpr(*[f"approx_count_distinct(x{j}) AS n{j}" for j in range(len(features))],
                            *[f"percentile_approx(x{j}, array({shares}), 10000) AS q{j}" for j in range(len(features))]).first()
    # the sketch errs by a few percent: sets of up to 1.3 times the bins are gathered exactly
    few = [j for j in range(len(features)) if first[f"n{j}"] <= 1.3 * max_bins]
    sets = slim.selectExpr(*[f"collect_set(x{j}) AS s{j}" for j in few]).first() if few else {}
    edges = []
    for j in range(len(features)):
        values = sorted(sets[f"s{j}"]) if j in few else []
        if j not in few or len(values) > max_bins:
            values = sorted(set(first[f"q{j}"] or []))
        edges.append([float(v) for v in values[1:]])
    return edges


def binned(df: DataFrame, features: list[str], edges: list[list[float]], output_col: str = "_bins") -> DataFrame:
    """Add the array of bins: per feature the number of cuts that are not above the value, -1 where it is missing."""
    out = df.selectExpr("*", *[f"coalesce({number(c)}, double('NaN')) AS _b{j}" for j, c in enumerate(features)])
    # a bucketizer searches the cuts by halving and needs one cut at least; invalid values go to its last bucket
    cut = [j for j, e in enumerate(edges) if e]
    if cut:
        out = Bucketizer(inputCols=[f"_b{j}" for j in cut], outputCols=[f"_c{j}" for j in cut], handleInvalid="keep",
                         splitsArray=[[-math.inf, *edges[j], math.inf] for j in cut]).transform(out)
    found = ", ".join(f"CASE WHEN isnan(_b{j}) THEN -1 ELSE {f'CAST(_c{j} AS INT)' if edges[j] else '0'} END"
                      for j in range(len(features)))
    return out.selectExpr(*[f"`{c}`" for c in df.columns], f"array({found}) AS {output_col}")


def sampled_columns(n: int, params: BoostParams, tree: int) -> list[int]:
    """Positions of the features a tree may use, ascending."""
    keep = max(1, math.ceil(round(params.colsample * n, 9)))
    order = sorted(range(n), key=lambda j: hashlib.md5(f"{params.seed}|{tree}|{j}".encode()).hexdigest())
    return sorted(order[:keep])


def in_sample(keys: list[str], params: BoostParams, tree: int) -> str:
    """Whether a row is in a tree's sample: a hash of its key against the rate."""
    named = ", ".join(f"coalesce(CAST(`{k}` AS STRING), '')" for k in keys)
    return (f"CAST(conv(substring(md5(concat_ws('|', {named}, '{params.seed}', '{tree}')), 1, 8), 16, 10) AS DOUBLE)"
            f" < {params.subsample * 2.0 ** 32!r}D")


def literal(trees: list[Tree]) -> str:
    """Trees as one constant (folded by the optimiser): arrays of nodes ``f, b, l, w``."""
    text = json.dumps([[{"f": f, "b": b, "l": m, "w": w} for f, b, m, w in
                        zip(t.feature, t.bin, t.missing_left, t.weight, strict=True)] for t in trees])
    return f"from_json('{text}', 'array<array<struct<f:int,b:int,l:boolean,w:double>>>')"


def reached(nodes: str, depth: int) -> str:
    """The node of a tree that a row's bins lead to, from the root down ``depth`` levels."""
    own = f"element_at({nodes}, n + 1)"
    at = f"get(_bins, {own}.f)"
    return (f"aggregate(sequence(1, {depth}), 0, (n, level) -> CASE WHEN {own}.f < 0 THEN n "
            f"WHEN CASE WHEN {at} < 0 THEN {own}.l ELSE {at} < {own}.b END THEN 2 * n + 1 ELSE 2 * n + 2 END)") if depth else "0"


def ensemble(trees: list[Tree]) -> str:
    """Sum of the weights that a row gets from the trees."""
    if not trees:
        return "0D"
    depth = max(t.depth() for t in trees)
    return f"aggregate({literal(trees)}, 0D, (total, nodes) -> total + element_at(nodes, {reached('nodes', depth)} + 1).w)"


def histogram(rows: DataFrame, columns: list[int]) -> DataFrame:
    """``node, f, bin, g, h``: gradient and hessian sums; ``rows`` hold ``node, g, _bins``."""
    own = ", ".join(f"struct({j} AS f, _bins[{j}] AS bin)" for j in columns)
    return rows.selectExpr("node", "g", f"inline(array({own}))").groupBy("node", "f", "bin").agg(
        F.expr("sum(g) AS g"), F.expr("CAST(count(1) AS DOUBLE) AS h"))


def best_splits(hist: DataFrame, params: BoostParams) -> DataFrame:
    """One row a node: ``sums`` (f, G, H) and ``best``, its best split (null where none gains)."""
    lam, least = f"{float(params.reg_lambda)!r}D", f"{float(params.min_child_weight)!r}D"
    return hist.sparkSession.sql(f"""
WITH sums AS (
    SELECT node, f, bin, sum(g) OVER alike AS G, sum(h) OVER alike AS H,
           coalesce(sum(CASE WHEN bin < 0 THEN g END) OVER alike, 0D) AS gm, coalesce(sum(CASE WHEN bin < 0 THEN h END) OVER alike, 0D) AS hm,
           coalesce(sum(CASE WHEN bin >= 0 THEN g END) OVER below, 0D) AS gl0, coalesce(sum(CASE WHEN bin >= 0 THEN h END) OVER below, 0D) AS hl0
    FROM {{hist}} WINDOW alike AS (PARTITION BY node, f),
                         below AS (PARTITION BY node, f ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
sides AS (
    SELECT node, f, bin, G, H, missing_left, gl0 + if(missing_left, gm, 0D) AS gl, hl0 + if(missing_left, hm, 0D) AS hl
    FROM sums LATERAL VIEW explode(array(false, true)) AS missing_left),
gains AS (
    SELECT *, round(0.5D * (try_divide(gl * gl, hl + {lam}) + try_divide((G - gl) * (G - gl), H - hl + {lam})
                            - try_divide(G * G, H + {lam})) - {float(params.gamma)!r}D, {PLACES}) AS gain FROM sides)
SELECT node, min(struct(f, G, H)) AS sums, min(CASE WHEN bin > 0 AND hl > 0 AND H - hl > 0 AND hl >= {least} AND H - hl >= {least}
           AND gain > 0 THEN struct(-gain AS loss, f, bin, missing_left, gl, hl) END) AS best
FROM gains GROUP BY node""", hist=hist)


@dataclass
class BoostedModel:
    features: list[str]
    edges: list[list[float]]
    base_score: float
    params: BoostParams
    trees: list[Tree] = field(default_factory=list)

    def transform(self, df: DataFrame, prediction_col: str = "prediction") -> DataFrame:
        """Add the prediction to every row: its bins, then every tree from the root down, as column expressions."""
        kept = [f"`{c}`" for c in df.columns if c != prediction_col]
        total = f"{self.base_score!r}D + {self.params.learning_rate!r}D * {ensemble(self.trees)}"
        return binned(df, self.features, self.edges).selectExpr(*kept, f"{total} AS `{prediction_col}`")

    def nodes(self, spark: SparkSession) -> DataFrame:
        """The model as data: ``tree, node, feature, cut, missing_left, gain, weight`` (cut null in a leaf). A row
        with a missing or smaller value than the cut goes left as ``missing_left`` says."""
        rows = []
        for k, t in enumerate(self.trees):
            live = {0}
            for i in range(len(t.feature)):
                if i not in live:
                    continue
                f = t.feature[i]
                live |= {2 * i + 1, 2 * i + 2} if f >= 0 else set()
                rows.append((k, i, self.features[f] if f >= 0 else None, self.edges[f][t.bin[i] - 1] if f >= 0 else None,
                             t.missing_left[i] if f >= 0 else None, t.gain[i] if f >= 0 else None, t.weight[i]))
        return spark.createDataFrame(rows, "tree int, node int, feature string, cut double, missing_left boolean,"
                                           " gain double, weight double")

    def importance(self, spark: SparkSession) -> DataFrame:
        """``feature, splits, gain``: how often a feature is cut and what its cuts gain in all trees."""
        return self.nodes(spark).filter("feature IS NOT NULL").groupBy("feature").agg(
            F.count(F.lit(1)).alias("splits"), F.sum("gain").alias("gain"))


@dataclass
class Prepared:
    """Binned rows of a training slice, written once; fits with the same number of bins share them."""
    features: list[str]
    edges: list[list[float]]
    keys: list[str]
    mean: float | None
    state: DataFrame | None


def prepare_boosted(rows: DataFrame, features: list[str], label_col: str, keys: list[str], max_bins: int) -> Prepared:
    label = number(label_col)
    rows = rows.filter(f"{label} IS NOT NULL")
    mean = rows.selectExpr(f"avg({label})").first()[0]
    if mean is None:
        return Prepared(list(features), [[] for _ in features], list(keys), None, None)
    edges = bin_edges(rows, features, max_bins)
    state = binned(rows, features, edges).selectExpr(
        *[f"`{k}`" for k in dict.fromkeys(keys)], f"{label} AS _y", "_bins", f"{mean!r}D AS _margin")
    return Prepared(list(features), edges, list(keys), mean, cut_lineage(state))


def fit_boosted(rows: DataFrame | Prepared, features: list[str], label_col: str, keys: list[str],
                params: BoostParams = BoostParams()) -> BoostedModel:
    """Fit on every row of ``rows`` with a label. ``keys`` name a row (they decide the row samples)."""
    ready = rows if isinstance(rows, Prepared) else prepare_boosted(rows, features, label_col, keys, params.max_bins)
    model = BoostedModel(ready.features, ready.edges, ready.mean or 0.0, params)
    if ready.mean is None:
        return model
    state = ready.state
    rate = f"{params.learning_rate!r}D"
    pending: list[Tree] = []  # trees that the margins of ``state`` do not hold yet
    for k in range(params.n_trees):
        work = state if params.subsample >= 1 else state.filter(in_sample(keys, params, k))
        work = work.selectExpr("_bins", f"_margin + {rate} * {ensemble(pending)} - _y AS g")
        tree, columns = Tree.of_depth(params.max_depth), sampled_columns(len(features), params, k)
        for level in range(params.max_depth):
            first = 2 ** level - 1
            if level and not any(f >= 0 for f in tree.feature[(first - 1) // 2:first]):
                break
            node = f"element_at(transform({literal([tree])}, nodes -> {reached('nodes', level)}), 1)" if level else "0"
            hist = histogram(work.selectExpr("_bins", "g", f"{node} AS node").filter(f"node >= {first}"), columns)
            if 2 ** level * len(columns) * (params.max_bins + 1) <= ONE_TASK_ROWS:
                hist = hist.repartition(1)  # of bounded size: the steps that follow need no more exchanges
            for r in best_splits(hist, params).collect():  # at most one row a node
                grow(tree, r, params)
        model.trees.append(tree)
        pending.append(tree)
        if len(pending) == TREES_PER_CHECKPOINT and k + 1 < params.n_trees:
            held = f"_margin + {rate} * {ensemble(pending)} AS _margin"
            state, pending = cut_lineage(state.selectExpr(*[f"`{c}`" for c in state.columns if c != "_margin"], held)), []
    return model


def grow(tree: Tree, r, params: BoostParams) -> None:
    """Enter a node's chosen split and its children's weights."""
    node, best = r["node"], r["best"]
    if node == 0:
        tree.weight[0] = -r["sums"]["G"] / (r["sums"]["H"] + params.reg_lambda)
    if best is None:
        return
    tree.feature[node], tree.bin[node] = best["f"], best["bin"]
    tree.missing_left[node], tree.gain[node] = best["missing_left"], -best["loss"]
    rest = r["sums"]["G"] - best["gl"], r["sums"]["H"] - best["hl"]
    tree.weight[2 * node + 1] = -best["gl"] / (best["hl"] + params.reg_lambda)
    tree.weight[2 * node + 2] = -rest[0] / (rest[1] + params.reg_lambda)


def tune_boosted(frame: DataFrame, features: list[str], keys: list[str], candidates: list[dict],
                 base: BoostParams = BoostParams(), label_col: str = "sales", parallelism: int = 8,
                 refit_max_label: int = 1):
    """``(model refitted on labels <= refit_max_label, [(id, candidate, validation MAPE)], best id)``: every candidate
    is fitted on label 0 and scored on label 1, several at a time."""
    valid = frame.filter(F.col(LABEL) == 1)
    train: dict[int, Prepared] = {}  # by number of bins
    for c in candidates:
        bins = replace(base, **c).max_bins
        if bins not in train:
            train[bins] = prepare_boosted(frame.filter(F.col(LABEL) == 0), features, label_col, keys, bins)

    def loss(i):
        params = replace(base, **candidates[i])
        model = fit_boosted(train[params.max_bins], features, label_col, keys, params)
        return i, candidates[i], mape(model.transform(valid, "_prediction"), label_col, "_prediction")

    losses = side_by_side(frame.sparkSession, loss, list(range(len(candidates))), parallelism)
    best = min(losses, key=lambda x: (x[2] is None, x[2] if x[2] is not None else 0.0, x[0]))[0]
    params = replace(base, **candidates[best])
    return fit_boosted(frame.filter(F.col(LABEL) <= refit_max_label), features, label_col, keys, params), losses, best
