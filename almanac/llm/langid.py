"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads the lower-cased UTF-8 bytes of a text in windows, forwards and backwards, and
gives every byte position a probability for each language; a document's probabilities are the mean
over all its positions. It is trained in numpy by backpropagation through time on a bounded,
documented sample of labelled documents (``per_lang`` documents a language, ``span`` characters of
each, at most ``max_langs`` languages); prediction covers every byte of every text.

Prediction is a map over the table: the weights (a few kB) travel with the task, a batch of texts
becomes one matrix of windows, and tiles of windows bound the memory whatever the text lengths.

Defined results: null texts and texts without letters are ``und`` with score 0; without any labelled
document every text is ``und``; ties between languages go to the alphabetically first.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.util import slices, small_batches

UNDETERMINED = "und"


def has_letter(text: str) -> bool:
    """Whether a text has a letter; number signs such as one half or a Roman numeral's are none."""
    return any(map(str.isalpha, text))


@dataclass
class GruModel:
    """``langs`` and, per direction, byte inputs (256, 3H), recurrent weights (H, 3H) and outputs (H, K)."""

    langs: list[str]
    weights: dict[str, np.ndarray]
    window: int = 64

    @property
    def hidden(self) -> int:
        return self.weights["Uf"].shape[0]


def _gates(x: np.ndarray, h: np.ndarray, u: np.ndarray, n: int):
    """One step: update and reset gates (hard sigmoid) and candidate state."""
    a = h @ u
    g = np.clip(0.25 * (x[:, :2 * n] + a[:, :2 * n]) + 0.5, 0.0, 1.0)
    c = np.tanh(x[:, 2 * n:] + g[:, n:] * a[:, 2 * n:])
    return a, g, c


def _scan(seq: np.ndarray, e: np.ndarray, u: np.ndarray, order: range) -> list:
    """States of one direction: per step (h before, recurrent part, gates, candidate, h after)."""
    n = u.shape[0]
    h = np.zeros((seq.shape[0], n), dtype=np.float32)
    kept: list = [None] * seq.shape[1]
    for t in order:
        a, g, c = _gates(e[seq[:, t]], h, u, n)
        new = c + g[:, :n] * (h - c)
        kept[t] = (h, a, g, c, new)
        h = new
    return kept


def _back(seq, u, kept, d_out, order, grad_e, grad_u):
    """Backpropagation through time for one direction; ``d_out[t]`` is the loss gradient of state t."""
    n = u.shape[0]
    carry = np.zeros((seq.shape[0], n), dtype=np.float32)
    d_x = np.empty((seq.shape[0], 3 * n), dtype=np.float32)
    for t in reversed(order):
        h, a, g, c, _ = kept[t]
        dh = d_out[t] + carry
        z, r = g[:, :n], g[:, n:]
        inside = 0.25 * ((g > 0) & (g < 1))
        d_c = dh * (1 - z) * (1 - c * c)
        d_x[:, :n] = dh * (h - c) * inside[:, :n]
        d_x[:, n:2 * n] = d_c * a[:, 2 * n:] * inside[:, n:]
        d_x[:, 2 * n:] = d_c
        d_a = d_x.copy()
        d_a[:, 2 * n:] *= r
        grad_u += h.T @ d_a
        for j in range(3 * n):
            grad_e[:, j] += np.bincount(seq[:, t], weights=d_x[:, j], minlength=256).astype(np.float32)
        carry = dh * z + d_a @ u.T


def train(texts: list[str], langs: list[str], *, hidden: int = 8, window: int = 64, steps: int = 250,
          batch: int = 192, rate: float = 0.02, seed: int = 7) -> GruModel:
    """Fit the network on (text, language) pairs; every position of a window carries its text's language."""
    names = sorted(set(langs))
    rng = np.random.default_rng(seed)
    data = [np.frombuffer(t.lower().encode(), dtype=np.uint8) for t in texts]
    by_lang = [[d for d, x in zip(data, langs, strict=True) if x == k and len(d)] for k in names]
    k, n = len(names), hidden
    w = {}
    for s in "fb":
        w["E" + s] = rng.normal(0, 0.5, (256, 3 * n)).astype(np.float32)
        w["U" + s] = rng.normal(0, 0.5 / np.sqrt(n), (n, 3 * n)).astype(np.float32)
        w["V" + s] = rng.normal(0, 0.3, (n, k)).astype(np.float32)
    w["b"] = np.zeros(k, dtype=np.float32)
    first = {p: np.zeros_like(v) for p, v in w.items()}
    second = {p: np.zeros_like(v) for p, v in w.items()}
    ahead, behind = range(window), range(window - 1, -1, -1)
    for step in range(1, steps + 1):
        label = rng.integers(0, k, batch)
        seq = np.zeros((batch, window), dtype=np.uint8)
        for i, lab in enumerate(label):
            d = by_lang[lab][rng.integers(len(by_lang[lab]))]
            at = rng.integers(0, max(1, len(d) - window + 1))
            piece = d[at:at + window]
            seq[i, :len(piece)] = piece
        real = (seq > 0).astype(np.float32)
        fw, bw = _scan(seq, w["Ef"], w["Uf"], ahead), _scan(seq, w["Eb"], w["Ub"], behind)
        grad = {p: np.zeros_like(v) for p, v in w.items()}
        d_f, d_b = [], []
        total = max(float(real.sum()), 1.0)
        for t in ahead:
            y = fw[t][4] @ w["Vf"] + bw[t][4] @ w["Vb"] + w["b"]
            y = np.exp(y - y.max(1, keepdims=True))
            y /= y.sum(1, keepdims=True)
            y[np.arange(batch), label] -= 1.0
            y *= real[:, t:t + 1] / total
            grad["Vf"] += fw[t][4].T @ y
            grad["Vb"] += bw[t][4].T @ y
            grad["b"] += y.sum(0)
            d_f.append(y @ w["Vf"].T)
            d_b.append(y @ w["Vb"].T)
        _back(seq, w["Uf"], fw, d_f, ahead, grad["Ef"], grad["Uf"])
        _back(seq, w["Ub"], bw, d_b, behind, grad["Eb"], grad["Ub"])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        lr = rate * min(1.0, 2.0 * (1 - step / (steps + 1)))
        for p, g in grad.items():
            g = g * min(1.0, 1.0 / max(norm, 1e-9))
            first[p] += 0.1 * (g - first[p])
            second[p] += 0.01 * (g * g - second[p])
            w[p] -= lr * (first[p] / (1 - 0.9 ** step)) / (np.sqrt(second[p] / (1 - 0.99 ** step)) + 1e-6)
    return GruModel(names, w, window)


def _probabilities(model: GruModel, seq: np.ndarray) -> np.ndarray:
    """Sum over the real positions of each window of the position's language probabilities."""
    w, n = model.weights, model.hidden
    rows, width = seq.shape
    cols = np.ascontiguousarray(seq.T).astype(np.intp)
    # scaled once: the gates use 0.25 x + 0.5
    inputs, recur = {}, {}
    for s in "fb":
        e, u = w["E" + s].copy(), w["U" + s].copy()
        e[:, :2 * n] = 0.25 * e[:, :2 * n] + 0.5
        u[:, :2 * n] *= 0.25
        inputs[s], recur[s] = e, u
    states = {s: np.empty((width, rows, n), dtype=np.float32) for s in "fb"}
    x = np.empty((rows, 3 * n), dtype=np.float32)
    a = np.empty((rows, 3 * n), dtype=np.float32)
    g = np.empty((rows, 2 * n), dtype=np.float32)
    c = np.empty((rows, n), dtype=np.float32)
    for s, order in (("f", range(width)), ("b", range(width - 1, -1, -1))):
        h = np.zeros((rows, n), dtype=np.float32)
        for t in order:
            np.take(inputs[s], cols[t], axis=0, out=x)
            np.matmul(h, recur[s], out=a)
            np.add(x[:, :2 * n], a[:, :2 * n], out=g)
            np.maximum(g, 0.0, out=g)
            np.minimum(g, 1.0, out=g)
            np.multiply(g[:, n:], a[:, 2 * n:], out=c)
            c += x[:, 2 * n:]
            np.tanh(c, out=c)
            new = states[s][t]
            np.subtract(h, c, out=new)
            new *= g[:, :n]
            new += c
            h = new
    total = np.zeros((rows, len(model.langs)), dtype=np.float64)
    for t in range(width):
        y = states["f"][t] @ w["Vf"]
        y += states["b"][t] @ w["Vb"]
        y += w["b"]
        y -= y.max(1, keepdims=True)
        np.exp(y, out=y)
        y *= ((cols[t] > 0) / y.sum(1))[:, None].astype(np.float32)
        total += y
    return total


def predict(model: GruModel | None, texts: list[str | None], tile: int = 2048) -> tuple[list[str], list[float]]:
    """Language and score of each whole text."""
    out_lang, out_score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    if model is None or not model.langs:
        return out_lang, out_score
    width = model.window
    owners: list[np.ndarray] = []
    blocks: list[np.ndarray] = []
    pooled = np.zeros((len(texts), len(model.langs)))
    waiting = 0

    def flush() -> None:
        nonlocal waiting
        if not blocks:
            return
        seq, own = np.concatenate(blocks), np.concatenate(owners)
        for at in range(0, len(seq), tile):
            part = _probabilities(model, seq[at:at + tile])
            np.add.at(pooled, own[at:at + tile], part)
        blocks.clear()
        owners.clear()
        waiting = 0

    for i, text in enumerate(texts):
        if not isinstance(text, str) or not has_letter(text):
            continue
        data = np.frombuffer(text.lower().encode("utf-8", "replace"), dtype=np.uint8)
        for at in range(0, len(data), width * tile):  # a very long text goes in pieces of bounded size
            piece = data[at:at + width * tile]
            rows = -(-len(piece) // width)
            seq = np.zeros(rows * width, dtype=np.uint8)
            seq[:len(piece)] = piece
            blocks.append(seq.reshape(rows, width))
            owners.append(np.full(rows, i))
            waiting += rows
            if waiting >= 4 * tile:
                flush()
    flush()
    sums = pooled.sum(1)
    for i in np.flatnonzero(sums > 0):
        best = int(np.argmax(pooled[i]))
        out_lang[i], out_score[i] = model.langs[best], float(min(1.0, pooled[i, best] / sums[i]))
    return out_lang, out_score


def fit(docs: DataFrame, usable: Column, *, key: str = "doc_id", text: str = "text", lang: str = "lang",
        per_lang: int = 400, span: int = 768, max_langs: int = 200, **options) -> GruModel | None:
    """Train on at most ``per_lang`` documents of each of the ``max_langs`` most frequent languages.

    The sample holds the documents of smallest key hash; each gives ``span`` characters from a place
    its hash picks. Rows with a null key are not sampled.
    """
    pick = F.xxhash64(F.col(key).cast("string"), F.lit(11))
    start = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(13)),
                   F.greatest(F.length(text) - F.lit(span), F.lit(1)).cast("long")).cast("int") + 1
    labelled = docs.filter(usable & F.col(lang).isNotNull() & F.col(key).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("whole"), pick.alias("pick"), start.alias("start"))
    # the smallest hashes of each language are found without the texts; only rows that have them are then read
    known = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_langs).collect()
    if not known:
        return None

    def among(bounds: dict[str, int]) -> Column:
        hits = [(F.col("lang") == name) & (F.col("pick") <= F.lit(bound)) for name, bound in bounds.items()]
        return functools.reduce(lambda a, b: a | b, hits)

    # hashes are uniform: a bound that about eight times the sample's rows are under leaves few rows of any language to rank
    few = {r["lang"]: min(2 ** 63 - 1, -2 ** 63 + int(2 ** 64 * min(1.0, 8 * per_lang / r["count"]))) for r in known}
    place = F.row_number().over(Window.partitionBy("lang").orderBy("pick"))

    def least(bounds: dict[str, int]) -> list:
        return labelled.select("lang", "pick").filter(among(bounds)).withColumn("place", place).filter(
            F.col("place") <= per_lang).groupBy("lang").agg(F.max("pick").alias("last"), F.count("*").alias("n")).collect()

    last, sizes = least(few), {r["lang"]: r["count"] for r in known}
    if sum(r["n"] for r in last) < sum(min(per_lang, n) for n in sizes.values()):  # ids that repeat often share their hash
        last = least(dict.fromkeys(sizes, 2 ** 63 - 1))
    chosen = among({r["lang"]: r["last"] for r in last})
    rows = labelled.filter(chosen).filter(F.col("whole").rlike(r"\p{L}"))
    sample = rows.select("lang", F.col("pick").alias("rank"),
                         F.substring("whole", F.col("start"), F.lit(span)).alias("text")).collect()
    if not sample:
        return None
    sample = sorted((r["lang"], r["rank"], r["text"]) for r in sample)
    return train([r[2] for r in sample], [r[0] for r in sample], **options)


def identify(docs: DataFrame, model: GruModel | None, *, text: str = "text",
             keep: tuple[str, ...] | None = None) -> DataFrame:
    """``keep`` columns (default: all) with ``lang_pred`` and ``score`` for every row."""
    small_batches(docs.sparkSession)
    keep = tuple(docs.columns) if keep is None else keep
    fields = {f.name: f for f in docs.schema.fields}
    schema = ", ".join(f"`{c}` {fields[c].dataType.simpleString()}" for c in keep) + \
        ", lang_pred string, score double"
    columns = [F.col(c).alias(f"__{i}") for i, c in enumerate(keep)] + [F.col(text).alias("__text")]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in (part for whole in batches for part in slices(whole)):
            pred, score = predict(model, batch.column(batch.num_columns - 1).to_pylist())
            arrays = [batch.column(i) for i in range(batch.num_columns - 1)] + \
                [pa.array(pred, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "lang_pred", "score"])

    return docs.select(*columns).mapInArrow(run, schema)
