"""SentencePiece encoding by sampled segmentation, and lossless decoding.

A text is cut into units at its blanks (a word with the blank before it, or a run of blanks); every
unit has a lattice of vocabulary pieces. Forward filtering gives each lattice node the log-sum of all
segmentations that reach it; backward sampling then walks from the end of the unit to its start and
draws each piece in proportion to the segmentations it closes. The draw at a place is a hash of the
row's key and the place, so a row is segmented the same way on every run, in any partitioning, and
differently for another key or seed. ``alpha`` sharpens (above 1) or flattens (below 1) the draw.

The vocabulary file ranks its pieces; a piece's log-probability follows Zipf's law on the rank.
Characters without a piece are spelt in byte pieces. Pieces hold real blanks here, so a literal
U+2581 is spelt in bytes and decoding gives back every text exactly, byte for byte.

Both directions are maps over the table: numpy works on a few MB of text at a time, the lattices of
recent units are kept in a table of bounded size, and nothing is shuffled. The vocabulary is broadcast
(its size does not depend on the data).

Defined results: a null text has null pieces, an empty one none; null keys count as one fixed key.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.llm.shingles import mix, string_bytes
from almanac.llm.util import slices, small_batches

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
_UNIT = re.compile(r" ?[^ ]+| +")
#: Lattices a task keeps (about 0.4 kB each); beyond it, those of units met least often go. More save time.
KEPT_UNITS = 500_000
_BYTE = 1 << 24  # a lattice edge of this value plus a code point spells the character in bytes


def load_vocabulary(path: str = VOCABULARY) -> dict:
    """Pieces with real blanks, their byte forms and log-probabilities, from a SentencePiece model file."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    pieces, forms, byte_ids = {}, [], [0] * 256
    order = sorted((i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))),
                   key=lambda i: (-sp.get_score(i), i))
    rank = {i: r for r, i in enumerate(order)}
    log_p = np.zeros(n)
    for i in range(n):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            value = int(piece[3:5], 16)
            byte_ids[value] = i
            forms.append(bytes([value]))
        elif i in rank:
            text = piece.replace("▁", " ")
            pieces[text] = i
            forms.append(text.encode())
            log_p[i] = -np.log(rank[i] + 2.7)
        else:
            forms.append(b"")
    log_p -= np.log(sum(1 / (r + 2.7) for r in range(len(order))))
    return {"pieces": pieces, "forms": forms, "byte_ids": byte_ids, "log_p": log_p,
            "byte_log_p": -float(np.log(n + 2.7)) * 2}


_STEP = np.uint64(0xD6E8FEB86659FD93)


def _piece_table(vocabulary: dict) -> dict:
    """Per piece length: sorted hashes and ids, and a bit table that most other strings miss."""
    if "table" not in vocabulary:
        by_length: dict[int, list[tuple[str, int]]] = {}
        for text, i in vocabulary["pieces"].items():
            by_length.setdefault(len(text), []).append((text, i))
        table = {}
        for n, found in by_length.items():
            points = np.frombuffer("".join(t for t, _ in found).encode("utf-32-le"), np.uint32).reshape(-1, n)
            with np.errstate(over="ignore"):
                h = np.zeros(len(found), np.uint64)
                for k in range(n):
                    h = h * _STEP + mix(points[:, k].astype(np.uint64) + np.uint64(1))
                h = mix(h)
            order = np.argsort(h)
            seen = np.zeros(1 << 20, dtype=bool)
            seen[h >> np.uint64(44)] = True
            table[n] = (h[order], np.array([i for _, i in found], np.int32)[order], seen)
        vocabulary["table"] = table
    return vocabulary["table"]


class Growing:
    """A numpy array that grows at its end. Room is reserved, not filled: pages are taken as they are written."""

    def __init__(self, kind, room: int = 1 << 23):
        self.data, self.size = np.empty(room, kind), 0

    def extend(self, values: np.ndarray) -> None:
        size = self.size + len(values)
        if size > len(self.data):
            grown = np.empty(max(size, 3 * len(self.data) // 2), self.data.dtype)
            grown[:self.size] = self.data[:self.size]
            self.data = grown
        self.data[self.size:size] = values
        self.size = size


@dataclass
class Lattices:
    """Lattices of units, flattened: unit u has nodes first[u] .. first[u] + length[u].

    The edges that end in a node stand together from ``edge[node]`` on; ``cum`` is their cumulative
    probability within the node, so a draw takes the first edge whose value exceeds it.
    """

    vocabulary: dict
    alpha: float
    number: dict = field(default_factory=dict)
    first: Growing = field(default_factory=lambda: Growing(np.int64))
    length: Growing = field(default_factory=lambda: Growing(np.int64))
    edge: Growing = field(default_factory=lambda: Growing(np.int32))
    cum: Growing = field(default_factory=lambda: Growing(np.float32))
    start: Growing = field(default_factory=lambda: Growing(np.int32))
    piece: Growing = field(default_factory=lambda: Growing(np.int32))
    uses: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    nodes: int = 0
    kept: int = KEPT_UNITS

    def numbers(self, units: list[str]) -> np.ndarray:
        """The number of every unit's lattice; missing ones are made."""
        if len(self.number) > self.kept:
            self.shrink(self.kept // 2)
        found = list(map(self.number.get, units))
        if None in found:
            self.add(list(dict.fromkeys(u for u, n in zip(units, found, strict=True) if n is None)))
            found = list(map(self.number.__getitem__, units))
        which = np.array(found, np.int64)
        counts = np.bincount(which, minlength=len(self.number))
        counts[:len(self.uses)] += self.uses
        self.uses = counts
        return which

    def shrink(self, most: int) -> None:
        """Keep the ``most`` lattices met most often; the others are made again when they are met again."""
        kept = np.sort(np.argsort(-self.uses, kind="stable")[:most])
        first, size = self.first.data[kept], self.length.data[kept] + 1
        new_first = np.cumsum(size) - size
        edge_end = np.append(self.edge.data[:self.nodes], np.int32(self.cum.size))
        low, width = edge_end[first], edge_end[first + size] - edge_end[first]
        new_low = (np.cumsum(width) - width).astype(np.int32)
        # places fit 32 bits; one column at a time is moved, so that little stands beside the lattices
        nodes = np.repeat((first - new_first).astype(np.int32), size)
        nodes += np.arange(len(nodes), dtype=np.int32)
        edge = edge_end[nodes]
        edge += np.repeat(new_low - low, size)
        del nodes, edge_end
        edges = np.repeat(low - new_low, width)
        edges += np.arange(len(edges), dtype=np.int32)
        for name in ("cum", "start", "piece"):
            values = getattr(self, name).data[edges]
            if name == "start":
                values += np.repeat((new_first - first).astype(np.int32), width)
            self._replace(name, values)
        self._replace("edge", edge)
        self._replace("first", new_first)
        self._replace("length", size - 1)
        names = list(self.number)
        self.number = {names[u]: i for i, u in enumerate(kept.tolist())}
        self.uses = self.uses[kept] // 2  # older uses count less
        self.nodes = int(size.sum())

    def _replace(self, name: str, values: np.ndarray) -> None:
        column = Growing(getattr(self, name).data.dtype)
        column.extend(values)
        setattr(self, name, column)

    def _edges(self, units: list[str], length: np.ndarray):
        """All edges of new units: end node, start node and piece, by piece length."""
        points = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.uint64)
        unit = np.repeat(np.arange(len(units)), length)
        left = np.cumsum(length)[unit] - np.arange(len(points))  # characters to the unit's end
        value = mix(points + np.uint64(1))
        h, at = np.zeros(len(points), np.uint64), np.arange(len(points))
        table = _piece_table(self.vocabulary)
        ends, starts, pieces = [], [], []
        for n in range(1, max(table) + 1):
            on = left[at] >= n
            at, h = at[on], h[on]
            if not len(at):
                break
            h = h * _STEP + value[at + n - 1]
            if n not in table:
                continue
            hashes, ids, seen = table[n]
            full = mix(h)
            maybe = np.flatnonzero(seen[full >> np.uint64(44)])
            place = np.minimum(np.searchsorted(hashes, full[maybe]), len(hashes) - 1)
            hit = hashes[place] == full[maybe]
            who, found = at[maybe[hit]], ids[place[hit]]
            if n == 1:
                spelt = np.ones(len(points), dtype=bool)
                spelt[who] = False
                rest = np.flatnonzero(spelt)  # characters without a piece
                who = np.concatenate((who, rest))
                found = np.concatenate((found, (_BYTE + points[rest].astype(np.int64)).astype(np.int32)))
            begin = who + unit[who]
            starts.append(begin)
            ends.append(begin + n)
            pieces.append(found)
        return np.concatenate(ends), np.concatenate(starts), np.concatenate(pieces)

    def add(self, units: list[str]) -> None:
        """Forward filtering of new units, all of them position by position."""
        log_p = self.vocabulary["log_p"]
        length = np.fromiter(map(len, units), np.int64, len(units))
        first = np.cumsum(length + 1) - length - 1
        size = int(length.sum()) + len(units)
        with np.errstate(over="ignore"):
            end, start, piece = self._edges(units, length)
        order = np.argsort(end, kind="stable")
        end, start, piece = end[order], start[order], piece[order]
        byte = piece >= _BYTE
        weight = log_p[np.where(byte, 0, piece)]
        if byte.any():
            point = piece[byte] - _BYTE
            weight[byte] = self.vocabulary["byte_log_p"] * (1 + (point > 0x7F) + (point > 0x7FF) + (point > 0xFFFF))
        weight *= self.alpha
        node_first = np.searchsorted(end, np.arange(size + 1))
        width = np.diff(node_first)
        pos = np.arange(size) - np.repeat(first, length + 1)  # of every node in its unit
        total, cum = np.zeros(size), np.empty(len(end), np.float32)
        deepest = int(length.max()) if len(length) else 0
        by_pos = np.argsort(pos.astype(np.uint16) if deepest < 1 << 16 else pos, kind="stable")
        cuts = np.searchsorted(pos[by_pos], np.arange(1, deepest + 2))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            node = by_pos[a:b]
            n = width[node]
            heads = np.cumsum(n) - n
            edges = np.repeat(node_first[node] - heads, n) + np.arange(int(n.sum()))
            score = total[start[edges]] + weight[edges]
            top = np.maximum.reduceat(score, heads)
            mass = np.exp(score - np.repeat(top, n))
            sums = np.add.reduceat(mass, heads)
            total[node] = top + np.log(sums)
            run = np.cumsum(mass)
            part = (run - np.repeat(run[heads] - mass[heads], n)) / np.repeat(sums, n)
            part[heads + n - 1] = 2.0  # the last edge takes every draw that is left
            cum[edges] = part
        base = self.nodes
        self.edge.extend(node_first[:-1] + self.cum.size)
        self.cum.extend(cum)
        self.start.extend(start + base)
        self.piece.extend(piece)
        self.first.extend(first + base)
        self.length.extend(length)
        self.number.update(zip(units, range(len(self.number), len(self.number) + len(units)), strict=True))
        self.nodes = base + size


def _sample(lat: Lattices, texts: list[str], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of all texts one after another, and the number of pieces of each text."""
    units, counts = [], np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        found = _UNIT.findall(t)
        counts[i] = len(found)
        units += found
    which = lat.numbers(units)
    length, first = lat.length.data[which], lat.first.data[which]
    row = np.repeat(np.arange(len(texts)), counts)
    ends = np.cumsum(length)
    text_start = np.concatenate(([0], ends))[np.cumsum(counts) - counts] if len(texts) else ends
    offset = ends - length - text_start[row]  # of the unit in its text
    with np.errstate(over="ignore"):
        seed = mix(seeds[row] + offset.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    node, active, step = first + length, np.arange(len(units)), 0
    drawn: list[tuple[np.ndarray, np.ndarray]] = []
    taken = np.zeros(len(units), np.int64)
    while len(active):
        now = node[active]
        with np.errstate(over="ignore"):
            place = (now - first[active]).astype(np.uint64)
            u = (mix(seed[active] + place * np.uint64(0xD1B54A32D192ED03)) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
        # the first edge of the node whose cumulative probability exceeds the draw
        edge, cum = lat.edge.data[now], lat.cum.data
        behind = np.flatnonzero(cum[edge] <= u)
        while len(behind):
            edge[behind] += 1
            behind = behind[cum[edge[behind]] <= u[behind]]
        drawn.append((active, lat.piece.data[edge]))
        node[active] = lat.start.data[edge]
        taken[active] += 1
        active = active[node[active] > first[active]]
        step += 1
    out = np.empty(int(taken.sum()), np.int64)
    close = np.cumsum(taken)
    for k, (who, piece) in enumerate(drawn):
        out[close[who] - 1 - k] = piece
    totals = np.zeros(len(texts), np.int64)
    np.add.at(totals, row, taken)
    return out, totals


def _spell(lat: Lattices, out: np.ndarray, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace byte edges by their byte pieces."""
    byte = np.flatnonzero(out >= _BYTE)
    if not len(byte):
        return out.astype(np.int32), totals
    ids = lat.vocabulary["byte_ids"]
    points, which = np.unique(out[byte], return_inverse=True)
    spelt = [[ids[b] for b in chr(int(p) - _BYTE).encode()] for p in points]
    widths = np.ones(len(out), np.int64)
    widths[byte] = np.array([len(s) for s in spelt])[which]
    result = np.repeat(out, widths)
    at = (np.cumsum(widths) - widths)[byte]
    for k in range(4):
        has = np.array([len(s) > k for s in spelt])[which]
        result[at[has] + k] = np.array([s[k] if len(s) > k else 0 for s in spelt])[which][has]
    row = np.repeat(np.arange(len(totals)), totals)
    grown = totals.copy()
    np.add.at(grown, row[byte], widths[byte] - 1)
    return result.astype(np.int32), grown


def encode_texts(lat: Lattices, texts: list[str], seeds: np.ndarray, chunk: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
    """Sampled pieces (int32) of all texts, and each text's number of pieces."""
    outs, totals, at = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop]) <= chunk):
            size += len(texts[stop])
            stop += 1
        out, n = _spell(lat, *_sample(lat, texts[at:stop], seeds[at:stop]))
        outs.append(out)
        totals.append(n)
        at = stop
    return np.concatenate(outs), np.concatenate(totals)


def decode_pieces(vocabulary: dict, pieces: np.ndarray) -> np.ndarray:
    """The bytes that a run of pieces spells."""
    if "blob" not in vocabulary:
        forms = vocabulary["forms"]
        vocabulary["blob"] = np.frombuffer(b"".join(forms), np.uint8)
        vocabulary["widths"] = np.array([len(f) for f in forms], np.int32)
        vocabulary["starts"] = (np.cumsum(vocabulary["widths"]) - vocabulary["widths"]).astype(np.int32)
    out = []
    for at in range(0, len(pieces), 1 << 18):  # a stretch at a time: places fit 32 bits and the cache
        part = pieces[at:at + (1 << 18)]
        widths = vocabulary["widths"][part]
        before = np.cumsum(widths, dtype=np.int32) - widths
        where = np.repeat(vocabulary["starts"][part] - before, widths)
        where += np.arange(len(where), dtype=np.int32)
        out.append(vocabulary["blob"][where])
    return np.concatenate(out) if out else np.zeros(0, np.uint8)


def _seed(key: str, seed: int) -> Column:
    return F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(seed))


def encode(df: DataFrame, *, key: str = "doc_id", text: str = "text", path: str = VOCABULARY, alpha: float = 1.0,
           seed: int = 1, keep: tuple[str, ...] = ("doc_id",), kept_units: int = KEPT_UNITS) -> DataFrame:
    """``keep`` columns, ``pieces`` (sampled ids) and ``lossless`` (the pieces decode to the text's own bytes)."""
    small_batches(df.sparkSession)
    fields = {f.name: f for f in df.schema.fields}
    schema = ", ".join(f"`{c}` {fields[c].dataType.simpleString()}" for c in keep) + ", pieces array<int>, lossless boolean"
    shared = df.sparkSession.sparkContext.broadcast(load_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = dict(shared.value)
        lat = Lattices(vocabulary, alpha, kept=kept_units)
        for whole in batches:
            for batch in slices(whole):
                column = batch.column(batch.num_columns - 2)
                null = np.asarray(column.is_null())
                texts = [x if x is not None else "" for x in column.to_pylist()]
                seeds = np.asarray(batch.column(batch.num_columns - 1)).astype(np.int64).view(np.uint64)
                ids, totals = encode_texts(lat, texts, seeds)
                offsets = np.concatenate(([0], np.cumsum(totals)))
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids),
                                                 mask=pa.array(null) if null.any() else None)
                data, starts, ends = string_bytes(column)
                same = []
                plain = decode_pieces(vocabulary, ids)
                widths = np.concatenate(([0], np.cumsum(vocabulary["widths"][ids], dtype=np.int64)))[offsets]
                for i in range(len(texts)):
                    same.append(None if null[i] else bool(np.array_equal(plain[widths[i]:widths[i + 1]],
                                                                         data[starts[i]:ends[i]])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i) for i in range(batch.num_columns - 2)] + [lists, pa.array(same, pa.bool_())],
                    names=[*keep, "pieces", "lossless"])

    columns = [F.col(c).alias(f"__{i}") for i, c in enumerate(keep)]
    return df.select(*columns, F.col(text).alias("__text"), _seed(key, seed).alias("__seed")).mapInArrow(run, schema)


def decode(df: DataFrame, *, pieces: str = "pieces", path: str = VOCABULARY, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``text``: the text the pieces spell (null for null pieces)."""
    fields = {f.name: f for f in df.schema.fields}
    schema = ", ".join(f"`{c}` {fields[c].dataType.simpleString()}" for c in keep) + ", text string"
    shared = df.sparkSession.sparkContext.broadcast(load_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = dict(shared.value)
        for batch in batches:
            texts = []
            for ids in batch.column(batch.num_columns - 1):
                texts.append(None if not ids.is_valid else decode_pieces(
                    vocabulary, np.asarray(ids.values, dtype=np.int64)).tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(batch.num_columns - 1)] +
                                             [pa.array(texts, pa.string())], names=[*keep, "text"])

    columns = [F.col(c).alias(f"__{i}") for i, c in enumerate(keep)]
    return df.select(*columns, F.col(pieces).alias("__pieces")).mapInArrow(run, schema)
