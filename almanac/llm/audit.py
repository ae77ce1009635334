"""Filter interaction audit: what each of five document filters removes in every order they can be applied in.

Texts are measured by a table-driven byte transducer. Every byte has a class (``CLASS``), a class has a next state
(``NEXT``: between words, inside a word) and what a transition puts out (``EMIT``: a word begins, a word ends, a
capital, a symbol, a code point). White space, capitals and symbols are ASCII, whose bytes occur in no longer UTF-8
sequence, and a class leads to the same state from every state; so all transitions of a batch of texts are looked up
at once instead of byte by byte. The word spans it puts out go into an open-addressing hash table whose hits are
verified byte by byte, so that two words count as one only if they are equal.

The rest is counting: a document becomes a digest of its text and a mask of failed filters. Copies are folded to one
row per text, part and label before anything meets by text, so a text that a third of all rows share is one row per
task. What the 120 orders remove follows from the counts of the masks alone: a filter removes what fails it and none
of the filters before it, so 80 pairs of (filter, set of filters before it) give all 600 steps.

Defined results: a null text is empty; a null source is part of the empty string's; a document without labels loses
nothing good or toxic, and one with several rows of ``labels`` counts as good or toxic if any row says so. Of rows
with equal texts those fail E whose doc_id is larger than the least one; rows of equal text and id do not make each
other fail, and a row without an id neither fails E nor makes another fail. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm.util import materialise

FILTERS = "ABCDE"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#$%&*|"
#: Failure conditions A to C: least words, percent of words that must be distinct, percent of capitals allowed.
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 65, 5

# ------------------------------------------------------------------------------ transducer

SPACE, CAPITAL, SYMBOL, OTHER, TAIL = range(5)  # classes of bytes; TAIL continues a UTF-8 sequence
BETWEEN, INSIDE = range(2)  # states
BEGINS, ENDS, IS_CAPITAL, IS_SYMBOL, IS_POINT = 1, 2, 4, 8, 16  # what a transition puts out

CLASS = np.full(256, OTHER, dtype=np.uint8)
CLASS[list(SPACES)] = SPACE
CLASS[ord("A"):ord("Z") + 1] = CAPITAL
CLASS[list(SYMBOLS)] = SYMBOL
CLASS[0x80:0xC0] = TAIL
#: next state by class: the same from every state
NEXT = np.array([BETWEEN, INSIDE, INSIDE, INSIDE, INSIDE], dtype=np.uint8)
#: output by state before and class
EMIT = np.zeros((2, 5), dtype=np.uint8)
EMIT[BETWEEN, 1:] |= BEGINS
EMIT[INSIDE, SPACE] |= ENDS
EMIT[:, CAPITAL] |= IS_CAPITAL
EMIT[:, SYMBOL] |= IS_SYMBOL
EMIT[:, :TAIL] |= IS_POINT
#: the two tables over bytes: output by 256 * state + byte
OUT = EMIT[:, CLASS].ravel()
STATE = NEXT[CLASS]


def transduce(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per text: code points, capitals, symbols; and all word spans with the text they are in.

    Texts are ``data[starts[i]:ends[i]]``, one after the other without gaps.
    """
    state = np.empty(len(data) + 1, dtype=np.uint8)
    state[0] = BETWEEN
    state[1:] = STATE[data]
    begin = starts[starts < ends]
    before = state[:-1].copy()
    before[begin] = BETWEEN  # a text begins between words
    out = OUT[(before.astype(np.uint16) << 8) | data]

    filled = starts < ends

    def per_text(flag):
        total = np.zeros(len(starts), dtype=np.int64)
        if len(data):
            total[filled] = np.add.reduceat(out & flag != 0, starts[filled], dtype=np.int64)
        return total

    opened = np.flatnonzero(out & BEGINS)
    closed = np.flatnonzero(out & ENDS)
    last = ends[starts < ends]  # a word that reaches the end of its text ends there
    closed = np.sort(np.concatenate([closed, last[state[last] == INSIDE]]))
    text = np.searchsorted(ends, opened, side="right")
    return per_text(IS_POINT), per_text(IS_CAPITAL), per_text(IS_SYMBOL), opened, closed, text


# ------------------------------------------------------------------------------ hash table of spans

#: Words of up to this many bytes are hashed and compared eight bytes at a time, longer ones as a whole.
LONG_WORD = 64


def _eights(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position of ``data``, which has 8 bytes to spare."""
    return np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))


def _first(size: np.ndarray) -> np.ndarray:
    """Masks of the first ``size`` (1 to 8) bytes of a little-endian word."""
    return ~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * size.astype(np.uint64))


def span_hashes(data: np.ndarray, begin: np.ndarray, size: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span, with its size and ``salt``."""
    eights = _eights(data)
    own = (salt.astype(np.uint64) + np.uint64(1)) * np.uint64(0xA0761D6478BD642F) + size.astype(np.uint64)
    rest, at = np.flatnonzero(size <= LONG_WORD), 0
    while rest.size:
        part = eights[begin[rest] + at] & _first(np.minimum(size[rest] - at, 8))
        mixed = (own[rest] ^ part) * np.uint64(0xE7037ED1A0B428DB)
        own[rest] = mixed ^ (mixed >> np.uint64(29))
        at += 8
        rest = rest[size[rest] > at]
    for i in np.flatnonzero(size > LONG_WORD):
        whole = hashlib.blake2b(data[begin[i]:begin[i] + size[i]], digest_size=8).digest()
        own[i] ^= np.uint64(int.from_bytes(whole, "little"))
    return own ^ (own >> np.uint64(32))


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether spans of equal ``size`` that begin at ``a`` and ``b`` hold equal bytes. ``data`` has 8 bytes to spare."""
    equal = np.ones(len(a), dtype=bool)
    eights = _eights(data)
    rest, at = np.flatnonzero(size <= LONG_WORD), 0
    while rest.size:
        differ = (eights[a[rest] + at] ^ eights[b[rest] + at]) & _first(np.minimum(size[rest] - at, 8))
        equal[rest[differ != 0]] = False
        at += 8
        rest = rest[(differ == 0) & (size[rest] > at)]
    for i in np.flatnonzero(size > LONG_WORD):
        equal[i] = np.array_equal(data[a[i]:a[i] + size[i]], data[b[i]:b[i] + size[i]])
    return equal


def first_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray, text: np.ndarray) -> np.ndarray:
    """One span of each distinct word of each text: all spans are put into one table keyed by text and bytes.

    In each round the spans that are left look at their slot; empty slots take one of them. A span equal to the
    one in its slot is done (it is that one or a copy); the others go on to the next slot.
    """
    if not len(begin):
        return np.zeros(0, dtype=np.int64)
    spare = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    size = end - begin
    hashes = span_hashes(spare, begin, size, text)
    capacity = 1 << int(2 * len(begin) - 1).bit_length()
    table = np.full(capacity, -1, dtype=np.int64)
    slot = (hashes & np.uint64(capacity - 1)).astype(np.int64)
    left = np.arange(len(begin))
    while left.size:
        here = slot[left]
        free = table[here] < 0
        table[here[free]] = left[free]  # one of several that meet in a slot stays
        held = table[here]
        equal = (held == left) | ((hashes[held] == hashes[left]) & (text[held] == text[left]) & (size[held] == size[left]))
        check = np.flatnonzero(equal & (held != left))
        equal[check] = same_bytes(spare, begin[left[check]], begin[held[check]], size[left[check]])
        left = left[~equal]
        slot[left] = (slot[left] + 1) & (capacity - 1)
    return table[table >= 0]


# ------------------------------------------------------------------------------ documents

#: Bytes of text measured at once (at least one text, or a piece of a longer one).
SLICE_BYTES = 2 << 20


def measure_long(data: np.ndarray, piece: int = SLICE_BYTES) -> tuple[int, ...]:
    """The same five counts of one text that is longer than ``piece``, cut after white space into pieces."""
    total, met, at = np.zeros(4, dtype=np.int64), set(), 0
    while at < len(data):
        stop = min(at + piece, len(data))
        while 0 < stop < len(data) and STATE[data[stop - 1]] != BETWEEN:  # go on to the end of the word
            window = data[stop:stop + 65_536]
            gap = np.flatnonzero(STATE[window] == BETWEEN)
            stop += int(gap[0]) + 1 if gap.size else len(window)
        part, edges = data[at:stop], (np.array([0]), np.array([stop - at]))
        points, capitals, symbols, begin, end, text = transduce(part, *edges)
        total += [len(begin), capitals[0], points[0], symbols[0]]
        raw = part.tobytes()
        met.update(raw[begin[i]:end[i]] for i in first_spans(part, begin, end, text))
        at = stop
    return int(total[0]), len(met), *(int(v) for v in total[1:])


def measure_texts(column: pa.Array) -> tuple[np.ndarray, ...]:
    """Per text: words, distinct words, capitals, code points, symbols."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if pa.types.is_large_string(column.type) else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    lo, hi = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(raw, dtype=np.uint8)[lo:hi] if raw is not None and hi > lo else np.zeros(0, dtype=np.uint8)
    starts, ends = offsets[:-1] - lo, offsets[1:] - lo
    if len(column) == 1 and len(data) > SLICE_BYTES:
        return tuple(np.array([v]) for v in measure_long(data))
    points, capitals, symbols, begin, end, text = transduce(data, starts, ends)
    words = np.bincount(text, minlength=len(starts))
    distinct = np.bincount(text[first_spans(data, begin, end, text)], minlength=len(starts))
    return words, distinct, capitals, points, symbols


def text_slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most ``SLICE_BYTES`` of text; a longer text is a slice of its own."""
    at, size = 0, 0
    for i, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        if size + n > SLICE_BYTES and i > at:
            yield batch.slice(at, i - at)
            at, size = i, 0
        size += n
    if at < batch.num_rows:
        yield batch.slice(at)


def masks(words, distinct, capitals, points, symbols) -> np.ndarray:
    """Bits of the filters A to D that a text fails."""
    failed = (words < LEAST_WORDS, 100 * distinct < DISTINCT_PERCENT * words,
              100 * capitals > CAPITAL_PERCENT * points, symbols > 0)
    return sum(f.astype(np.int32) << i for i, f in enumerate(failed))


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``id, part, digest, mask``: SHA-256 of every text and the filters A to D it fails."""
    narrow = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"),
                         F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, 2):
                column = b.column(2)
                digests = [hashlib.sha256(t.as_buffer()).digest() for t in column]
                failed = masks(*measure_texts(column)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(digests, pa.binary()), pa.array(failed)],
                                                 names=["id", "part", "digest", "mask"])

    return narrow.mapInArrow(run, "id long, part string, digest binary, mask int")


def counts(measured: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """``part, mask, good, toxic, n``: documents by the filters A to E they fail, and by label."""
    flags = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("of")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    named = measured.filter("id IS NOT NULL").join(flags, F.col("id") == F.col("of"), "left").select(
        "id", "part", "digest", "mask", F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"))
    what = ["part", "mask", "good", "toxic"]
    # one row per id and text, then one per text, part and label: copies are folded inside each task
    once = named.groupBy("id", "digest", *what).agg(F.count(F.lit(1)).alias("n"))
    folded = once.groupBy("digest", *what).agg(F.sum("n").alias("n"), F.min("id").alias("least"),
                                               F.min_by("n", "id").alias("n_least"))
    folded = materialise(folded, "texts")
    shared = folded.groupBy("digest").agg(F.min("least").alias("first"), F.sum("n").alias("copies")).filter(
        "copies > 1").select(F.col("digest").alias("same"), "first")
    first = folded.join(shared, F.col("digest") == F.col("same"), "left").withColumn(
        "stay", F.when(F.col("first").isNull() | (F.col("first") == F.col("least")), F.col("n_least")).otherwise(F.lit(0)))
    e = 1 << FILTERS.index("E")
    cases = F.array(F.struct(F.col("mask").alias("mask"), F.col("stay").alias("n")),
                    F.struct((F.col("mask") + e).alias("mask"), (F.col("n") - F.col("stay")).alias("n")))
    of_named = first.select("part", "good", "toxic", F.explode(cases).alias("c")).select(
        "part", "c.mask", "good", "toxic", "c.n")
    loose = measured.filter("id IS NULL").select("part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic"),
                                                 F.lit(1).cast("long").alias("n"))
    return of_named.unionByName(loose).groupBy(*what).agg(F.sum("n").alias("n"))


def steps() -> list[tuple[int, str, int, int, int]]:
    """Every step of every order: order as text, step, letter's bit, bits of the filters before it."""
    found = []
    for order in permutations(FILTERS):
        before = 0
        for place, letter in enumerate(order):
            bit = 1 << FILTERS.index(letter)
            found.append(("".join(order), place + 1, bit, before))
            before |= bit
    return found


def interactions(counted: DataFrame) -> DataFrame:
    """The audit's rows (see :func:`audit`) from the counts of the masks."""
    spark = counted.sparkSession
    orders = steps()
    often: dict[tuple[int, int], int] = {}  # in how many orders a filter comes right after these
    for _, _, bit, before in orders:
        often[bit, before] = often.get((bit, before), 0) + 1
    pairs = F.array(*[F.struct(F.lit(b).alias("bit"), F.lit(p).alias("before"), F.lit(n).cast("long").alias("orders"))
                      for (b, p), n in sorted(often.items())])
    wide = counted.select("*", F.explode(pairs).alias("s")).select(
        "part", "mask", "good", "toxic", "n", "s.bit", "s.before", "s.orders")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0

    def total(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))

    per_pair = wide.groupBy("part", "bit", "before", "orders").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"), total(fails & ~gone & F.col("good")).alias("good_lost"),
        total(fails & ~gone & F.col("toxic")).alias("toxic_lost"))
    per_pair = materialise(per_pair, "interactions")  # 80 rows a part
    shapley = per_pair.groupBy(F.col("part").alias("p"), F.col("bit").alias("b")).agg(
        F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    # the 600 steps: a fixed number, whatever the data
    listed = F.broadcast(spark.createDataFrame(orders, "filter_order string, step int, bit int, before int"))
    return per_pair.join(listed, ["bit", "before"]).join(
        shapley, (F.col("part") == F.col("p")) & (F.col("bit") == F.col("b"))).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``."""
    return interactions(counts(materialise(measure(docs, key, text, part), "measured"), labels, key))


def oracle_sql() -> str:
    """The same audit in DuckDB SQL over the ``documents`` and ``labels`` views."""
    letters = ", ".join(f"('{f}', {1 << i})" for i, f in enumerate(FILTERS))
    return f"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
     w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
                  doc_id > min(doc_id) OVER (PARTITION BY text) AS later FROM t),
     l AS (SELECT doc_id AS of, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels
           WHERE doc_id IS NOT NULL GROUP BY doc_id),
     d AS (SELECT part, (CASE WHEN len(ws) < {LEAST_WORDS} THEN 1 ELSE 0 END)
                  + (CASE WHEN 100 * len(list_distinct(ws)) < {DISTINCT_PERCENT} * len(ws) THEN 2 ELSE 0 END)
                  + (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {CAPITAL_PERCENT} * length(text) THEN 4 ELSE 0 END)
                  + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
                  + (CASE WHEN later THEN 16 ELSE 0 END) AS mask,
                  coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
           FROM w LEFT JOIN l ON w.doc_id = l.of),
     c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM d GROUP BY ALL),
     f AS (SELECT * FROM (VALUES {letters}) v(letter, bit)),
     o AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
                  [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
           FROM f a JOIN f b ON b.bit <> a.bit JOIN f c ON c.bit NOT IN (a.bit, b.bit)
           JOIN f d ON d.bit NOT IN (a.bit, b.bit, c.bit) JOIN f e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)),
     s AS (SELECT filter_order, CAST(unnest(range(1, 6)) AS INTEGER) AS step, bits FROM o),
     b AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0) AS before FROM s),
     r AS (SELECT part, filter_order, step, bit,
                  CAST(coalesce(sum(n) FILTER (mask & bit = 0 AND mask & before = 0), 0) AS BIGINT) AS kept,
                  CAST(coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS BIGINT) AS removed,
                  CAST(coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0), 0) AS BIGINT) AS redundant,
                  CAST(coalesce(sum(n) FILTER (mask = bit), 0) AS BIGINT) AS unique_fails,
                  CAST(coalesce(sum(g) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS BIGINT) AS good_lost,
                  CAST(coalesce(sum(x) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS BIGINT) AS toxic_lost
           FROM (SELECT c.*, filter_order, step, bit, CAST(before AS INTEGER) AS before FROM c CROSS JOIN b) y GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM r"""
