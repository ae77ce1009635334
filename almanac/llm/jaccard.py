"""N-gram Jaccard join: a grouped prefix join over sets of word shingles, exact at any threshold.

1. Frequency sketch: one pass counts shingles in 2**20 hash buckets (a table of fixed size). The
   order (bucket count, hash) is the same everywhere, so it serves the prefix filter, and common
   lines and passages come last in it.
2. Each text becomes its set's digest and its prefix: the first ``n - ceil(t n) + 1`` shingles in
   that order. Two sets with Jaccard of at least t share a prefix shingle.
3. Documents with identical prefixes and size are one group; only groups send prefix shingles.
   Shingles met by one group with one class (set of equal texts) link nothing and go.
4. Remaining groups expand to their classes. Candidate pairs pass the size and positional filters and
   are verified on the exact sets of both texts.

Large clusters of near copies would give all pairs of their members. Two linear rounds come first:
in every shingle's list, in a random order, each class meets only its next one, and verified links
join classes into components. The exact round then pairs only classes that are still in different
components, walking from the classes outside a list's largest component. Pairs left out are inside
one component already, so components are exact, though not every link is tested.

Defined results: null and wordless texts have an empty set and link with nothing; rows with a null
id are left out of linking and keep a null component; a document repeated under one id with other texts
links through any of them, and each row reports the component of its own text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.components import connected_components
from almanac.llm.shingles import sets_of
from almanac.llm.util import materialise, slices, small_batches

ORDER_BITS = 20
_BLOCK = 1 << 14
#: A bucket with this share of all shingles is dealt over ``HOT_SALTS`` tasks; at most 1 / share of them exist.
HOT_SHARE, HOT_SALTS = 0.0005, 64


def shingle_frequencies(docs: DataFrame, text: str, k: int) -> tuple[np.ndarray, int]:
    """Counts of shingles (once a document) by the hash's top bits, and their total."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << ORDER_BITS, dtype=np.int64)
        shift = np.uint64(64 - ORDER_BITS)
        for batch in (part for whole in batches for part in slices(whole)):
            found = [s for s in sets_of(batch.column(0), k) if len(s)]
            if found:
                counts += np.bincount((np.concatenate(found) >> shift).astype(np.int64), minlength=len(counts))
        blocks = counts.reshape(-1, _BLOCK)
        used = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([_pack(blocks[i]) for i in used], pa.binary())], names=["block", "counts"])

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        whole = sum((_unpack(x) for x in pdf["counts"]), np.zeros(_BLOCK, dtype=np.int64))
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "counts": [whole.tobytes()]})

    parts = docs.select(text).mapInArrow(run, "block int, counts binary")
    counts = np.zeros(((1 << ORDER_BITS) // _BLOCK, _BLOCK), dtype=np.int64)
    for row in parts.groupBy("block").applyInPandas(total, "block int, counts binary").collect():
        counts[row["block"]] = np.frombuffer(row["counts"], dtype=np.int64)
    counts = counts.reshape(-1)
    return counts, int(counts.sum())


def _pack(counts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(counts.astype(np.uint32).tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint32).astype(np.int64)


def prefix_of(s: np.ndarray, ranks: np.ndarray, percent: int) -> np.ndarray:
    """The prefix of a sorted set in the global order (bucket rank, hash)."""
    n = len(s)
    size = n - -(-percent * n // 100) + 1
    bucket = (s >> np.uint64(64 - ORDER_BITS)).astype(np.int64)
    return s[np.argsort(ranks[bucket], kind="stable")[:size]]


def _profiles(docs: DataFrame, key: str, text: str, k: int, percent: int, ranks) -> DataFrame:
    """Per row: ``id, n``, 128-bit digests of the set and of the prefix, and the prefix as bytes."""
    schema = "id long, n long, digest binary, group binary, prefix binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = ranks.value

        def digest(x: bytes) -> bytes:
            return hashlib.blake2b(x, digest_size=16).digest()

        for batch in (part for whole in batches for part in slices(whole)):
            sizes, digests, groups, prefixes = [], [], [], []
            for s in sets_of(batch.column(1), k):
                p = prefix_of(s, order, percent).tobytes() if len(s) else b""
                sizes.append(len(s))
                digests.append(digest(s.tobytes()))
                groups.append(digest(len(s).to_bytes(8, "little") + p))
                prefixes.append(p)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(groups, pa.binary()), pa.array(prefixes, pa.binary())],
                names=["id", "n", "digest", "group", "prefix"])

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, schema)


def _tokens(groups: DataFrame, hot: list[int]) -> DataFrame:
    """One row a prefix shingle of a group: ``s, p, salt, gid, n, classes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            raw = batch.column(3)
            sizes = np.fromiter((len(x.as_py()) // 8 for x in raw), np.int64, len(raw))
            if not sizes.sum():
                continue
            s = np.frombuffer(b"".join(x.as_py() for x in raw), dtype=np.int64)
            p = np.arange(len(s)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(s), pa.array(p.astype(np.int32))] +
                [pa.array(np.repeat(np.asarray(batch.column(i)), sizes)) for i in range(3)],
                names=["s", "p", "gid", "n", "classes"])

    rows = groups.select("gid", F.col("n").cast("int"), F.col("classes").cast("int"), "prefix").mapInArrow(
        run, "s long, p int, gid long, n int, classes int")
    return rows.withColumn("salt", _salt("gid", hot))


def _salt(who: str, hot: list[int]) -> Column:
    if not hot:
        return F.lit(-1)
    bucket = F.shiftrightunsigned("s", 64 - ORDER_BITS).cast("int")
    return F.when(bucket.isin(hot), F.pmod(F.xxhash64(who, "s"), F.lit(HOT_SALTS)).cast("int")).otherwise(-1)


def _may_link(percent: int, a: str, b: str) -> Column:
    """Size filter and positional filter of a pair met at one prefix shingle."""
    na, nb = F.col(f"n{a}"), F.col(f"n{b}")
    size = (100 * na >= percent * nb) & (100 * nb >= percent * na)
    rest = 1 + F.least(na - F.col(f"p{a}") - 1, nb - F.col(f"p{b}") - 1)
    return size & ((100 + percent) * rest >= percent * (na + nb))


def _chain(tokens: DataFrame, percent: int, seed: int, hot: list[int]) -> DataFrame:
    """Candidate pairs of classes next to each other in a shingle's list, in a random order."""
    order = Window.partitionBy("s", "salt").orderBy(F.xxhash64("c", "s", F.lit(seed)), "c")
    prev = F.lag(F.struct("c", "n", "p", "comp")).over(order)
    near = tokens.withColumn("salt", _salt("c", hot)).withColumn("b", prev).filter("b.comp <> comp").select(
        "c", "n", "p", F.col("b.c").alias("c2"), F.col("b.n").alias("n2"), F.col("b.p").alias("p2"))
    return near.filter(_may_link(percent, "", "2")).select(
        F.least("c", "c2").alias("u"), F.greatest("c", "c2").alias("v")).distinct()


def _rest(tokens: DataFrame, percent: int) -> DataFrame:
    """All candidate pairs of classes in different components, from those outside a list's largest one."""
    lists = tokens.groupBy("s", "comp").agg(F.count("*").alias("k")).groupBy("s").agg(
        F.max_by("comp", F.struct("k", "comp")).alias("major"))
    marked = tokens.join(lists.withColumnRenamed("s", "ls"), F.col("s") == F.col("ls"))
    side = marked.filter("comp <> major").select(
        F.col("s").alias("s1"), F.col("c").alias("c1"), F.col("n").alias("n1"), F.col("p").alias("p1"),
        F.col("comp").alias("comp1"))
    other = marked.select("s", F.col("c").alias("c2"), F.col("n").alias("n2"), F.col("p").alias("p2"),
                          F.col("comp").alias("comp2"), "major")
    met = side.join(other, (F.col("s1") == F.col("s")) & (F.col("comp1") != F.col("comp2"))
                    & ((F.col("comp2") == F.col("major")) | (F.col("c1") < F.col("c2"))) & _may_link(percent, "1", "2"))
    return met.select(F.least("c1", "c2").alias("u"), F.greatest("c1", "c2").alias("v")).distinct()


def _verify(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs whose texts' sets reach the threshold; texts travel compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        # compressed texts: a MB of them makes several of text and shingles
        for batch in (part for whole in batches for part in slices(whole, 1 << 20)):
            a, b = (pa.array([unpack.decompress(x.as_py()) for x in batch.column(i)], pa.large_binary())
                    .cast(pa.large_string()) for i in (2, 3))
            ok = []
            for x, y in zip(sets_of(a, k), sets_of(b, k), strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["u", "v"])

    left = pairs.join(texts.select(F.col("c").alias("u"), F.col("z").alias("zu")), "u")
    both = left.join(texts.select(F.col("c").alias("v"), F.col("z").alias("zv")), "v")
    return both.select("u", "v", "zu", "zv").mapInArrow(run, "u long, v long")


def _packed_texts(docs: DataFrame, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """``c, z``: the compressed text of every class (by the id that stands for it) in ``wanted``.

    A bit table of fixed size, built from the wanted ids, lets tasks skip most other texts before the
    shuffle; the join that follows is exact.
    """
    bits = 22

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(1 << bits, dtype=bool)
        for pdf in batches:
            seen[pdf["h"].to_numpy()] = True
        blocks = np.packbits(seen).reshape(-1, 1 << 13)
        used = np.flatnonzero(blocks.any(axis=1))
        yield pd.DataFrame({"block": used.astype("int32"), "bits": [blocks[i].tobytes() for i in used]})

    def union(pdf: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(1 << 13, dtype=np.uint8)
        for x in pdf["bits"]:
            out |= np.frombuffer(x, dtype=np.uint8)
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "bits": [out.tobytes()]})

    def place(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(1 << bits)).cast("int")

    rows = wanted.select(place("c").alias("h")).mapInPandas(mark, "block int, bits binary").groupBy("block") \
        .applyInPandas(union, "block int, bits binary").collect()
    flat = np.zeros((((1 << bits) // 8) >> 13, 1 << 13), dtype=np.uint8)
    for r in rows:
        flat[r["block"]] = np.frombuffer(r["bits"], dtype=np.uint8)
    seen = docs.sparkSession.sparkContext.broadcast(np.unpackbits(flat.reshape(-1)).astype(bool))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in (part for whole in batches for part in slices(whole)):
            keep = pa.array(seen.value[np.asarray(batch.column(2))])
            ids, texts = batch.column(0).filter(keep), batch.column(1).filter(keep)
            z = [squeeze.compress((x.as_py() or "").encode()) for x in texts]
            yield pa.RecordBatch.from_arrays([ids, pa.array(z, pa.binary())], names=["c", "z"])

    named = docs.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("c"), F.col(text).alias("text"))
    packed = named.withColumn("h", place("c")).mapInArrow(pack, "c long, z binary")
    return packed.join(wanted, "c", "left_semi").dropDuplicates(["c", "z"])


def jaccard_components(docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = 5,
                       percent: int = 75, linear_rounds: int = 2) -> DataFrame:
    """``key, n_shingles, component_id`` for every row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    named = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    counts, total = shingle_frequencies(named, "text", k)
    ranks = np.empty(len(counts), dtype=np.int32)  # one place a bucket, by count then number
    ranks[np.argsort(counts, kind="stable")] = np.arange(len(counts), dtype=np.int32)
    hot = np.flatnonzero(counts >= max(HOT_SHARE * total, 1000)).tolist()
    order = spark.sparkContext.broadcast(ranks)
    rows = materialise(_profiles(named, "id", "text", k, percent, order), "profiles")

    usable = rows.filter("id IS NOT NULL AND n > 0")
    classes = materialise(usable.groupBy("digest", "n").agg(F.min("id").alias("c"), F.first("group").alias("group")),
                          "classes")
    groups = usable.groupBy("group").agg(F.min("id").alias("gid"), F.first("n").alias("n"),
                                         F.first("prefix").alias("prefix"))
    sizes = classes.groupBy("group").agg(F.count("*").alias("classes"))
    groups = groups.join(sizes, "group").select("gid", "n", "classes", "prefix")
    # shingles of a single group with a single class link nothing
    lists = Window.partitionBy("s", "salt").orderBy("gid")
    seen = _tokens(groups, hot)
    alone = F.lag("gid").over(lists).isNull() & F.lead("gid").over(lists).isNull()
    shared = seen.withColumn("alone", alone).filter("NOT alone OR classes > 1 OR salt >= 0")
    group_of = classes.join(classes.groupBy("group").agg(F.min("c").alias("gid")), "group").select("gid", "c")
    expanded = materialise(shared.select("s", "p", "gid", "n").join(group_of, "gid").select("s", "p", "n", "c"), "tokens")

    wanted = materialise(expanded.select("c").distinct(), "wanted")
    texts = materialise(_packed_texts(named, "id", "text", wanted), "texts")
    comps, tested = None, None
    for turn in range(linear_rounds + 1):
        tokens = expanded.withColumn("comp", F.col("c")) if comps is None else expanded.join(
            comps.select(F.col("node").alias("c"), "component"), "c", "left").withColumn(
            "comp", F.coalesce("component", "c")).drop("component")
        if comps is not None:  # only lists with several components can still link
            mixed = tokens.groupBy("s").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select(
                F.col("s").alias("ms"))
            tokens = tokens.join(mixed, F.col("s") == F.col("ms"), "left_semi")
        pairs = _chain(tokens, percent, turn, hot) if turn < linear_rounds else _rest(tokens, percent)
        if tested is not None:
            pairs = pairs.join(tested, ["u", "v"], "left_anti")
        pairs = materialise(pairs, "pairs")
        links = _verify(pairs, texts, k, percent)
        if comps is not None:
            links = links.unionByName(comps.select(F.col("component").alias("u"), F.col("node").alias("v")))
        tested = pairs if tested is None else tested.unionByName(pairs)
        comps = materialise(connected_components(links), "components")
    known = classes.join(comps.select(F.col("node").alias("c"), "component"), "c", "left").select(
        "digest", "n", F.coalesce("component", "c").alias("component_id"))
    known = materialise(known, "classes")
    out = rows.select("id", "n", "digest").join(
        known.select(F.col("digest").alias("kd"), F.col("n").alias("kn"), "component_id"),
        (F.col("digest") == F.col("kd")) & (F.col("n") == F.col("kn")) & F.col("id").isNotNull(), "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"),
                      F.coalesce("component_id", "id").alias("component_id"))


def oracle_sql(k: int = 5, percent: int = 75) -> str:
    """The same components in DuckDB SQL over the ``documents`` view (all pairs: for small tables)."""
    after = " || ' ' || ".join(["word"] + [f"lead(word, {j}) OVER w" for j in range(1, k)])
    return f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id,
                         list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
                     FROM documents),
     o AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d WHERE len(ws) >= {k}),
     g AS (SELECT DISTINCT rid, g FROM (SELECT rid, {after} AS g FROM o WINDOW w AS (PARTITION BY rid ORDER BY i))
           WHERE g IS NOT NULL
           UNION ALL SELECT rid, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND {k - 1}),
     sizes AS (SELECT rid, count(*) AS n FROM g GROUP BY rid),
     sets AS (SELECT d.doc_id, coalesce(sizes.n, 0) AS n FROM d LEFT JOIN sizes ON d.rid = sizes.rid),
     t AS (SELECT d.doc_id, sizes.n, g.g FROM g JOIN d ON d.rid = g.rid JOIN sizes ON sizes.rid = g.rid),
     p AS (SELECT a.doc_id AS x, b.doc_id AS y, a.n + b.n AS total, count(*) AS same
           FROM t a JOIN t b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
     l AS (SELECT x, y FROM p WHERE 100 * same >= {percent} * (total - same)),
     r AS (SELECT doc_id, doc_id AS other FROM sets UNION SELECT r.doc_id, l.y FROM r JOIN l ON r.other = l.x),
     c AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT sets.doc_id, CAST(n AS BIGINT) AS n_shingles, component_id FROM sets JOIN c ON sets.doc_id = c.doc_id"""
