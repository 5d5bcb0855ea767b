"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints are 64-bit SimHashes of word shingles.  Two link at ``RADIUS`` = 4
or fewer differing bits; a component is what links reach.  Candidates come from
a covering family of masks: every bit position gets a nonzero vector of
RADIUS + 1 bits, and the mask of each of the 31 nonzero vectors v holds the
positions whose vector has an odd product with v.  The vectors of at most 4
differing positions leave some v orthogonal to them all, so any pair within the
radius agrees on that mask and meets in its table: no pair is missed, by
construction.

Work is done on distinct fingerprints, so copies cost nothing.  Inside a bucket
only a spanning forest of its links is emitted, never all pairs.  A bucket of
more than ``LIMIT`` fingerprints is dealt again by the same covering over the
bits its mask left free, until it is small; a bucket on few free bits is small
because its members are distinct.  Hot buckets are found on a sample and dealt
again where their rows lie, so that no task gathers one.  Components are found by alternating
large-star and small-star steps on DataFrames, each written to the shared folder.

Defined results: a null or empty text has fingerprint zero and is linked like
any other; a text with fewer words than a shingle is one shingle; null ids sort
after all others when a class takes its smallest id; repeated rows are one
class; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.llm.common import by_bytes, fresh, table, text_of, trim, written

RADIUS = 4
VECTORS = (1 << (RADIUS + 1)) - 1
LIMIT = 4096
FULL = (1 << 64) - 1


# Fingerprints


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of ``size`` words; A-Z lower-cased, words split at ASCII white space."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-size]]).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)), np.uint64, len(starts))


def majority(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes; no hashes give zero."""
    n, votes = len(hashes), np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def _fingerprints(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            texts = batch.column("text").cast(pa.binary())
            prints = np.fromiter((majority(shingle_hashes(t.as_py() or b"", size)) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("row"), pa.array(prints.view(np.int64))], names=["id", "row", "print"])
        trim()

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, row: Column | None = None) -> DataFrame:
    """(id, row, print): the SimHash as a signed 64-bit integer; ``row`` tells rows apart."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), (F.monotonically_increasing_id() if row is None else row).alias("row"), text_of(text_col).alias("text"))
    return rows.mapInArrow(_fingerprints(size), T.StructType([*rows.schema.fields[:2], T.StructField("print", T.LongType())]))


# Covering masks


def submasks(free: int) -> list[int]:
    """A covering family over the bit positions set in ``free``: one mask for each nonzero vector."""
    out = [0] * VECTORS
    for k, bit in enumerate(i for i in range(64) if free >> i & 1):
        vector = k % VECTORS + 1
        for v in range(1, VECTORS + 1):
            if (vector & v).bit_count() & 1:
                out[v - 1] |= 1 << bit
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(members: np.ndarray) -> list[tuple[int, int]]:
    """Links (within the radius) of a spanning forest of the members, which are distinct."""
    links, rest = [], members
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = np.bitwise_count(rest ^ at) <= RADIUS
            if near.any():
                new = rest[near]
                links += [(at, x) for x in new]
                queue += list(new)
                rest = rest[~near]
    return links


def _search(limit: int) -> Callable:
    """Over rows (bucket, free, print) sorted so: links as (a, b, null, null), rows of over-full buckets as (null, null, bucket, free, print) of the next level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "bucket", "free", "print"]
        masks: dict[int, list[int]] = {}

        def out(links: list[np.ndarray]) -> pa.RecordBatch:
            both = np.concatenate(links).astype(np.uint64).view(np.int64)
            none = pa.nulls(len(both), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), none, none, none], names=names)

        def again(bucket: int, free: int, prints: np.ndarray) -> pa.RecordBatch:
            subs = masks.setdefault(free, submasks(free))
            seed = np.uint64(bucket & FULL) * np.uint64(0x9E3779B97F4A7C15)
            buckets, frees, rows = [], [], []
            with np.errstate(over="ignore"):
                for t, sub in enumerate(subs):
                    # the hash may merge two buckets; that only adds comparisons
                    key = ((prints & np.uint64(sub)) ^ seed) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(t + 1) * np.uint64(0x165667B19E3779F9)
                    buckets.append(key ^ (key >> np.uint64(29)))
                    frees.append(np.full(len(prints), free & ~sub & FULL, np.uint64))
                    rows.append(prints)
            none = pa.nulls(len(prints) * len(subs), pa.int64())
            return pa.RecordBatch.from_arrays([none, none, *[pa.array(np.concatenate(x).view(np.int64)) for x in (buckets, frees, rows)]], names=names)

        held: np.ndarray = np.empty((0, 3), np.uint64)
        over: tuple[int, int] | None = None  # the bucket whose first rows went to the next level already

        def work(rows: np.ndarray, last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, over
            if not len(rows):
                return
            change = np.flatnonzero((rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])) + 1
            starts, ends = np.concatenate([[0], change]), np.concatenate([change, [len(rows)]])
            links = []
            sizes = ends - starts
            open_run = len(starts) - 1 if not last else len(starts)
            for r in np.flatnonzero(sizes > 1) if over is None else range(len(starts)):
                if r >= open_run:
                    continue
                bucket, free, prints = int(rows[starts[r], 0]), int(rows[starts[r], 1]), rows[starts[r] : ends[r], 2]
                if over == (bucket, free) or (len(prints) > limit and free.bit_count() > 12):
                    yield again(bucket, free, prints)
                elif len(prints) == 2:
                    if int(prints[0] ^ prints[1]).bit_count() <= RADIUS:
                        links.append(prints.reshape(1, 2))
                elif len(prints) > 1 and (found := _forest(prints)):
                    links.append(np.array(found, np.uint64))
            if links:
                yield out(links)
            held = rows[starts[-1] :] if not last else rows[:0]
            if len(held):
                bucket, free = int(held[0, 0]), int(held[0, 1])
                if over != (bucket, free):
                    over = None
                if free.bit_count() > 12 and (over or len(held) > limit):
                    over = (bucket, free)
                    yield again(bucket, free, held[:, 2])
                    held = held[:0]

        for batch in batches:
            rows = np.stack([batch.column(k).to_numpy().view(np.uint64) for k in range(3)], axis=1)
            yield from work(np.concatenate([held, rows]) if len(held) else rows, False)
        yield from work(held, True)

    return run


LINKS = "a long, b long, bucket long, free long, print long"


def _family(free: int) -> Column:
    """The covering family over ``free`` as an array of (t, m, free): the mask and the bits that it leaves free."""
    return F.array(*[F.struct(F.lit(t).alias("t"), F.lit(_signed(m)).alias("m"), F.lit(_signed(free & ~m & FULL)).alias("free")) for t, m in enumerate(submasks(free))])


def _hot(level: DataFrame, hot_rows: int, seed: int = 42) -> DataFrame | None:
    """(bucket, free) of the buckets that hold about ``hot_rows`` fingerprints or more, by a sample of a level; None where there can be none.

    A bucket that the sample misses is dealt again by its own task, so the sample decides who works, never what is found.
    """
    if level.count() <= hot_rows:
        return None
    share = min(1.0, 512 / hot_rows)
    found = level.sample(share, seed).groupBy("bucket", "free").agg(F.count("*").alias("n")).where(F.col("n") >= max(2.0, 0.5 * share * hot_rows)).where(F.bit_count("free") > 12)
    hot = written(found.select("bucket", "free"), "hot")
    return None if hot.isEmpty() else hot


def links(prints: DataFrame, limit: int = LIMIT, hot_rows: int = 64 * LIMIT) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``print``), enough to connect every pair within the radius.

    Buckets of ``hot_rows`` or more are dealt again where their rows lie, before any task gathers them.
    """
    level = prints.select("print", F.inline(_family(FULL))).select(F.xxhash64("t", F.col("print").bitwiseAND(F.col("m"))).alias("bucket"), "free", "print")
    found = None
    while True:
        again = None
        if (hot := _hot(level, hot_rows)) is not None:
            # few buckets are hot: at most the rows of a level over hot_rows
            masks = sorted(r["free"] for r in hot.select("free").distinct().collect())
            family = F.create_map(*[x for m in masks for x in (F.lit(m), _family(m & FULL))])
            again = level.join(hot, ["bucket", "free"], "left_semi").select("bucket", "print", F.inline(family[F.col("free")]))
            again = again.select(F.xxhash64("bucket", "t", F.col("print").bitwiseAND(F.col("m"))).alias("bucket"), "free", "print")
            level = level.join(hot, ["bucket", "free"], "left_anti")
        dealt = level.repartition("bucket", "free").sortWithinPartitions("bucket", "free", "print")
        result = written(dealt.mapInArrow(_search(limit), LINKS), "links")
        some = result.where("a is not null").select("a", "b")
        found = some if found is None else found.unionByName(some)
        level = result.where("bucket is not null").select("bucket", "free", "print")
        if again is not None:
            level = written(level.unionByName(again), "dealt")
        if level.isEmpty():
            return found


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the smallest node reachable.

    Large-star and small-star steps alternate until nothing changes; every
    step is two aggregations and a join whose large side Spark may split.
    """
    star = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "star")
    mark = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = mark(star)
    while before[0]:
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        star = written(small, "star")
        after = mark(star)
        if after == before:
            break
        before = after
    return star.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, row: Column | None = None) -> DataFrame:
    """(id, row, print, class_id, first) a document: ``class_id`` is the smallest id of its class, ``first`` true for the one row that stands for it."""
    prints = written(fingerprints(docs, id_col, text_col, size, row), "prints")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    distinct = written(prints.groupBy("print").agg(F.min(order).alias("least")), "distinct")
    roots = components(links(distinct.select("print")))
    linked = distinct.join(roots, distinct["print"] == roots["node"], "left").select("print", "least", F.coalesce("root", "print").alias("root"))
    heads = linked.groupBy("root").agg(F.min("least").alias("head"))
    labels = linked.join(heads, "root").select("print", "head")
    return prints.join(labels, "print").select("id", "row", "print", F.col("head.id").alias("class_id"), (F.col("row") == F.col("head.row")).alias("first"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4) -> DataFrame:
    """``docs`` with one document of each class, the one with the smallest id; of rows that repeat id and text, one.

    The documents are written once with a row number; the rows that go are a
    table of row numbers: small ones are broadcast, others cost one exchange.
    """
    (row,) = fresh(docs, "_row")
    base = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    gone = written(near_classes(base, id_col, text_col, size, F.col(row)).where("not first").select(F.col("row").alias(row)), "gone")
    return base.join(gone, row, "left_anti").select(*[f"`{c}`" for c in docs.columns])


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), F.col("class_id").alias("component_id"))
