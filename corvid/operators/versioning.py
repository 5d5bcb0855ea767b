"""Versioned relations: merge-on-read over a lineage of parts, compaction, fingerprints, pruning, publication, ledgers.

A relation's active rows come from its parts in lineage order (0 is the oldest):
``upsert`` keeps a key's newest row, ``append`` its oldest (or the least or
greatest by a tie-breaker), ``scoped_mask`` the rows that came with their
parent's winning part.  Compaction packs whole keys into parts of a row budget
by a running sum of key counts, and is proved by an order-free fingerprint.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from corvid.scratch import Files, written

ORD = "_lineage_ord"


@dataclass(frozen=True)
class RelationSpec:
    name: str
    key: tuple[str, ...]
    strategy: str = "upsert"  # upsert, append or scoped_mask
    tie: str | None = None
    tie_max: bool = False
    parent: str | None = None
    parent_key: tuple[str, ...] = ()
    schema: T.StructType | None = None
    sort: tuple[str, ...] = field(default=())


def stacked(parts: Sequence[DataFrame]) -> DataFrame:
    """The union of parts by column name, tagged with the lineage place; missing columns are null."""
    tagged = [p.withColumn(ORD, F.lit(k)) for k, p in enumerate(parts)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def active(spec: RelationSpec, parts: Sequence[DataFrame], parents: DataFrame | None = None) -> DataFrame:
    """The relation's active rows with their lineage place; ``parents``: the active parent rows, for ``scoped_mask``."""
    rows = stacked(parts)
    if spec.strategy == "scoped_mask":
        winners = parents.select(*[F.col(k) for k in spec.parent_key], ORD)
        return rows.join(winners, [*spec.parent_key, ORD], "left_semi")
    if spec.strategy == "upsert":
        order = [F.desc(ORD)]
    elif spec.tie:
        order = [F.desc_nulls_last(spec.tie), F.desc(ORD)] if spec.tie_max else [F.asc_nulls_last(spec.tie), F.asc(ORD)]
    else:
        order = [F.asc(ORD)]
    pick = F.row_number().over(W.Window.partitionBy(*spec.key).orderBy(*order))
    return rows.withColumn("_rn", pick).where("_rn = 1").drop("_rn")


def resolve(specs: Sequence[RelationSpec], parts: Mapping[str, Sequence[DataFrame]]) -> dict[str, DataFrame]:
    """Active rows of every relation, parents before children whatever the order given."""
    left, done = list(specs), {}
    while left:
        ready = [s for s in left if s.parent is None or s.parent in done]
        if not ready:
            raise ValueError(f"parents never resolve: {[s.name for s in left]}")
        for s in ready:
            done[s.name] = active(s, parts[s.name], done.get(s.parent))
            left.remove(s)
    return done


def fingerprint(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row (n, a, b): the count and two sums of row hashes, the same for any order and layout of the rows."""
    row = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    half = lambda at: F.conv(F.substring(F.sha2(row, 256), at, 12), 16, 10).cast("decimal(20,0)")
    return df.agg(F.count("*").alias("n"), F.sum(half(1)).alias("a"), F.sum(half(13)).alias("b"))


def part_numbers(df: DataFrame, key: str, budget: int, bucket: Column | None = None, bucket_keys: int = 1_000_000) -> DataFrame:
    """(key, part): keys in order, packed so that a part starts a new budget; a key never spans parts.

    The running sum goes over counts of keys, by bucket and then inside buckets.
    ``bucket`` must rise with the key; without it buckets are ranges of about
    ``bucket_keys`` keys, so no task orders all of them.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    if bucket is not None:
        counts = counts.withColumn("_b", F.coalesce(bucket, F.lit(-1)))
    else:
        counts = written(counts, "key-counts")
        ranges = max(1, -(-counts.count() // bucket_keys))
        # written: which range a key is in must not change between the two uses below
        counts = written(counts.repartitionByRange(ranges, F.asc_nulls_first(key)).withColumn("_b", F.spark_partition_id()), "key-ranges")
    sums = counts.groupBy("_b").agg(F.sum("n").alias("_s"))  # one row a bucket
    base = sums.select("_b", F.coalesce(F.sum("_s").over(W.Window.orderBy("_b").rowsBetween(W.Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    inside = F.coalesce(F.sum("n").over(W.Window.partitionBy("_b").orderBy(F.asc_nulls_first(key)).rowsBetween(W.Window.unboundedPreceding, -1)), F.lit(0))
    return counts.withColumn("_i", inside).join(base, "_b").select(key, F.floor((F.col("_base") + F.col("_i")) / budget).cast("long").alias("part"))


def compact(df: DataFrame, path: str, key: str, sort: Sequence[str], budget: int = 128_000) -> DataFrame:
    """Write the active rows as key-aligned parts, sorted, and return them reread; null keys stay."""
    parts = part_numbers(df, key, budget)
    placed = df.join(parts.withColumnRenamed(key, "_k"), F.col(key).eqNullSafe(F.col("_k"))).drop("_k")
    placed.repartition("part").sortWithinPartitions("part", *sort).write.mode("errorifexists").option("compression", "zstd").partitionBy("part").parquet(path)
    return df.sparkSession.read.parquet(path).drop("part")


def key_bounds(df: DataFrame, key: str, part: str) -> DataFrame:
    """(part, low, high, rows): a manifest's bounds, from one aggregation."""
    return df.groupBy(part).agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count("*").alias("rows"))


def prune(bounds: Sequence[Mapping[str, object]], low: object, high: object) -> list[Mapping[str, object]]:
    """The manifest entries whose bounds meet [low, high]; an entry without bounds stays."""
    return [b for b in bounds if (b["low"] is None or high is None or b["low"] <= high) and (b["high"] is None or low is None or b["high"] >= low)]


class StaleParentError(RuntimeError):
    """The branch moved since the delta was made."""


#: How bounds of a key type are compared once they went through JSON.
_NUMBERS = ("byte", "short", "integer", "long", "float", "double", "decimal")


def comparable(value: object, kind: str) -> object:
    """A bound of a key of this type, from a manifest or a caller, as something that orders like the key."""
    if value is None:
        return None
    return Decimal(str(value)) if kind.startswith(_NUMBERS) else str(value)


class SnapshotStore:
    """Snapshots of named relations under a folder of any Hadoop file system: immutable Parquet parts and a manifest each.

    A branch is a folder of numbered files, each the name of a node; moving it
    makes the next number, which only one publisher can.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, str(root).rstrip("/")
        self.files = Files(spark, self.root)
        for folder in ("branches", "nodes"):
            self.files.make(folder)

    def _moves(self, branch: str) -> list[str]:
        return self.files.names(f"branches/{branch}")

    def tip(self, branch: str = "main") -> str | None:
        moves = self._moves(branch)
        return self.files.read(f"branches/{branch}/{moves[-1]}") if moves else None

    def manifest(self, node: str) -> dict:
        return json.loads(self.files.read(f"nodes/{node}.json"))

    def lineage(self, node: str | None) -> list[str]:
        """Ancestors first; a checkpoint ends the walk."""
        out, seen = [], set()
        while node:
            if node in seen:
                raise ValueError(f"lineage has a cycle at {node}")
            seen.add(node)
            out.append(node)
            m = self.manifest(node)
            node = None if m.get("checkpoint") else m["parent"]
        return out[::-1]

    def publish(self, relations: Mapping[str, DataFrame], keys: Mapping[str, str], branch: str = "main", parent: str | None = None, checkpoint: bool = False) -> str:
        """Write the parts, then move the branch; ``StaleParentError`` if its tip isn't ``parent`` any more."""
        moves = self._moves(branch)
        if self.tip(branch) != parent:
            raise StaleParentError(f"{branch} is at {self.tip(branch)}, not {parent}")
        draft, told = f"draft-{uuid.uuid4().hex}", {}
        for name, df in relations.items():
            df.drop(ORD).write.option("compression", "zstd").parquet(f"{self.root}/{draft}/{name}")
            part = self.spark.read.parquet(f"{self.root}/{draft}/{name}")
            low, high, n = part.agg(F.min(keys[name]), F.max(keys[name]), F.count("*")).first()
            kind = part.schema[keys[name]].dataType.typeName()
            bound = lambda x: x if x is None or isinstance(x, int | float | str) else str(x)
            told[name] = {"low": bound(low), "high": bound(high), "type": kind, "rows": n, "columns": part.columns}
        node = hashlib.sha256(json.dumps([parent, told, uuid.uuid4().hex], sort_keys=True).encode()).hexdigest()[:24]
        self.files.move(draft, f"parts-{node}")
        self.files.put(f"nodes/{node}.json", json.dumps({"parent": parent, "checkpoint": checkpoint, "relations": told}))
        after = f"{int(moves[-1]) + 1 if moves else 0:010d}"
        if not self.files.claim(f"branches/{branch}/{after}", node):
            raise StaleParentError(f"{branch} moved while {node} was written")
        return node

    def parts(self, name: str, node: str | None, low: object = None, high: object = None) -> list[DataFrame]:
        """The relation's parts in lineage order, without those whose key bounds miss [low, high]."""
        found = [(n, m["relations"][name]) for n in self.lineage(node) if name in (m := self.manifest(n))["relations"]]
        kind = found[0][1]["type"] if found else "string"
        bounds = [{"node": n, "rows": m["rows"], "low": comparable(m["low"], kind), "high": comparable(m["high"], kind)} for n, m in found]
        kept = prune(bounds, comparable(low, kind), comparable(high, kind))
        return [self.spark.read.parquet(f"{self.root}/parts-{b['node']}/{name}") for b in kept]

    def lookup(self, spec: RelationSpec, node: str | None, low: object, high: object) -> DataFrame:
        """The relation's active rows whose key lies in [low, high], read from the parts whose bounds meet it."""
        inside = F.col(spec.key[0]).between(F.lit(low), F.lit(high))
        kept = self.parts(spec.name, node, low, high)
        if not kept:
            every = self.parts(spec.name, node)
            return every[0].limit(0).withColumn(ORD, F.lit(0))
        return active(spec, [p.where(inside) for p in kept])

    def reachable(self, pins: Sequence[str] = ()) -> set[str]:
        """Nodes that a branch or pin leads to; the rest may go."""
        out: set[str] = set()
        for node in [*[self.tip(b) for b in self.files.names("branches")], *pins]:
            while node and node not in out:
                out.add(node)
                node = self.manifest(node)["parent"]
        return out

    def garbage(self, pins: Sequence[str] = ()) -> list[str]:
        return sorted({n.removesuffix(".json") for n in self.files.names("nodes")} - self.reachable(pins))


def append_unseen(ledger: DataFrame, events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The events that the ledger doesn't have, once each."""
    return events.dropDuplicates(list(keys)).join(ledger.select(*keys), list(keys), "left_anti")


def dedupe_events(events: DataFrame, keys: Sequence[str], order: str, source: str) -> DataFrame:
    """One event a key, its first in order, with all the sources that told of it."""
    rest = [c for c in events.columns if c not in keys]
    first = F.min_by(F.struct(*rest), order).alias("_first")
    told = events.groupBy(*keys).agg(first, F.array_join(F.sort_array(F.collect_set(source)), ",").alias("sources"))
    return told.select(*keys, "_first.*", "sources")


def ledger_stats(ledger: DataFrame, kind: str, at: str) -> DataFrame:
    """(kind, n, high): events of each kind and the time of the last."""
    return ledger.groupBy(kind).agg(F.count("*").alias("n"), F.max(at).alias("high"))


def after_mark(ledger: DataFrame, events: DataFrame, at: str) -> DataFrame:
    """The events later than the ledger's last one; all of them where the ledger is empty."""
    mark = ledger.agg(F.max(at).alias("_mark"))  # one row
    return events.join(F.broadcast(mark), F.col("_mark").isNull() | (F.col(at) > F.col("_mark"))).drop("_mark")


def carried(now: DataFrame, before: DataFrame, key: str, order: Sequence[str], value: str) -> DataFrame:
    """(key, state): what a refresh carries over, by each key's values in order: new, removed, carried or changed."""
    def said(df: DataFrame) -> DataFrame:
        return df.groupBy(key).agg(F.sha2(F.to_json(F.sort_array(F.collect_list(F.struct(*order, value)))), 256).alias("_f"))

    a, b = said(now), said(before).withColumnsRenamed({key: "_k", "_f": "_g"})
    state = F.when(F.col("_g").isNull(), "new").when(F.col("_f").isNull(), "removed").when(F.col("_f") == F.col("_g"), "carried").otherwise("changed")
    return a.join(b, F.col(key).eqNullSafe(F.col("_k")), "full_outer").select(F.coalesce(key, "_k").alias(key), state.alias("state"))
