"""Keyed relations: latest and first rows, changes, differences, validators, ordinals.

All of them hash-partition by key at most once.  ``with_ordinal`` numbers rows
densely without one task seeing all of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "_rn") -> DataFrame:
    return df.withColumn(name, F.row_number().over(W.Window.partitionBy(*keys).orderBy(*order)))


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in this order; give it a unique last column, or ties are arbitrary."""
    return ranked(df, keys, order).where(F.col("_rn") <= n).drop("_rn")


def first_nonempty(df: DataFrame, key: str, label: str, order: str) -> DataFrame:
    """(key, label): the first label, in order, that isn't empty; empty where there is none."""
    some = F.when(F.coalesce(F.col(label), F.lit("")) != "", F.struct(order, label))
    return df.groupBy(key).agg(F.coalesce(F.min(some)[label], F.lit("")).alias(label))


def representative(df: DataFrame, key: str, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Each column's first value that isn't null, in order, independently of the others."""
    return df.groupBy(key).agg(*[F.min(F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c).alias("_v"))))["_v"].alias(c) for c in columns])


def new_rows(candidates: DataFrame, active: DataFrame, keys: Sequence[str]) -> DataFrame:
    return candidates.join(active.select(*keys), list(keys), "left_anti")


def known_rows(candidates: DataFrame, active: DataFrame, keys: Sequence[str]) -> DataFrame:
    return candidates.join(active.select(*keys), list(keys), "left_semi")


def changed_rows(candidates: DataFrame, active: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Candidates with a new key or any different value (nulls compare as values), tagged ``change``: added or changed."""
    old = active.select(*keys, *[F.col(v).alias(f"_old_{v}") for v in values], F.lit(True).alias("_known"))
    same = reduce(and_, [F.col(v).eqNullSafe(F.col(f"_old_{v}")) for v in values])
    both = candidates.join(old, list(keys), "left").withColumn("change", F.when(F.col("_known").isNull(), "added").when(~same, "changed"))
    return both.where("change is not null").drop("_known", *[f"_old_{v}" for v in values])


def keyed_diff(base: DataFrame, new: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """(keys, change): added, removed or changed; keys may be null and compare as values."""
    names = [f"_{k}" for k in range(len(keys))]
    a = base.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.struct(*values).alias("_a"))
    b = new.select(*keys, F.struct(*values).alias("_b"))
    on = reduce(and_, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)])
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(~F.col("_a").eqNullSafe(F.col("_b")), "changed")
    both = a.join(b, on, "full_outer").withColumn("change", change).where("change is not null")
    return both.select(*[F.when(F.col("_b").isNull(), F.col(n)).otherwise(F.col(k)).alias(k) for k, n in zip(keys, names, strict=True)], "change")


def symmetric_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of one side only, tagged ``side``."""
    return left.subtract(right).withColumn("side", F.lit("left")).unionByName(right.subtract(left).withColumn("side", F.lit("right")))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def conflicts(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one value, with the least and greatest."""
    return df.groupBy(key).agg(F.min(value).alias("low"), F.max(value).alias("high"), F.count_distinct(value).alias("n")).where("n > 1")


def order_violations(df: DataFrame, position: str, columns: Sequence[str], part: Sequence[str]) -> DataFrame:
    """Rows not strictly after the one before them in their part (equal is a violation)."""
    before = F.lag(F.struct(*columns)).over(W.Window.partitionBy(*part).orderBy(position))
    return df.withColumn("_before", before).where(F.col("_before").isNotNull() & (F.col("_before") >= F.struct(*columns))).drop("_before")


def with_ordinal(df: DataFrame, order: Sequence[Column], bucket: Column, name: str = "ordinal") -> DataFrame:
    """A dense number from 0 in this order.  ``bucket`` must rise with the order: rows are numbered inside buckets, and
    buckets by a running sum over their counts, so no task holds more rows than a bucket or the table of counts."""
    tagged = df.withColumn("_bucket", bucket)
    counts = tagged.groupBy("_bucket").agg(F.count("*").alias("_n"))
    base = counts.select("_bucket", F.coalesce(F.sum("_n").over(W.Window.orderBy("_bucket").rowsBetween(W.Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    inside = F.row_number().over(W.Window.partitionBy("_bucket").orderBy(*order)) - 1
    return tagged.withColumn("_inside", inside).join(base, "_bucket").withColumn(name, F.col("_base") + F.col("_inside")).drop("_bucket", "_base", "_inside")


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a null in any key column."""
    return df.where(reduce(or_, [F.col(k).isNull() for k in keys]))


def uncovered(rows: DataFrame, cover: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows whose key (column of ``rows``: column of ``cover``) the other relation doesn't have."""
    told = cover.select(*[F.col(c).alias(f"_{k}") for k, c in enumerate(on.values())])
    return rows.join(told, reduce(and_, [F.col(r) == F.col(f"_{k}") for k, r in enumerate(on)]), "left_anti")


def star(fact: DataFrame, *dimensions: tuple[DataFrame, str, str]) -> DataFrame:
    """``fact`` left-joined to dimensions (frame, column of the fact or of an earlier dimension, key of the dimension)."""
    for dimension, column, key in dimensions:
        fact = fact.join(dimension, F.col(column) == F.col(key), "left")
    return fact


def stacked_by_name(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def ordered_lookup(table: DataFrame, key: str, asked: Sequence[object]) -> DataFrame:
    """(pos, key, ...): a row for each key asked for, in the order of the request; nulls where the table hasn't it."""
    kind = table.schema[key].dataType.simpleString()
    wanted = table.sparkSession.createDataFrame(list(enumerate(asked)), f"pos int, {key} {kind}")
    return wanted.join(table.where(F.col(key).isin(*asked)), key, "left").select("pos", *table.columns)  # the keys asked for


def index_positions(table: DataFrame, key: str, asked: Sequence[object], part_rows: int) -> DataFrame:
    """(key, position, part, total) of the asked keys that are there: a key's place in a sorted index of distinct keys, cut into parts.

    The keys below it are counted in one aggregation; nothing is sorted.
    """
    keys = table.select(key).distinct()
    counts = [F.count_if(F.col(key) < F.lit(a)).alias(f"n{k}") for k, a in enumerate(asked)] + [F.max(F.col(key) == F.lit(a)).alias(f"t{k}") for k, a in enumerate(asked)]
    one = keys.agg(F.count("*").alias("total"), *counts)
    told = F.array(*[F.struct(F.lit(a).cast(table.schema[key].dataType).alias(key), F.col(f"n{k}").alias("position"), F.col(f"t{k}").alias("there")) for k, a in enumerate(asked)])
    return one.select("total", F.inline(told)).where("there").select(key, "position", F.expr(f"position div {int(part_rows)}").alias("part"), "total")


def partners(rows: DataFrame, group: str, member: str, name: str = "partner") -> DataFrame:
    """(group, member, partner): every other member of the group, one null where there is none; groups are filings, with few members."""
    a = rows.select(group, member).distinct()
    b = a.select(F.col(group).alias("_g"), F.col(member).alias(name))
    return a.join(b, (F.col(group) == F.col("_g")) & (F.col(member) != F.col(name)), "left").select(group, member, name)


def last_of(df: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """(key, value): each key's value at its last place in order; a map-side aggregation, no sort."""
    return df.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))


def sessions(events: DataFrame, key: str, at: str, order: Sequence[str], gap: str) -> DataFrame:
    """(key, sessions): runs of events without a pause longer than ``gap`` (an interval)."""
    before = F.lag(at).over(W.Window.partitionBy(key).orderBy(at, *order))
    begun = events.withColumn("_b", before).where(F.expr(f"_b is null or {at} - _b > interval {gap}"))
    return begun.groupBy(key).agg(F.count("*").alias("sessions"))


def filtered(rows: DataFrame, form: str, date: str, forms: Sequence[str] = (), prefix: str = "", limit: int | None = None) -> DataFrame:
    """Rows of these forms whose date, as text, begins with a prefix; at most ``limit`` of the latest."""
    out = rows.where(F.col(form).isin(*forms)) if forms else rows
    if prefix:
        out = out.where(F.startswith(F.col(date).cast("string"), F.lit(prefix)))
    return out.orderBy(F.desc(date), form).limit(limit) if limit is not None else out


def ordered_fingerprint(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """(key, fingerprint, n): the digest of each key's values in order; keys are shards, whose values fit a task."""
    told = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, F.col(value).cast("string").alias("_v")))), lambda x: F.coalesce(x["_v"], F.lit(""))), ",")
    return rows.groupBy(key).agg(F.sha2(told, 256).alias("fingerprint"), F.count("*").alias("n"))


def census(rows: DataFrame, groups: Sequence[str], flags: dict[str, Column]) -> DataFrame:
    """Rows and flagged rows by every prefix of the groups, totals included: one aggregation over a rollup."""
    return rows.rollup(*groups).agg(F.grouping_id().cast("int").alias("level"), F.count("*").alias("n"), *[F.count_if(c).alias(name) for name, c in flags.items()])
