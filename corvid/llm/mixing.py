"""Mixing sources to target weights by temperature.

A source's weight is its token share to a power, normalised.  The exponent is
bisected so that the weights' entropy reaches a target, or so that no source is
repeated more than a limit over the least repeated one.  A token budget turns
weights into tokens a source: so many whole epochs, and of one more epoch the
documents whose running token sum stays within the rest.  Every epoch is a
permutation of the source (by the hash of seed, epoch and id), dealt to blocks
that hold the same share of every source.

Running sums go by permutation key in two levels: sums of key ranges (as many
as the rows need), a running sum over those sums, and sums inside a range; so a
source with a third of all rows is no single task's work.  The cut of an epoch
is one key a source: ``mix`` broadcasts those (at most ``max_sources`` rows,
checked) and decides on every row where it is, without a shuffle of texts; with
more sources than that it joins them by source.

Defined results: a null source is one source; a null id is hashed as the empty
text; rows that repeat an id share a key, and are in or out together; a source
without tokens keeps one epoch; an empty table gives an empty result; other
columns are passed through by ``mix``.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from corvid.llm.common import fresh, table, text_of, written

WORD = r"[^\x20\x09-\x0D]+"
STEPS = 60
RANGE_ROWS = 2_000


def token_count(text_col: str) -> Column:
    """Words of the whole text, split at ASCII white space."""
    return F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long")


def epoch_key(seed: int, epoch: Column, id_col: Column) -> Column:
    """A place in the epoch's permutation: 32 hexadecimal digits."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(id_col.cast("string"), F.lit(""))))


def weights(tokens: list[int], exponent: float) -> list[float]:
    powers = [t**exponent if t else 0.0 for t in tokens]
    total = sum(powers)
    return [p / total if total else 0.0 for p in powers]


def entropy(shares: list[float]) -> float:
    return -sum(w * math.log2(w) for w in shares if w > 0)


def bisect(good: Callable[[float], bool]) -> float:
    """The largest exponent in [0, 1] for which ``good`` holds (it holds from 0 up to some point), to nine decimals."""
    if good(1.0):
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(STEPS):
        mid = (low + high) / 2
        low, high = (mid, high) if good(mid) else (low, mid)
    return round(low, 9)


def exponent_for_entropy(tokens: list[int], share: float) -> float:
    """Weights with at least ``share`` of the greatest possible entropy."""
    some = [t for t in tokens if t]
    target = share * math.log2(len(some)) if some else 0.0
    return bisect(lambda a: entropy(weights(some, a)) >= target)


def exponent_for_repeats(tokens: list[int], limit: float) -> float:
    """Weights under which the most repeated source has at most ``limit`` times the epochs of the least repeated."""
    some = [t for t in tokens if t]
    ratio = max(some) / min(some) if some else 1.0
    # epochs go with share ** (exponent - 1): the ratio falls as the exponent grows, so the least exponent is wanted
    spread = bisect(lambda b: ratio**b <= limit)
    return round(1 - spread, 9)


def plan(groups: dict[str | None, int], exponent: float, budget: int | None = None) -> dict[str | None, tuple[int, int, int]]:
    """source: (tokens wanted, whole epochs, tokens of the part epoch).

    Without a budget the least is taken that gives every source one whole epoch.
    """
    names = sorted(groups, key=lambda s: (s is not None, s or ""))
    shares = weights([groups[s] for s in names], exponent)
    if budget is None:
        budget = math.ceil(max((groups[s] / w for s, w in zip(names, shares, strict=True) if w), default=0))
    out = {}
    for s, w in zip(names, shares, strict=True):
        wanted = math.floor(w * budget + 0.5)
        out[s] = (wanted, *divmod(wanted, groups[s])) if groups[s] else (0, 1, 0)
    return out


def bisect_entropy(sums: DataFrame, share: float, at_once: int = 15) -> float:
    """``exponent_for_entropy`` over a table of sources (tokens): each aggregation measures ``at_once`` exponents."""
    t = F.col("tokens").cast("double")
    some = sums.where("tokens > 0")
    target = share * math.log2(max(some.count(), 1))

    def good(exponents: list[float]) -> list[bool]:
        # with p = t ** a and S their sum, the entropy is log2 S - a * sum(p log2 t) / S
        parts = [x for a in exponents for x in (F.sum(F.pow(t, F.lit(a))), F.sum(F.pow(t, F.lit(a)) * F.log2(t)))]
        got = some.agg(*parts).first()
        return [got[2 * k] is None or math.log2(got[2 * k]) - a * got[2 * k + 1] / got[2 * k] >= target - 1e-12 for k, a in enumerate(exponents)]

    if good([1.0])[0]:
        return 1.0
    low, high = 0.0, 1.0
    while high - low > 1e-11:
        points = [low + (high - low) * k / (at_once + 1) for k in range(1, at_once + 1)]
        n = sum(good(points))  # the good ones are the first
        low, high = ([low, *points][n], [*points, high][n])
    return round(low, 9)


def plan_table(sums: DataFrame, exponent: float, budget: int | None) -> DataFrame:
    """``plan`` as a table (s, wanted, whole, rest, has) over a table of sources (source, tokens)."""
    t, power = F.col("tokens").cast("double"), F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(exponent))).otherwise(0.0)
    total = sums.agg(F.sum(power)).first()[0] or 1.0
    if budget is None:
        budget = math.ceil(sums.where("tokens > 0").agg(F.max(t / (power / total))).first()[0] or 0)
    wanted = F.floor(power / total * budget + 0.5).cast("long")
    shared = sums.select(F.col("source").alias("s"), F.col("tokens").alias("has"), F.when(F.col("tokens") > 0, wanted).otherwise(0).alias("wanted"))
    some = F.col("has") > 0
    return shared.select("s", "wanted", F.when(some, F.expr("wanted div greatest(has, 1)")).otherwise(1).alias("whole"), F.when(some, F.expr("wanted % greatest(has, 1)")).otherwise(0).alias("rest"), "has")


def _sums(rows: DataFrame, total: int) -> DataFrame:
    """rows (source, epoch, key, tokens, ...) with ``upto``: tokens of the source and epoch up to this key, ties included."""
    digits = max(1, math.ceil(math.log(max(total / RANGE_ROWS, 1), 16)))
    ranged = rows.withColumn("range", F.substring("key", 1, digits))
    sums = ranged.groupBy("source", "epoch", "range").agg(F.sum("tokens").alias("inside"))
    before = W.Window.partitionBy("source", "epoch").orderBy("range").rowsBetween(W.Window.unboundedPreceding, -1)
    bases = sums.withColumn("base", F.coalesce(F.sum("inside").over(before), F.lit(0))).drop("inside").withColumnsRenamed({"source": "s", "epoch": "e", "range": "r"})
    inside = W.Window.partitionBy("source", "epoch", "range").orderBy("key").rangeBetween(W.Window.unboundedPreceding, W.Window.currentRow)
    part = ranged.withColumn("local", F.sum("tokens").over(inside))
    return part.join(bases, F.col("source").eqNullSafe(F.col("s")) & (F.col("epoch") == F.col("e")) & (F.col("range") == F.col("r"))).withColumn("upto", F.col("base") + F.col("local")).drop("s", "e", "r", "range", "base", "local")


class Mixture:
    """Sized rows, the exponent and the plan of a mixture.

    Up to ``max_sources`` sources are planned on the driver and their plan is
    broadcast; beyond that the same sums, bisection and plan are made by
    aggregations over the table of sources, and the plan is joined by source.
    """

    def __init__(self, docs: DataFrame, source_col: str, id_col: str, text_col: str, seed: int, entropy_share: float | None, repeat_limit: float | None, budget: int | None, cover: bool, max_sources: int):
        self.seed, spark = seed, docs.sparkSession
        self.rows = written(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"), token_count(text_col).alias("tokens")), "sized")
        sums = written(self.rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows")), "sources")
        n, self.total, tokens, high, low = sums.agg(F.count("*"), F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0)), F.max("tokens"), F.min(F.when(F.col("tokens") > 0, F.col("tokens")))).first()
        self.small, share = n <= max_sources, 1.0 if entropy_share is None else entropy_share
        budget = None if cover else tokens if budget is None else budget
        if self.small:
            groups = {r["source"]: r["tokens"] for r in sums.collect()}
            some = list(groups.values())
            self.exponent = exponent_for_repeats(some, repeat_limit) if repeat_limit is not None else exponent_for_entropy(some, share)
            told = [(s, *p, groups[s]) for s, p in plan(groups, self.exponent, budget).items()]
            self.table = spark.createDataFrame(told, "s string, wanted long, whole long, rest long, has long")
        else:
            self.exponent = exponent_for_repeats([high, low] if low else [], repeat_limit) if repeat_limit is not None else bisect_entropy(sums, share)
            self.table = written(plan_table(sums, self.exponent, budget), "plan")

    def with_plan(self, rows: DataFrame) -> DataFrame:
        told = F.broadcast(self.table) if self.small else self.table  # at most max_sources rows
        return rows.join(told, F.col("source").eqNullSafe(F.col("s"))).drop("s")

    def cuts(self) -> DataFrame:
        """(s, whole, cut): the last key of the part epoch that stays within the budget; null where none does."""
        part = self.with_plan(self.rows).where("rest > 0").withColumn("epoch", F.col("whole")).withColumn("key", epoch_key(self.seed, F.col("epoch"), F.col("id")))
        cut = _sums(part, self.total).where("upto <= rest").groupBy("source").agg(F.max("key").alias("cut")).withColumnRenamed("source", "c")
        return self.table.join(cut, F.col("s").eqNullSafe(F.col("c")), "left").select("s", "whole", "cut")

    def realised(self, block_tokens: int) -> DataFrame:
        """(id, source, epoch, block, n_tokens) of every drawn document; order inside a block is by md5 key."""
        blocks = max(1, -(-(self.table.agg(F.sum("wanted")).first()[0] or 0) // block_tokens))
        drawn = self.with_plan(self.rows).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole")))).where("epoch < whole or rest > 0")
        summed = _sums(drawn.withColumn("key", epoch_key(self.seed, F.col("epoch"), F.col("id"))), self.total).where("epoch < whole or upto <= rest")
        at = F.col("epoch") * F.col("has") + F.col("upto") - F.col("tokens")
        block = F.when(F.col("wanted") > 0, F.least(F.expr("cast(0 as bigint)") + F.floor(at.cast("decimal(38,0)") * blocks / F.col("wanted")).cast("long"), F.lit(blocks - 1).cast("long"))).otherwise(F.lit(0).cast("long"))
        return summed.select("id", "source", "epoch", block.alias("block"), F.col("tokens").alias("n_tokens"))


def mix(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", seed: int = 42, entropy_share: float | None = None, repeat_limit: float | None = None, budget: int | None = None, cover: bool = False, max_sources: int = 100_000) -> DataFrame:
    """``docs``, each row as often as the mixture draws it.  ``cover``: every source gets at least one whole epoch, so every row stays."""
    mixture = Mixture(docs, source_col, id_col, text_col, seed, entropy_share, repeat_limit, budget, cover, max_sources)
    s, whole, cut, copy = fresh(docs, "_s", "_whole", "_cut", "_copy")
    cuts = written(mixture.cuts().withColumnsRenamed({"s": s, "whole": whole, "cut": cut}), "cuts")
    told = docs.join(F.broadcast(cuts) if mixture.small else cuts, F.col(f"`{source_col}`").cast("string").eqNullSafe(F.col(s)))
    part = F.coalesce(epoch_key(seed, F.col(whole), F.col(f"`{id_col}`")) <= F.col(cut), F.lit(False)).cast("long")
    times = told.withColumn(copy, F.col(whole) + part).where(F.col(copy) > 0)
    return times.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copy)))).select(*[f"`{c}`" for c in docs.columns])


SEED, ENTROPY, BLOCK = 42, 0.95, 1_000_000


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixture = Mixture(table(spark, sf_dir, "documents"), "source", "doc_id", "text", SEED, ENTROPY, None, None, False, 100_000)
    return mixture.realised(BLOCK).withColumnRenamed("id", "doc_id")


SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens FROM documents
), g AS (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS has FROM d GROUP BY source),
h(step, low, high) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
  UNION ALL
  SELECT step + 1, CASE WHEN ok THEN (low + high) / 2 ELSE low END, CASE WHEN ok THEN high ELSE (low + high) / 2 END
  FROM (
    SELECT h.*, (
      SELECT -sum(w * log2(w)) FROM (SELECT pow(has, (h.low + h.high) / 2) / sum(pow(has, (h.low + h.high) / 2)) OVER () AS w FROM g WHERE has > 0)
    ) >= {ENTROPY} * (SELECT log2(count(*)) FROM g WHERE has > 0) AS ok
    FROM h WHERE step < {STEPS}
  )
), e AS (
  SELECT CASE WHEN (SELECT -sum(w * log2(w)) FROM (SELECT has / sum(has) OVER () AS w FROM g WHERE has > 0)) >= {ENTROPY} * (SELECT log2(count(*)) FROM g WHERE has > 0)
              THEN 1 ELSE round(max(low) FILTER (step = {STEPS}), 9) END AS x FROM h
), p AS (
  SELECT source, has, CAST(floor(pow(has, x) / sum(pow(has, x)) OVER () * (SELECT sum(has) FROM g) + 0.5) AS BIGINT) AS wanted FROM g, e WHERE has > 0
  UNION ALL SELECT source, has, 0 FROM g WHERE has = 0
), q AS (
  SELECT source, has, wanted, CASE WHEN has > 0 THEN wanted // has ELSE 1 END AS whole, CASE WHEN has > 0 THEN wanted % has ELSE 0 END AS rest FROM p
), n AS (SELECT greatest(1, CAST(ceil(sum(wanted) / {BLOCK}.0) AS BIGINT)) AS blocks FROM q),
r AS (
  SELECT d.doc_id, d.source, d.n_tokens, q.has, q.wanted, q.whole, q.rest, epoch, md5('{SEED}:' || epoch || ':' || d.doc_id) AS key
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source, unnest(generate_series(0, q.whole)) u(epoch)
), s AS (
  SELECT *, CAST(sum(n_tokens) OVER (PARTITION BY source, epoch ORDER BY key RANGE UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM r
)
SELECT doc_id, source, epoch,
       CASE WHEN wanted > 0 THEN least((epoch * has + upto - n_tokens) * blocks // wanted, blocks - 1) ELSE 0 END AS block, n_tokens
FROM s, n WHERE epoch < whole OR (rest > 0 AND upto <= rest)
"""
