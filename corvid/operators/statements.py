"""Questions over facts: terms with a status, a fluent filter, chains, ratios, statement roll-ups, derived totals, quarantine, breakdowns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from corvid.operators.facts import rounding_conflicts, sorted_entries
from corvid.operators.graph import double_counted
from corvid.scratch import written


class FactQuery:
    """Conditions on facts (concept, value, unit, start, end, dims, text), gathered and applied at once."""

    def __init__(self, facts: DataFrame):
        self.facts, self.conditions, self.steps = facts, [], []

    def where(self, condition: Column) -> FactQuery:
        self.conditions.append(condition)
        return self

    def concept(self, pattern: str) -> FactQuery:
        """``*`` stands for any run of characters."""
        if "*" not in pattern:
            return self.where(F.col("concept") == pattern)
        return self.where(F.col("concept").like(pattern.replace("\\", "\\\\").replace("%", r"\%").replace("_", r"\_").replace("*", "%")))

    def unit(self, unit: str) -> FactQuery:
        return self.where(F.col("unit") == unit)

    def close_to(self, value: float, within: float = 0.01) -> FactQuery:
        return self.where(F.abs(F.col("value") - value) <= abs(value) * within)

    def period(self, end: str, start: str | None = None) -> FactQuery:
        self.where(F.col("end") == F.lit(end).cast("date"))
        return self.where(F.col("start") == F.lit(start).cast("date")) if start else self

    def member(self, axis: str, member: str | None = None) -> FactQuery:
        held = F.try_element_at("dims", F.lit(axis))
        return self.where(held.isNotNull() if member is None else held == member)

    def face_only(self) -> FactQuery:
        return self.where(F.coalesce(F.size("dims"), F.lit(0)) <= 0)

    def text_contains(self, text: str) -> FactQuery:
        return self.where(F.contains(F.lower("text"), F.lit(text.lower())))

    def latest_period(self) -> FactQuery:
        """Applied after the conditions: the last end among instants, and among durations."""
        def last(df: DataFrame) -> DataFrame:
            kind = F.col("start").isNull()
            return df.withColumn("_last", F.max("end").over(W.Window.partitionBy(kind))).where(F.col("end") == F.col("_last")).drop("_last")

        self.steps.append(last)
        return self

    def frame(self) -> DataFrame:
        out = self.facts.where(reduce(and_, self.conditions)) if self.conditions else self.facts
        for step in self.steps:
            out = step(out)
        return out


def term_status(facts: DataFrame, entities: DataFrame, entity: str, candidates: Sequence[str]) -> DataFrame:
    """(entity, concept, value, status): the first candidate concept an entity reports; CONFLICT if its values don't share a rounding interval,
    AMBIGUOUS if contexts differ, UNAVAILABLE without any."""
    order = F.create_map(*[F.lit(x) for k, c in enumerate(candidates) for x in (c, k)])
    mine = facts.where(F.col("concept").isin(*candidates)).withColumn("_rank", order[F.col("concept")])
    first = mine.withColumn("_best", F.min("_rank").over(W.Window.partitionBy(entity))).where("_rank = _best")
    agreed = rounding_conflicts(first.withColumn("_c", F.concat_ws("|", F.col("start").cast("string"), F.col("end").cast("string"), sorted_entries(F.col("dims")))), [entity, "concept", "_c"], "value", "decimals")
    one = agreed.groupBy(entity, "concept").agg(F.count("*").alias("_n"), F.bool_and("agreed").alias("_a"), F.max("value").alias("_v"))
    status = F.when(F.col("_n").isNull(), "UNAVAILABLE").when(~F.col("_a"), "CONFLICT").when(F.col("_n") > 1, "AMBIGUOUS").otherwise("REPORTED")
    return entities.select(entity).join(one, entity, "left").select(entity, "concept", F.when(status == "REPORTED", F.col("_v")).alias("value"), status.alias("status"))


def chain(facts: DataFrame, key: Sequence[str], terms: Sequence[tuple[int, str]], arcs: DataFrame | None = None) -> DataFrame:
    """(key, value, missing): a signed sum over concepts, one value each; refused where one concept holds another by the arcs (a, b)."""
    if arcs is not None:
        names = [c for _, c in terms]
        starts = facts.sparkSession.createDataFrame([(c,) for c in names], "x string")
        held = double_counted(arcs, starts).toDF("a", "b").limit(1).collect()
        if held:
            raise ValueError(f"{held[0]['a']} holds {held[0]['b']}: the sum counts it twice")
    sign = F.create_map(*[F.lit(x) for s, c in terms for x in (c, s)])
    mine = facts.where(F.col("concept").isin(*[c for _, c in terms])).groupBy(*key, "concept").agg(F.max("value").alias("v"))
    out = mine.groupBy(*key).agg(F.sum(sign[F.col("concept")] * F.col("v")).alias("_s"), F.sort_array(F.array_except(F.array(*[F.lit(c) for _, c in terms]), F.collect_set("concept"))).alias("missing"))
    return out.select(*key, F.when(F.size("missing") == 0, F.col("_s")).alias("value"), "missing")


def trailing_ratio(quarters: DataFrame, key: Sequence[str], over: str, under: str, position: str, days: str | None = None) -> DataFrame:
    """(key, position, ratio): a ratio of trailing sums over four quarters in a row, never a sum of ratios; ``days`` weighs the denominator instead of summing it."""
    w = W.Window.partitionBy(*key).orderBy(position).rowsBetween(-3, W.Window.currentRow)
    whole = (F.count(over).over(w) == 4) & (F.count(under).over(w) == 4) & (F.col(position) - F.min(position).over(w) == 3)
    below = F.sum(under).over(w) if days is None else F.sum(F.col(under) * F.col(days)).over(w) / F.sum(days).over(w)
    return quarters.select(*key, position, F.when(whole & (below != 0), F.sum(over).over(w) / below).alias("ratio"))


def rollup(facts: DataFrame, arcs: DataFrame, key: Sequence[str], tolerance: float = 1.0) -> DataFrame:
    """(key, parent, computed, reported, children, expected, holds): weighted sums of children of (parent, child, weight) against the parent's own value."""
    one = facts.groupBy(*key, "concept").agg(F.max("value").alias("v"))
    kids = one.withColumnRenamed("concept", "child").join(arcs, "child").groupBy(*key, "parent").agg(F.sum(F.col("weight") * F.col("v")).alias("computed"), F.count("*").alias("children"))
    want = arcs.groupBy("parent").agg(F.count("*").alias("expected"))
    whole = kids.join(want, "parent").join(one.withColumnsRenamed({"concept": "parent", "v": "reported"}), [*key, "parent"], "left")
    return whole.select(*key, "parent", "computed", "reported", "children", "expected", (F.abs(F.col("computed") - F.col("reported")) <= tolerance).alias("holds"))


def derive_totals(facts: DataFrame, arcs: DataFrame, key: Sequence[str]) -> DataFrame:
    """Totals that aren't reported but whose children all are: (key, concept, value, status DERIVED), beside the reported facts."""
    made = rollup(facts, arcs, key).where("reported is null and children = expected").select(*key, F.col("parent").alias("concept"), F.col("computed").alias("value"), F.lit("DERIVED").alias("status"))
    return facts.select(*key, "concept", "value", F.lit("REPORTED").alias("status")).unionByName(made)


def evaluate_totals(facts: DataFrame, arcs: DataFrame, key: Sequence[str], tolerance: float = 1.0, most: int = 32) -> DataFrame:
    """(key, concept, value, status) over any number of hops: REPORTED facts; totals that their children, reported or derived, confirm
    (VERIFIED) or deny (CONFLICT); and totals that aren't reported but whose children all are known (DERIVED).

    Each round derives the totals whose children the last one made known, until none is new.
    """
    known = written(facts.groupBy(*key, "concept").agg(F.max("value").alias("value")).withColumn("status", F.lit("REPORTED")), "totals")
    for _ in range(most):
        sums = rollup(known, arcs, key, tolerance).where("children = expected")
        made = written(sums.where("reported is null").select(*key, F.col("parent").alias("concept"), F.col("computed").alias("value"), F.lit("DERIVED").alias("status")), "totals")
        if made.isEmpty():
            break
        known = written(known.unionByName(made), "totals")
    else:
        raise ValueError(f"totals still follow after {most} rounds: the arcs have a cycle")
    told = sums.where("reported is not null").select(*key, F.col("parent").alias("concept"), F.col("holds"))
    status = F.when(F.col("status") == "DERIVED", "DERIVED").when(F.col("holds"), "VERIFIED").when(~F.col("holds"), "CONFLICT").otherwise("REPORTED")
    return known.join(told, [*key, "concept"], "left").select(*key, "concept", "value", status.alias("status"))


def quarantine(facts: DataFrame, arcs: DataFrame, key: Sequence[str], tolerance: float = 1.0) -> DataFrame:
    """Children of broken totals, with the hypothesis that explains the gap: sign (twice a child), scale (a power of ten off), or none."""
    broken = rollup(facts, arcs, key, tolerance).where("reported is not null and children = expected and not holds").withColumn("gap", F.col("computed") - F.col("reported"))
    one = facts.groupBy(*key, F.col("concept").alias("child")).agg(F.max("value").alias("v"))
    parts = broken.select(*key, "parent", "gap").join(arcs, "parent").join(one, [*key, "child"])
    w, v, gap = F.col("weight"), F.col("v"), F.col("gap")
    scale = reduce(lambda a, b: a | b, [F.abs(w * v * (1 - 10.0**p) - gap) <= tolerance for p in (-6, -3, 3, 6)])
    return parts.withColumn("hypothesis", F.when(F.abs(2 * w * v - gap) <= tolerance, "sign").when(scale, "scale").otherwise("none")).select(*key, "parent", "child", "gap", "hypothesis")


def breakdown(facts: DataFrame, key: Sequence[str], concept: str) -> DataFrame:
    """(key, axis, member, value, share): a concept by each of its axes, with the share of the axis."""
    told = facts.where(F.col("concept") == concept).select(*key, F.explode(F.col("dims")).alias("axis", "member"), "value").groupBy(*key, "axis", "member").agg(F.sum("value").alias("value"))
    return told.withColumn("share", F.col("value") / F.sum("value").over(W.Window.partitionBy(*key, "axis")))


def search_concepts(concepts: DataFrame, term: str, limit: int = 20) -> DataFrame:
    """Concepts close to a term: exact, prefix, then by words in common; ties by name."""
    asked = [w for w in term.lower().split() if w]
    said = F.lower(F.regexp_replace(F.regexp_replace("concept", "([a-z0-9])([A-Z])", "$1 $2"), "[^A-Za-z0-9]+", " "))
    common = F.size(F.array_intersect(F.split(said, " "), F.array(*[F.lit(w) for w in asked])))
    rank = F.when(said == " ".join(asked), 0).when(F.startswith(said, F.lit(" ".join(asked))), 1).when(common == len(asked), 2).otherwise(3)
    return concepts.select("concept").distinct().withColumns({"rank": rank, "common": common}).where("common > 0").orderBy("rank", F.desc("common"), "concept").limit(limit)


