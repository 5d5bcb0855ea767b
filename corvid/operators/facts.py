"""Financial facts: scope, amendment lineages, precedence, rounding conflicts, series, quarters, trailing sums, identities.

A fact has an entity, a concept, a unit, a start and end day (start null:
instant), dimensions (a map), a value and decimals.  Dimensions are compared as
sorted entries.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from corvid.functions.dates import period_class


def sorted_entries(dims: Column) -> Column:
    """A map as text that is equal for equal maps."""
    return F.to_json(F.array_sort(F.map_entries(F.coalesce(dims, F.create_map().cast("map<string,string>")))))


def in_scope(facts: DataFrame, instant: Column | None = None, start: Column | None = None, end: Column | None = None, unit: str | None = None, dimensions: Mapping[str, str] | None = None) -> DataFrame:
    """Facts at an instant or over a duration, of a unit, with exactly these dimensions."""
    out = facts
    if instant is not None:
        out = out.where(F.col("start").isNull() & (F.col("end") == instant))
    if start is not None:
        out = out.where((F.col("start") == start) & (F.col("end") == end))
    if unit is not None:
        out = out.where(F.col("unit") == unit)
    if dimensions is not None:
        asked = F.create_map(*[F.lit(x) for kv in dimensions.items() for x in kv]) if dimensions else F.create_map().cast("map<string,string>")
        out = out.where(sorted_entries(F.col("dims")) == sorted_entries(asked))
    return out


def lineages(filings: DataFrame, entity: str, form: Column, period: str, amendment: Column, filed: str, accession: str) -> DataFrame:
    """Each filing's lineage and rank: amendments of one form and period, in order of (is amendment, filed, accession)."""
    key = [entity, "base_form", period]
    rows = filings.withColumns({"base_form": form, "is_amendment": amendment})
    w = W.Window.partitionBy(*key).orderBy("is_amendment", filed, accession)
    return rows.withColumns({"lineage_rank": F.row_number().over(w), "lineage_size": F.count("*").over(W.Window.partitionBy(*key))})


def supersede(facts: DataFrame, key: Sequence[str], rank: str, accession: str) -> DataFrame:
    """Every fact kept, with ``superseded_by``: the accession of the highest-ranked fact of its key, null on that one."""
    best = F.max(F.struct(rank, accession)).over(W.Window.partitionBy(*key))
    return facts.withColumn("superseded_by", F.when(F.col(rank) < best[rank], best[accession]))


def latest_filed(facts: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Facts of the latest filing of their key; the winner's own duplicates stay."""
    best = F.max(F.struct(*order)).over(W.Window.partitionBy(*key))
    return facts.withColumn("_best", best).where(F.struct(*order) == F.col("_best")).drop("_best")


def rounding_conflicts(facts: DataFrame, key: Sequence[str], value: str, decimals: str) -> DataFrame:
    """One row a key: agreed, if all values share a point within half a unit of their last decimal; the most precise value."""
    slack = F.coalesce(0.5 * F.pow(F.lit(10.0), -F.col(decimals)), F.lit(0.0))
    return facts.withColumn("_t", slack).groupBy(*key).agg(
        (F.max(F.col(value) - F.col("_t")) <= F.min(F.col(value) + F.col("_t"))).alias("agreed"), F.min_by(value, F.struct("_t", value)).alias("value"), F.count("*").alias("n"),
    )


def series_breaks(annual: DataFrame, entity: str, end: str, tolerance: int = 15) -> DataFrame:
    """Annual ends with ``break``: the year end moved by more than ``tolerance`` days against the one before."""
    before = F.lag(end).over(W.Window.partitionBy(entity).orderBy(end))
    moved = F.abs(F.datediff(F.col(end), F.add_months(before, 12)))
    return annual.withColumn("break", F.coalesce(moved > tolerance, F.lit(False)))


def value_clusters(facts: DataFrame, key: Sequence[str], value: str, decimals: str) -> DataFrame:
    """(key, cluster, value, n): values whose rounding intervals overlap in a chain are one cluster, numbered upwards; its most precise
    value stands for it.  More than one cluster is a conflict."""
    slack = F.coalesce(0.5 * F.pow(F.lit(10.0), -F.col(decimals)), F.lit(0.0))
    ranged = facts.select(*key, F.col(value).alias("_v"), slack.alias("_t")).withColumns({"_low": F.col("_v") - F.col("_t"), "_high": F.col("_v") + F.col("_t")})
    w = W.Window.partitionBy(*key).orderBy("_low", "_high", "_v")
    before = F.max("_high").over(w.rowsBetween(W.Window.unboundedPreceding, -1))
    numbered = ranged.withColumn("_new", F.coalesce((F.col("_low") > before).cast("int"), F.lit(0))).withColumn("cluster", F.sum("_new").over(w.rowsBetween(W.Window.unboundedPreceding, W.Window.currentRow)))
    return numbered.groupBy(*key, "cluster").agg(F.min_by("_v", F.struct("_t", "_v")).alias("value"), F.count("*").alias("n"))


def assembled_series(annual: DataFrame, entity: str, start: str, end: str, tolerance: int = 15) -> DataFrame:
    """Annual periods in order with ``break`` and ``segment``: a period that isn't a year long is a ``transition``; else a year end that
    lies a year and more too late is a ``gap``, and one that moved otherwise a ``year_end``.  Each break begins the next segment."""
    w = W.Window.partitionBy(entity).orderBy(end, start)
    before, days = F.lag(end).over(w), F.datediff(end, start) + 1
    late = F.datediff(F.col(end), F.add_months(before, 12))
    kind = F.when(~days.between(365 - tolerance - 10, 366 + tolerance), "transition").when(late > 365 - tolerance, "gap").when(F.abs(late) > tolerance, "year_end")
    told = annual.withColumn("break", kind)
    return told.withColumn("segment", F.sum(F.col("break").isNotNull().cast("int")).over(w.rowsBetween(W.Window.unboundedPreceding, W.Window.currentRow)))


#: How many quarters a class of duration holds.
RUNGS = {"QUARTER": 1, "YTD_2Q": 2, "YTD_3Q": 3, "ANNUAL": 4}


def discrete_quarters(facts: DataFrame, key: Sequence[str], additive: Column | None = None) -> DataFrame:
    """Quarters that a filer gave only cumulatively: each rung less the one before it with the same start.

    (key, start, end, value, status, reason); status is reported, derived or
    refused.  Reported quarters win; a missing or ambiguous earlier rung, or a
    kind that doesn't add up, refuses that quarter only.
    """
    rung = F.when(F.lit(False), 0)
    kind = period_class(F.col("start"), F.col("end"))
    for name, n in RUNGS.items():
        rung = rung.when(kind == name, n)
    rows = facts.withColumns({"rung": rung, "additive": F.lit(True) if additive is None else additive}).where("rung is not null")
    legs = rows.groupBy(*key, "start", "rung").agg(F.count("*").alias("n"), F.min("end").alias("end"), F.min("value").alias("value"), F.bool_and("additive").alias("additive"))
    before = legs.select(*key, "start", (F.col("rung") + 1).alias("rung"), F.col("n").alias("_n"), F.col("end").alias("_end"), F.col("value").alias("_value"))
    both = legs.where("rung > 1").join(before, [*key, "start", "rung"], "left")
    reason = (
        F.when(~F.col("additive"), "not additive").when(F.col("_n").isNull(), "missing leg").when((F.col("_n") > 1) | (F.col("n") > 1), "ambiguous leg")
    )
    first = F.date_add(F.col("_end"), 1)
    made = both.select(*key, F.coalesce(first, F.col("start")).alias("start"), "end", F.when(reason.isNull(), F.col("value") - F.col("_value")).alias("value"), F.when(reason.isNull(), "derived").otherwise("refused").alias("status"), reason.alias("reason"))
    reported = legs.where("rung = 1").select(*key, "start", "end", "value", F.lit("reported").alias("status"), F.lit(None).cast("string").alias("reason"))
    known = reported.select(*key, "end")
    return reported.unionByName(made.join(known, [*key, "end"], "left_anti"))


def trailing_year(quarters: DataFrame, key: Sequence[str], end: str, value: str, position: str) -> DataFrame:
    """Sum of four quarters up to each; null with a reason where one of them is missing (``position``: quarter number, year * 4 + quarter)."""
    w = W.Window.partitionBy(*key).orderBy(position).rowsBetween(-3, W.Window.currentRow)
    whole = (F.count(value).over(w) == 4) & (F.col(position) - F.min(position).over(w) == 3)
    return quarters.select(*key, end, position, F.when(whole, F.sum(value).over(w)).alias("ttm"), F.when(~whole, "missing quarter").alias("reason"))


def identity(facts: DataFrame, key: Sequence[str], concept: str, value: str, plus: Sequence[str], minus: Sequence[str], total: str, tolerance: float = 0.15) -> DataFrame:
    """(key, computed, reported, holds): plus less minus against the total, within a tolerance relative to it; keys without all parts are left out."""
    names = [*plus, *minus, total]
    wide = facts.where(F.col(concept).isin(*names)).groupBy(*key).pivot(concept, names).agg(F.first(value))
    complete = wide.dropna(subset=names)
    computed = sum((F.col(p) for p in plus), F.lit(0.0)) - sum((F.col(m) for m in minus), F.lit(0.0))
    return complete.select(*key, computed.alias("computed"), F.col(total).alias("reported"), (F.abs(computed - F.col(total)) <= tolerance * F.greatest(F.abs(F.col(total)), F.lit(1.0))).alias("holds"))


def binary_round(x: Column, places: int | Column) -> Column:
    """A double rounded half away from zero as DuckDB does it: scaled by a power of ten, rounded, scaled back.

    ``F.round`` takes the shortest decimal text of the double instead, and differs where scaling falls to the other side of a half.
    """
    by = F.pow(F.lit(10.0), F.lit(places) if isinstance(places, int) else places)
    return F.round(x * by) / by


def sums_in_order(rows: DataFrame, key: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """(key, values): sums of doubles, added one by one in an order that tells rows apart: the last bits of such a sum depend on it.  Nulls are left out."""
    w = W.Window.partitionBy(*key).orderBy(*order)
    upto = w.rowsBetween(W.Window.unboundedPreceding, W.Window.currentRow)
    return rows.select(*key, *[F.sum(v).over(upto).alias(v) for v in values], F.lead(F.lit(1)).over(w).alias("_next")).where("_next is null").drop("_next")


def eps_identity(facts: DataFrame, key: Sequence[str], income: str, shares: str, eps: str, decimals: str) -> DataFrame:
    """(key, computed, reported, holds): income over shares against earnings a share, at the precision it is printed with;
    keys without all three, or without shares, are left out."""
    names = [income, shares, eps]
    one = facts.where(F.col("concept").isin(*names)).groupBy(*key).agg(*[F.max(F.when(F.col("concept") == n, F.col("value"))).alias(f"_{k}") for k, n in enumerate(names)], F.max(F.when(F.col("concept") == eps, F.col(decimals))).alias("_d"))
    whole = one.where(F.col("_0").isNotNull() & (F.col("_1") != 0) & F.col("_2").isNotNull())
    computed = F.col("_0") / F.col("_1")
    # half a unit of the last printed place, and a hair for the division
    near = F.abs(computed - F.col("_2")) <= 0.5 * F.pow(F.lit(10.0), -F.coalesce("_d", F.lit(2))) * (1 + 1e-9)
    return whole.select(*key, computed.alias("computed"), F.col("_2").alias("reported"), near.alias("holds"))


def stitched_year(quarters: DataFrame, annuals: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, year, quarter, ttm, derived): trailing sums over four quarters in a row, stitched from different filings.

    ``quarters`` (key, year, quarter, value, filed) and ``annuals`` (key, year, value, filed): of a period that several filings tell,
    the last filed counts; a year's single missing quarter is its annual value less the other three (``derived`` counts such legs).
    """
    def last(df: DataFrame, at: Sequence[str]) -> DataFrame:
        return df.groupBy(*key, *at).agg(F.max_by("value", F.struct("filed", "value")).alias("value"))

    q, a = last(quarters, ["year", "quarter"]), last(annuals, ["year"])
    years = q.groupBy(*key, "year").agg(F.count("*").alias("_n"), F.sum("value").alias("_s"), (10 - F.sum("quarter")).alias("quarter"))
    made = years.where("_n = 3").join(a, [*key, "year"]).select(*key, "year", "quarter", (F.col("value") - F.col("_s")).alias("value"), F.lit(1).alias("_d"))
    legs = q.withColumn("_d", F.lit(0)).unionByName(made).withColumn("_p", F.col("year") * 4 + F.col("quarter"))
    w = W.Window.partitionBy(*key).orderBy("_p").rowsBetween(-3, W.Window.currentRow)
    whole = (F.count("value").over(w) == 4) & (F.col("_p") - F.min("_p").over(w) == 3)
    return legs.select(*key, "year", "quarter", F.when(whole, F.sum("value").over(w)).alias("ttm"), F.when(whole, F.sum("_d").over(w)).alias("derived"))


def normalized(facts: DataFrame) -> DataFrame:
    """Facts (concept, value, unit, start, end, dims, ...) with their place in the cube: ``period`` (instant, quarter, half, nine_months,
    year or other), ``unit_class`` (money, shares, money_per_share, pure or other) and ``slice`` (the sorted axes and members as text)."""
    days = F.date_diff("end", "start") + 1
    period = F.when(F.col("start").isNull(), "instant").when(days.between(75, 105), "quarter").when(days.between(160, 200), "half").when(days.between(250, 295), "nine_months").when(days.between(340, 380), "year").otherwise("other")
    unit = F.lower(F.element_at(F.split(F.coalesce("unit", F.lit("")), ":"), -1))
    kind = F.when(F.col("unit").rlike("^(iso4217:)?[A-Z]{3}$"), "money").when(unit == "shares", "shares").when(unit.rlike("^[a-z]{3}(/|per)shares?$"), "money_per_share").when(unit.isin("pure", "percent", ""), "pure").otherwise("other")
    return facts.withColumns({"period": period, "unit_class": kind, "slice": F.array_join(F.transform(F.array_sort(F.map_entries(F.coalesce("dims", F.create_map().cast("map<string,string>")))), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")})


def dimension_rollup(facts: DataFrame, key: Sequence[str], member: str, value: str, tolerance: float = 0.15) -> DataFrame:
    """(key, members, total, holds): the sum over members against the fact without a member."""
    sums = facts.groupBy(*key).agg(F.sum(F.when(F.col(member).isNotNull(), F.col(value))).alias("members"), F.max(F.when(F.col(member).isNull(), F.col(value))).alias("total"))
    return sums.where("members is not null and total is not null").withColumn("holds", F.abs(F.col("members") - F.col("total")) <= tolerance * F.greatest(F.abs("total"), F.lit(1.0)))


def latest_period(facts: DataFrame, kind: str, end: str) -> DataFrame:
    best = F.max(end).over(W.Window.partitionBy(kind))
    return facts.withColumn("_best", best).where(F.col(end) == F.col("_best")).drop("_best")


def panel(entities: DataFrame, entity: str, facts: DataFrame, value: str) -> DataFrame:
    """One row an entity, with its value or a reason; none is dropped."""
    one = facts.groupBy(entity).agg(F.count("*").alias("_n"), F.max(value).alias("_v"))
    joined = entities.select(entity).join(one, entity, "left")
    return joined.select(entity, F.when(F.col("_n") == 1, F.col("_v")).alias("value"), F.when(F.col("_n").isNull(), "UNAVAILABLE").when(F.col("_n") > 1, "AMBIGUOUS").otherwise("REPORTED").alias("status"))


def compare_sources(left: DataFrame, right: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """(key, status): agree, differ, left_only or right_only."""
    a, b = left.select(*key, F.col(value).alias("_a"), F.lit(1).alias("_l")), right.select(*key, F.col(value).alias("_b"), F.lit(1).alias("_r"))
    status = F.when(F.col("_r").isNull(), "left_only").when(F.col("_l").isNull(), "right_only").when(F.col("_a").eqNullSafe(F.col("_b")), "agree").otherwise("differ")
    return a.join(b, list(key), "full_outer").select(*key, status.alias("status"))


# Concepts as atoms: a head and a set of modifiers


def is_a(modifiers: Column, other: Column) -> Column:
    """The modifiers include the other's (the head compared elsewhere)."""
    return F.size(F.array_except(other, modifiers)) == 0


def most_specific(atoms: DataFrame, head: str, modifiers: str) -> DataFrame:
    """Atoms that no other atom of the head refines."""
    a, b = atoms.select(head, modifiers).distinct().alias("a"), atoms.select(head, F.col(modifiers).alias("_m")).distinct()
    refined = is_a(F.col("_m"), F.col(modifiers)) & (F.size("_m") > F.size(modifiers))
    return a.join(b, head).groupBy(head, modifiers).agg(F.bool_or(refined).alias("_r")).where("not _r").drop("_r")


def equivalence_tier(head_a: Column, mods_a: Column, head_b: Column, mods_b: Column) -> Column:
    """exact: the same atom; near: one refines the other by one modifier; unrelated otherwise."""
    extra = F.size(F.array_except(mods_a, mods_b)) + F.size(F.array_except(mods_b, mods_a))
    contained = (F.size(F.array_except(mods_a, mods_b)) == 0) | (F.size(F.array_except(mods_b, mods_a)) == 0)
    return F.when(head_a != head_b, "unrelated").when(extra == 0, "exact").when((extra == 1) & contained, "near").otherwise("unrelated")


def rank_equivalents(atoms: DataFrame, name: str, head: str, modifiers: str, target: str) -> DataFrame:
    """(name, tier, rank): concepts by how near they are to a target: exact, then near by fewest modifiers apart, then by name; unrelated ones are left out."""
    asked = atoms.where(F.col(name) == target).select(F.col(head).alias("_h"), F.col(modifiers).alias("_m")).limit(1)
    both = atoms.where(F.col(name) != target).crossJoin(F.broadcast(asked))  # one target
    tier = equivalence_tier(F.col("_h"), F.col("_m"), F.col(head), F.col(modifiers))
    apart = F.size(F.array_except("_m", modifiers)) + F.size(F.array_except(modifiers, "_m"))
    found = both.select(name, tier.alias("tier"), apart.alias("_apart")).where("tier <> 'unrelated'")
    return found.withColumn("rank", F.row_number().over(W.Window.partitionBy(F.lit(1)).orderBy("_apart", name))).drop("_apart")  # the few that are near


def peers(rows: DataFrame, entity: str, head: str, modifiers: str) -> DataFrame:
    """(entity, class_id, peers): entities that share a coordinate are one class, named by its least entity; ``peers`` are the others in it.

    Pairs aren't made: they grow with the square of a class, and the class tells them all.
    """
    at = rows.select(entity, F.concat_ws("|", head, F.array_join(F.array_sort(modifiers), ",")).alias("_c")).distinct()
    classes = at.groupBy("_c").agg(F.min(entity).alias("class_id"), (F.count("*") - 1).alias("peers"))
    return at.join(classes, "_c").select(entity, "class_id", "peers")


def collocations(tokens: DataFrame, words: str, min_count: int = 2, min_pmi: float = 0.5) -> DataFrame:
    """(first, second, n, pmi) of neighbouring words: log2 of their share over the product of their words' shares."""
    pairs = tokens.select(F.explode(F.arrays_zip(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))).alias("first"), F.slice(words, 2, F.greatest(F.size(words), F.lit(1))).alias("second"))).alias("p")).select("p.first", "p.second").where("second is not null")
    one = tokens.select(F.explode(words).alias("w")).groupBy("w").agg(F.count("*").alias("c"))
    total = one.agg(F.sum("c").alias("words"))
    counted = pairs.groupBy("first", "second").agg(F.count("*").alias("n"))
    whole = counted.agg(F.sum("n").alias("pairs"))
    found = counted.where(F.col("n") >= min_count).join(one.toDF("first", "ca"), "first").join(one.toDF("second", "cb"), "second").crossJoin(F.broadcast(total)).crossJoin(F.broadcast(whole))  # one row each
    pmi = F.log2((F.col("n") / F.col("pairs")) / ((F.col("ca") / F.col("words")) * (F.col("cb") / F.col("words"))))
    return found.withColumn("pmi", pmi).where(F.col("pmi") >= min_pmi).select("first", "second", "n", "pmi")
