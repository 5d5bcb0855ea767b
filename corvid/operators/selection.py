"""Features and deterministic selection: medians and bands, lifecycles, seeded draws, quotas, caps, water-filling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from corvid.functions.dates import date_predicate, parse_dates
from corvid.functions.text import has_suffix

#: Upper limits of the bands as multiples of the family's median, and their names.
BANDS = ((0.25, "very_small"), (1.0, "small"), (4.0, "median"), (16.0, "large"), (None, "very_large"))


def size_anchors(rows: DataFrame, family: str, document: str, occurrence: str, size: str) -> DataFrame:
    """(family, median_size) over one row a document, its first occurrence with a size.

    The exact median, found in a running count over each family's sizes, so no task holds a family's sizes at once.
    """
    first = F.min_by(F.struct(family, size), occurrence).alias("_f")
    one = rows.where(F.col(size).isNotNull()).groupBy(document).agg(first).select("_f.*")
    counts = one.groupBy(family, size).agg(F.count("*").alias("_n"))
    w = W.Window.partitionBy(family).orderBy(size)
    upto = counts.withColumns({"_upto": F.sum("_n").over(w), "_all": F.sum("_n").over(W.Window.partitionBy(family))})
    middle = lambda k: F.min(F.when(F.col("_upto") >= k, F.col(size)))
    return upto.groupBy(family).agg(((middle(F.ceil(F.col("_all") / 2)) + middle(F.floor(F.col("_all") / 2) + 1)) / 2).alias("median_size"))


def size_band(size: Column, anchor: Column) -> Column:
    out = F.when(size.isNull() | anchor.isNull(), "unknown")
    for limit, name in BANDS[:-1]:
        out = out.when(size < anchor * limit, name)
    return out.otherwise(BANDS[-1][1])


def lifecycle(rows: DataFrame, entity: str, year: str, gap: int = 3, grace: int = 5) -> DataFrame:
    """(entity, has_revival_gap, lifecycle_class) from the years in which an entity filed."""
    years = rows.where(F.col(year).isNotNull()).select(entity, year).distinct()
    last = years.agg(F.max(year).alias("_last"))
    pairs = years.withColumn("_next", F.lead(year).over(W.Window.partitionBy(entity).orderBy(year)))
    found = pairs.groupBy(entity).agg(F.max(year).alias("_max"), F.count("*").alias("_n"), F.coalesce(F.bool_or(F.col("_next") - F.col(year) >= gap), F.lit(False)).alias("has_revival_gap"))
    since = F.col("_last") - F.col("_max")
    kind = F.when((F.col("_n") <= 2) & (since <= 2), "short_recent_history").when(since >= grace, "ceased_filing_observed").when(since <= 1, "right_censored_active").otherwise("intermediate_or_dormant")
    return found.crossJoin(F.broadcast(last)).select(entity, "has_revival_gap", kind.alias("lifecycle_class"))  # ``last`` is one row


def locator_rollup(rows: DataFrame, key: str, occurrence: str) -> DataFrame:
    """The first occurrence of each key, with how many there are and their class; one partitioning for both."""
    w = W.Window.partitionBy(key)
    ranked = rows.withColumns({"_rn": F.row_number().over(w.orderBy(occurrence)), "occurrences": F.count("*").over(w.orderBy(occurrence).rowsBetween(W.Window.unboundedPreceding, W.Window.unboundedFollowing))})
    kind = F.when(F.col("occurrences") == 1, "single").when(F.col("occurrences") <= 3, "low_2_to_3").otherwise("high_4_plus")
    return ranked.where("_rn = 1").drop("_rn").withColumn("locator_class", kind)


def draw_order(seed: str, key: str) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)


def sample_modulo(rows: DataFrame, key: str, percent: int) -> DataFrame:
    """Rows whose key's md5, its first eight hexadecimal digits as a number, is below ``percent`` modulo 100."""
    return rows.where(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint") % 100 < percent)


def sample_top(rows: DataFrame, key: str, seed: str, n: int) -> DataFrame:
    """``n`` rows in seeded order: each task keeps its own ``n`` before they meet."""
    return rows.withColumn("_draw", draw_order(seed, key)).orderBy("_draw", key).limit(n).drop("_draw")


def sample_groups(rows: DataFrame, group: str, key: str, seed: str, n: int) -> DataFrame:
    """One row a group (its least key), ``n`` groups in seeded order."""
    heads = rows.groupBy(group).agg(F.min(key).alias(key))
    return sample_top(heads, group, seed, n)


def pool_for_value(rows: DataFrame, dimension: str, value: object, key: str, group: str, seed: str, n: int, excluded: DataFrame | None = None) -> DataFrame:
    """At most ``n`` rows with a value of a dimension in seeded order, one a group (its first drawn), without those whose group is excluded."""
    mine = rows.where(F.col(dimension) == F.lit(value))
    if excluded is not None:
        mine = mine.join(excluded.select(group).distinct(), group, "left_anti")
    draw = F.struct(draw_order(seed, key), F.col(key))
    one = mine.groupBy(group).agg(F.min_by(F.struct(*rows.columns), draw).alias("_r")).select("_r.*")
    return one.withColumn("_draw", draw_order(seed, key)).orderBy("_draw", key).limit(n).drop("_draw")


def candidate_predicate(name: Column | None = None, suffixes: Sequence[str] = (), size: Column | None = None, most: int | None = None, date: Column | None = None, dates: str = "") -> Column:
    """Every given condition at once: a suffix of the name, a size that is known and at most ``most``, and a date selection."""
    test = F.lit(True)
    if suffixes:
        test = test & has_suffix(name, tuple(suffixes))
    if most is not None:
        test = test & F.coalesce(size <= most, F.lit(False))
    return test & date_predicate(date, parse_dates(dates)) if dates.strip() else test


def top_per_key(rows: DataFrame, group: str, key: str, seed: str, n: int) -> DataFrame:
    w = W.Window.partitionBy(group).orderBy(draw_order(seed, key), key)
    return rows.withColumn("draw_rank", F.row_number().over(w)).where(F.col("draw_rank") <= n)


def page(rows: DataFrame, key: str, seed: str, index: int, size: int) -> DataFrame:
    return rows.withColumn("_draw", draw_order(seed, key)).orderBy("_draw", key).offset(index * size).limit(size).drop("_draw")


def signature_cap(rows: DataFrame, signature: Sequence[str], prior: DataFrame, cap: int, seed: str, key: str) -> DataFrame:
    """Rows within ``cap`` of their signature, less what ``prior`` (signature, filled) used already."""
    ranked = rows.withColumn("_rank", F.row_number().over(W.Window.partitionBy(*signature).orderBy(draw_order(seed, key), key)))
    return ranked.join(prior, list(signature), "left").where(F.col("_rank") <= cap - F.coalesce("filled", F.lit(0))).drop("_rank", "filled")


def floor_candidates(rows: DataFrame, key: str, dimensions: Sequence[str], floors: DataFrame) -> DataFrame:
    """(dimension, value, key): rows unpivoted over their dimensions and matched to the floors (dimension, value, need)."""
    told = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions])
    return rows.select(key, F.inline(told)).join(floors, ["dimension", "value"])


def water_fill(cells: Sequence[tuple[str, int, int]], budget: int) -> dict[str, int]:
    """Additions a cell (name, filled, available) so that levels are as equal as capacity lets them be; the rest goes in order.

    What a common level costs is a broken line in the level: it gets steeper where
    a cell begins to fill and flatter where one is full.  Walking its corners
    gives the stretch in which the budget runs out, and one division the level.
    """
    room = {name: max(0, min(budget, free)) for name, _, free in cells}
    corners = sorted([(filled, 1) for _, filled, _ in cells] + [(filled + room[name], -1) for name, filled, _ in cells])
    level = filling = 0
    left = budget
    for at, turn in corners:
        if filling * (at - level) > left:
            break
        left -= filling * (at - level)
        level, filling = at, filling + turn
    whole, extra = divmod(left, filling) if filling else (0, 0)
    level += whole
    out = {}
    for name, filled, _ in cells:
        out[name] = min(max(level - filled, 0), room[name])
        if extra and filled <= level < filled + room[name]:
            out[name] += 1
            extra -= 1
    return out


def additions(rows: DataFrame, cell: str, targets: Mapping[str, int], seed: str, key: str) -> DataFrame:
    """The first rows of each cell in seeded order, as many as its target; targets are a small table by cell."""
    spark = rows.sparkSession
    told = spark.createDataFrame([(c, n) for c, n in targets.items()], f"{cell} {rows.schema[cell].dataType.simpleString()}, _target long")
    w = W.Window.partitionBy(cell).orderBy(draw_order(seed, key), key)
    return rows.join(F.broadcast(told), cell).withColumn("_rn", F.row_number().over(w)).where("_rn <= _target").drop("_rn", "_target")


def quota_fill(rows: DataFrame, key: str, wanted: Column, quota: int, limit: int) -> DataFrame:
    """At most ``limit`` keys in key order: first up to ``quota`` keys for which ``wanted`` holds on some row, then the rest."""
    keys = rows.groupBy(key).agg(F.bool_or(F.coalesce(wanted, F.lit(False))).alias("wanted"))
    first = keys.where("wanted").orderBy(key).limit(quota).withColumn("_turn", F.lit(0))
    rest = keys.join(first.select(key), key, "left_anti").withColumn("_turn", F.lit(1))
    return first.unionByName(rest).orderBy("_turn", key).limit(limit).select(key, "wanted")


def share_capped(ordered: Sequence[tuple[str, str]], target: int, share: float) -> list[str]:
    """Keys taken in order while no value's share of the target passes the cap; the pages are bounded by the caller."""
    filled: dict[str, int] = {}
    out = []
    for key, value in ordered:
        if len(out) == target:
            break
        if (filled.get(value, 0) + 1) / target <= share:
            filled[value] = filled.get(value, 0) + 1
            out.append(key)
    return out


def stratified(pool: DataFrame, key: str, cell: str, dimension: str, size: int, floors: Mapping[str, int], share: float, seed: str, reserve: int = 0, seeds: Sequence[object] = ()) -> DataFrame:
    """(key, cell, dimension, reason): a deterministic stratified selection of ``size`` keys.

    In turn: given seeds, floors of the dimension's values, equal filling of
    cells by water-filling, then the rest in draw order while no value of the
    dimension passes its share, and a reserve.  Ranks are computed in Spark;
    the driver sees one count a cell, of each cell the candidates within the
    level that water-filling reaches (``size`` and one a cell in all), and of each
    of the dimension's values ``size + reserve`` at most.
    """
    spark, most = pool.sparkSession, size + reserve
    drawn = pool.withColumn("_draw", draw_order(seed, key))
    counts = [(r[cell], 0, r["count"]) for r in pool.groupBy(cell).count().collect()]
    # what seeds and floors fill counts towards the level, so it gets no higher than this
    level = max(water_fill(counts, size).values(), default=0) + 1
    rank = lambda c: F.row_number().over(W.Window.partitionBy(c).orderBy("_draw", key))
    wanted, given = set(seeds), F.col(key).isin(*seeds) if seeds else F.lit(False)
    near = drawn.withColumns({"_cell": rank(cell), "_value": rank(dimension)}).where((F.col("_cell") <= level) | (F.col("_value") <= most) | given)
    rows = near.select(key, cell, dimension, "_draw").orderBy("_draw", key).collect()
    chosen: dict[object, str] = {}
    count: dict[object, int] = {}

    def take(r, reason: str) -> None:
        chosen[r[key]] = reason
        count[r[dimension]] = count.get(r[dimension], 0) + 1

    for r in rows:
        if r[key] in wanted and len(chosen) < size:
            take(r, "seed")
    for value, need in sorted(floors.items()):
        for r in rows:
            if count.get(value, 0) >= need or len(chosen) >= size:
                break
            if r[dimension] == value and r[key] not in chosen:
                take(r, "floor")
    free: dict[object, list] = {}
    filled: dict[object, int] = {}
    for r in rows:
        if r[key] in chosen:
            filled[r[cell]] = filled.get(r[cell], 0) + 1
        else:
            free.setdefault(r[cell], []).append(r)
    names = sorted({*free, *filled}, key=str)
    targets = water_fill([(c, filled.get(c, 0), len(free.get(c, []))) for c in names], size - len(chosen))
    for c in names:
        for r in free.get(c, [])[: targets[c]]:
            if (count.get(r[dimension], 0) + 1) / size <= share:
                take(r, "cell")
    for r in rows:
        if len(chosen) >= size:
            break
        if r[key] not in chosen and (count.get(r[dimension], 0) + 1) / size <= share:
            take(r, "fill")
    left = [r for r in rows if r[key] not in chosen][:reserve]
    told = [(r[key], r[cell], r[dimension], chosen[r[key]]) for r in rows if r[key] in chosen] + [(r[key], r[cell], r[dimension], "reserve") for r in left]
    kinds = {c: pool.schema[c].dataType.simpleString() for c in (key, cell, dimension)}
    return spark.createDataFrame(told, f"{key} {kinds[key]}, {cell} {kinds[cell]}, {dimension} {kinds[dimension]}, reason string")
