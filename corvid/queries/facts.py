"""The facts layer: orders as filings, order totals as facts, customers as filers."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions import text as X
from corvid.operators import facts as A
from corvid.registry import load, query


def _filings(spark, sf_dir):
    return load(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("entity"), F.concat("o_orderstatus", F.when(F.col("o_orderkey") % 3 == 0, "/A").otherwise("")).alias("form"), F.year("o_orderdate").alias("period"),
        F.col("o_orderdate").cast("date").alias("filed"), F.col("o_orderkey").alias("accession"), F.round("o_totalprice").alias("value"),
    )


_FILINGS = """WITH f AS (SELECT o_custkey AS entity, o_orderstatus || CASE WHEN o_orderkey % 3 = 0 THEN '/A' ELSE '' END AS form, year(o_orderdate) AS period, CAST(o_orderdate AS DATE) AS filed, o_orderkey AS accession, round(o_totalprice) AS value, o_orderstatus AS base_form, o_orderkey % 3 = 0 AS am FROM orders),
l AS (SELECT *, row_number() OVER (PARTITION BY entity, base_form, period ORDER BY am, filed, accession) AS lineage_rank, count(*) OVER (PARTITION BY entity, base_form, period) AS lineage_size FROM f)
"""


def _lineages(spark, sf_dir):
    return A.lineages(_filings(spark, sf_dir), "entity", X.form_family(F.col("form")), "period", F.endswith("form", F.lit("/A")), "filed", "accession")


@query(f"{_FILINGS} SELECT entity, base_form, period, accession, lineage_rank, lineage_size FROM l")
def lineage_chains(spark, sf_dir):
    return _lineages(spark, sf_dir).select("entity", "base_form", "period", "accession", "lineage_rank", "lineage_size")


@query(f"{_FILINGS} SELECT accession, CASE WHEN lineage_rank < lineage_size THEN last_value(accession) OVER (PARTITION BY entity, base_form, period ORDER BY lineage_rank ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) END AS superseded_by FROM l")
def supersession(spark, sf_dir):
    return A.supersede(_lineages(spark, sf_dir), ["entity", "base_form", "period"], "lineage_rank", "accession").select("accession", "superseded_by")


@query(f"{_FILINGS} SELECT accession, entity, period FROM (SELECT *, rank() OVER (PARTITION BY entity, period ORDER BY filed DESC, accession DESC) AS r FROM f) WHERE r = 1")
def precedence_latest_filed(spark, sf_dir):
    return A.latest_filed(_filings(spark, sf_dir), ["entity", "period"], ["filed", "accession"]).select("accession", "entity", "period")


@query("""WITH f AS (SELECT l_partkey AS k, l_extendedprice AS v, -(l_linenumber % 4) AS d FROM lineitem), t AS (SELECT *, 0.5 * pow(10.0, -d) AS t FROM f)
SELECT k, max(v - t) <= min(v + t) AS agreed, arg_min(v, (t, v)) AS value, count(*) AS n FROM t GROUP BY 1""")
def interval_conflict(spark, sf_dir):
    f = load(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k"), F.col("l_extendedprice").alias("v"), (-(F.col("l_linenumber") % 4)).alias("d"))
    return A.rounding_conflicts(f, ["k"], "v", "d")


def _facts(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    return e.select("event_id", F.col("event_type").alias("concept"), F.lit("USD").alias("unit"), F.when(F.col("event_id") % 2 == 0, F.to_date(F.lit("2024-01-01"))).alias("start"), F.col("ts").cast("date").alias("end"), F.create_map(F.lit("k"), F.get_json_object("props", "$.k")).alias("dims"))


@query("SELECT event_id FROM events WHERE event_id % 2 = 1 AND CAST(ts AS DATE) = DATE '2024-01-10' AND json_extract_string(props, '$.k') = '7' OR (event_id % 2 = 1 AND CAST(ts AS DATE) = DATE '2024-01-10' AND json_extract_string(props, '$.k') = '7')")
def scope_filter(spark, sf_dir):
    return A.in_scope(_facts(spark, sf_dir), instant=F.to_date(F.lit("2024-01-10")), unit="USD", dimensions={"k": "7"}).select("event_id")


@query("SELECT event_id, event_type FROM events e WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events x WHERE x.event_type = e.event_type)")
def latest_period(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").cast("date").alias("d"))
    return A.latest_period(e, "event_type", "d").select("event_id", "event_type")


@query("""WITH b AS (SELECT o_custkey AS k, o_orderkey, o_orderkey % 5 AS r, CAST(round(o_totalprice) AS BIGINT) AS v FROM orders),
f AS (SELECT k, r + 1 AS rung, DATE '2023-01-01' AS s, CASE r WHEN 0 THEN DATE '2023-03-31' WHEN 1 THEN DATE '2023-06-30' WHEN 2 THEN DATE '2023-09-30' WHEN 3 THEN DATE '2023-12-31' END AS e, v FROM b WHERE r < 4),
l AS (SELECT k, s, rung, count(*) AS n, min(e) AS e, min(v) AS v FROM f GROUP BY ALL),
d AS (SELECT l.k, coalesce(CAST(p.e + 1 AS DATE), l.s) AS start, l.e AS "end", CASE WHEN p.n IS NULL THEN 'missing leg' WHEN p.n > 1 OR l.n > 1 THEN 'ambiguous leg' END AS reason, l.v - p.v AS v
  FROM l LEFT JOIN l p ON p.k = l.k AND p.s = l.s AND p.rung = l.rung - 1 WHERE l.rung > 1)
SELECT k, CAST(start AS VARCHAR) AS start, CAST("end" AS VARCHAR) AS "end", CASE WHEN reason IS NULL THEN v END AS value, CASE WHEN reason IS NULL THEN 'derived' ELSE 'refused' END AS status, reason FROM d
UNION ALL SELECT k, CAST(s AS VARCHAR), CAST(e AS VARCHAR), v, 'reported', NULL FROM l WHERE rung = 1""")
def quarter_unaccumulate(spark, sf_dir):
    o = load(spark, sf_dir, "orders").where("o_orderkey % 5 < 4")
    ends = F.element_at(F.array(*[F.to_date(F.lit(d)) for d in ("2023-03-31", "2023-06-30", "2023-09-30", "2023-12-31")]), (F.col("o_orderkey") % 5 + 1).cast("int"))
    f = o.select(F.col("o_custkey").alias("k"), F.to_date(F.lit("2023-01-01")).alias("start"), ends.alias("end"), F.round("o_totalprice").cast("bigint").alias("value"))
    out = A.discrete_quarters(f, ["k"])
    return out.withColumns({"start": F.col("start").cast("string"), "end": F.col("end").cast("string")})


@query("""WITH q AS (SELECT o_custkey AS k, year(o_orderdate) * 4 + quarter(o_orderdate) AS p, CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS v, CAST(max(o_orderdate) AS DATE) AS e FROM orders GROUP BY 1, 2),
w AS (SELECT *, count(v) OVER x AS n, p - min(p) OVER x AS span, sum(v) OVER x AS s FROM q WINDOW x AS (PARTITION BY k ORDER BY p ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))
SELECT k, p, CASE WHEN n = 4 AND span = 3 THEN CAST(s AS BIGINT) END AS ttm, CASE WHEN NOT (n = 4 AND span = 3) THEN 'missing quarter' END AS reason FROM w""")
def ttm_rolling(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    q = o.groupBy(F.col("o_custkey").alias("k"), (F.year("o_orderdate") * 4 + F.quarter("o_orderdate")).alias("p")).agg(F.sum(F.round("o_totalprice").cast("bigint")).alias("v"), F.max("o_orderdate").cast("date").alias("e"))
    return A.trailing_year(q, ["k"], "e", "v", "p").drop("e")


@query("""WITH a AS (SELECT o_custkey, year(o_orderdate) AS y, max(CAST(o_orderdate AS DATE)) AS e FROM orders GROUP BY 1, 2)
SELECT o_custkey, CAST(e AS VARCHAR) AS e, coalesce(abs(date_diff('day', CAST(lag(e) OVER (PARTITION BY o_custkey ORDER BY e) + INTERVAL 12 MONTH AS DATE), e)) > 15, false) AS break FROM a""")
def series_breaks(spark, sf_dir):
    a = load(spark, sf_dir, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.max(F.col("o_orderdate").cast("date")).alias("e"))
    return A.series_breaks(a, "o_custkey", "e").select("o_custkey", F.col("e").cast("string").alias("e"), "break")


@query("""WITH f AS (SELECT l_orderkey AS k, CASE WHEN l_linenumber = 1 THEN NULL ELSE 'm' || l_linenumber END AS m, CAST(CASE WHEN l_linenumber = 1 THEN 2 * l_quantity ELSE l_quantity END AS BIGINT) AS v FROM lineitem),
s AS (SELECT k, CAST(sum(v) FILTER (m IS NOT NULL) AS BIGINT) AS members, max(v) FILTER (m IS NULL) AS total FROM f GROUP BY 1) SELECT *, abs(members - total) <= 0.15 * greatest(abs(total), 1) AS holds FROM s WHERE members IS NOT NULL AND total IS NOT NULL""")
def rollup_check(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    first = F.col("l_linenumber") == 1
    f = li.select(F.col("l_orderkey").alias("k"), F.when(~first, F.concat(F.lit("m"), F.col("l_linenumber").cast("string"))).alias("m"), F.when(first, 2 * F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("bigint").alias("v"))
    return A.dimension_rollup(f, ["k"], "m", "v")


@query("""WITH f AS (SELECT o_custkey AS k, o_orderstatus AS c, CAST(count(*) AS DOUBLE) AS v FROM orders GROUP BY 1, 2), w AS (SELECT k, max(v) FILTER (c = 'F') AS f, max(v) FILTER (c = 'O') AS o, max(v) FILTER (c = 'P') AS p FROM f GROUP BY 1)
SELECT k, f + o AS computed, p AS reported, abs(f + o - p) <= 0.15 * greatest(abs(p), 1) AS holds FROM w WHERE f IS NOT NULL AND o IS NOT NULL AND p IS NOT NULL""")
def identity_check(spark, sf_dir):
    f = load(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("c")).agg(F.count("*").cast("double").alias("v"))
    return A.identity(f, ["k"], "c", "v", ["F", "O"], [], "P")


@query("""SELECT c_custkey AS entity, CASE WHEN n = 1 THEN v END AS value, CASE WHEN n IS NULL THEN 'UNAVAILABLE' WHEN n > 1 THEN 'AMBIGUOUS' ELSE 'REPORTED' END AS status FROM customer
LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_orderkey) AS v FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def panel_left_join(spark, sf_dir):
    f = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("entity"), "o_orderkey")
    return A.panel(load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity")), "entity", f, "o_orderkey")


@query("""WITH a AS (SELECT o_orderkey AS k, o_orderstatus AS v FROM orders WHERE o_orderkey % 4 <> 0), b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 9 = 0 THEN 'X' ELSE o_orderstatus END AS v FROM orders WHERE o_orderkey % 3 <> 0)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'left_only' WHEN a.k IS NULL THEN 'right_only' WHEN a.v IS NOT DISTINCT FROM b.v THEN 'agree' ELSE 'differ' END AS status FROM a FULL JOIN b ON a.k = b.k""")
def fact_source_comparison(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("v"))
    b = o.where("k % 3 <> 0").withColumn("v", F.when(F.col("k") % 9 == 0, "X").otherwise(F.col("v")))
    return A.compare_sources(o.where("k % 4 <> 0"), b, ["k"], "v")


def _atoms(spark, sf_dir):
    """Part names as modifier sets, part types' first word as the head."""
    p = load(spark, sf_dir, "part")
    mods = F.array_sort(F.array_distinct(F.split(F.lower("p_type"), " ")))
    return p.select("p_partkey", F.concat(F.lit("size"), (F.col("p_size") % 5).cast("string")).alias("head"), F.when(F.col("p_partkey") % 3 == 0, F.slice(mods, 1, 1)).otherwise(mods).alias("mods"))


_ATOMS = """WITH m AS (SELECT p_partkey, 'size' || (p_size % 5) AS head, list_sort(list_distinct(string_split(lower(p_type), ' '))) AS mods FROM part),
a AS (SELECT p_partkey, head, CASE WHEN p_partkey % 3 = 0 THEN mods[1:1] ELSE mods END AS mods FROM m), u AS (SELECT DISTINCT head, mods FROM a)
"""


@query(f"{_ATOMS} SELECT head, array_to_string(mods, ',') AS mods FROM u x WHERE NOT EXISTS (SELECT 1 FROM u y WHERE y.head = x.head AND list_has_all(y.mods, x.mods) AND len(y.mods) > len(x.mods))")
def atom_subsumption(spark, sf_dir):
    return A.most_specific(_atoms(spark, sf_dir), "head", "mods").select("head", F.array_join("mods", ",").alias("mods"))


@query(f"{_ATOMS} SELECT p_partkey FROM a, (SELECT mods AS w FROM a ORDER BY len(mods), p_partkey LIMIT 1) WHERE list_has_all(mods, w)")
def modifier_containment(spark, sf_dir):
    a = _atoms(spark, sf_dir)
    asked = a.orderBy(F.size("mods"), "p_partkey").select(F.col("mods").alias("w")).limit(1)
    return a.crossJoin(F.broadcast(asked)).where(A.is_a(F.col("mods"), F.col("w"))).select("p_partkey")  # one row asked for


@query(f"{_ATOMS} SELECT p_partkey, min(p_partkey) OVER (PARTITION BY head, mods) AS class_id, count(*) OVER (PARTITION BY head, mods) - 1 AS peers FROM a")
def peer_exact_coordinate(spark, sf_dir):
    return A.peers(_atoms(spark, sf_dir), "p_partkey", "head", "mods")


@query(f"""{_ATOMS}, t AS (SELECT head AS h, mods AS w FROM a WHERE p_partkey = 7) SELECT p_partkey, CASE WHEN head <> h THEN 'unrelated' WHEN x + y = 0 THEN 'exact' WHEN x + y = 1 AND (x = 0 OR y = 0) THEN 'near' ELSE 'unrelated' END AS tier
FROM (SELECT *, len(list_filter(w, lambda q: NOT list_contains(mods, q))) AS x, len(list_filter(mods, lambda q: NOT list_contains(w, q))) AS y FROM a, t)""")
def equivalence_tiers(spark, sf_dir):
    a = _atoms(spark, sf_dir)
    target = a.where("p_partkey = 7").select(F.col("head").alias("h"), F.col("mods").alias("w"))
    return a.crossJoin(F.broadcast(target)).select("p_partkey", A.equivalence_tier(F.col("h"), F.col("w"), F.col("head"), F.col("mods")).alias("tier"))  # one target


@query("""WITH f AS (SELECT l_orderkey AS k, sum(l_extendedprice) AS i, sum(l_quantity) AS s, round(sum(l_extendedprice) / sum(l_quantity), CAST(l_orderkey % 3 AS INT)) + CASE WHEN l_orderkey % 4 = 0 THEN 0.7 ELSE 0 END AS e, l_orderkey % 3 AS d FROM lineitem GROUP BY l_orderkey)
SELECT k, round(i / s, 3) AS computed, round(e, 3) AS reported, abs(i / s - e) <= 0.5 * pow(10.0, -d) * (1 + 1e-9) AS holds FROM f""")
def eps_identity(spark, sf_dir):
    """The SQL adds doubles in the order of the rows (on one thread; on more its order is open), and so does this query."""
    li = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), F.col("l_extendedprice").alias("i"), F.col("l_quantity").alias("s"))
    one = A.sums_in_order(li, ["k"], ["file", "row"], ["i", "s"])
    d = (F.col("k") % 3).cast("int")
    printed = A.binary_round(F.col("i") / F.col("s"), d) + F.when(F.col("k") % 4 == 0, 0.7).otherwise(0.0)
    told = F.array(*[F.struct(F.lit(c).alias("concept"), v.cast("double").alias("value")) for c, v in (("Income", F.col("i")), ("Shares", F.col("s")), ("EPS", printed))])
    facts = one.select("k", d.alias("decimals"), F.inline(told))
    return A.eps_identity(facts, ["k"], "Income", "Shares", "EPS", "decimals").withColumns({c: A.binary_round(F.col(c), 3) for c in ("computed", "reported")})


@query("""WITH o AS (SELECT o_custkey AS k, year(o_orderdate) AS y, quarter(o_orderdate) AS q, CAST(round(o_totalprice) AS BIGINT) AS v, o_orderkey AS filed FROM orders),
l AS (SELECT k, y, q, arg_max(v, (filed, v)) AS v FROM o WHERE filed % 9 <> 0 GROUP BY ALL), a AS (SELECT k, y, arg_max(v * 4, (filed, v)) AS v FROM o GROUP BY ALL),
m AS (SELECT l.k, l.y, 10 - sum(q) AS q, max(a.v) - sum(l.v) AS v FROM l JOIN a ON a.k = l.k AND a.y = l.y GROUP BY l.k, l.y HAVING count(*) = 3),
s AS (SELECT k, y, q, v, 0 AS d FROM l UNION ALL SELECT k, y, q, v, 1 FROM m),
w AS (SELECT *, count(v) OVER x AS n, y * 4 + q - min(y * 4 + q) OVER x AS span, sum(v) OVER x AS t, sum(d) OVER x AS ds FROM s WINDOW x AS (PARTITION BY k ORDER BY y * 4 + q ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))
SELECT k, y AS year, CAST(q AS BIGINT) AS quarter, CASE WHEN n = 4 AND span = 3 THEN CAST(t AS BIGINT) END AS ttm, CASE WHEN n = 4 AND span = 3 THEN CAST(ds AS BIGINT) END AS derived FROM w""")
def ttm_stitched(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter"), F.round("o_totalprice").cast("bigint").alias("value"), F.col("o_orderkey").alias("filed"))
    return A.stitched_year(o.where("filed % 9 <> 0"), o.withColumn("value", F.col("value") * 4), ["k"]).withColumn("quarter", F.col("quarter").cast("bigint"))


@query("""SELECT event_id, CASE WHEN event_id % 2 = 1 THEN 'instant' WHEN d BETWEEN 75 AND 105 THEN 'quarter' WHEN d BETWEEN 160 AND 200 THEN 'half' WHEN d BETWEEN 250 AND 295 THEN 'nine_months' WHEN d BETWEEN 340 AND 380 THEN 'year' ELSE 'other' END AS period,
CASE event_id % 5 WHEN 0 THEN 'money' WHEN 1 THEN 'shares' WHEN 2 THEN 'money_per_share' WHEN 3 THEN 'pure' ELSE 'other' END AS unit_class, 'a=' || json_extract_string(props, '$.k') || ';b=' || event_type AS slice FROM (SELECT *, event_id % 400 + 1 AS d FROM events)""")
def fact_cube(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    units = F.element_at(F.array(*[F.lit(u) for u in ("iso4217:USD", "xbrli:shares", "usdPerShare", "pure", "utr:kWh")]), (F.col("event_id") % 5 + 1).cast("int"))
    end = F.lit("2024-01-01").cast("date")
    f = e.select("event_id", units.alias("unit"), F.when(F.col("event_id") % 2 == 0, F.date_sub(end, (F.col("event_id") % 400).cast("int"))).alias("start"), end.alias("end"), F.create_map(F.lit("b"), F.col("event_type"), F.lit("a"), F.get_json_object("props", "$.k")).alias("dims"))
    return A.normalized(f).select("event_id", "period", "unit_class", "slice")


@query("""WITH f AS (SELECT l_partkey AS k, l_extendedprice AS v, 0.5 * pow(10.0, -(-(l_linenumber % 4))) AS t FROM lineitem), r AS (SELECT k, v, t, v - t AS lo, v + t AS hi FROM f),
n AS (SELECT *, CASE WHEN lo > max(hi) OVER (PARTITION BY k ORDER BY lo, hi, v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS nw FROM r),
c AS (SELECT *, CAST(sum(nw) OVER (PARTITION BY k ORDER BY lo, hi, v ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cluster FROM n) SELECT k, cluster, arg_min(v, (t, v)) AS value, count(*) AS n FROM c GROUP BY 1, 2""")
def value_clusters(spark, sf_dir):
    f = load(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k"), F.col("l_extendedprice").alias("v"), (-(F.col("l_linenumber") % 4)).alias("d"))
    return A.value_clusters(f, ["k"], "v", "d")


@query("""WITH a AS (SELECT o_custkey AS k, year(o_orderdate) AS y, max(CAST(o_orderdate AS DATE)) AS e, count(*) AS n FROM orders GROUP BY 1, 2), b AS (SELECT k, e, CAST(e - CASE WHEN n % 3 = 0 THEN 120 ELSE 364 END AS DATE) AS s FROM a),
l AS (SELECT *, date_diff('day', CAST(lag(e) OVER (PARTITION BY k ORDER BY e, s) + INTERVAL 12 MONTH AS DATE), e) AS late FROM b),
t AS (SELECT *, CASE WHEN date_diff('day', s, e) + 1 NOT BETWEEN 340 AND 381 THEN 'transition' WHEN late > 350 THEN 'gap' WHEN abs(late) > 15 THEN 'year_end' END AS break FROM l)
SELECT k, CAST(e AS VARCHAR) AS e, break, CAST(sum(CASE WHEN break IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY e, s ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment FROM t""")
def assembled_series(spark, sf_dir):
    a = load(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k"), F.year("o_orderdate").alias("y")).agg(F.max(F.col("o_orderdate").cast("date")).alias("e"), F.count("*").alias("n"))
    a = a.withColumn("s", F.date_sub("e", F.when(F.col("n") % 3 == 0, 120).otherwise(364)))
    return A.assembled_series(a, "k", "s", "e").select("k", F.col("e").cast("string").alias("e"), "break", "segment")


@query(f"""{_ATOMS}, d AS (SELECT DISTINCT 'c' || p_partkey AS name, head, mods FROM a), t AS (SELECT head AS h, mods AS w FROM d WHERE name = 'c7'),
x AS (SELECT name, len(list_filter(w, lambda q: NOT list_contains(mods, q))) AS p, len(list_filter(mods, lambda q: NOT list_contains(w, q))) AS q FROM d, t WHERE name <> 'c7' AND head = h)
SELECT name, CASE WHEN p + q = 0 THEN 'exact' ELSE 'near' END AS tier, CAST(row_number() OVER (ORDER BY p + q, name) AS INT) AS rank FROM x WHERE p + q = 0 OR (p + q = 1 AND (p = 0 OR q = 0))""")
def ranked_equivalents(spark, sf_dir):
    a = _atoms(spark, sf_dir).withColumn("name", F.concat(F.lit("c"), "p_partkey"))
    return A.rank_equivalents(a, "name", "head", "mods", "c7")
