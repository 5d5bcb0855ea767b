"""Set algebra, intake, differences, changes and validators over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.operators import cohorts as C
from corvid.operators import relational as R
from corvid.registry import load, query


def _sides(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    c = load(spark, sf_dir, "customer")
    side = lambda low, high, tag: C.ingest(c.where(f"c_nationkey between {low} and {high}").select("c_custkey", F.concat(F.lit(tag), "c_name").alias("c_name"), F.col("c_custkey").alias("o")), "c_custkey", "c_name", "o")
    return {"first": side(0, 14, "L "), "second": side(8, 20, "R "), "third": side(12, 24, "T ")}


_SIDES = """
WITH first AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS key, 'L ' || c_name AS name FROM customer WHERE c_nationkey BETWEEN 0 AND 14),
second AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS key, 'R ' || c_name AS name FROM customer WHERE c_nationkey BETWEEN 8 AND 20),
third AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS key, 'T ' || c_name AS name FROM customer WHERE c_nationkey BETWEEN 12 AND 24),
u AS (SELECT * FROM first UNION ALL SELECT * FROM second WHERE key NOT IN (SELECT key FROM first))
"""
_NUMBER = "SELECT CAST(row_number() OVER (ORDER BY key) - 1 AS BIGINT) AS ordinal, key, name FROM"


@query(f"{_SIDES} {_NUMBER} u")
def setop_union(spark, sf_dir):
    return C.evaluate("first + second", _sides(spark, sf_dir))


@query(f"{_SIDES} {_NUMBER} first WHERE key IN (SELECT key FROM second)")
def setop_intersect(spark, sf_dir):
    return C.evaluate("first & second", _sides(spark, sf_dir))


@query(f"{_SIDES} {_NUMBER} first WHERE key NOT IN (SELECT key FROM second)")
def setop_difference(spark, sf_dir):
    return C.evaluate("first - second", _sides(spark, sf_dir))


@query(f"{_SIDES} {_NUMBER} u WHERE key NOT IN (SELECT key FROM third)")
def setop_expression(spark, sf_dir):
    return C.evaluate("(first + second) - third", _sides(spark, sf_dir))


@query(f"""{_SIDES} SELECT (SELECT count(*) FROM first) AS left_total, (SELECT count(*) FROM second) AS right_total,
(SELECT count(*) FROM first WHERE key IN (SELECT key FROM second)) AS both, (SELECT count(*) FROM first WHERE key NOT IN (SELECT key FROM second)) AS left_only,
(SELECT count(*) FROM second WHERE key NOT IN (SELECT key FROM first)) AS right_only, (SELECT count(*) FROM u) AS either""")
def cohort_diff_counts(spark, sf_dir):
    s = _sides(spark, sf_dir)
    return C.diff_counts(s["first"], s["second"])


@query(f"""{_SIDES} SELECT * FROM (SELECT 'left' AS side, * FROM first WHERE key NOT IN (SELECT key FROM second) ORDER BY key LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'right' AS side, * FROM second WHERE key NOT IN (SELECT key FROM first) ORDER BY key LIMIT 5)""")
def cohort_diff_sample(spark, sf_dir):
    s = _sides(spark, sf_dir)
    return C.diff_sample(s["first"], s["second"])


@query("""SELECT CAST(row_number() OVER (ORDER BY k) - 1 AS BIGINT) AS ordinal, lpad(CAST(k AS VARCHAR), 10, '0') AS key, name FROM (
SELECT k, coalesce(arg_min(name, event_id) FILTER (name <> ''), '') AS name FROM (
SELECT user_id AS k, event_id, CASE WHEN event_type = 'error' THEN '' ELSE trim(event_type || ' ') END AS name FROM events) GROUP BY k)""")
def cohort_ingest(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_type") == "error", "").otherwise(F.concat("event_type", F.lit(" "))).alias("label"))
    return C.ingest(e, "user_id", "label", "event_id")


@query("""SELECT count(*) AS rows, count(k) AS valid, count(*) - count(k) AS invalid, count(k) - count(DISTINCT k) AS duplicates
FROM (SELECT TRY_CAST(CASE WHEN event_type = 'error' THEN 'x' || user_id ELSE CAST(user_id AS VARCHAR) END AS BIGINT) AS k FROM events)""")
def cohort_intake_quality(spark, sf_dir):
    e = load(spark, sf_dir, "events").select(F.when(F.col("event_type") == "error", F.concat(F.lit("x"), "user_id")).otherwise(F.col("user_id").cast("string")).alias("key"))
    return C.intake_quality(e, "key")


@query(f"{_SIDES} SELECT * FROM ({_NUMBER} first) WHERE lower(name) LIKE '%customer#00000001%' ORDER BY ordinal LIMIT 25 OFFSET 3")
def cohort_page(spark, sf_dir):
    return C.page(_sides(spark, sf_dir)["first"], name_part="Customer#00000001", offset=3)[1]


@query(f"""{_SIDES} SELECT * FROM (
SELECT 'first' AS cohort, * FROM ({_NUMBER} first) UNION ALL SELECT 'second', * FROM ({_NUMBER} second) UNION ALL SELECT 'third', * FROM ({_NUMBER} third)
) WHERE lower(name) LIKE '%#0000000%' ORDER BY cohort, ordinal LIMIT 25""")
def cohort_find_across(spark, sf_dir):
    return C.find_across(_sides(spark, sf_dir), "#0000000")


@query("""SELECT CAST(row_number() OVER (ORDER BY key) - 1 AS BIGINT) AS ordinal, key, name FROM (
SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS key, c_name AS name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders))""")
def delta_roster(spark, sf_dir):
    c = load(spark, sf_dir, "customer").select(C.padded(F.col("c_custkey")).alias("key"), F.col("c_name").alias("name"))
    o = load(spark, sf_dir, "orders").select(C.padded(F.col("o_custkey")).alias("key"))
    return C.numbered(R.new_rows(c, o, ["key"]))


# Latest, first and representative rows


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1")
def dedupe_latest(spark, sf_dir):
    return R.latest(load(spark, sf_dir, "orders"), ["o_custkey"], [F.desc_nulls_last("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT user_id, coalesce(arg_min(label, event_id) FILTER (label <> ''), '') AS label FROM (SELECT user_id, event_id, CASE WHEN value < 50 THEN '' ELSE event_type END AS label FROM events) GROUP BY user_id")
def dedupe_first_nonempty(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("value") < 50, "").otherwise(F.col("event_type")).alias("label"))
    return R.first_nonempty(e, "user_id", "label", "event_id")


@query("""SELECT o_custkey, arg_min(p, (o_orderdate, o_orderkey)) FILTER (p IS NOT NULL) AS p, arg_min(q, (o_orderdate, o_orderkey)) FILTER (q IS NOT NULL) AS q
FROM (SELECT *, nullif(o_orderpriority, '1-URGENT') AS p, CASE WHEN o_totalprice > 100000 THEN o_orderkey END AS q FROM orders) GROUP BY o_custkey""")
def representative_min_by(spark, sf_dir):
    o = load(spark, sf_dir, "orders").withColumns({"p": F.nullif("o_orderpriority", F.lit("1-URGENT")), "q": F.when(F.col("o_totalprice") > 100000, F.col("o_orderkey"))})
    return R.representative(o, "o_custkey", ["p", "q"], ["o_orderdate", "o_orderkey"])


@query("""SELECT o_orderkey, o_custkey, o_totalprice FROM (
SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY src DESC) AS rn FROM (
SELECT o_orderkey, o_custkey, o_totalprice, 0 AS src FROM orders WHERE o_orderkey % 3 <> 0
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice + 1, 1 FROM orders WHERE o_orderkey % 2 = 0)) WHERE rn = 1""")
def latest_over_base_and_delta(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    both = o.where("o_orderkey % 3 <> 0").withColumn("src", F.lit(0)).unionByName(o.where("o_orderkey % 2 = 0").withColumns({"o_totalprice": F.col("o_totalprice") + 1, "src": F.lit(1)}))
    return R.latest(both, ["o_orderkey"], [F.desc("src")]).drop("src")


# Changes and differences


def _line_parts(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("q"), F.max(F.col("l_shipdate").cast("date")).alias("d"))
    return li.where("d < '1997-01-01'").drop("d"), li.where("d >= '1996-01-01'").select("l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 2 == 0, F.col("q") + 1).otherwise(F.col("q")).alias("q"))


_LINES = """WITH li AS (SELECT l_orderkey, l_linenumber, max(l_quantity) AS q, max(CAST(l_shipdate AS DATE)) AS d FROM lineitem GROUP BY ALL),
base AS (SELECT l_orderkey, l_linenumber, q FROM li WHERE d < '1997-01-01'),
delta AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 2 = 0 THEN q + 1 ELSE q END AS q FROM li WHERE d >= '1996-01-01')
"""


@query(f"{_LINES} SELECT * FROM delta d WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.l_orderkey = d.l_orderkey AND b.l_linenumber = d.l_linenumber)")
def delta_new_rows(spark, sf_dir):
    base, delta = _line_parts(spark, sf_dir)
    return R.new_rows(delta, base, ["l_orderkey", "l_linenumber"])


@query(f"{_LINES} SELECT * FROM delta d WHERE EXISTS (SELECT 1 FROM base b WHERE b.l_orderkey = d.l_orderkey AND b.l_linenumber = d.l_linenumber)")
def delta_known_rows(spark, sf_dir):
    base, delta = _line_parts(spark, sf_dir)
    return R.known_rows(delta, base, ["l_orderkey", "l_linenumber"])


@query(f"""{_LINES} SELECT d.*, CASE WHEN b.l_orderkey IS NULL THEN 'added' ELSE 'changed' END AS change
FROM delta d LEFT JOIN base b ON b.l_orderkey = d.l_orderkey AND b.l_linenumber = d.l_linenumber WHERE b.l_orderkey IS NULL OR b.q IS DISTINCT FROM d.q""")
def delta_changed_rows(spark, sf_dir):
    base, delta = _line_parts(spark, sf_dir)
    return R.changed_rows(delta, base, ["l_orderkey", "l_linenumber"], ["q"])


_PLANS = """WITH a AS (SELECT o_custkey, o_orderkey, nullif(o_orderpriority, '5-LOW') AS p, o_orderstatus AS s FROM orders WHERE o_orderkey % 5 <> 0),
b AS (SELECT o_custkey, o_orderkey, nullif(o_orderpriority, '5-LOW') AS p, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 4 <> 0)
"""


@query(f"""{_PLANS} SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, coalesce(a.p, b.p) AS p,
CASE WHEN a.o_orderkey IS NULL THEN 'added' WHEN b.o_orderkey IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM a FULL JOIN b ON a.o_custkey = b.o_custkey AND a.o_orderkey = b.o_orderkey AND a.p IS NOT DISTINCT FROM b.p
WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.s IS DISTINCT FROM b.s""")
def plan_diff_full_outer(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"), F.col("o_orderstatus").alias("s"))
    b = o.where("o_orderkey % 4 <> 0").withColumn("s", F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("s")))
    return R.keyed_diff(o.where("o_orderkey % 5 <> 0"), b, ["o_custkey", "o_orderkey", "p"], ["s"])


@query("""WITH a AS (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal > 5000), b AS (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal < 0)
SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT *, 'right' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def except_both_ways(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    return R.symmetric_difference(c.where("c_acctbal > 5000").select("c_nationkey", "c_mktsegment"), c.where("c_acctbal < 0").select("c_nationkey", "c_mktsegment"))


@query("""SELECT count(*) FILTER (o_orderkey IS NULL) AS orphans, count(*) AS n FROM lineitem LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderkey % 10 <> 0) ON l_orderkey = o_orderkey""")
def coverage_orphans(spark, sf_dir):
    o = load(spark, sf_dir, "orders").where("o_orderkey % 10 <> 0")
    li = load(spark, sf_dir, "lineitem")
    lost = R.uncovered(li, o, {"l_orderkey": "o_orderkey"}).agg(F.count("*").alias("orphans"))
    return lost.crossJoin(li.agg(F.count("*").alias("n")))  # one row each


# Validators


@query("SELECT l_orderkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dup_keys(spark, sf_dir):
    return R.duplicate_keys(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_suppkey"])


@query("SELECT count(*) AS null_keys FROM (SELECT nullif(o_orderpriority, '5-LOW') AS p FROM orders) WHERE p IS NULL")
def null_keys(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"))
    return R.null_keys(o, ["o_orderkey", "p"]).agg(F.count("*").alias("null_keys"))


@query("""SELECT event_id, user_id, d FROM (SELECT event_id, user_id, CAST(ts AS DATE) AS d, lag(CAST(ts AS DATE)) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM events) WHERE b >= d""")
def sorted_violations(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("date").alias("d"))
    return R.order_violations(e, "event_id", ["d"], ["user_id"])


@query("SELECT c_nationkey, min(c_mktsegment) AS low, max(c_mktsegment) AS high, count(DISTINCT c_mktsegment) AS n FROM customer GROUP BY 1 HAVING count(DISTINCT c_mktsegment) > 1")
def conflict_groups(spark, sf_dir):
    return R.conflicts(load(spark, sf_dir, "customer"), "c_nationkey", "c_mktsegment")


@query("SELECT CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS BIGINT) AS ordinal, o_orderkey FROM orders")
def dense_ordinal(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey")
    return R.with_ordinal(o, [F.col("o_orderdate"), F.col("o_orderkey")], F.trunc("o_orderdate", "month")).select("ordinal", "o_orderkey")


@query("""SELECT o_custkey, count(*) AS n, sha256(string_agg(o_orderstatus, ',' ORDER BY o_orderkey)) AS fingerprint FROM orders GROUP BY 1""")
def ordered_fingerprint(spark, sf_dir):
    return R.ordered_fingerprint(load(spark, sf_dir, "orders"), "o_custkey", "o_orderstatus", "o_orderkey")


@query("""SELECT o_orderstatus, o_orderpriority, CAST(grouping_id(o_orderstatus, o_orderpriority) AS INT) AS level, count(*) AS n, count(*) FILTER (o_totalprice > 100000) AS large FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""")
def census(spark, sf_dir):
    return R.census(load(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"], {"large": F.col("o_totalprice") > 100000})


@query("""SELECT o_orderkey, o_orderpriority, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d FROM orders WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM') AND CAST(CAST(o_orderdate AS DATE) AS VARCHAR) LIKE '1996-0%'""")
def filings_filter(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", F.col("o_orderdate").cast("date").cast("string").alias("d"))
    return R.filtered(o, "o_orderpriority", "d", ["1-URGENT", "3-MEDIUM"], "1996-0")
