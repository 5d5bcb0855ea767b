"""Questions over facts, selection in full, lookups and stream sinks over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.operators import relational as R
from corvid.operators import selection as L
from corvid.operators import statements as Q
from corvid.registry import load, query
from corvid.scratch import scratch_path
from corvid.streaming import ledger as T


def _facts(spark, sf_dir):
    """Order lines as facts: the order is the filing, the return flag and status a concept, the ship mode a member."""
    li = load(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("k"), F.concat("l_returnflag", "l_linestatus").alias("concept")).agg(F.sum("l_quantity").alias("value"))


_FACTS = "WITH f AS MATERIALIZED (SELECT l_orderkey AS k, l_returnflag || l_linestatus AS concept, sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2)"


@query("""WITH f AS (SELECT o_custkey AS e, o_orderstatus AS c, o_orderkey % 3 AS x, count(*) AS n, max(round(o_totalprice)) - min(round(o_totalprice)) <= 1 AS a, max(round(o_totalprice)) AS v FROM orders GROUP BY 1, 2, 3),
p AS (SELECT * FROM f WHERE c IN ('P', 'F')), b AS (SELECT e, min(CASE c WHEN 'P' THEN 0 ELSE 1 END) AS r FROM p GROUP BY 1), o AS (SELECT p.e, c, count(*) AS n, bool_and(a) AS a, max(v) AS v FROM p JOIN b ON b.e = p.e AND r = CASE c WHEN 'P' THEN 0 ELSE 1 END GROUP BY 1, 2)
SELECT c_custkey AS e, c AS concept, CASE WHEN a AND n = 1 THEN v END AS value, CASE WHEN n IS NULL THEN 'UNAVAILABLE' WHEN NOT a THEN 'CONFLICT' WHEN n > 1 THEN 'AMBIGUOUS' ELSE 'REPORTED' END AS status FROM customer LEFT JOIN o ON o.e = c_custkey""")
def term_status(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    f = o.select(F.col("o_custkey").alias("e"), F.col("o_orderstatus").alias("concept"), F.round("o_totalprice").alias("value"), F.lit(0).alias("decimals"), F.lit(None).cast("date").alias("start"), F.lit(None).cast("date").alias("end"), F.create_map(F.lit("x"), (F.col("o_orderkey") % 3).cast("string")).alias("dims"))
    return Q.term_status(f, load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("e")), "e", ["P", "F"])


@query("""SELECT event_id FROM events WHERE (event_type LIKE 'c%' OR event_type LIKE 'p%') AND event_type LIKE '%i%' AND json_extract_string(props, '$.k') = '7'""")
def fact_query(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("concept"), F.col("value"), F.create_map(F.lit("k"), F.get_json_object("props", "$.k")).alias("dims"))
    return Q.FactQuery(e).where(F.col("concept").rlike("^[cp]")).concept("*i*").member("k", "7").frame().select("event_id")


@query(f"{_FACTS} SELECT k, CASE WHEN count(*) = 2 THEN sum(CASE concept WHEN 'RF' THEN value ELSE -value END) END AS value, CASE WHEN count(*) = 2 THEN 0 ELSE 1 END AS missing FROM f WHERE concept IN ('RF', 'AF') GROUP BY 1")
def operand_chain(spark, sf_dir):
    return Q.chain(_facts(spark, sf_dir), ["k"], [(1, "RF"), (-1, "AF")]).select("k", "value", F.size("missing").alias("missing"))


_ARCS = [("AF", "RF", 1.0), ("AF", "NF", 1.0), ("NO", "NF", 1.0)]


@query(f"""{_FACTS}, a(parent, child, weight) AS (VALUES ('AF', 'RF', 1.0), ('AF', 'NF', 1.0), ('NO', 'NF', 1.0)), c AS (SELECT k, parent, sum(weight * value) AS computed, count(*) AS children FROM f JOIN a ON child = concept GROUP BY 1, 2),
n AS (SELECT parent, count(*) AS expected FROM a GROUP BY 1) SELECT c.k, parent, CAST(computed AS DOUBLE) AS computed, value AS reported, children, expected, abs(computed - value) <= 1 AS holds FROM c JOIN n USING (parent) LEFT JOIN f ON f.k = c.k AND f.concept = parent""")
def statement_rollup(spark, sf_dir):
    arcs = spark.createDataFrame(_ARCS, "parent string, child string, weight double")
    return Q.rollup(_facts(spark, sf_dir), arcs, ["k"])


@query(f"""{_FACTS}, c AS (SELECT k, count(*) AS n, sum(value) AS v FROM f WHERE concept IN ('RF', 'NF') GROUP BY 1), o AS (SELECT k, value AS v FROM f WHERE concept = 'NF')
SELECT k, concept, value, 'REPORTED' AS status FROM f UNION ALL SELECT k, 'AF', v, 'DERIVED' FROM c WHERE n = 2 AND k NOT IN (SELECT k FROM f WHERE concept = 'AF') UNION ALL SELECT k, 'NO', v, 'DERIVED' FROM o WHERE k NOT IN (SELECT k FROM f WHERE concept = 'NO')""")
def derived_totals(spark, sf_dir):
    arcs = spark.createDataFrame(_ARCS, "parent string, child string, weight double")
    return Q.derive_totals(_facts(spark, sf_dir), arcs, ["k"])


@query(f"""{_FACTS}, w AS (SELECT k, max(value) FILTER (concept = 'AF') AS a, max(value) FILTER (concept = 'RF') AS r, max(value) FILTER (concept = 'NF') AS n, max(value) FILTER (concept = 'NO') AS o FROM f GROUP BY 1),
g AS (SELECT k, 'AF' AS parent, 'RF' AS child, r + n - a AS gap, r AS v FROM w UNION ALL SELECT k, 'AF', 'NF', r + n - a, n FROM w UNION ALL SELECT k, 'NO', 'NF', n - o, n FROM w)
SELECT k, parent, child, CAST(gap AS DOUBLE) AS gap, CASE WHEN abs(2 * v - gap) <= 1 THEN 'sign' WHEN abs(v * (1 - 1e-6) - gap) <= 1 OR abs(v * (1 - 1e-3) - gap) <= 1 OR abs(v * (1 - 1e3) - gap) <= 1 OR abs(v * (1 - 1e6) - gap) <= 1 THEN 'scale' ELSE 'none' END AS hypothesis FROM g WHERE abs(gap) > 1""")
def quarantined_facts(spark, sf_dir):
    arcs = spark.createDataFrame(_ARCS, "parent string, child string, weight double")
    return Q.quarantine(_facts(spark, sf_dir), arcs, ["k"])


@query("""WITH b AS (SELECT c_nationkey AS k, c_mktsegment AS member, count(*) AS value FROM customer GROUP BY 1, 2) SELECT k, 'segment' AS axis, member, value, round(value / sum(value) OVER (PARTITION BY k), 9) AS share FROM b""")
def axis_breakdown(spark, sf_dir):
    f = load(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"), F.lit("Customers").alias("concept"), F.lit(1).alias("value"), F.create_map(F.lit("segment"), F.col("c_mktsegment")).alias("dims"))
    return Q.breakdown(f, ["k"], "Customers").withColumn("share", F.round("share", 9))


@query("""WITH q AS (SELECT o_custkey AS k, year(o_orderdate) * 4 + quarter(o_orderdate) AS p, CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS v, count(*) AS n FROM orders GROUP BY 1, 2),
w AS (SELECT k, p, count(*) OVER x AS c, p - min(p) OVER x AS span, sum(v) OVER x AS v, sum(n) OVER x AS n FROM q WINDOW x AS (PARTITION BY k ORDER BY p ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))
SELECT k, p, CASE WHEN c = 4 AND span = 3 THEN round(CAST(v AS DOUBLE) / CAST(n AS DOUBLE), 6) END AS ratio FROM w""")
def trailing_ratio(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    q = o.groupBy(F.col("o_custkey").alias("k"), (F.year("o_orderdate") * 4 + F.quarter("o_orderdate")).alias("p")).agg(F.sum(F.round("o_totalprice").cast("bigint")).alias("v"), F.count("*").alias("n"))
    return Q.trailing_ratio(q, ["k"], "v", "n", "p").withColumn("ratio", F.round("ratio", 6))


@query("""WITH c AS (SELECT DISTINCT p_type AS concept, string_split(lower(p_type), ' ') AS w FROM part) SELECT concept, CASE WHEN lower(concept) = 'steel' THEN 0 WHEN lower(concept) LIKE 'steel%' THEN 1 WHEN list_contains(w, 'steel') THEN 2 ELSE 3 END AS rank, 1 AS common FROM c WHERE list_contains(w, 'steel') ORDER BY rank, common DESC, concept LIMIT 20""")
def concept_search(spark, sf_dir):
    return Q.search_concepts(load(spark, sf_dir, "part").select(F.col("p_type").alias("concept")), "steel")


@query("""SELECT k AS name, min(c_custkey) AS cik FROM (VALUES ('BUILDING'), ('MACHINERY'), ('NONE')) t(k) LEFT JOIN customer ON c_mktsegment = k GROUP BY 1""")
def ticker_lookup(spark, sf_dir):
    known = load(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("name")).agg(F.min("c_custkey").alias("cik"))
    return R.ordered_lookup(known, "name", ["BUILDING", "MACHINERY", "NONE"]).drop("pos")


@query("""SELECT o_custkey, CAST(rn - 1 AS BIGINT) AS position, CAST((rn - 1) // 100 AS BIGINT) AS part, total FROM (SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) AS rn, count(*) OVER () AS total FROM (SELECT DISTINCT o_custkey FROM orders)) WHERE o_custkey IN (7, 100, 1000)""")
def sorted_index_position(spark, sf_dir):
    """A key's place in a sorted index cut into parts of 100."""
    return R.index_positions(load(spark, sf_dir, "orders"), "o_custkey", [7, 100, 1000], 100)


@query("""SELECT a.l_orderkey, a.l_suppkey AS filer, b.l_suppkey AS cofiler FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) a LEFT JOIN (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey <> b.l_suppkey""")
def cofilers(spark, sf_dir):
    return R.partners(load(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey", "cofiler").withColumnRenamed("l_suppkey", "filer")


@query("SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND strftime(o_orderdate, '%Y') = '1996' GROUP BY 1")
def filtered_latest(spark, sf_dir):
    o = load(spark, sf_dir, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (F.year("o_orderdate") == 1996))
    return R.last_of(o, "o_custkey", "o_orderkey", ["o_orderdate", "o_orderkey"])


@query()
def stratified_selection(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("cell"), "o_orderpriority")
    return L.stratified(o, "o_orderkey", "cell", "o_orderpriority", 100, {"1-URGENT": 10}, 0.4, "s9", 10, [1, 2])


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2")
def ledger_stream(spark, sf_dir):
    """Events streamed into a ledger that appends unseen (user, type) pairs."""
    base = scratch_path(spark, "ledger")
    kind = load(spark, sf_dir, "events").schema
    events = spark.readStream.schema(kind).parquet(f"{sf_dir}/events.parquet*").select("user_id", "event_type", "event_id")
    T.feed_ledger(events, f"{base}/out", ["user_id", "event_type"], f"{base}/cp", order="event_id").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("user_id", "event_type", "event_id")


@query("SELECT user_id, count(*) AS sessions FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events) WHERE b IS NULL OR ts - b > INTERVAL 12 HOUR GROUP BY 1")
def gap_islands(spark, sf_dir):
    return R.sessions(load(spark, sf_dir, "events"), "user_id", "ts", ["event_id"], "12 hours")


@query(f"""{_FACTS}, p AS (SELECT k, max(value) FILTER (concept = 'RF') AS rf, max(value) FILTER (concept = 'AF') AS af, max(value) FILTER (concept = 'NF') AS nf, max(value) FILTER (concept = 'NO') AS no FROM f GROUP BY 1),
c AS (SELECT k, rf + af AS r FROM p WHERE rf IS NOT NULL AND af IS NOT NULL), t AS (SELECT p.k, coalesce(p.no, 0) AS no, r FROM p JOIN c USING (k) WHERE p.no IS NOT NULL)
SELECT k, concept, value, 'REPORTED' AS status FROM f UNION ALL SELECT k, 'RETURNED', r, 'DERIVED' FROM c UNION ALL SELECT k, 'ALL', r + no, 'DERIVED' FROM t UNION ALL SELECT k, 'TWICE', 2 * (r + no), 'DERIVED' FROM t""")
def totals_over_hops(spark, sf_dir):
    arcs = spark.createDataFrame([("RETURNED", "RF", 1.0), ("RETURNED", "AF", 1.0), ("ALL", "RETURNED", 1.0), ("ALL", "NO", 1.0), ("TWICE", "ALL", 2.0)], "parent string, child string, weight double")
    return Q.evaluate_totals(_facts(spark, sf_dir), arcs, ["k"])
