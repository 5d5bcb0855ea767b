"""Merge-on-read, compaction, pruning, graphs, ledgers over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.operators import graph as G
from corvid.operators import relational as R
from corvid.operators import versioning as V
from corvid.registry import load, query
from corvid.scratch import scratch_path


def _parts(spark, sf_dir):
    """Three ranked parts of orders: a base, a correction, a late one."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    return [o.where("o_orderkey % 4 <> 3"), o.where("o_orderkey % 5 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1), o.where("o_orderkey % 7 = 0 or o_orderkey % 4 = 3").withColumn("o_orderstatus", F.lit("Z"))]


_PARTS = """WITH stacked AS (
SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, 0 AS _lineage_ord FROM orders WHERE o_orderkey % 4 <> 3
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice + 1, o_orderstatus, 1 FROM orders WHERE o_orderkey % 5 = 0
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, 'Z', 2 FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 4 = 3)
"""


@query(f"{_PARTS} SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY _lineage_ord DESC) AS rn FROM stacked) WHERE rn = 1")
def merge_upsert(spark, sf_dir):
    return V.active(V.RelationSpec("orders", ("o_orderkey",)), _parts(spark, sf_dir))


@query(f"{_PARTS} SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY _lineage_ord) AS rn FROM stacked) WHERE rn = 1")
def merge_append(spark, sf_dir):
    return V.active(V.RelationSpec("orders", ("o_orderkey",), "append"), _parts(spark, sf_dir))


@query(f"{_PARTS} SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_totalprice DESC NULLS LAST, _lineage_ord DESC) AS rn FROM stacked) WHERE rn = 1")
def merge_append_tiebreak(spark, sf_dir):
    return V.active(V.RelationSpec("orders", ("o_orderkey",), "append", "o_totalprice", True), _parts(spark, sf_dir))


def _children(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return [li.where("l_orderkey % 4 <> 3"), li.where("l_orderkey % 5 = 0").withColumn("l_quantity", F.col("l_quantity") + 100), li.where("l_orderkey % 7 = 0 or l_orderkey % 4 = 3").withColumn("l_quantity", F.col("l_quantity") + 200)]


@query("""WITH p AS (SELECT o_orderkey, max(o) AS o FROM (
SELECT o_orderkey, 0 AS o FROM orders WHERE o_orderkey % 4 <> 3 UNION ALL SELECT o_orderkey, 1 FROM orders WHERE o_orderkey % 5 = 0
UNION ALL SELECT o_orderkey, 2 FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 4 = 3) GROUP BY 1),
c AS (SELECT l_orderkey, l_partkey, l_quantity, 0 AS o FROM lineitem WHERE l_orderkey % 4 <> 3
UNION ALL SELECT l_orderkey, l_partkey, l_quantity + 100, 1 FROM lineitem WHERE l_orderkey % 5 = 0
UNION ALL SELECT l_orderkey, l_partkey, l_quantity + 200, 2 FROM lineitem WHERE l_orderkey % 7 = 0 OR l_orderkey % 4 = 3)
SELECT l_orderkey, l_partkey, l_quantity, c.o AS _lineage_ord FROM c JOIN p ON o_orderkey = l_orderkey AND p.o = c.o""")
def merge_scoped_mask(spark, sf_dir):
    specs = [V.RelationSpec("lines", ("l_orderkey", "l_partkey"), "scoped_mask", parent="orders", parent_key=("l_orderkey",)), V.RelationSpec("orders", ("l_orderkey",))]
    parents = [p.withColumnRenamed("o_orderkey", "l_orderkey") for p in _parts(spark, sf_dir)]
    return V.resolve(specs, {"lines": _children(spark, sf_dir), "orders": parents})["lines"].select("l_orderkey", "l_partkey", "l_quantity", V.ORD)


@query("""WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
SELECT o_custkey, CAST(floor(coalesce(sum(n) OVER (ORDER BY o_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 500) AS BIGINT) AS part FROM c""")
def compaction_parts(spark, sf_dir):
    return V.part_numbers(load(spark, sf_dir, "orders"), "o_custkey", 500, F.floor(F.col("o_custkey") / 1000))


@query("SELECT true AS same, count(*) AS n FROM orders")
def compaction_parity(spark, sf_dir):
    """The fingerprint of orders as they lie, and of the same rows dealt out and sorted anew, compared."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    a = V.fingerprint(o, o.columns)
    b = V.fingerprint(o.repartition("o_custkey").sortWithinPartitions("o_orderkey"), o.columns)
    return a.crossJoin(b.toDF("n2", "a2", "b2")).select(((F.col("n") == F.col("n2")) & (F.col("a") == F.col("a2")) & (F.col("b") == F.col("b2"))).alias("same"), "n")  # one row each


@query("SELECT l_linenumber AS part, min(l_orderkey) AS low, max(l_orderkey) AS high, count(*) AS rows FROM lineitem GROUP BY 1")
def key_bounds(spark, sf_dir):
    return V.key_bounds(load(spark, sf_dir, "lineitem").withColumnRenamed("l_linenumber", "part"), "l_orderkey", "part")


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem WHERE l_orderkey BETWEEN 100 AND 120")
def pruned_range_lookup(spark, sf_dir):
    """Orders' lines published as snapshots by key range, and a range looked up in the parts that its keys meet."""
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    store, node = V.SnapshotStore(spark, scratch_path(spark, "snapshots")), None
    for low, high in ((None, 90), (90, 110), (110, 1000), (1000, None)):
        inside = (F.col("l_orderkey") >= low if low else F.lit(True)) & (F.col("l_orderkey") < high if high else F.lit(True))
        node = store.publish({"lines": li.where(inside)}, {"lines": "l_orderkey"}, parent=node)
    parts = store.parts("lines", node, 100, 120)
    if len(parts) != 2:
        raise AssertionError(f"{len(parts)} parts")
    return R.stacked_by_name(*parts).where("l_orderkey between 100 and 120")


@query("""SELECT user_id, event_type, min(event_id) AS event_id FROM events e WHERE event_id > 500
AND NOT EXISTS (SELECT 1 FROM events l WHERE l.event_id <= 500 AND l.user_id = e.user_id AND l.event_type = e.event_type) GROUP BY 1, 2""")
def ledger_append_unseen(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    new = e.where("event_id > 500").groupBy("user_id", "event_type").agg(F.min("event_id").alias("event_id"))
    return V.append_unseen(e.where("event_id <= 500"), new, ["user_id", "event_type"])


@query("""SELECT user_id, arg_min(event_type, event_id) AS event_type, min(event_id) AS event_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS sources FROM events GROUP BY user_id""")
def events_dedupe_multi_source(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    return V.dedupe_events(e, ["user_id"], "event_id", "event_type")


@query("SELECT event_type, count(*) AS n, CAST(max(ts) AS VARCHAR)[:19] AS high FROM events GROUP BY 1")
def ledger_stats(spark, sf_dir):
    return V.ledger_stats(load(spark, sf_dir, "events"), "event_type", "ts").withColumn("high", F.date_format("high", "yyyy-MM-dd HH:mm:ss"))


@query("""WITH mark AS (SELECT max(ts) AS m FROM events WHERE event_id <= 600) SELECT event_id, user_id FROM events, mark WHERE event_id > 400 AND ts > m""")
def high_water_mark(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    return V.after_mark(e.where("event_id <= 600"), e.where("event_id > 400"), "ts").select("event_id", "user_id")


@query("""SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'""")
def late_reconcile(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey")
    seen = load(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return R.new_rows(o, seen, ["o_orderkey"]).distinct()


@query("""WITH f AS (SELECT c_custkey AS k, string_agg(o_orderstatus, ',' ORDER BY o_orderkey) AS f FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1),
p AS (SELECT o_custkey AS k, string_agg(o_orderstatus, ',' ORDER BY o_orderkey) AS f FROM orders WHERE o_orderkey % 50 <> 0 GROUP BY 1)
SELECT coalesce(f.k, p.k) AS k, CASE WHEN p.k IS NULL THEN 'new' WHEN f.k IS NULL THEN 'removed' WHEN p.f = f.f THEN 'carried' ELSE 'changed' END AS state FROM f FULL JOIN p ON f.k = p.k""")
def carried_rows(spark, sf_dir):
    """What a refresh carries over: keys whose ordered fingerprint didn't change."""
    o = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), "o_orderkey", "o_orderstatus")
    now = o.join(load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), "k", "left_semi")
    return V.carried(now, o.where("o_orderkey % 50 <> 0"), "k", ["o_orderkey"], "o_orderstatus")


# Graphs

_NODES = """nodes AS (SELECT 'n' || n_nationkey AS id, 'r' || n_regionkey AS parent FROM nation UNION ALL SELECT 'r' || r_regionkey, 'world' FROM region UNION ALL SELECT 'world', NULL)"""


def _nodes(spark, sf_dir):
    n = load(spark, sf_dir, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.concat(F.lit("r"), "n_regionkey").alias("parent"))
    r = load(spark, sf_dir, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.lit("world").alias("parent"))
    return n.unionByName(r).unionByName(spark.sql("select 'world' as id, cast(null as string) as parent"))


@query(f"""WITH RECURSIVE {_NODES}, w(id, depth) AS (SELECT id, 0 FROM nodes WHERE id = 'n7' UNION ALL SELECT n.parent, depth + 1 FROM w JOIN nodes n ON n.id = w.id WHERE n.parent IS NOT NULL)
SELECT id, max(depth) AS depth FROM w GROUP BY id""")
def lineage_walk(spark, sf_dir):
    return G.ancestors(_nodes(spark, sf_dir), "n7")


@query(f"""WITH RECURSIVE {_NODES}, e AS (SELECT id AS a, parent AS b FROM nodes WHERE parent IS NOT NULL),
c(a, b) AS (SELECT a, b FROM e UNION SELECT c.a, e.b FROM c JOIN e ON e.a = c.b) SELECT DISTINCT a, b FROM c""")
def reachability(spark, sf_dir):
    return G.closure(_nodes(spark, sf_dir).where("parent is not null").select(F.col("id").alias("a"), F.col("parent").alias("b")))


@query("""WITH RECURSIVE e AS (SELECT DISTINCT o_custkey % 40 AS a, (o_custkey * 7 + 3) % 40 AS b FROM orders WHERE o_custkey % 40 <> (o_custkey * 7 + 3) % 40),
c(a, b) AS (SELECT a, b FROM e UNION SELECT c.a, e.b FROM c JOIN e ON e.a = c.b) SELECT DISTINCT a AS node FROM c WHERE a = b""")
def cycle_audit(spark, sf_dir):
    e = load(spark, sf_dir, "orders").select((F.col("o_custkey") % 40).alias("a"), ((F.col("o_custkey") * 7 + 3) % 40).alias("b")).where("a <> b").distinct()
    return G.on_cycles(e)


@query("""WITH RECURSIVE e AS (SELECT DISTINCT l_suppkey % 30 AS a, l_suppkey % 30 + 1 + l_partkey % 3 AS b FROM lineitem),
c(a, b) AS (SELECT a, b FROM e UNION SELECT c.a, e.b FROM c JOIN e ON e.a = c.b),
s(x) AS (VALUES (2), (9), (17), (31)) SELECT p.x AS above, q.x AS below FROM s p, s q, (SELECT DISTINCT a, b FROM c) c WHERE c.a = p.x AND c.b = q.x""")
def antichain_pairs(spark, sf_dir):
    """Selected nodes of which one reaches the other: a sum over both counts something twice."""
    e = load(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 30).alias("a"), (F.col("l_suppkey") % 30 + 1 + F.col("l_partkey") % 3).alias("b")).distinct()
    return G.double_counted(e, spark.createDataFrame([(2,), (9,), (17,), (31,)], "x long"))


@query("""SELECT id AS orphan FROM (SELECT 'p' || p_partkey AS id, 'p' || (p_partkey // 10) AS parent FROM part) WHERE parent NOT IN (SELECT 'p' || p_partkey FROM part)""")
def orphan_parents(spark, sf_dir):
    p = load(spark, sf_dir, "part").select(F.concat(F.lit("p"), "p_partkey").alias("id"), F.concat(F.lit("p"), F.expr("p_partkey div 10")).alias("parent"))
    return G.orphans(p).select(F.col("id").alias("orphan"))
