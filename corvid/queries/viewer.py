"""Viewer, family and nested operators over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.operators import family as Y
from corvid.operators import nested as N
from corvid.operators import relational as R
from corvid.operators import viewer as V
from corvid.registry import load, query


@query("""SELECT 'o_orderkey' AS "column", count(*) AS rows, count(*) - count(o_orderkey) AS nulls, count(DISTINCT o_orderkey) AS "distinct" FROM orders
UNION ALL SELECT 'o_orderstatus', count(*), count(*) - count(o_orderstatus), count(DISTINCT o_orderstatus) FROM orders UNION ALL SELECT 'p', count(*), count(*) - count(p), count(DISTINCT p) FROM (SELECT nullif(o_orderpriority, '5-LOW') AS p FROM orders)""")
def page_stats(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"))
    return V.column_stats(o, exact=True)


@query()
def approx_distinct(spark, sf_dir):
    return V.column_stats(load(spark, sf_dir, "orders"))


@query("SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, value LIMIT 3")
def top_values(spark, sf_dir):
    return V.top_values(load(spark, sf_dir, "orders"), "o_orderpriority", 3)


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey >= 100 AND o_orderstatus <> 'F' ORDER BY o_custkey DESC NULLS LAST, o_orderkey LIMIT 26 OFFSET 50")
def paged_filter_sort(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return V.page(o, filters=[{"column": "o_custkey", "op": "ge", "value": 100}, {"column": "o_orderstatus", "op": "ne", "value": "F"}], sort="o_custkey", descending=True, unique=["o_orderkey"], offset=50, limit=25)


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE (CAST(c_custkey AS VARCHAR) ILIKE '%77%' OR c_name ILIKE '%77%' OR c_mktsegment ILIKE '%77%') AND NOT c_mktsegment ILIKE '%auto%' ORDER BY c_custkey LIMIT 101")
def search_like_any(spark, sf_dir):
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return V.page(c, filters=[{"column": "c_mktsegment", "op": "not_contains", "value": "auto"}], search="77", unique=["c_custkey"])


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def guarded_sql(spark, sf_dir):
    load(spark, sf_dir, "orders").createOrReplaceTempView("corvid_orders")
    return spark.sql(V.validate_snapshot_query("/* counts */ SELECT o_orderstatus, count(*) AS n FROM corvid_orders GROUP BY 1;"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT unnest(generate_series(1, 400, 7)))")
def keyed_semi_join(spark, sf_dir):
    return V.keys_in(load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", list(range(1, 401, 7)))


# Families

_FAMILY = r"""WITH n AS (SELECT p_partkey AS k, p_type || CASE WHEN p_partkey % 5 = 0 THEN ' Trust ' || p_partkey WHEN p_partkey % 5 = 1 THEN ' Corp' ELSE '' END AS name FROM part),
s AS (SELECT k, list_filter(string_split(trim(regexp_replace(lower(name), '[^\w]+', ' ', 'g')), ' '), lambda t: t <> '' AND t NOT IN ('inc','corp','corporation','co','company','llc','ltd','limited','lp','plc','sa','ag','nv','the') AND NOT regexp_matches(t, '\d')) AS w FROM n)
"""


def _names(spark, sf_dir):
    p = load(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("k"), F.concat("p_type", F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit(" Trust "), F.col("p_partkey").cast("string"))).when(F.col("p_partkey") % 5 == 1, " Corp").otherwise("")).alias("name"))


@query(f"{_FAMILY} SELECT k, array_to_string(w, ' ') AS stem FROM s")
def name_stems(spark, sf_dir):
    return _names(spark, sf_dir).select("k", Y.stem(F.col("name")).alias("stem"))


@query(f"""{_FAMILY}, e AS (SELECT DISTINCT array_to_string(w, ' ') AS stem, w FROM s WHERE NOT list_contains(w, 'trust')), c AS (SELECT k, w[1:list_position(w, 'trust') - 1] AS w FROM s WHERE list_contains(w, 'trust')),
a AS (SELECT k, array_to_string(w[1:i], ' ') AS p FROM c, unnest(generate_series(1, len(w))) t(i)), b AS (SELECT stem, array_to_string(w[1:i], ' ') AS p FROM e, unnest(generate_series(1, len(w))) t(i))
SELECT k, arg_min(stem, (-length(stem), stem)) AS sponsor FROM a JOIN b USING (p) GROUP BY k""")
def longest_prefix_match(spark, sf_dir):
    stems = _names(spark, sf_dir).select("k", Y.stem(F.col("name")).alias("s"))
    vehicles = stems.where(F.contains("s", F.lit("trust"))).select("k", Y.before_boundary(F.col("s"), ("trust",)).alias("c"))
    return Y.longest_prefix(vehicles, "k", "c", stems.where(~F.contains("s", F.lit("trust"))).select(F.col("s").alias("stem")).distinct(), "stem")


@query("""WITH n AS (SELECT CASE WHEN p_partkey % 3 = 0 THEN replace(lower(p_type), ' ', '') ELSE lower(p_type) END AS stem FROM part), c AS (SELECT stem, replace(stem, ' ', '') AS q, count(*) AS m FROM n GROUP BY 1)
SELECT stem, CASE WHEN length(q) >= 8 THEN first_value(stem) OVER (PARTITION BY q ORDER BY m DESC, stem) ELSE stem END AS canonical FROM c""")
def canonical_spelling(spark, sf_dir):
    p = load(spark, sf_dir, "part").select(F.when(F.col("p_partkey") % 3 == 0, F.replace(F.lower("p_type"), F.lit(" "), F.lit(""))).otherwise(F.lower("p_type")).alias("stem"))
    return Y.canonical_spelling(p, "stem")


@query(f"{_FAMILY} SELECT CASE WHEN list_contains(w, 'trust') THEN 'spv' WHEN len(w) = 0 THEN 'singleton' ELSE 'entity' END AS family_kind, count(*) AS n FROM s GROUP BY 1")
def family_assignment(spark, sf_dir):
    return Y.assign(_names(spark, sf_dir), "k", "name").groupBy("family_kind").agg(F.count("*").alias("n"))


# Nested shapes


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract(spark, sf_dir):
    return load(spark, sf_dir, "events").select("event_id", N.json_value("props", "$.k", "bigint").alias("k"))


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def nested_unnest(spark, sf_dir):
    nested = N.gathered(load(spark, sf_dir, "lineitem"), "l_orderkey", ["l_linenumber", "l_quantity"], "lines")
    return N.unnested(nested, "l_orderkey", "lines")


@query("""WITH a AS (SELECT o_custkey, list(o_orderkey ORDER BY o_orderkey) AS a, list(o_orderkey ORDER BY o_orderkey) FILTER (o_orderstatus = 'F') AS b FROM orders GROUP BY 1)
SELECT o_custkey, a[i] AS a, b[i] AS b FROM a, unnest(generate_series(1, greatest(len(a), coalesce(len(b), 0)))) t(i)""")
def arrays_zip_pad(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    n = o.groupBy("o_custkey").agg(F.struct(F.sort_array(F.collect_list("o_orderkey")).alias("a"), F.sort_array(F.collect_list(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")))).alias("b")).alias("s"))
    return n.select("o_custkey", F.inline(N.zipped(["a", "b"], "s")))


@query("SELECT o_custkey, o_orderstatus AS key, count(*) AS value FROM orders GROUP BY 1, 2")
def map_explode(spark, sf_dir):
    c = load(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n"))
    return N.entries(c.groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("o_orderstatus", "n"))).alias("m")), "o_custkey", "m")


@query("""SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'data_file' WHEN page_id % 4 = 1 THEN 'graphic' WHEN page_id % 4 = 2 THEN 'primary' ELSE 'exhibit' END AS role,
CASE page_id % 7 WHEN 0 THEN 'schema' WHEN 1 THEN 'calculation' WHEN 2 THEN 'definition' WHEN 3 THEN 'label' WHEN 4 THEN 'presentation' WHEN 5 THEN 'reference' ELSE NULL END AS linkbase, page_id % 4 = 3 OR page_id % 2 = 0 AS exhibit FROM pages""")
def attachment_classes(spark, sf_dir):
    p = load(spark, sf_dir, "pages")
    kind = F.when(F.col("page_id") % 4 == 1, "GRAPHIC").when(F.col("page_id") % 4 == 2, "10-K").when(F.col("page_id") % 4 == 3, "EX-10.1").otherwise("XML")
    table = F.when(F.col("page_id") % 4 == 0, "data").otherwise("document")
    name = F.element_at(F.array(*[F.lit(x) for x in ("a.xsd", "a_cal.xml", "a_def.xml", "a_lab.xml", "a_pre.xml", "a_ref.xml", "main.pdf")]), (F.col("page_id") % 7 + 1).cast("int"))
    return p.select(
        "page_id", N.attachment_role(table, kind, F.lit("10-k")).alias("role"), N.linkbase_kind(kind, name, F.lit(None).cast("string")).alias("linkbase"),
        N.is_exhibit(kind, F.when(F.col("page_id") % 2 == 0, "d123-ex10.htm").otherwise("main.htm")).alias("exhibit"),
    )


@query("""SELECT n_name, o_orderstatus, count(*) AS n FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL""")
def star_left_joins(spark, sf_dir):
    customers, nations = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    both = R.star(load(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus"), (customers, "o_custkey", "c_custkey"), (nations, "c_nationkey", "n_nationkey"))
    return both.groupBy("n_name", "o_orderstatus").agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey, o_custkey, NULL AS o_orderstatus FROM orders WHERE o_orderkey % 9 = 0 UNION ALL BY NAME SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 9 = 1""")
def union_by_name(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    return R.stacked_by_name(o.where("o_orderkey % 9 = 0").select("o_orderkey", "o_custkey"), o.where("o_orderkey % 9 = 1").select("o_orderkey", "o_orderstatus"))


@query("""SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price, count(*) AS n
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""")
def pricing_summary(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").where("l_shipdate <= timestamp'1998-09-02'")
    money = lambda c: F.sum(F.col(c).cast("decimal(18,2)")).cast("double")
    return li.groupBy("l_returnflag", "l_linestatus").agg(money("l_quantity").alias("sum_qty"), money("l_extendedprice").alias("sum_price"), F.count("*").alias("n"))
