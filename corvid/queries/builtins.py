"""Built-in SQL functions and clauses that the engine's users rely on, in Spark SQL and in DuckDB SQL side by side."""

from __future__ import annotations

from corvid.registry import load, query

#: (name, Spark expression, DuckDB expression) over a row of orders.
SCALARS = (
    ("try_cast", "try_cast(concat(o_custkey, if(o_orderkey % 2 = 0, 'x', '')) as bigint)", "try_cast(o_custkey || CASE WHEN o_orderkey % 2 = 0 THEN 'x' ELSE '' END AS BIGINT)"),
    ("case_when", "case when o_orderkey % 3 = 0 then 'a' when o_orderkey % 3 = 1 then 'b' end", "CASE WHEN o_orderkey % 3 = 0 THEN 'a' WHEN o_orderkey % 3 = 1 THEN 'b' END"),
    ("coalesce", "coalesce(nullif(o_orderpriority, '5-LOW'), 'none')", "coalesce(nullif(o_orderpriority, '5-LOW'), 'none')"),
    ("greatest_least", "greatest(o_custkey, 50) - least(o_custkey, 50)", "greatest(o_custkey, 50) - least(o_custkey, 50)"),
    ("regexp_replace", "regexp_replace(o_orderpriority, '[^A-Z]+', '_')", "regexp_replace(o_orderpriority, '[^A-Z]+', '_', 'g')"),
    ("regexp_extract", "regexp_extract(o_orderpriority, '([0-9])-(.)', 2)", "regexp_extract(o_orderpriority, '([0-9])-(.)', 2)"),
    ("regexp_matches", "o_orderpriority rlike '^[12]-'", "regexp_matches(o_orderpriority, '^[12]-')"),
    ("ilike", "o_orderpriority ilike '%LOW%' or contains(o_orderpriority, 'MED')", "o_orderpriority ILIKE '%low%' OR contains(o_orderpriority, 'MED')"),
    ("substr", "concat(lower(substr(o_orderpriority, 3, 4)), lpad(o_custkey, 6, '0'), reverse(o_orderstatus))", "lower(substr(o_orderpriority, 3, 4)) || lpad(CAST(o_custkey AS VARCHAR), 6, '0') || reverse(o_orderstatus)"),
    ("split_part", "split_part(o_orderpriority, '-', 2)", "split_part(o_orderpriority, '-', 2)"),
    ("starts_ends", "startswith(o_orderpriority, '1') or endswith(o_orderpriority, 'W')", "starts_with(o_orderpriority, '1') OR ends_with(o_orderpriority, 'W')"),
    ("digests", "concat(md5(o_orderpriority), sha2(cast(o_orderkey as string), 256))", "md5(o_orderpriority) || sha256(CAST(o_orderkey AS VARCHAR))"),
    ("date_parts", "year(o_orderdate) * 10000 + month(o_orderdate) * 100 + quarter(o_orderdate)", "year(o_orderdate) * 10000 + month(o_orderdate) * 100 + quarter(o_orderdate)"),
    ("date_trunc", "cast(cast(date_trunc('month', o_orderdate) as date) as string)", "CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR)"),
    ("date_diff", "cast(datediff(cast(o_orderdate as date), date'1995-01-01') as bigint)", "date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE))"),
    ("date_format", "date_format(o_orderdate, 'yyyy-MM')", "strftime(o_orderdate, '%Y-%m')"),
    ("interval", "cast(cast(o_orderdate + interval 3 months as date) as string)", "CAST(CAST(o_orderdate + INTERVAL 3 MONTH AS DATE) AS VARCHAR)"),
    ("distinct_from", "nullif(o_orderstatus, 'F') <=> nullif(o_orderstatus, 'O')", "nullif(o_orderstatus, 'F') IS NOT DISTINCT FROM nullif(o_orderstatus, 'O')"),
    ("between_in", "o_custkey between 10 and 90 and o_orderstatus in ('F', 'O')", "o_custkey BETWEEN 10 AND 90 AND o_orderstatus IN ('F', 'O')"),
    ("lists", "array_join(array_sort(filter(array(3, cast(o_orderkey % 5 as int), 1), x -> x > 0)), ',')", "array_to_string(list_sort(list_filter([3, CAST(o_orderkey % 5 AS INT), 1], lambda x: x > 0)), ',')"),
    ("list_contains", "array_contains(split(o_orderpriority, '-'), 'LOW')", "list_contains(string_split(o_orderpriority, '-'), 'LOW')"),
    ("json", "get_json_object(concat('{\"a\":{\"b\":', o_custkey, '}}'), '$.a.b')", "json_extract_string('{\"a\":{\"b\":' || o_custkey || '}}', '$.a.b')"),
)


@query("SELECT o_orderkey, " + ", ".join(f"CAST({duck} AS VARCHAR) AS {name}" for name, _, duck in SCALARS) + " FROM orders")
def sql_scalars(spark, sf_dir):
    load(spark, sf_dir, "orders").createOrReplaceTempView("corvid_orders")
    return spark.sql("SELECT o_orderkey, " + ", ".join(f"cast({said} as string) AS {name}" for name, said, _ in SCALARS) + " FROM corvid_orders")


@query("""SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS filtered, count(DISTINCT o_orderpriority) AS kinds, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last,
string_agg(o_orderstatus, ',' ORDER BY o_orderkey) AS said, array_to_string(list_sort(list(DISTINCT o_orderpriority)), '|') AS distinct_list, bool_or(o_orderstatus = 'P') AS any_p, bool_and(o_orderstatus = 'O') AS all_o, median(o_orderkey) AS middle FROM orders GROUP BY ALL HAVING count(*) > 1""")
def sql_aggregates(spark, sf_dir):
    load(spark, sf_dir, "orders").createOrReplaceTempView("corvid_orders")
    return spark.sql(
        """SELECT o_custkey, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS filtered, count(DISTINCT o_orderpriority) AS kinds, min_by(o_orderkey, struct(o_orderdate, o_orderkey)) AS first, max_by(o_orderkey, struct(o_orderdate, o_orderkey)) AS last,
        array_join(transform(array_sort(collect_list(struct(o_orderkey, o_orderstatus))), x -> x.o_orderstatus), ',') AS said, array_join(array_sort(collect_set(o_orderpriority)), '|') AS distinct_list, bool_or(o_orderstatus = 'P') AS any_p, bool_and(o_orderstatus = 'O') AS all_o, median(o_orderkey) AS middle
        FROM corvid_orders GROUP BY ALL HAVING count(*) > 1"""
    )


@query("""SELECT o_orderkey, row_number() OVER w AS rn, rank() OVER p AS r, dense_rank() OVER p AS d, lag(o_orderkey) OVER w AS before, lead(o_orderkey, 2) OVER w AS after, first_value(o_orderkey) OVER w AS first, ntile(4) OVER w AS tile,
count(*) OVER (PARTITION BY o_custkey) AS n, sum(o_orderkey) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), p AS (PARTITION BY o_custkey ORDER BY o_orderpriority) QUALIFY row_number() OVER w <= 3""")
def sql_windows(spark, sf_dir):
    load(spark, sf_dir, "orders").createOrReplaceTempView("corvid_orders")
    return spark.sql(
        """SELECT * FROM (SELECT o_orderkey, row_number() OVER w AS rn, rank() OVER p AS r, dense_rank() OVER p AS d, lag(o_orderkey) OVER w AS before, lead(o_orderkey, 2) OVER w AS after, first_value(o_orderkey) OVER w AS first, ntile(4) OVER w AS tile,
        count(*) OVER (PARTITION BY o_custkey) AS n, sum(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling
        FROM corvid_orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), p AS (PARTITION BY o_custkey ORDER BY o_orderpriority)) WHERE rn <= 3"""
    )


@query("""WITH a AS (SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0), b AS (SELECT DISTINCT o_custkey AS k FROM orders), u AS (SELECT k, 'a' AS side FROM a UNION ALL SELECT k, 'b' FROM b)
SELECT 'except' AS clause, count(*) AS n FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL SELECT 'intersect', count(*) FROM (SELECT k FROM a INTERSECT SELECT k FROM b) UNION ALL SELECT 'union', count(*) FROM (SELECT k FROM a UNION SELECT k FROM b)
UNION ALL SELECT 'anti', count(*) FROM a ANTI JOIN b USING (k) UNION ALL SELECT 'semi', count(*) FROM a SEMI JOIN b USING (k) UNION ALL SELECT 'full', count(*) FROM a FULL JOIN b USING (k) UNION ALL SELECT 'exists', count(*) FROM a WHERE EXISTS (SELECT 1 FROM b WHERE b.k = a.k)
UNION ALL SELECT 'not_in', count(*) FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT 'unnest', count(*) FROM (SELECT unnest([k, k + 1]) FROM a) UNION ALL SELECT 'grouping', count(*) FROM (SELECT side, count(*) FROM u GROUP BY ROLLUP (side)) UNION ALL SELECT 'limit', count(*) FROM (SELECT k FROM a ORDER BY k LIMIT 7 OFFSET 3)""")
def sql_sets_and_joins(spark, sf_dir):
    load(spark, sf_dir, "orders").createOrReplaceTempView("corvid_orders")
    load(spark, sf_dir, "customer").createOrReplaceTempView("corvid_customer")
    return spark.sql(
        """WITH a AS (SELECT c_custkey AS k FROM corvid_customer WHERE c_acctbal > 0), b AS (SELECT DISTINCT o_custkey AS k FROM corvid_orders), u AS (SELECT k, 'a' AS side FROM a UNION ALL SELECT k, 'b' FROM b)
        SELECT 'except' AS clause, count(*) AS n FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL SELECT 'intersect', count(*) FROM (SELECT k FROM a INTERSECT SELECT k FROM b) UNION ALL SELECT 'union', count(*) FROM (SELECT k FROM a UNION SELECT k FROM b)
        UNION ALL SELECT 'anti', count(*) FROM a LEFT ANTI JOIN b USING (k) UNION ALL SELECT 'semi', count(*) FROM a LEFT SEMI JOIN b USING (k) UNION ALL SELECT 'full', count(*) FROM a FULL JOIN b USING (k) UNION ALL SELECT 'exists', count(*) FROM a WHERE EXISTS (SELECT 1 FROM b WHERE b.k = a.k)
        UNION ALL SELECT 'not_in', count(*) FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT 'unnest', count(*) FROM (SELECT explode(array(k, k + 1)) FROM a) UNION ALL SELECT 'grouping', count(*) FROM (SELECT side, count(*) FROM u GROUP BY ROLLUP (side)) UNION ALL SELECT 'limit', count(*) FROM (SELECT k FROM a ORDER BY k LIMIT 7 OFFSET 3)"""
    )
