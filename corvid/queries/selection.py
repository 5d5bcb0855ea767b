"""Features, predicates and sampling over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions import dates as D
from corvid.functions import text as X
from corvid.operators import relational as R
from corvid.operators import selection as S
from corvid.registry import load, query


@query("""SELECT p_partkey, CASE WHEN b = '' THEN f ELSE b END AS family FROM (SELECT p_partkey, f,
trim(regexp_replace(regexp_replace(regexp_replace(upper(trim(f)), '/A$', ''), '_A$', ''), '\\-A$', ''), '_-') AS b
FROM (SELECT p_partkey, p_type || CASE p_partkey % 4 WHEN 0 THEN '/A' WHEN 1 THEN '_A' WHEN 2 THEN '-' ELSE '' END AS f FROM part))""")
def form_family(spark, sf_dir):
    p = load(spark, sf_dir, "part")
    form = F.concat("p_type", F.when(F.col("p_partkey") % 4 == 0, "/A").when(F.col("p_partkey") % 4 == 1, "_A").when(F.col("p_partkey") % 4 == 2, "-").otherwise(""))
    return p.select("p_partkey", X.form_family(form).alias("family"))


_BANDS = [("early", None, "1995-12-31"), ("middle", "1996-01-01", "1998-06-30"), ("late", "1998-07-01", "2004-12-31")]


@query("""SELECT o_orderkey, CASE WHEN d IS NULL OR length(d) < 4 THEN 'unknown' WHEN d <= '1995-12-31' THEN 'early' WHEN d >= '1996-01-01' AND d <= '1998-06-30' THEN 'middle'
WHEN d >= '1998-07-01' AND d <= '2004-12-31' THEN 'late' ELSE 'unknown' END AS era FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS d FROM orders)""")
def era_band(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderdate").cast("date").cast("string")).alias("d"))
    return o.select("o_orderkey", D.era(F.col("d"), _BANDS).alias("era"))


def _dated(spark, sf_dir):
    return load(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 13 == 0, "not a date").otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("d"))


_DATED = "WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d FROM orders)"


@query(f"{_DATED} SELECT o_orderkey FROM o WHERE d BETWEEN DATE '1995-04-01' AND DATE '1996-06-30' OR d >= DATE '1998-01-01'")
def date_selection_abs(spark, sf_dir):
    return _dated(spark, sf_dir).where(D.date_predicate(F.col("d"), D.parse_dates("1995Q2..1996Q1, 1996-02..1996-06, 1998.."))).select("o_orderkey")


@query(f"{_DATED} SELECT o_orderkey FROM o WHERE quarter(d) = 1 OR (quarter(d) = 2 AND year(d) BETWEEN 1995 AND 1996) OR (month(d) = 12 AND year(d) >= 1997)")
def date_selection_recurring(spark, sf_dir):
    return _dated(spark, sf_dir).where(D.date_predicate(F.col("d"), D.parse_dates("@Q1,@Q2[1995..1996],@M12[1997..]"))).select("o_orderkey")


@query(r"SELECT page_id, url FROM pages WHERE regexp_matches(lower(url), '\.(?:html|htm|txt)$') OR lower(url) LIKE '%.pdf'")
def suffix_filter(spark, sf_dir):
    return load(spark, sf_dir, "pages").select("page_id", "url").where(X.has_suffix(F.col("url"), ("html", "htm", "txt", "pdf")))


@query("""WITH li AS (SELECT l_partkey, l_orderkey * 10 + l_linenumber AS occ, l_quantity, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey),
a AS (SELECT p_brand, median(l_quantity) AS m FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY occ, l_quantity) AS rn FROM li) WHERE rn = 1 GROUP BY 1)
SELECT p_brand, band, count(*) AS n FROM (SELECT li.p_brand, CASE WHEN l_quantity < m * 0.25 THEN 'very_small' WHEN l_quantity < m THEN 'small' WHEN l_quantity < m * 4 THEN 'median' WHEN l_quantity < m * 16 THEN 'large' ELSE 'very_large' END AS band
FROM li JOIN a USING (p_brand)) GROUP BY ALL""")
def size_band_by_median(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").select("l_partkey", F.struct((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("a"), F.col("l_quantity").alias("b")).alias("occ"), "l_quantity")
    rows = li.join(load(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    anchors = S.size_anchors(rows, "p_brand", "l_partkey", "occ", "l_quantity")
    return rows.join(anchors, "p_brand").groupBy("p_brand", S.size_band(F.col("l_quantity"), F.col("median_size")).alias("band")).agg(F.count("*").alias("n"))


@query("""WITH y AS (SELECT DISTINCT o_custkey, year(o_orderdate) AS y FROM orders), p AS (SELECT *, lead(y) OVER (PARTITION BY o_custkey ORDER BY y) AS nx FROM y),
m AS (SELECT o_custkey, max(y) AS hi, count(*) AS n, coalesce(bool_or(nx - y >= 3), false) AS gap FROM p GROUP BY 1), g AS (SELECT max(y) AS last FROM y)
SELECT o_custkey, gap AS has_revival_gap, CASE WHEN n <= 2 AND last - hi <= 2 THEN 'short_recent_history' WHEN last - hi >= 5 THEN 'ceased_filing_observed' WHEN last - hi <= 1 THEN 'right_censored_active' ELSE 'intermediate_or_dormant' END AS lifecycle_class FROM m, g""")
def lifecycle_gap(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("y"))
    return S.lifecycle(o, "o_custkey", "y")


@query("""SELECT l_partkey, occ, occurrences, CASE WHEN occurrences = 1 THEN 'single' WHEN occurrences <= 3 THEN 'low_2_to_3' ELSE 'high_4_plus' END AS locator_class FROM (
SELECT l_partkey, occ, row_number() OVER w AS rn, count(*) OVER (PARTITION BY l_partkey) AS occurrences FROM (SELECT l_partkey, min(l_orderkey * 10 + l_linenumber) AS occ, l_suppkey FROM lineitem GROUP BY l_partkey, l_suppkey)
WINDOW w AS (PARTITION BY l_partkey ORDER BY occ)) WHERE rn = 1""")
def locator_rollup_framed_count(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.min(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("occ"))
    return S.locator_rollup(li, "l_partkey", "occ").select("l_partkey", "occ", "occurrences", "locator_class")


@query("SELECT c_custkey FROM customer WHERE CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 17")
def sample_modulo_md5(spark, sf_dir):
    return S.sample_modulo(load(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", 17)


@query("SELECT o_orderkey FROM orders ORDER BY sha256('s1:' || o_orderkey), o_orderkey LIMIT 200")
def sample_seeded_topn(spark, sf_dir):
    return S.sample_top(load(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", "s1", 200)


@query("SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1 ORDER BY sha256('s2:' || o_custkey), o_custkey LIMIT 100")
def sample_by_family(spark, sf_dir):
    return S.sample_groups(load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey", "s2", 100)


@query("SELECT o_custkey, o_orderkey, draw_rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY sha256('s3:' || o_orderkey), o_orderkey) AS draw_rank FROM orders) WHERE draw_rank <= 3")
def per_key_topn(spark, sf_dir):
    return S.top_per_key(load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey", "s3", 3)


@query("SELECT o_orderkey FROM orders ORDER BY sha256('s4:' || o_orderkey), o_orderkey LIMIT 50 OFFSET 100")
def candidate_page(spark, sf_dir):
    return S.page(load(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", "s4", 2, 50)


@query("""WITH prior AS (SELECT o_orderpriority, o_orderstatus, count(*) AS filled FROM orders WHERE o_orderkey % 400 = 0 GROUP BY ALL)
SELECT o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY sha256('s5:' || o_orderkey), o_orderkey) AS rn FROM orders) LEFT JOIN prior USING (o_orderpriority, o_orderstatus) WHERE rn <= 10 - coalesce(filled, 0)""")
def signature_cap(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    prior = o.where("o_orderkey % 400 = 0").groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("filled"))
    return S.signature_cap(o, ["o_orderpriority", "o_orderstatus"], prior, 10, "s5", "o_orderkey").select("o_orderkey")


@query("""WITH u AS (SELECT o_orderkey, 'o_orderstatus' AS dimension, o_orderstatus AS value FROM orders UNION ALL SELECT o_orderkey, 'o_orderpriority', o_orderpriority FROM orders),
f(dimension, value, need) AS (VALUES ('o_orderstatus', 'P', 3), ('o_orderpriority', '1-URGENT', 5)) SELECT dimension, value, count(*) AS candidates, min(need) AS need FROM u JOIN f USING (dimension, value) GROUP BY 1, 2""")
def floor_candidates(spark, sf_dir):
    floors = spark.createDataFrame([("o_orderstatus", "P", 3), ("o_orderpriority", "1-URGENT", 5)], "dimension string, value string, need int")
    found = S.floor_candidates(load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), "o_orderkey", ["o_orderstatus", "o_orderpriority"], floors)
    return found.groupBy("dimension", "value").agg(F.count("*").alias("candidates"), F.min("need").alias("need"))


@query("""WITH c AS (SELECT c_mktsegment AS cell, count(*) AS n FROM customer GROUP BY 1), l AS (SELECT max(lv) AS lv FROM generate_series(0, 1000) t(lv) WHERE (SELECT sum(least(n, lv)) FROM c) <= 60),
g AS (SELECT cell, least(n, lv) + CASE WHEN n > lv AND row_number() OVER (PARTITION BY n > lv ORDER BY cell) <= 60 - (SELECT sum(least(n, lv)) FROM c, l) THEN 1 ELSE 0 END AS target FROM c, l)
SELECT c_custkey, cell FROM (SELECT c_custkey, c_mktsegment AS cell, row_number() OVER (PARTITION BY c_mktsegment ORDER BY sha256('s6:' || c_custkey), c_custkey) AS rn FROM customer) JOIN g USING (cell) WHERE rn <= target""")
def cell_waterfill(spark, sf_dir):
    c = load(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("cell"))
    cells = [(r["cell"], 0, r["count"]) for r in c.groupBy("cell").count().orderBy("cell").collect()]  # one row a segment
    return S.additions(c, "cell", S.water_fill(cells, 60), "s6", "c_custkey").select("c_custkey", "cell")


@query("""WITH k AS (SELECT o_custkey, bool_or(o_orderpriority = '1-URGENT') AS wanted FROM orders GROUP BY 1), f AS (SELECT *, 0 AS t FROM k WHERE wanted ORDER BY o_custkey LIMIT 40)
SELECT o_custkey, wanted FROM (SELECT * FROM f UNION ALL SELECT *, 1 FROM k WHERE o_custkey NOT IN (SELECT o_custkey FROM f)) ORDER BY t, o_custkey LIMIT 100""")
def quota_priority_fill(spark, sf_dir):
    return S.quota_fill(load(spark, sf_dir, "orders"), "o_custkey", F.col("o_orderpriority") == "1-URGENT", 40, 100)


@query("""SELECT ord - 1 AS pos, k AS c_custkey, c_name FROM (SELECT unnest([42, 7, 1000, 3]) AS k, unnest([1, 2, 3, 4]) AS ord) LEFT JOIN customer ON c_custkey = k""")
def ordered_lookup(spark, sf_dir):
    """A keyed lookup that keeps the order of the request."""
    return R.ordered_lookup(load(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey", [42, 7, 1000, 3])


@query("""SELECT p_partkey, array_to_string(regexp_extract_all(regexp_replace(regexp_replace(n, '([a-z0-9])([A-Z])', '\\1 \\2', 'g'), '([A-Z]+)([A-Z][a-z])', '\\1 \\2', 'g'), '[A-Za-z0-9]+'), ' ') AS words
FROM (SELECT p_partkey, replace(replace(p_brand, '#', 'No'), ' ', '') || 'ABCName' || p_partkey AS n FROM part)""")
def split_camel_case(spark, sf_dir):
    p = load(spark, sf_dir, "part").select("p_partkey", F.concat(F.replace(F.replace("p_brand", F.lit("#"), F.lit("No")), F.lit(" "), F.lit("")), F.lit("ABCName"), F.col("p_partkey").cast("string")).alias("n"))
    return p.select("p_partkey", F.array_join(X.split_camel(F.col("n")), " ").alias("words"))


@query("""SELECT o_orderkey, CASE WHEN d BETWEEN 75 AND 105 THEN 'QUARTER' WHEN d BETWEEN 160 AND 200 THEN 'YTD_2Q' WHEN d BETWEEN 250 AND 295 THEN 'YTD_3Q' WHEN d BETWEEN 340 AND 380 THEN 'ANNUAL' WHEN d > 380 THEN 'CUMULATIVE' ELSE 'DURATION' END AS kind
FROM (SELECT o_orderkey, o_orderkey % 420 AS d FROM orders)""")
def period_class(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", F.lit("2023-01-01").cast("date").alias("s"), F.expr("date_add(date'2023-01-01', cast(o_orderkey % 420 as int))").alias("e"))
    return o.select("o_orderkey", D.period_class(F.col("s"), F.col("e")).alias("kind"))


@query("""SELECT o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik, CASE WHEN yy >= 90 THEN 1900 + yy ELSE 2000 + yy END AS year, a AS digits FROM (
SELECT o_orderkey, o_custkey, lpad(CAST(o_custkey AS VARCHAR), 10, '0') || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') AS a, o_orderkey % 100 AS yy FROM orders)""")
def identifiers(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    raw = F.concat_ws("-", X.padded_cik(F.col("o_custkey")), F.lpad((F.col("o_orderkey") % 100).cast("string"), 2, "0"), F.lpad((F.col("o_orderkey") % 1000000).cast("string"), 6, "0"))
    return o.select("o_orderkey", X.padded_cik(F.col("o_custkey")).alias("cik"), X.accession_year(raw).alias("year"), X.accession_digits(raw).alias("digits"))


@query("""WITH x AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P'), m AS (SELECT o_custkey, o_orderkey, sha256('s7:' || o_orderkey) AS d FROM orders WHERE o_orderpriority = '2-HIGH' AND o_custkey NOT IN (SELECT o_custkey FROM x))
SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY d, o_orderkey) AS rn FROM m) WHERE rn = 1 ORDER BY d, o_orderkey LIMIT 60""")
def pool_for_value(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus")
    return S.pool_for_value(o, "o_orderpriority", "2-HIGH", "o_orderkey", "o_custkey", "s7", 60, o.where("o_orderstatus = 'P'")).select("o_custkey", "o_orderkey")


@query(r"""SELECT page_id FROM pages WHERE (regexp_matches(lower(url), '\.html$') OR regexp_matches(lower(url), '\.txt$')) AND length(html) <= 4000 AND quarter(DATE '2020-01-01' + CAST(page_id % 700 AS INT)) = 2""")
def candidate_predicate(spark, sf_dir):
    p = load(spark, sf_dir, "pages").withColumn("d", F.date_add(F.lit("2020-01-01").cast("date"), (F.col("page_id") % 700).cast("int")))
    return p.where(S.candidate_predicate(F.col("url"), ("html", "txt"), F.length("html"), 4000, F.col("d"), "@Q2")).select("page_id")
