"""Structured forms built from order lines, read back and compared with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.registry import load, query
from corvid.sources.forms import form_rows, typed_rows


@query("""WITH l AS (SELECT l_orderkey AS k, l_partkey AS p, CAST(l_quantity AS BIGINT) AS q, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS n FROM lineitem)
SELECT k, 'holdings' AS family, 'infoTable' AS kind, n AS ordinal, 'P' || p AS issuer, CAST(q AS VARCHAR) AS amount FROM l UNION ALL SELECT DISTINCT k, 'holdings', 'header', 0, NULL, NULL FROM l""")
def form_records(spark, sf_dir):
    return _records(spark, sf_dir).select("k", "family", "kind", "ordinal", F.try_element_at("fields", F.lit("nameOfIssuer")).alias("issuer"), F.try_element_at("fields", F.lit("shrsOrPrnAmt/sshPrnamt")).alias("amount"))


@query("""SELECT l_orderkey AS k, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS INT) AS ordinal, 'P' || l_partkey AS issuer, CAST(l_quantity AS DOUBLE) AS shares FROM lineitem""")
def holdings_typed(spark, sf_dir):
    return typed_rows(_records(spark, sf_dir), "k", "holdings", "infoTable").select("k", "ordinal", "issuer", F.col("shares").cast("double"))


def _records(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    lines = li.groupBy(F.col("l_orderkey").alias("k")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", F.col("l_partkey").alias("p"), "l_quantity", F.col("l_quantity").cast("bigint").alias("q")))).alias("l"))
    body = F.array_join(F.transform("l", lambda x: F.concat(F.lit("<infoTable><nameOfIssuer>P"), x["p"].cast("string"), F.lit("</nameOfIssuer><shrsOrPrnAmt><sshPrnamt>"), x["q"].cast("string"), F.lit("</sshPrnamt></shrsOrPrnAmt></infoTable>"))), "")
    docs = lines.select("k", F.lit("13F-HR").alias("form"), F.concat(F.lit("<?xml version='1.0'?><informationTable><period>2024</period>"), body, F.lit("</informationTable>")).alias("xml"))
    return form_rows(docs, "k", "form", "xml")
