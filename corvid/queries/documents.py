"""Document transformations over pages and documents: tested on fixtures, as SQL can't express them, but for the text cleaners."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions import documents as D
from corvid.functions import text as X
from corvid.registry import load, query


@query()
def html_to_text(spark, sf_dir):
    return load(spark, sf_dir, "pages").select("page_id", D.on_text(D.html_to_text, F.col("html")).alias("text"))


_LINES = """WITH l AS (SELECT l_orderkey AS k, l_linenumber AS n, CAST(l_quantity AS BIGINT) AS q, CAST(l_extendedprice AS BIGINT) AS p FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n, q, p) - 1 AS i FROM l) """


def _orders(spark, sf_dir, line):
    """(k, lines): the lines of every order, one after another."""
    li = load(spark, sf_dir, "lineitem")
    made = li.groupBy(F.col("l_orderkey").alias("k")).agg(F.sort_array(F.collect_list(F.struct(F.col("l_linenumber").alias("n"), F.col("l_quantity").cast("bigint").alias("q"), F.round("l_extendedprice").cast("bigint").alias("p")))).alias("l"))
    return made.select("k", F.transform("l", line).alias("lines"))


@query(_LINES.replace("CAST(l_extendedprice AS BIGINT)", "CAST(round(l_extendedprice) AS BIGINT)") + "SELECT k, 0 AS table_index, i AS row, 3 AS width, n || '|' || q || '|' || p AS cells FROM r")
def html_tables(spark, sf_dir):
    pages = _orders(spark, sf_dir, lambda x: F.concat(F.lit("<tr><td>"), x["n"].cast("string"), F.lit("</td><td> <b>"), x["q"].cast("string"), F.lit("</b></td><td>"), x["p"].cast("string"), F.lit("</td></tr>")))
    rows = lambda html: [(t, r, len(row), "|".join(x or "" for x in row)) for t, grid in enumerate(D.html_tables(html)) for r, row in enumerate(grid)]
    return D.rows_of(pages.select("k", F.concat(F.lit("<html><table>"), F.array_join("lines", "\n"), F.lit("</table>")).alias("html")), rows, "k", "html", "table_index int, row int, width int, cells string")


@query(r"SELECT doc_id, trim(regexp_replace(translate(text, '‘’“”', '''''\"\"'), '[\s  ]+', ' ', 'g')) AS text FROM documents".replace('\\"', '"'))
def normalize_text(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", X.normalize(F.col("text")).alias("text"))


@query()
def page_furniture(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", D.on_text(D.strip_pages, F.col("text")).alias("text"))


@query()
def reflow(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", D.on_text(D.reflow, F.col("text")).alias("text"))


@query("""SELECT c_custkey, item, heading, start_line, end_line FROM customer, (VALUES ('1', 'Business', 6, 8), ('1A', 'Risk Factors', 9, 11), ('7', 'Discussion', 12, 13)) v(item, heading, start_line, end_line)""")
def section_spans(spark, sf_dir):
    lines = ["INDEX", "Item 1. Business .... 3", "Item 1A. Risk Factors .... 9", "Item 7. Discussion .... 20", "", "ITEM 1. Business", F.col("c_name"), "see Item 9", "Item 1A - Risk Factors", F.col("c_mktsegment"), "Item 7", "Item 7. Discussion", "end"]
    text = F.concat_ws("\n", *[F.lit(x) if isinstance(x, str) else x for x in lines])
    return D.rows_of(load(spark, sf_dir, "customer").select("c_custkey", text.alias("text")), D.sections, "c_custkey", "text", "item string, heading string, start_line int, end_line int")


@query("""SELECT c_custkey, number, heading, start_line, end_line FROM customer, (VALUES (1, 'Organization', 1, 2), (2, 'Summary of Policies', 3, 5), (3, 'Revenue', 6, 6)) v(number, heading, start_line, end_line)""")
def note_spans(spark, sf_dir):
    lines = ["Note 1. Organization", F.col("c_name"), "Note 2 - Summary of Policies", "7. Not the next note", F.col("c_mktsegment"), "3. Revenue"]
    text = F.concat_ws("\n", *[F.lit(x) if isinstance(x, str) else x for x in lines])
    return D.rows_of(load(spark, sf_dir, "customer").select("c_custkey", text.alias("text")), D.notes, "c_custkey", "text", "number int, heading string, start_line int, end_line int")


@query(_LINES + "SELECT k, 1 AS first_line, count(*) + 1 AS end_line, count(*) AS rows FROM r GROUP BY k HAVING count(*) >= 3")
def table_regions(spark, sf_dir):
    pages = _orders(spark, sf_dir, lambda x: F.concat(F.lit("line   "), F.lpad(x["q"].cast("string"), 6, " "), F.lpad(x["p"].cast("string"), 12, " ")))
    return D.rows_of(pages.select("k", F.concat(F.lit("A line of prose\n"), F.array_join("lines", "\n")).alias("text")), D.table_runs, "k", "text", "first_line int, end_line int, rows int")


@query()
def lexical_classify(spark, sf_dir):
    packs = [D.Evidence("license", (D.Tier(3, ("all rights reserved", "licensed under")), D.Tier(1, ("license", "copyright")))), D.Evidence("secret", (D.Tier(2, ("token", "password")),))]
    return D.rows_of(load(spark, sf_dir, "documents"), lambda t: [D.classify(t, packs, ("license", "secret"))], "doc_id", "text", "label string, score int, confidence double")


@query()
def normalized_documents(spark, sf_dir):
    n = D.normalize_documents(load(spark, sf_dir, "pages"), "page_id", "html")
    return n.select("page_id", "kind", F.length("text").alias("chars"), F.size("sections").alias("sections"), "error")


@query(r"""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_name WHEN 1 THEN c_name WHEN 2 THEN c_name ELSE c_name || ' /x/' END AS name FROM customer""")
def jurisdictions(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 4
    said = F.concat("c_name", F.when(k == 0, " /DE/").when(k == 1, " (Delaware)").when(k == 2, "/NY").otherwise(" /x/"))
    return c.select("c_custkey", X.strip_jurisdiction(said).alias("name"))
