"""Registered queries read whole tables: rows that a condition on ids would leave out reach their results."""

import duckdb
import pytest

from corvid import queries as own

SF = "/root/testdata/sf0.001"
#: Rows that conditions on ids, of the kind queries once had, would leave out.
LEFT_OUT = {"lineitem": "l_orderkey % 10 <> 0 AND l_orderkey % 3 <> 0", "orders": "o_orderkey % 20 <> 0 AND o_custkey % 10 <> 1 AND o_orderkey % 3 <> 0", "part": "p_partkey % 10 <> 0", "customer": "c_custkey % 7 <> 0"}
NAMES = ["arrays_zip_pad", "cofilers", "exhibit_choice", "form_records", "html_tables", "interval_conflict", "locator_rollup_framed_count", "peer_exact_coordinate", "quarter_unaccumulate", "table_regions", "nested_unnest", "late_reconcile", "cell_waterfill"]


def made(folder, kept):
    for name, rows in kept.items():
        duckdb.sql(f"COPY (SELECT * FROM '{SF}/{name}.parquet' WHERE {rows}) TO '{folder}/{name}.parquet'")
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_rows_reach_results(spark, tmp_path, name):
    assert not own.queries()[name](spark, made(tmp_path, LEFT_OUT)).isEmpty()


def test_panel_and_cofilers(spark, tmp_path):
    at = made(tmp_path, LEFT_OUT)
    status = {r["entity"]: r["status"] for r in own.queries()["panel_left_join"](spark, at).collect()}
    orders = [r["o_custkey"] for r in spark.read.parquet(f"{at}/orders.parquet").collect()]
    assert status == {c: ("UNAVAILABLE", "REPORTED", "AMBIGUOUS")[min(orders.count(c), 2)] for c in status}
    filers = {}
    for r in spark.read.parquet(f"{at}/lineitem.parquet").collect():
        filers.setdefault(r["l_orderkey"], set()).add(r["l_suppkey"])
    want = {(k, a, b) for k, s in filers.items() for a in s for b in (s - {a} or {None})}
    assert {tuple(r) for r in own.queries()["cofilers"](spark, at).collect()} == want


def test_whole_history(spark, tmp_path):
    """Conclusions that need every row: a customer with an order every year has no gap, and every status is seen."""
    at = made(tmp_path, {"orders": "TRUE", "customer": "TRUE", "part": "TRUE"})
    years, facts = {}, {}
    for r in spark.read.parquet(f"{at}/orders.parquet").collect():
        years.setdefault(r["o_custkey"], set()).add(r["o_orderdate"].year)
        facts.setdefault(r["o_custkey"], set()).add(r["o_orderstatus"])
    gaps = {c: any(b - a >= 3 for a, b in zip(sorted(y), sorted(y)[1:])) for c, y in years.items()}
    assert {r["o_custkey"]: r["has_revival_gap"] for r in own.queries()["lifecycle_gap"](spark, at).collect()} == gaps
    status = {r["e"]: r["status"] for r in own.queries()["term_status"](spark, at).collect()}
    assert {e for e, s in status.items() if s == "UNAVAILABLE"} == {e for e in status if not facts.get(e, set()) & {"P", "F"}}
    parts = {r["p_partkey"]: r["p_type"] for r in spark.read.parquet(f"{at}/part.parquet").collect()}
    found = own.queries()["equivalent_facts"](spark, at).collect()
    assert {(r["k"], r["filing"]) for r in found} == {(a, b) for a, x in parts.items() if a % 20 == 0 for b, y in parts.items() if x == y}
