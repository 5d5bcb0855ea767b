"""Concept names, staged writes, full selection, and the parsers of series pages, packages and summaries."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from corvid.functions import concepts as K
from corvid.operators import selection as L
from corvid.operators import statements as Q
from corvid.sources import filings as P
from corvid.sources import readers as E


def test_numbers_and_periods():
    said = {"two hundred and five": 205, "twenty one": 21, "three thousand four hundred": 3400, "12 million": 12_000_000, "nineteen": 19}
    for text, value in said.items():
        assert K.number_phrase(text.split()) == (value, len(text.split()))
    assert K.number_phrase(["no"]) is None and K.number_phrase("five apples".split()) == (5, 1)
    assert K.temporal("in the third quarter".split()) == ("quarter", 3) and K.temporal("two years later".split()) == ("days", 730) and K.temporal(["none"]) is None


def test_decompose():
    heads, mods = {"assets": "Assets", "income": "Income"}, {"current": "Current", "net": "Net", "income tax": "IncomeTax"}
    atom, rest = K.decompose("us-gaap:NetIncomeTaxAssetsCurrentFoo", heads, mods)
    assert atom == K.Atom("Assets", frozenset({"Net", "IncomeTax", "Current"})) and rest == ("foo",)
    assert K.decompose("Nothing", heads, mods) == (None, ("nothing",))
    a, b, c = K.Atom("h"), K.Atom("h", frozenset("x")), K.Atom("g", frozenset("x"))
    assert b.is_a(a) and not a.is_a(b) and a.meet(b) == b and a.join(b) == a and a.meet(c) is None
    assert K.most_specific([a, b, c]) == [b, c] and K.most_general([a, b, c]) == [a, c]
    assert K.compounds(["total", ""], ["assets"]) == ("total assets", "assets")
    assert K.heal_dates(["ended December", "31, 2023", "next"]) == ["ended December 31, 2023", "next"]


def test_fact_query(spark):
    kind = "concept string, value double, unit string, start date, end date, dims map<string,string>, text string"
    d = lambda x: __import__("datetime").date.fromisoformat(x)
    facts = spark.createDataFrame([("us:Sales", 10.0, "USD", d("2023-01-01"), d("2023-12-31"), {}, None), ("us:Sales", 20.0, "USD", d("2024-01-01"), d("2024-12-31"), {"ax": "m"}, None), ("us:Cash", 5.0, "USD", None, d("2024-12-31"), None, "Held in a bank")], kind)
    assert Q.FactQuery(facts).concept("*Sales").latest_period().frame().count() == 1
    assert Q.FactQuery(facts).concept("us:Cash").face_only().text_contains("BANK").frame().count() == 1
    assert Q.FactQuery(facts).member("ax", "m").close_to(20.1).frame().count() == 1 and Q.FactQuery(facts).unit("EUR").frame().count() == 0
    assert Q.FactQuery(facts).period("2023-12-31", "2023-01-01").frame().count() == 1


def test_chain_refuses_double_counting(spark):
    facts = spark.createDataFrame([(1, "A", 5.0), (1, "B", 2.0)], "k long, concept string, value double")
    arcs = spark.createDataFrame([("A", "X"), ("X", "B")], "a string, b string")
    with pytest.raises(ValueError, match="twice"):
        Q.chain(facts, ["k"], [(1, "A"), (1, "B")], arcs)
    assert Q.chain(facts, ["k"], [(1, "A"), (-1, "B")]).first()["value"] == 3.0
    assert Q.chain(facts, ["k"], [(1, "A"), (1, "C")]).first()["missing"] == ["C"]


def test_stratified(spark):
    pool = spark.createDataFrame([(k, f"c{k % 5}", "rare" if k % 50 == 0 else "common") for k in range(500)], "k long, cell string, d string")
    got = L.stratified(pool, "k", "cell", "d", 40, {"rare": 5}, 0.9, "s", 7, [3]).collect()
    assert sum(r["reason"] != "reserve" for r in got) == 40 and sum(r["reason"] == "reserve" for r in got) == 7
    assert sum(r["d"] == "rare" for r in got if r["reason"] != "reserve") >= 5 and [r["k"] for r in got if r["reason"] == "seed"] == [3]
    again = L.stratified(pool.repartition(7), "k", "cell", "d", 40, {"rare": 5}, 0.9, "s", 7, [3]).collect()
    assert sorted(got) == sorted(again)


def test_staged_writer(spark, tmp_path):
    writer = E.StagedWriter(spark, f"file://{tmp_path}/out", "k")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    writer.append(df)
    E.StagedWriter(spark, f"file://{tmp_path}/out", "k").append(df.unionByName(df.limit(1).withColumn("k", F.lit(3).cast("long"))))
    with pytest.raises(ValueError):
        writer.commit(5)
    assert writer.commit(3) == 3 and spark.read.parquet(f"{tmp_path}/out").count() == 3


def test_other_parsers():
    page = b"<table><tr><td>0000000012</td></tr><tr><td></td><td>S000000001</td><td>Fund A</td></tr><tr><td></td><td></td><td>C000000002</td><td>Class I</td><td>TICK</td></tr></table>"
    assert P.parse_series_page(page) == [{"cik": "0000000012", "series_id": "S000000001", "series_name": "Fund A"}, {"cik": "0000000012", "series_id": "S000000001", "series_name": "Fund A", "class_id": "C000000002", "class_name": "Class I", "ticker": "TICK"}]
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("a.xsd", "x")
    assert P.parse_package(buffer.getvalue())[0]["filename"] == "a.xsd"
    summary = b"<FilingSummary><MyReports><Report><ShortName>Cover</ShortName><HtmlFileName>R1.htm</HtmlFileName></Report></MyReports><InputFiles><File>a.htm</File></InputFiles></FilingSummary>"
    assert [(r["table_kind"], r["filename"]) for r in P.parse_filing_summary(summary)] == [("InputFiles", "a.htm"), ("Report", "R1.htm")]
    pem = b"-----BEGIN PRIVACY-ENHANCED MESSAGE-----\nProc-Type: 2001\n\n<DOCUMENT>\n<TYPE>4\n<TEXT>\nx\n</TEXT>\n</DOCUMENT>\n-----END PRIVACY-ENHANCED MESSAGE-----\n"
    assert P.parse_bundle(pem)[0]["body"] == "x"


def test_forms(spark):
    from corvid.sources import forms as M

    assert [M.family_of(f) for f in ("4/A", "13F-HR", "SC 13G/A", "10-K405", "424B5", "N-PX", "XYZ", "")] == ["ownership", "holdings", "beneficial", "annual", "prospectus", "proxy_votes", "other", "other"]
    xml = b"<?xml version='1.0'?><ownershipDocument><issuer><name>A</name></issuer><reportingOwner><id>1</id></reportingOwner><nonDerivativeTransaction><shares><value>5</value></shares><shares><value>6</value></shares></nonDerivativeTransaction></ownershipDocument>"
    family, rows = M.parse_form(xml, "4")
    assert family == "ownership" and rows[0] == ("header", 0, {"issuer/name": "A"}) and rows[2] == ("nonDerivativeTransaction", 1, {"shares/value": "5", "shares/value[2]": "6"})
    text = b"FORM 10-K\nCommission File Number: 001-123\nFor the fiscal year ended December 31, 2023\n\nItem 1. Business\nx\nItem 2. Properties\ny\n"
    _, rows = M.parse_form(text, "10-K")
    assert rows[0][2] == {"Commission File Number": "001-123", "For the fiscal year ended": "December 31, 2023"} and [r[2]["item"] for r in rows[1:]] == ["1", "2"]
    bad = M.form_rows(spark.createDataFrame([(1, "4", "<?xml version='1.0'?><a>")], "k long, form string, t string"), "k", "form", "t").first()
    assert bad["error"].startswith("ParseError")


def test_manifest(tmp_path):
    import hashlib

    from corvid.operators.planning import validate_manifest

    (tmp_path / "a").write_bytes(b"one")
    (tmp_path / "b").write_bytes(b"two")
    good = [{"path": "a", "bytes": 3, "sha256": hashlib.sha256(b"one").hexdigest()}, {"path": "b", "bytes": 3}]
    assert validate_manifest(tmp_path, good) == []
    bad = [{"path": "b", "bytes": 9}, {"path": "a", "sha256": "x"}, {"path": "../c"}, {"path": "z"}]
    assert [x.split(": ")[1] for x in validate_manifest(tmp_path, bad)] == ["3 bytes, not 9", "not after b", "digest", "outside the root", "missing"]
