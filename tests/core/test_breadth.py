"""Tables, whole documents, archives, journals, typed forms; and queries that SQL can't say, by brute force."""

import hashlib
import random
import zipfile
from itertools import combinations

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid import queries as own
from corvid.functions import documents as O
from corvid.functions import payload as Z
from corvid.functions import tables as B
from corvid.functions import text as X
from corvid.operators import family as Y
from corvid.operators import planning as P
from corvid.operators import progress as J
from corvid.operators import search as S
from corvid.operators import selection as L
from corvid.operators import statements as Q
from corvid.operators import versioning as V
from corvid.operators import viewer as W
from corvid.sources import archives as A
from corvid.sources import forms as M


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# Tables


def test_numbers():
    cells = {"1,234.50": 1234.5, "(7)": -7, "$ (1.5)": -1.5, "-3": -3, "12%": 12, "$9": 9, "": None, "—": None, "n/a": None, "Q3": None, "1 2": None, None: None}
    assert {c: B.number(c) for c in cells} == cells


def grid(*lines):
    return [line.split("|") for line in lines]


def test_arithmetic():
    t = B.typed(grid("|2030|2029", "Pens|5|1", "Ink|7|2", "Total supplies|12|3", "Desks|30|", "Chairs|8|4", "Total furniture|38|4", "Total|50|9"), "Costs")
    assert t.header == ("", "2030", "2029") and t.labels[0] == "Pens" and t.width == 2
    told = {(s.row, s.column): (s.first, s.holds) for s in B.arithmetic(t)}
    assert told[2, 0] == (0, True) and told[5, 0] == (3, True) and told[6, 0] == (2, True)
    assert told[2, 1] == (0, True) and not told[6, 1][1]
    order = random.Random(1)
    for _ in range(50):
        values = [order.randrange(-50, 90) for _ in range(order.randrange(2, 7))]
        t = B.typed([[f"row {k}", str(v)] for k, v in enumerate(values)] + [["Total", str(sum(values))], ["Total again", str(sum(values) + 500)]])
        first, second = B.arithmetic(t)
        assert first.holds and not second.holds


def test_classify_and_assemble():
    sheet = B.typed(grid("|2030", "Cash|5", "Other current assets|7", "Total assets|12", "Liabilities|4", "Stockholders' equity|8"), "Position")
    more = B.typed(grid("Notes due|3", "Leases|1"))
    flows = B.typed(grid("|2030", "Operating activities|5", "Investing activities|-2", "Financing activities|1"))
    weak = B.typed(grid("|2030", "Total assets|5", "Liabilities|1"), "Summary")
    signed = B.typed(grid("/s/ A. Person|2030"))
    empty = B.typed(grid("x|y"))
    assert B.classify(sheet)[0] == "balance_sheet" and B.classify(flows)[0] == "cash_flow" and B.classify(signed) == ("signature", 0.0) and B.classify(empty) == ("furniture", 0.0)
    assert B.classify(more)[0] == "residual" and B.evidence(sheet)["balance_sheet"] > B.evidence(weak)["balance_sheet"] >= B.FLOOR
    # a confirmed sum adds to a family that has words, and not to one without
    assert B.evidence(sheet)["balance_sheet"] - sum({"total assets": 3, "liabilities": 2, "stockholders equity": 2, "current assets": 1, "cash": 0.5}.values()) in (0, 0.5)
    got = B.assemble([weak, sheet, more, flows, signed])
    assert [(g.family, g.tables) for g in got] == [("residual", [0]), ("balance_sheet", [1, 2]), ("cash_flow", [3]), ("signature", [4])]
    assert B.assemble([]) == []


def test_partition_kind():
    """Against every subset."""
    order = random.Random(6)
    seen = set()
    for _ in range(200):
        values = {f"m{k}": order.randrange(1, 40) for k in range(order.randrange(1, 9))}
        total = order.randrange(1, sum(values.values()) + 10)
        whole, kind = sum(values.values()), O.partition_kind(values, total)
        some = any(sum(c) == total for n in range(len(values)) for c in combinations(values.values(), n))
        assert kind == ("CLEAN" if whole == total else "INCOMPLETE" if whole < total else "OVERLAPPING" if some else "OVER_UNEXPLAINED")
        seen.add(kind)
    assert len(seen) == 4
    assert O.partition_kind({str(k): 2.0 for k in range(30)}, 31.0) == "OVER_UNEXPLAINED" and O.partition_kind({str(k): 2.0 for k in range(30)}, 32.0) == "OVERLAPPING"
    assert O.partition_kind({str(k): 2.0 for k in range(50)}, 32.0) == "OVER_UNDECIDED"
    assert O.partition_kind({"a": 5.0, "b": 2.0, "c": 3.0}, 5.0, [("a", "b"), ("a", "c")]) == "NESTED"


# Documents

FILING = """NORTH COVE MILLS
Commission File Number: 77-123
Annual report ☒ yes ☐ no

INDEX
Item 1. Business .... 3
Item 2. Property .... 5
Item 3. Disputes .... 9

Item 1. Business
The mill turns oats into flour, and it has done so since the river was
dammed; nothing else is made there.

Note 1. Basis
All of it is in thousands.
Item 2. Property
One mill.
Item 3. Disputes
None.
SIGNATURES
A. Miller
"""


def test_normalize_document(spark):
    n = O.normalize_document(FILING.encode())
    lines = n.text.split("\n")
    assert n.kind == "ascii" and "[X] yes [ ] no" in n.text and "made there" in n.text
    assert [(i, lines[a - 1].split(". ")[0]) for i, _, a, _ in n.sections] == [("1", "Item 1"), ("2", "Item 2"), ("3", "Item 3")]
    assert n.contents is not None and n.cover[1] <= n.contents[0] and lines[-1] == "A. Miller"
    assert any("since the river was dammed" in x for x in lines)
    empty = O.normalize_document(b"")
    assert (empty.text, empty.sections, empty.notes) == ("", (), ())
    html = O.normalize_document(("<html><body>" + "".join(f"<p>{x}</p>" for x in FILING.split("\n")) + "</body></html>").encode())
    assert html.kind == "html" and [s[0] for s in html.sections] == ["1", "2", "3"]
    df = spark.createDataFrame([(1, FILING), (2, None), (3, "")], "k long, body string")
    got = {r["k"]: r for r in O.normalize_documents(df, "k", "body").collect()}
    assert [s["label"] for s in got[1]["sections"]] == ["1", "2", "3"] and got[1]["text"] == n.text and got[2]["text"] == got[3]["text"] == ""
    assert O.normalize_documents(df.limit(0), "k", "body").count() == 0


def test_forms(spark):
    long_cover = "\n".join(["line"] * 400 + ["CUSIP No.: 99X", "Item 2.02 Results", "They rose.", "Item 9.01 Papers", "None."])
    trade = """<ownershipDocument><nonDerivativeTransaction><securityTitle><value>Common</value></securityTitle><transactionDate><value>2031-02-03</value></transactionDate>
      <transactionCoding><transactionCode>P</transactionCode></transactionCoding><transactionAmounts><transactionShares><value>12.5</value></transactionShares><transactionPricePerShare><value>x</value></transactionPricePerShare></transactionAmounts>
      </nonDerivativeTransaction></ownershipDocument>"""
    df = spark.createDataFrame([(1, "8-K", long_cover), (2, "4", "<?xml version='1.0'?>" + trade), (3, "4", "<?xml version='1.0'?><a>"), (4, "10-D", "Item 1. Pool\nx\nItem 2. Y\nz"), (5, "F-N", "hello"), (6, "SUPPL", None)], "k long, form string, body string")
    got = M.form_rows(df, "k", "form", "body").cache()
    header = {r["k"]: r["fields"] for r in got.where("kind = 'header'").collect()}
    assert header[1]["CUSIP No."] == "99X"
    typed = M.typed_rows(got, "k", "ownership", "nonDerivativeTransaction").collect()
    assert [(r["k"], r["security"], str(r["transacted"]), r["code"], float(r["shares"]), r["price"]) for r in typed] == [(2, "Common", "2031-02-03", "P", 12.5, None)]
    assert [r["k"] for r in got.where("error is not null").collect()] == [3]
    assert [r["k"] for r in M.earnings(got, "k").collect()] == [1]
    assert {r["k"]: r["family"] for r in got.where("kind = 'header'").collect()} == {1: "current", 2: "ownership", 4: "asset_pool", 5: "foreign_notice", 6: "supplement"}
    before = dict(M.FAMILIES)
    try:
        M.register_family("house", M.Family(r"HOUSE-\d", ("room",)))
        assert M.family_of("house-7") == "house" and M.family_of("4") == "ownership"
    finally:
        M.FAMILIES.clear()
        M.FAMILIES.update(before)
    assert all(M.typed_rows(got, "k", *key).columns[:2] == ["k", "ordinal"] for key in M.TYPED)


# Archives, journals, plans


def test_archive_store(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for k in range(5):
            z.writestr(f"m{k}.txt", f"text {k}" * k)
    store = A.ArchiveStore(spark, f"file://{tmp_path}/store")
    digest = store.put(f"file://{tmp_path}/a.zip")
    assert digest == hashlib.sha256((tmp_path / "a.zip").read_bytes()).hexdigest() == store.put(f"file://{tmp_path}/a.zip")
    assert store.archives() == [digest] and store.verify(digest) and store.index(digest).count() == 5
    got = {r["member"]: (bytes(r["content"]) if r["content"] is not None else None, r["error"]) for r in store.read(digest, ["m3.txt", "none"]).collect()}
    assert got == {"m3.txt": (b"text 3" * 3, None), "none": (None, "no such member")}


def test_schema_and_footers(spark, tmp_path):
    spark.range(50).selectExpr("cast(id as int) as a", "id * 2 as b").write.parquet(f"{tmp_path}/a")
    schema = T.StructType([T.StructField("b", T.LongType()), T.StructField("a", T.LongType())])
    A.rewrite_schema(spark, f"{tmp_path}/a", f"{tmp_path}/b", schema)
    assert spark.read.parquet(f"{tmp_path}/b").dtypes == [("b", "bigint"), ("a", "bigint")]
    assert A.footer_stats(spark, f"{tmp_path}/b", "a") == {"rows": 50, "low": 0, "high": 49} and A.footer_stats(spark, f"{tmp_path}/b") == {"rows": 50}


def test_journal(spark, tmp_path):
    journal, units = J.Journal(spark, f"{tmp_path}/j"), spark.range(6).select(F.col("id").cast("string").alias("u"))

    def work(df):
        return df.where("u <> '5'").withColumn("bad", F.when(F.col("u") == "2", "no such thing"))

    journal.record(J.outcomes(units, "u", work, "bad"))
    assert sorted(rows(journal.counts())) == [("done", 4), ("failed", 1), ("lost", 1)]
    assert sorted(r["u"] for r in journal.open(units, "u").collect()) == ["2", "5"]
    journal.record(J.outcomes(journal.open(units, "u"), "u", lambda df: df.withColumn("bad", F.lit(None).cast("string")), "bad"))
    assert rows(journal.counts()) == [("done", 6)] and journal.open(units, "u").count() == 0


def test_refreshed(spark):
    """Only keys whose rows changed are computed again, and the result is that of all."""
    order = random.Random(7)
    before = [(order.randrange(20), k, order.randrange(9)) for k in range(80)]
    now = [r for r in before if r[0] != 3][5:] + [(25, 900, 1), (4, 901, 2)]
    kinds, seen = "k long, at long, v long", []

    def compute(df):
        seen.append({r["k"] for r in df.select("k").distinct().collect()})
        return df.groupBy("k").agg(F.sum("v").alias("s"))

    a, b = spark.createDataFrame(before, kinds), spark.createDataFrame(now, kinds)
    got = J.refreshed(b, a, compute(a), "k", ["at"], "v", compute)
    assert sorted(rows(got)) == sorted(rows(b.groupBy("k").agg(F.sum("v").alias("s"))))
    changed = {k for k in {r[0] for r in now} if sorted(r for r in now if r[0] == k) != sorted(r for r in before if r[0] == k)}
    assert seen[-1] == changed and len(changed) < 12


def test_remaining(spark):
    for bucket in (1, 7, 1_000_000):
        left = P.remaining(spark.range(100).toDF("k"), spark.range(0, 100, 3).toDF("k"), "k", 10, bucket).collect()
        chunks = {}
        for r in left:
            chunks.setdefault(r["chunk"], []).append(r["k"])
        assert sorted(k for c in chunks.values() for k in c) == [k for k in range(100) if k % 3] and all(len(c) <= 10 for c in chunks.values())
        assert sorted(chunks) == list(range(len(chunks)))


def test_totals_over_hops(spark):
    facts = [(1, "a", 1.0), (1, "b", 2.0), (1, "top", 10.0), (1, "d", 4.0), (2, "a", 5.0), (2, "ab", 9.0), (2, "b", 2.0)]
    arcs = spark.createDataFrame([("ab", "a", 1.0), ("ab", "b", 1.0), ("abc", "ab", 1.0), ("abc", "d", -1.0), ("top", "abc", 1.0)], "parent string, child string, weight double")
    got = sorted(rows(Q.evaluate_totals(spark.createDataFrame(facts, "k long, concept string, value double"), arcs, ["k"])))
    assert got == [(1, "a", 1.0, "REPORTED"), (1, "ab", 3.0, "DERIVED"), (1, "abc", -1.0, "DERIVED"), (1, "b", 2.0, "REPORTED"), (1, "d", 4.0, "REPORTED"), (1, "top", 10.0, "CONFLICT"), (2, "a", 5.0, "REPORTED"), (2, "ab", 9.0, "CONFLICT"), (2, "b", 2.0, "REPORTED")]


def test_strip_jurisdiction(spark):
    said = {"Mill Co /DE/": "Mill Co", "Mill Co/NY": "Mill Co", "Mill Co (New York)": "Mill Co", "Mill Co \\FL\\": "Mill Co", "A/B Mill": "A/B Mill", "Mill (2)": "Mill (2)", "": ""}
    df = spark.createDataFrame(list(said.items()), "a string, b string")
    assert df.where(X.strip_jurisdiction(F.col("a")) != F.col("b")).count() == 0


def test_publish_run(spark, tmp_path):
    journal, units = J.Journal(spark, f"{tmp_path}/j"), spark.range(3).select(F.col("id").cast("string").alias("u"))
    store, made = V.SnapshotStore(spark, f"{tmp_path}/s"), spark.range(5).toDF("k")
    journal.record(J.outcomes(units.where("u <> '2'"), "u", lambda df: df.withColumn("bad", F.when(F.col("u") == "1", "x")), "bad"))
    with pytest.raises(ValueError, match="1 keys without an outcome, 1 "):
        J.publish_run(store, journal, {"r": made}, {"r": "k"}, units)
    journal.record(J.outcomes(units.where("u = '2'"), "u", lambda df: df.withColumn("bad", F.lit(None).cast("string")), "bad"))
    node = J.publish_run(store, journal, {"r": made}, {"r": "k"}, units, allow_failures=True)
    assert store.tip() == node and store.parts("r", node)[0].count() == 5 and store.parts("outcomes", node)[0].count() == 3


def test_result_pages(spark):
    views = {"corvid_numbers": spark.range(23).toDF("k")}
    pages = list(W.result_pages(spark, "SELECT k FROM corvid_numbers ORDER BY k", views, 10))
    assert [len(p) for p in pages] == [10, 10, 3] and [r["k"] for p in pages for r in p] == list(range(23))
    assert [len(p) for p in W.result_pages(spark, "SELECT k FROM corvid_numbers WHERE k < 0", views, 10)] == [0]
    with pytest.raises(W.SqlGuardError):
        list(W.result_pages(spark, "DROP TABLE corvid_numbers", views, 10))


def test_payload(spark):
    df = spark.createDataFrame([("",), ("é" * 5000,), (None,)], "t string")
    frames = df.select("t", Z.compressed(F.col("t")).alias("z"))
    assert frames.where("length(z) > 200").count() == 0
    assert rows(frames.select("t", Z.decompressed(F.col("z")).cast("string").alias("u")).where("not t <=> u")) == []


def test_positioned_text():
    order = random.Random(9)
    cells = [(page, row, column) for page in range(2) for row in range(6) for column in range(4)]
    order.shuffle(cells)
    html, at = "<html><body>", 0
    for page in range(2):
        html += f'<div style="position:absolute; left:10px; top:{page and 5}pt{"; page-break-before: always" if page else ""}">'
        for p, row, column in cells:
            if p == page:
                html += f'<span style="position:absolute;left:{column}in;top:{row * 12 + order.random()}pt">p{p}r{row}<b>c{column}</b></span>'
        html += "</div>"
    lines = O.positioned_text(html + "</body></html>").split("\n")
    assert [line.replace(" ", "") for line in lines] == ["".join(f"p{p}r{r}c{c}" for c in range(4)) for p in range(2) for r in range(6) if True][:6] + [""] + ["".join(f"p1r{r}c{c}" for c in range(4)) for r in range(6)]
    assert len({line.index("c1") if "c1" in line else None for line in lines if line}) == 1
    assert O.positioned_text("<p>plain</p>") == ""
    assert O.normalize_document((html + "</body></html>").encode()).text.lstrip().startswith("p0r0")


def test_normalized_name(spark):
    said = {"1st Natl Banks of the U.S., Inc. /DE/": "first national bank of the us", "Intl Mfg Svcs Co": "international manufacturing service", "The Company Store LLC": "the company store", "Glass Works Ltd": "glass work", "": "", "Inc": "inc"}
    df = spark.createDataFrame(list(said), "string")
    assert {r[0]: r[1] for r in df.select("value", Y.normalized_name(F.col("value"))).collect()} == said


# Queries that SQL can't say


def test_median_anchors(spark):
    order = random.Random(3)
    data = [(f"f{order.randrange(4)}", k // 2, order.random(), order.choice([None, order.randrange(30)])) for k in range(400)]
    first = {}
    for f, d, o, s in sorted(data, key=lambda r: r[2]):
        if s is not None:
            first.setdefault(d, (f, s))
    want = {}
    for f, s in first.values():
        want.setdefault(f, []).append(s)
    middle = lambda x: (sorted(x)[(len(x) - 1) // 2] + sorted(x)[len(x) // 2]) / 2
    got = dict(rows(L.size_anchors(spark.createDataFrame(data, "f string, d long, o double, s long"), "f", "d", "o", "s")))
    assert got == {f: middle(x) for f, x in want.items()}


def test_chunk_documents(spark, sf):
    """Default windows over every document, against a plain cut."""
    want = set()
    for (text,) in duckdb.sql(f"SELECT DISTINCT coalesce(text, '') FROM '{sf}/documents.parquet'").fetchall():
        lines, k, n = text.splitlines(), 0, 0
        while k < len(lines):
            start, chars = k, 0
            while k < len(lines) and k - start < S.MAX_LINES and chars < S.MAX_CHARS:
                chars += len(lines[k]) + 1
                k += 1
            body = "\n".join(lines[start:k])
            want.add((hashlib.sha256(text.encode()).hexdigest(), n, start + 1, k, hashlib.sha256(body.encode()).hexdigest()))
            n += 1
    got = own.queries()["chunk_documents"](spark, sf).select("payload", "ordinal", "start_line", "end_line", "text_sha256").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_default_windows_search(spark, sf):
    """BM25, scans and extension with default windows, against plain Python on some long documents."""
    import math
    import re

    texts = {k: f"alpha beta {k}\n" * (150 * k) + "gamma\n" * k for k in range(1, 5)}
    docs = spark.createDataFrame(list(texts.items()), "doc long, text string")
    index = S.Index.build(docs.where("doc < 3")).extend(docs)
    chunks = [(r["payload"], r["chunk_text"], r["start_line"]) for r in index.chunks.collect()]
    assert len(chunks) > 8 and index.terms.where("term = 'gamma'").first()["chunk_frequency"] == sum("gamma" in c for _, c, _ in chunks)
    words = lambda t: [w for w in re.findall("[a-z0-9]+", t.lower()) if len(w) >= 2]
    mean = sum(len(words(c)) for _, c, _ in chunks) / len(chunks)
    df = sum("gamma" in words(c) for _, c, _ in chunks)
    idf = math.log(1 + (len(chunks) - df + 0.5) / (df + 0.5))
    want = []
    for payload, c, start in chunks:
        if n := words(c).count("gamma"):
            want.append((round(n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(words(c)) / mean)) * idf, 6), start))
    meta = docs.select("doc", F.sha2("text", 256).alias("payload"))
    got = [(round(r["score"], 6), r["start_line"]) for r in S.bm25("Gamma", index, meta).collect()]
    assert sorted(got) == sorted(want) and S.bm25("", index, meta).count() == 0
    assert S.scan(index.chunks, meta, "GAMMA", "exact").count() == df


def test_index_saved(spark, tmp_path):
    docs = spark.createDataFrame([(1, "one two"), (2, "two three")], "doc long, text string")
    S.Index.build(docs).save(f"{tmp_path}/i")
    again = S.Index.load(spark, f"{tmp_path}/i")
    assert rows(again.terms.select("term", "chunk_frequency"), "term") == [("one", 1), ("three", 1), ("two", 2)] and again.postings.count() == 4


def test_stratified_selection(spark, sf):
    """The query's choice keeps its promises on the whole table: size, seeds, floor, share, reserve, and equal cells as far as caps let them be."""
    got = own.queries()["stratified_selection"](spark, sf).collect()
    chosen = [r for r in got if r["reason"] != "reserve"]
    assert len(chosen) == 100 and len(got) == 110 and len({r["o_orderkey"] for r in got}) == 110
    there = {r[0] for r in duckdb.sql(f"SELECT o_orderkey FROM '{sf}/orders.parquet' WHERE o_orderkey IN (1, 2)").fetchall()}
    assert {r["o_orderkey"] for r in got if r["reason"] == "seed"} == there
    values = [r["o_orderpriority"] for r in chosen]
    assert values.count("1-URGENT") >= 10 and all(values.count(v) <= 40 for v in set(values))
    cells = [r["cell"] for r in chosen]
    sizes = [cells.count(c) for c in set(cells)]
    assert max(sizes) - min(sizes) <= 3 + len(there)


@pytest.mark.parametrize("column", ["o_orderkey", "o_custkey", "o_orderstatus"])
def test_approx_distinct(spark, sf, column):
    got = {r["column"]: r for r in own.queries()["approx_distinct"](spark, sf).collect()}[column]
    ((exact,),) = duckdb.sql(f"SELECT count(DISTINCT {column}) FROM '{sf}/orders.parquet'").fetchall()
    assert abs(got["distinct"] - exact) <= max(1, 0.1 * exact)


def test_equivalent_facts_spread(spark, monkeypatch):
    """Pairs by brute force, with nulls, repeats and several equivalents; no task makes all rows of a frequent concept."""
    from collections import Counter

    monkeypatch.setattr(P, "BLOCK", 8)
    draw = random.Random(11)
    some = [(draw.choice([k, None, 7]), draw.choice(["hot"] * 8 + ["cold", "lone", None]), draw.choice(["USD", "shares", None]), draw.choice([True, False, None]), draw.choice([1, 2, None])) for k in range(200)]
    facts = spark.createDataFrame(some, "filing long, concept string, unit string, instant boolean, dims int").coalesce(1)
    same = [("hot", "hot", "exact"), ("hot", "cold", "near"), ("cold", "hot", "near"), ("none", "lone", "exact")]
    source = facts.where("filing % 3 = 0").withColumnRenamed("filing", "k")

    def verdict(a, b):
        differ = lambda x, y: x is not None and y is not None and x != y
        return "unit" if differ(a[2], b[2]) else "period" if differ(a[3], b[3]) else "dimensions" if a[4] != b[4] else "comparable"

    want = Counter((a[0], b[0], tier, verdict(a, b)) for a in some if a[0] is not None and a[0] % 3 == 0 for x, y, tier in same if x == a[1] for b in some if b[1] == y)
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        found = P.equivalent_facts(source, facts, spark.createDataFrame(same, "concept string, equivalent string, tier string"), "k")
        assert found.columns == ["k", "filing", "tier", "verdict"]
        assert Counter(tuple(r) for r in found.collect()) == want
        tasks = Counter(r["t"] for r in found.where("tier = 'exact'").select(F.spark_partition_id().alias("t")).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    assert len(tasks) > 4 and max(tasks.values()) < sum(tasks.values()) / 2
