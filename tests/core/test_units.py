"""Single operators on small frames: the golden cases, refusals and edge cases."""

import io
import json
import random
import tarfile
import zipfile
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from corvid.functions import dates as D
from corvid.functions import documents as O
from corvid.functions import text as X
from corvid.operators import cohorts as C
from corvid.operators import facts as A
from corvid.operators import family as Y
from corvid.operators import graph as G
from corvid.operators import nested as N
from corvid.operators import relational as R
from corvid.operators import search as S
from corvid.operators import selection as L
from corvid.operators import versioning as V
from corvid.operators import viewer as W
from corvid.sources import filings as P
from corvid.sources import readers as E
from corvid.streaming import ledger as T


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# Cohorts


def cohort(spark, members):
    return spark.createDataFrame([(7 * k, f"{key:010d}", name) for k, (key, name) in enumerate(members.items())], "ordinal long, key string, name string")


def python_sets(op, held):
    """A parsed expression over Python dictionaries: keys as sets, names from the left side, in a union from the right one where that has none."""
    if isinstance(op, str):
        return held[op]
    a, b = python_sets(op.left, held), python_sets(op.right, held)
    keys = {"union": a.keys() | b.keys(), "intersect": a.keys() & b.keys(), "difference": a.keys() - b.keys()}[op.kind]
    return {k: a.get(k) or (b.get(k) if op.kind == "union" else "") or "" for k in keys}


def test_set_algebra(spark):
    """Random expressions over random cohorts agree with Python's sets; results are numbered by key."""
    order = random.Random(3)
    held = {n: {order.randrange(40): order.choice(["", f"{n}-name"]) for _ in range(size)} for n, size in (("alpha", 25), ("beta", 18), ("gamma", 9), ("none", 0))}
    frames = {n: cohort(spark, m) for n, m in held.items()}

    def text(depth):
        if depth == 0 or order.random() < 0.2:
            return order.choice([*held])
        return f"({text(depth - 1)} {order.choice('+&-')} {text(depth - 1)})"

    for _ in range(6):
        said = text(3)
        want = python_sets(C.parse_expression(said), held)
        assert rows(C.evaluate(said, frames), "ordinal") == [(k, f"{key:010d}", want[key]) for k, key in enumerate(sorted(want))], said
    a, b = held["alpha"].keys(), held["beta"].keys()
    counts = C.diff_counts(frames["alpha"], frames["beta"]).first().asDict()
    assert counts == {"left_total": len(a), "right_total": len(b), "both": len(a & b), "left_only": len(a - b), "right_only": len(b - a), "either": len(a | b)}


def test_expressions():
    """Only names, three operators and parentheses; limits on length and size hold at their edges."""
    assert C.parse_expression("p & q - r + s") == C.parse_expression("p & ((q - r) + s)") != C.parse_expression("(p & q) - r + s")
    deep = "x"
    for _ in range(60):
        deep = f"({deep}) - y"
    assert isinstance(C.parse_expression(deep), C.Op)
    for refused in ("7", "'p'", "p | q", "p ^ q", "p / q", "-p", "not p", "p if q else r", "p; q", "p == q", "lambda: p", "p[0]", "{p}", "p(q)", "p.q", "(p", "\n", "import os", "+".join(["p"] * 200), "p" * (C.MAX_CHARS + 1)):
        with pytest.raises(ValueError):
            C.parse_expression(refused)


# Versioning


def test_merge_strategies(spark):
    old, new = spark.createDataFrame([(1, "done"), (None, "x")], "k long, v string"), spark.createDataFrame([(1, "late"), (2, "new")], "k long, v string")
    up = rows(V.active(V.RelationSpec("r", ("k",)), [old, new]).select("k", "v"), "k")
    assert up == [(None, "x"), (1, "late"), (2, "new")]
    assert (1, "done") in rows(V.active(V.RelationSpec("r", ("k",), "append"), [old, new]).select("k", "v"))


def test_scoped_mask(spark):
    """Children stand with the part their parent won with, whatever the order of the specs: random parts against plain Python."""
    order = random.Random(5)
    parents = [[p for p in range(12) if order.random() < 0.5] for _ in range(4)]
    children = [[(p, order.randrange(9), f"v{k}-{p}") for p in range(12) for _ in range(order.randrange(3))] for k in range(4)]
    won = {p: max(k for k, part in enumerate(parents) if p in part) for p in range(12) if any(p in part for part in parents)}
    want = sorted(c for k, part in enumerate(children) for c in part if won.get(c[0]) == k)
    specs = [V.RelationSpec("leaf", ("p", "c"), "scoped_mask", parent="stem", parent_key=("p",)), V.RelationSpec("stem", ("p",))]
    frames = {"leaf": [spark.createDataFrame(part, "p int, c int, said string") for part in children], "stem": [spark.createDataFrame([(p,) for p in part], "p int") for part in parents]}
    for some in (specs, specs[::-1]):
        assert sorted(rows(V.resolve(some, frames)["leaf"].drop(V.ORD))) == want
    with pytest.raises(ValueError):
        V.resolve([V.RelationSpec("leaf", ("p",), "scoped_mask", parent="nowhere", parent_key=("p",))], {"leaf": frames["leaf"]})


def test_compaction(spark, tmp_path):
    df = spark.createDataFrame([(k % 7 if k % 10 else None, k) for k in range(100)], "k long, v long")
    again = V.compact(df, f"{tmp_path}/c", "k", ["k", "v"], 30)
    assert V.fingerprint(df, ["k", "v"]).collect() == V.fingerprint(again, ["k", "v"]).collect()
    parts = V.part_numbers(df, "k", 30).collect()
    assert len({r["k"] for r in parts}) == len(parts) == 8 and max(r["part"] for r in parts) >= 2
    for some in ({"bucket_keys": 1}, {"bucket_keys": 3}, {"bucket": F.floor(F.col("k") / 4)}):
        assert sorted(map(str, V.part_numbers(df, "k", 30, **some).collect())) == sorted(map(str, parts))


def test_snapshot_store(spark, tmp_path):
    store = V.SnapshotStore(spark, str(tmp_path))
    a = spark.createDataFrame([("a", 1), ("m", 2)], "k string, v long")
    first = store.publish({"r": a}, {"r": "k"})
    second = store.publish({"r": a.limit(1).withColumns({"k": F.lit("z"), "v": F.lit(9).cast("long")})}, {"r": "k"}, parent=first)
    assert store.lineage(second) == [first, second] and store.tip() == second
    assert len(store.parts("r", second)) == 2 and len(store.parts("r", second, "x", "zz")) == 1
    with pytest.raises(V.StaleParentError):
        store.publish({"r": a}, {"r": "k"}, parent=first)
    lost = store.publish({"r": a}, {"r": "k"}, branch="other")
    assert store.garbage() == []
    store.files.delete("branches/other")
    assert store.garbage() == [lost] and store.garbage([lost]) == []


@pytest.mark.parametrize("kind, low, high", [("int", 5, 7), ("bigint", 0, 0), ("decimal(12,2)", Decimal("9.5"), Decimal("10.00")), ("double", -3.0, 2.5), ("date", date(2024, 1, 9), date(2024, 1, 11))])
def test_snapshot_bounds(spark, tmp_path, kind, low, high):
    """Bounds order like the key, not like its text: no part that holds a key of the range is left out, and others are."""
    store = V.SnapshotStore(spark, f"file://{tmp_path}")
    value = F.expr("date_add(date'2024-01-01', cast(id as int))") if kind == "date" else F.col("id").cast(kind)
    whole, node = spark.range(-20, 120).select(value.alias("k"), F.col("id").alias("v")), None
    for start in range(-20, 120, 8):
        node = store.publish({"r": spark.range(start, start + 8).select(value.alias("k"), F.col("id").alias("v"))}, {"r": "k"}, parent=node)
    got = store.lookup(V.RelationSpec("r", ("k",)), node, low, high).select("k", "v")
    assert rows(got, "v") == rows(whole.where(F.col("k").between(F.lit(low), F.lit(high))), "v") != []
    assert 1 <= len(store.parts("r", node, low, high)) <= 2
    assert low == high or store.lookup(V.RelationSpec("r", ("k",)), node, high, low).count() == 0


def test_snapshot_race(spark, tmp_path):
    """Of two publishers that both passed the first look at the branch one wins."""
    store, a = V.SnapshotStore(spark, str(tmp_path)), spark.createDataFrame([(1, 2)], "k long, v long")
    first = store.publish({"r": a}, {"r": "k"})
    other = V.SnapshotStore(spark, str(tmp_path))
    put = store.files.put
    store.files.put = lambda name, text: (put(name, text), other.publish({"r": a}, {"r": "k"}, parent=first) if name.startswith("nodes/") else None)
    with pytest.raises(V.StaleParentError):
        store.publish({"r": a}, {"r": "k"}, parent=first)
    assert store.lineage(store.tip())[0] == first and len(store.lineage(store.tip())) == 2
    claims = [store.files.claim("branches/main/0000000009", str(k)) for k in range(3)]
    assert claims == [True, False, False] and store.files.read("branches/main/0000000009") == "0"


def test_changed_rows(spark):
    kind = "k long, v string"
    old = spark.createDataFrame([(1, "done"), (3, None)], kind)
    assert rows(R.changed_rows(spark.createDataFrame([(1, "done")], kind), old, ["k"], ["v"])) == []
    got = rows(R.changed_rows(spark.createDataFrame([(1, "x"), (2, "pending"), (3, None)], kind), old, ["k"], ["v"]), "k")
    assert got == [(1, "x", "changed"), (2, "pending", "added")]


def test_keyed_diff_with_null_keys(spark):
    kind = "a long, b string, v string"
    base, new = spark.createDataFrame([(1, None, "x"), (2, "q", "y")], kind), spark.createDataFrame([(1, None, "z"), (3, None, "w")], kind)
    assert rows(R.keyed_diff(base, new, ["a", "b"], ["v"]), "a") == [(1, None, "changed"), (2, "q", "removed"), (3, None, "added")]


def test_ordinal_and_order(spark):
    df = spark.createDataFrame([(k, k // 10) for k in range(100)], "k long, b long")
    assert rows(R.with_ordinal(df, [F.col("k")], F.col("b")).select("k", "ordinal"), "k") == [(k, k) for k in range(100)]
    dup = spark.createDataFrame([(1, 5), (2, 5), (3, 6)], "pos long, x long").withColumn("p", F.lit(0))
    assert [r["pos"] for r in R.order_violations(dup, "pos", ["x"], ["p"]).collect()] == [2]


def test_graphs(spark):
    """Random graphs against plain walks: closure, reach, cycles, selected pairs; and merged lineages, with and without a cycle."""
    order = random.Random(8)
    for n, m in ((9, 12), (14, 10)):
        edges = {(order.randrange(n), order.randrange(n)) for _ in range(m)}
        e = spark.createDataFrame(sorted(edges), "a int, b int")
        want = set(edges)
        while more := {(a, d) for a, b in want for c, d in edges if b == c} - want:
            want |= more
        assert set(rows(G.closure(e))) == want and G.closure(e).count() == len(want)
        assert sorted(rows(G.on_cycles(e))) == sorted((a,) for a, b in want if a == b)
        some = [order.randrange(n) for _ in range(4)]
        starts = spark.createDataFrame([(x,) for x in some], "x int")
        assert set(rows(G.reached(e, starts))) == {p for p in want if p[0] in some}
        assert set(rows(G.double_counted(e, starts))) == {p for p in want if p[0] in some and p[1] in some}
    # a ladder of diamonds has 2 ** 40 paths and 82 nodes
    ladder = [(f"{side}{k}", f"{up}{k + 1}") for k in range(40) for side in "lr" for up in "lr"] + [("l40", None), ("r40", None)]
    walk = {r["id"]: r["depth"] for r in G.ancestors(spark.createDataFrame(ladder, "id string, parent string"), "l0").collect()}
    assert len(walk) == 81 and walk["r40"] == 40 and walk["l0"] == 0
    with pytest.raises(ValueError):
        G.ancestors(spark.createDataFrame([("p", "q"), ("q", "r"), ("r", "q")], "id string, parent string"), "p")
    assert rows(G.orphans(spark.createDataFrame([("p", "q"), ("q", None), ("s", "t")], "id string, parent string")).select("id")) == [("s",)]


# Dates and text


def test_date_grammar(spark):
    """Terms select the days that their words say: every day of some years, against plain rules."""
    days = [date(2015, 1, 1) + timedelta(k) for k in range(365 * 7 + 2)]
    quarter = lambda d: (d.month + 2) // 3
    cases = {
        "2017": lambda d: d.year == 2017,
        "2016Q4": lambda d: d.year == 2016 and quarter(d) == 4,
        "2016-11..2017Q2": lambda d: date(2016, 11, 1) <= d <= date(2017, 6, 30),
        "..2015-06": lambda d: d <= date(2015, 6, 30),
        "2020-03..": lambda d: d >= date(2020, 3, 1),
        "2018Q1, 2018-04, 2019..2019Q3": lambda d: date(2018, 1, 1) <= d <= date(2018, 4, 30) or date(2019, 1, 1) <= d <= date(2019, 9, 30),
        "@M7": lambda d: d.month == 7,
        "@Q3[2018..], 2016-02": lambda d: quarter(d) == 3 and d.year >= 2018 or (d.year, d.month) == (2016, 2),
        "@M2[..2017], @M3[2016..2019]": lambda d: d.month == 2 and d.year <= 2017 or d.month == 3 and 2016 <= d.year <= 2019,
    }
    df = spark.createDataFrame([(str(d),) for d in days], "d string")
    for text, rule in cases.items():
        assert {r["d"] for r in df.where(D.date_predicate(F.col("d"), D.parse_dates(text))).collect()} == {str(d) for d in days if rule(d)}, text
    # the same days in other words are the same selection, and all days are none
    assert D.parse_dates("2018-01..2018-03,2018Q2") == D.parse_dates("2018Q1,2018-04..2018-06") == D.parse_dates("2018-01..2018Q2")
    assert D.parse_dates("..2018,2019..") == D.parse_dates("") == ()
    for refused in ("soon", "M7", "@M0", "@Q7", "@M7[2016]", "@M7[..]", "2019-00", "2019Q0", "2019..2018", "2018,", ",", "2021-02-29", "@Q2[2019..2018]"):
        with pytest.raises(ValueError):
            D.parse_dates(refused)


def test_date_predicate_drops_missing(spark):
    df = spark.createDataFrame([("2024-02-01",), ("bad",), (None,)], "d string")
    assert df.where(D.date_predicate(F.col("d"), ())).count() == 3
    assert df.where(D.date_predicate(F.col("d"), D.parse_dates("2024"))).count() == 1


def test_text(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(X.form_family(F.lit("10-k/a"))) == "10-K" and one(X.form_family(F.lit("/A"))) == "/A"
    assert one(X.accession_digits(F.lit("0000320193-24-000123"))) == "000032019324000123" and one(X.accession_digits(F.lit("12"))) is None
    assert one(X.accession_year(F.lit("0000320193-94-000123"))) == 1994
    assert one(X.archive_path(F.lit("320193"), F.lit("0000320193-24-000123"), F.lit("  ")))["path"] == "data/320193/000032019324000123/0000320193-24-000123.txt"
    assert one(X.split_camel(F.lit("NetIncomeLossEPS2"))) == ["Net", "Income", "Loss", "EPS2"]
    assert one(X.normalize(F.lit("“a”  ’b’​"))) == "\"a\" 'b'"
    assert [one(X.cell_value(F.lit(v))) for v in ("$ (1,234.5)", "12%", "—", "abc", "1,23")] == [-1234.5, 12.0, None, None, None]
    assert [one(X.roman_value(F.lit(v))) for v in ("XIV", "mcmxcix", "iiii", "")] == [14, 1999, None, None]
    assert one(D.parse_date(F.lit("March 5, 2024"))) == date(2024, 3, 5) and one(D.parse_date(F.lit("no"))) is None
    import re

    words = ["net", "network", "new", "a.b", "income"]
    assert all(re.fullmatch(X.alternation(words), w) for w in words) and not re.fullmatch(X.alternation(words), "ne")


# Selection


def test_size_anchors_and_bands(spark):
    df = spark.createDataFrame([("10-K", "a", 1, 1000), ("10-K", "b", 1, 2000), ("4", "c", 1, 3000), ("4", "d", 1, 4000), ("10-K", "a", 2, 9000)], "f string, d string, o long, s long")
    assert rows(L.size_anchors(df, "f", "d", "o", "s"), "f") == [("10-K", 1500.0), ("4", 3500.0)]
    sizes = spark.createDataFrame([(10,), (50,), (250,), (1250,), (6250,), (None,)], "s long")
    assert [r[0] for r in sizes.select(L.size_band(F.col("s"), F.lit(250.0))).collect()] == ["very_small", "very_small", "median", "large", "very_large", "unknown"]


def test_water_fill():
    """Against handing out one at a time to the lowest cell with room."""
    order = random.Random(4)
    for _ in range(300):
        cells = [(f"c{k}", order.randrange(8), order.randrange(10)) for k in range(order.randrange(7))]
        budget = order.randrange(40)
        level = {n: filled for n, filled, _ in cells}
        room = {n: free for n, _, free in cells}
        for _ in range(budget):
            if open_ := [n for n, *_ in cells if room[n]]:
                lowest = min(open_, key=level.__getitem__)  # the first of the lowest
                level[lowest] += 1
                room[lowest] -= 1
        got = L.water_fill(cells, budget)
        assert sorted(filled + got[n] for n, filled, _ in cells) == sorted(level.values())
        assert sum(got.values()) == min(budget, sum(f for *_, f in cells)) and all(0 <= got[n] <= f for n, _, f in cells)
    assert L.share_capped([(str(k), "x" if k < 8 else "y") for k in range(12)], 6, 0.5) == ["0", "1", "2", "8", "9", "10"]


# Search


def test_search(spark):
    docs = spark.createDataFrame([(1, "f1", "Revenue grew.\nLiquidity is fine."), (2, "f1", "no such word, revenue revenue"), (3, "f2", "other revenue"), (4, "f2", "other revenue")], "doc long, filing string, text string")
    index = S.Index.build(docs)
    meta = docs.select("doc", "filing", F.sha2("text", 256).alias("payload"))
    hits = S.bm25("Revenue", index, meta).collect()
    assert len(hits) == 4 and all(h["score"] > 0 for h in hits) and {h["doc"] for h in hits} == {1, 2, 3, 4}
    assert index.chunks.count() == 3
    assert [h["doc"] for h in S.scan(index.chunks, meta, "REVENUE grew", "exact").collect()] == [1]
    assert [h["doc"] for h in S.scan(index.chunks, meta, r"[Ll]iquid\w+", "regex").collect()] == [1]
    for bad in (("([", "regex"), ("x", "fuzzy")):
        with pytest.raises(ValueError):
            S.scan(index.chunks, meta, *bad)
    more = index.extend(spark.createDataFrame([(9, "f3", "Revenue grew.\nLiquidity is fine."), (10, "f3", "brand new")], "doc long, filing string, text string"))
    assert more.chunks.count() == 4


def brute_windows(text, max_lines, max_chars):
    lines, out, k = text.splitlines(), [], 0
    while k < len(lines):
        n = chars = 0
        start = k
        while k < len(lines) and n < max_lines:
            chars, n, k = chars + len(lines[k]) + 1, n + 1, k + 1
            if chars >= max_chars:
                break
        out.append((start + 1, k, "\n".join(lines[start:k])))
    return out


def test_chunk_windows(spark):
    texts = ["", "one", "\n" * 10, "ab\ncd\n" * 30, "x" * 50 + "\n" + "y\n" * 20, "a\r\nb\rc\x0bd"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {}
    for r in S.chunks(docs, max_lines=7, max_chars=40).collect():
        got.setdefault(r["payload"], []).append((r["start_line"], r["end_line"], r["chunk_text"]))
    import hashlib

    for t in texts:
        assert sorted(got.get(hashlib.sha256(t.encode()).hexdigest(), [])) == brute_windows(t, 7, 40)


# Facts


def test_unaccumulate(spark):
    d = lambda x: date.fromisoformat(f"2023-{x}")
    spans = [("a", d("01-01"), d("03-31"), 10), ("a", d("01-01"), d("06-30"), 25), ("a", d("01-01"), d("09-30"), 45), ("a", d("01-01"), d("12-31"), 70), ("b", d("01-01"), d("09-30"), 5), ("c", d("01-01"), d("03-31"), 1), ("c", d("01-01"), d("03-31"), 2), ("c", d("01-01"), d("06-30"), 9)]
    df = spark.createDataFrame(spans, "k string, start date, end date, value long")
    got = {(r["k"], str(r["end"])): (r["status"], r["value"], r["reason"]) for r in A.discrete_quarters(df, ["k"]).collect()}
    assert got["a", "2023-06-30"] == ("derived", 15, None) and got["a", "2023-09-30"][1] == 20 and got["a", "2023-12-31"][1] == 25
    assert got["b", "2023-09-30"] == ("refused", None, "missing leg") and got["c", "2023-06-30"] == ("refused", None, "ambiguous leg")
    averaged = A.discrete_quarters(df.where("k = 'a'"), ["k"], F.lit(False)).where("status = 'refused'").collect()
    assert {r["reason"] for r in averaged} == {"not additive"}


def test_scope_and_atoms(spark):
    df = spark.createDataFrame([(1, {"b": "2", "a": "1"}), (2, {}), (3, None)], "id long, dims map<string,string>").withColumns({"start": F.lit(None).cast("date"), "end": F.lit("2024-01-01").cast("date"), "unit": F.lit("USD")})
    assert [r["id"] for r in A.in_scope(df, dimensions={"a": "1", "b": "2"}).collect()] == [1]
    assert [r["id"] for r in A.in_scope(df, dimensions={}).collect()] == [2, 3]
    atoms = spark.createDataFrame([("h", ["a"]), ("h", ["a", "b"]), ("h", ["c"]), ("g", [])], "h string, m array<string>")
    assert rows(A.most_specific(atoms, "h", "m").select("h", F.array_join("m", ","))) and A.most_specific(atoms, "h", "m").count() == 3


def test_identities(spark):
    f = spark.createDataFrame([(1, "A", 100.0), (1, "L", 60.0), (1, "E", 40.0), (2, "A", 100.0), (2, "L", 10.0), (2, "E", 10.0), (3, "A", 5.0)], "k long, c string, v double")
    assert rows(A.identity(f, ["k"], "c", "v", ["L", "E"], [], "A").select("k", "holds"), "k") == [(1, True), (2, False)]
    r = spark.createDataFrame([("x", 100.0, 0), ("x", 100.4, 0), ("y", 1.0, 1), ("y", 2.0, 1)], "k string, v double, d int")
    assert rows(A.rounding_conflicts(r, ["k"], "v", "d").select("k", "agreed"), "k") == [("x", True), ("y", False)]


def test_rounding_in_binary(spark):
    """Halves that scaling moves: 2071.4275 times 1000 is below a half, 2342.6775 a half; F.round would take both up."""
    import duckdb

    given = [(2071.4275, 3), (2342.6775, 3), (-2071.4275, 3), (1.005, 2), (2.5, 0), (-2.5, 0), (None, 1)]
    want = [duckdb.execute("SELECT round(?::DOUBLE, ?::INT)", row).fetchone()[0] for row in given]
    df = spark.createDataFrame([(k, *row) for k, row in enumerate(given)], "k int, x double, d int")
    assert rows(df.select("k", A.binary_round(F.col("x"), F.col("d"))), "k") == list(enumerate(want))
    assert want[0] == 2071.427 and df.where("k = 0").select(F.round("x", 3)).first()[0] == 2071.428


def test_sums_in_order(spark):
    """1e16 swallows a one that follows it, so each order has its own sum; how rows are dealt out doesn't matter."""
    given = [("a", 0, 1.0, None), ("a", 1, 1e16, None), ("a", 2, 1.0, None), ("a", 3, -1e16, None), ("b", 0, 1e16, 2.0), ("b", 1, -1e16, None), ("b", 2, 1.0, 3.0)]
    df = spark.createDataFrame(random.Random(3).sample(given, len(given)), "k string, n int, x double, y double").repartition(5)
    assert rows(A.sums_in_order(df, ["k"], ["n"], ["x", "y"]), "k") == [("a", 0.0, None), ("b", 1.0, 5.0)]
    assert rows(A.sums_in_order(df.withColumn("n", -F.col("n")), ["k"], ["n"], ["x"]), "k") == [("a", 1.0), ("b", 0.0)]


def test_eps_sums(spark, tmp_path):
    """Orders whose rows lie far apart, in several row groups and files' worth of splits: as the SQL on one thread."""
    import duckdb

    from corvid import queries as own

    con = duckdb.connect(config={"threads": 1})
    con.execute(f"COPY (SELECT * FROM '/root/testdata/sf0.01/lineitem.parquet' ORDER BY hash(l_partkey, l_suppkey, l_extendedprice)) TO '{tmp_path}/lineitem.parquet' (ROW_GROUP_SIZE 2048)")
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet'")
    want = con.execute(f"SELECT k, computed, reported, holds FROM ({own.oracle_sql()['eps_identity']}) ORDER BY k").fetchall()
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        assert rows(own.queries()["eps_identity"](spark, str(tmp_path)).select("k", "computed", "reported", "holds"), "k") == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


# Viewer


def test_guard():
    for good in ("SELECT ';' AS x", "SELECT 'it''s; fine' AS x", "/* a */ -- b\nSELECT 1", "PRAGMA table_info('t')", "with a as (select 1) select * from a;"):
        assert W.validate_read_only(good)
    for bad in ("DROP TABLE a; SELECT 1", "ATTACH 'x.db'", "PRAGMA database_list", "", " ; ", "INSERT INTO t VALUES (1)", "-- only a comment"):
        with pytest.raises(W.SqlGuardError):
            W.validate_read_only(bad)
    with pytest.raises(W.SqlGuardError, match="multiple"):
        W.validate_read_only("DROP TABLE a; SELECT 1")
    for bad in ("SELECT * FROM '/etc/passwd'", "SELECT * FROM parquet.`/x`", "SELECT * FROM read_csv('x')"):
        with pytest.raises(W.SqlGuardError):
            W.validate_snapshot_query(bad)


def test_paging(spark):
    df = spark.createDataFrame([(k, f"name{k}", "x" if k % 2 else "y") for k in range(30)], "k long, n string, t string")
    assert [r["k"] for r in W.page(df, sort="k", limit=5, offset=10).collect()] == [10, 11, 12, 13, 14, 15]
    # the search holds together with the filter, over every column
    got = W.page(df, filters=[{"column": "t", "op": "eq", "value": "x"}], search="name2", unique=["k"]).collect()
    assert {r["k"] for r in got} == {21, 23, 25, 27, 29}
    for bad in ({"column": "z", "op": "eq"}, {"column": "k", "op": "like"}, {"column": "n", "op": "gt", "value": "a"}):
        with pytest.raises(ValueError):
            W.page(df, filters=[bad])
    told, cut = W.run_guarded(spark, "SELECT * FROM corvid_t ORDER BY k", {"corvid_t": df}, limit=10)
    assert len(told) == 10 and cut
    assert {c["column"]: c["top_values"] for c in W.profile(df)}["t"] == [("x", 15), ("y", 15)]
    assert W.keys_in(df, "k", list(range(40))).count() == 30 and W.keys_in(df, "k", [3, 99]).count() == 1


# Families and nested shapes


def test_families(spark):
    """Own names by rule: entities, vehicles under a known entity, under an unknown one, under an umbrella, and no name at all."""
    firms = ["Quill Harbor", "Quill Harbor Lending", "Osprey Vale", "Tern"]
    names = {k: f"{f} {suffix}" for k, (f, suffix) in enumerate(zip(firms, ("Inc.", "Corp", "LLC", "Ltd"), strict=True))}
    names |= {10: "Quill Harbor Lending Funding 2031-4", 11: "Quill Harbor Trust 7", 12: "Osprey Vale Mortgage Pool B", 13: "Heron Reach Receivables 2", 14: "Tern Series X, a Series of Grand Marsh", 15: "The Co.", 16: "Trust"}
    got = {r["cik"]: r for r in Y.assign(spark.createDataFrame(list(names.items()), "cik long, name string")).collect()}
    assert got.keys() == names.keys()
    assert {k: got[k]["company_family"] for k in range(4)} == {k: f"entity:{f.lower()}" for k, f in enumerate(firms)}
    assert {k: (got[k]["sponsor_key"], got[k]["assignment_rule"]) for k in (10, 11, 12, 13)} == {
        10: ("quill harbor lending", "sponsor_prefix"), 11: ("quill harbor lending", "sponsor_prefix"), 12: ("osprey vale", "sponsor_prefix"), 13: ("heron reach", "boundary_fallback"),
    }
    assert got[15]["family_kind"] == "singleton" and got[16]["assignment_rule"] == "stem_fallback"


def test_longest_prefix(spark):
    """Against every pair of name and stem; a long name and a first word that all share cost no more than their words."""
    order = random.Random(2)
    word = lambda: order.choice(["first", "lake", "river", "stone", "west"])
    stems = sorted({" ".join(["first", *[word() for _ in range(order.randrange(12))]]) for _ in range(60)})
    names = [(k, " ".join(["first" if k % 5 else "last", *[word() for _ in range(order.randrange(14))]])) for k in range(50)]
    shared = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    want = {}
    for k, name in names:
        near = [s for s in stems if shared(name.split(), s.split())]
        if near:
            want[k] = min(near, key=lambda s: (-len(s), s))
    known = spark.createDataFrame([(s,) for s in stems], "stem string")
    got = Y.longest_prefix(spark.createDataFrame(names, "k long, c string"), "k", "c", known, "stem")
    assert {r["k"]: r["sponsor"] for r in got.collect()} == want


def test_canonical_spelling(spark):
    df = spark.createDataFrame([("windowsill",), ("window sill",), ("window sill",), ("win dow sill",), ("ab c",), ("abc",)], "s string")
    assert rows(Y.canonical_spelling(df, "s"), "s") == [("ab c", "ab c"), ("abc", "abc"), ("win dow sill", "window sill"), ("window sill", "window sill"), ("windowsill", "window sill")]


def test_submissions(spark):
    body = {"cik": "320193", "name": "A", "formerNames": [], "filings": {"recent": {"accessionNumber": ["0000320193-24-000001", "0000320193-24-000002"], "filingDate": ["2024-01-01", "2024-01-02"], "reportDate": ["2023-12-31"], "form": ["10-K", "8-K"], "size": [1, 2], "primaryDocument": ["a.htm", " "], "isXBRL": [1, 0]}}}
    one = N.submissions(spark.createDataFrame([(json.dumps(body),)], "json string"))
    r = one.first()
    assert r["cik"] == "0000320193" and r["anomalies"] == ["ragged:reportDate"] and r["filings"][1]["reportDate"] is None
    occ = {x["accession"]: x for x in N.occurrences(one).collect()}
    assert occ["0000320193-24-000002"]["document_path"].endswith("0000320193-24-000002.txt")
    facts = {"cik": 1, "facts": {"us-gaap": {"Assets": {"label": "x", "units": {"USD": [{"end": "2023-12-31", "val": 5.0, "accn": "a", "fy": 2023, "fp": "FY", "form": "10-K", "filed": "2024-02-01"}]}}}}}
    f = N.company_facts(spark.createDataFrame([(json.dumps(facts),)], "json string")).first()
    assert (f["tag"], f["unit"], f["value"], f["start"]) == ("Assets", "USD", 5.0, None)


# Sources


def test_readers(spark, tmp_path):
    (tmp_path / "h.csv").write_text("CIK,Company_Name\n1,A\n2,B\n")
    (tmp_path / "n.tsv").write_text("1\tA\n2\tB\n3\tC\n")
    assert E.read_cohort(spark, str(tmp_path / "h.csv")).count() == 2 and E.read_cohort(spark, str(tmp_path / "n.tsv"), "tsv").count() == 3
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.txt", "hello")
        z.writestr("y.txt", "world")
    m = E.zip_members(spark, str(tmp_path / "a.zip"))
    assert {r["member"]: r["uncompressed_size"] for r in m.collect()} == {"x.txt": 5, "y.txt": 5}
    assert bytes(E.read_members(spark, str(tmp_path / "a.zip"), ["y.txt"]).first()["content"]) == b"world"
    old = m.withColumn("crc32", F.when(F.col("member") == "x.txt", F.col("crc32")).otherwise(0))
    assert rows(E.member_changes(m, old), "member") == [("x.txt", "carried"), ("y.txt", "changed")]
    df = spark.createDataFrame([(1,)], "v long")
    E.write_vintage(df, f"{tmp_path}/s", "set", "2023", "sha1")
    E.write_vintage(df, f"{tmp_path}/s", "set", "2024", "sha2")
    E.write_vintage(df.union(df), f"{tmp_path}/s", "set", "2023", "sha3")
    assert rows(spark.read.parquet(f"{tmp_path}/s").groupBy("vintage").count(), "vintage") == [(2023, 2), (2024, 1)]
    with pytest.raises(ValueError):
        E.read_table(spark, "x", "xlsx")


MASTER = b"Description: Master\n\nCIK|Company Name|Form Type|Date Filed|Filename\n--------------------------------------------------\n320193|APPLE|10-K|2024-01-02|data/a.txt\nbad line\nx|A|4|2024-01-02|f\n"
FORM = b"Form Type   Company Name      CIK         Date Filed  File Name\n------------------------------------------------------------------\n10-K        APPLE INC         320193      2024-01-02  data/a.txt\n"


def test_parsers(spark):
    got = P.parse_index(MASTER)
    assert got[0]["cik"] == "0000320193" and [bool(r.get("malformed")) for r in got] == [False, True, True]
    assert P.parse_index(FORM, "form")[0]["company"] == "APPLE INC"
    page = b'<table summary="Document Format Files"><tr><th>Seq</th><th>Description</th><th>Document</th><th>Type</th><th>Size</th></tr><tr><td>1</td><td>10-K</td><td><a href="/a.htm">a.htm</a> iXBRL</td><td>10-K</td><td>123</td></tr></table>'
    assert P.parse_html_index(page)[0] | {} == {"table_kind": "document", "row_ordinal": 1, "sequence": 1, "description": "10-K", "filename": "a.htm", "href": "/a.htm", "document_type": "10-K", "byte_size": 123}
    assert P.parse_json_index(b'{"directory": {"item": [{"name": "a", "size": "5", "type": "t"}]}}')[0]["byte_size"] == 5
    atom = b'<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>8-K - ACME (0000000012) (Filer)</title><id>urn:accession-number=0000000012-24-000001</id><category term="8-K"/><updated>2024-01-01T00:00:00</updated><summary>Filed: 2024-01-01</summary><link href="l"/></entry></feed>'
    assert P.parse_atom(atom)[0] == {"accession": "0000000012-24-000001", "form": "8-K", "company": "ACME", "cik": "0000000012", "filed": "2024-01-01", "accepted": "2024-01-01T00:00:00", "link": "l"}
    rss = b"<rss><channel><item><link>l</link><filing><companyName>A</companyName><formType>10-K</formType><filingDate>03/05/2024</filingDate><cikNumber>12</cikNumber><accessionNumber>x</accessionNumber></filing></item></channel></rss>"
    assert P.parse_rss(rss)[0]["filed"] == "2024-03-05"
    bundle = b"<SUBMISSION>\n<DOCUMENT>\n<TYPE>10-K\n<SEQUENCE>1\n<FILENAME>a.txt\n<TEXT>\nbody one\n</TEXT>\n</DOCUMENT>\n<DOCUMENT>\n<TYPE>EX-1\n<SEQUENCE>2\n<TEXT>\nopen end"
    assert [(d["sequence"], d["document_type"], d["body"]) for d in P.parse_bundle(bundle)] == [(1, "10-K", "body one"), (2, "EX-1", "open end")]
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w:gz") as tar:
        info = tarfile.TarInfo("a.nc")
        text = b"<ACCESSION-NUMBER>0001\n<TYPE>4\n<FILING-DATE>20240101\n<DOCUMENT>\n"
        info.size = len(text)
        tar.addfile(info, io.BytesIO(text))
    assert P.parse_tarball(buffer.getvalue())[0] | {} == {"member": "a.nc", "size": len(text), "accession": "0001", "form": "4", "filed": "20240101", "documents": 1}
    files = spark.createDataFrame([("good", bytearray(MASTER)), ("empty", None)], "path string, content binary")
    assert P.parse_files(files, "index").where("path = 'good' and malformed is null").count() == 1
    bad = P.parse_files(spark.createDataFrame([("p", bytearray(b"<not xml"))], "path string, content binary"), "instance").first()
    assert bad["error"].startswith("ParseError")


def test_xbrl():
    xml = b'<xbrl xmlns="http://www.xbrl.org/2003/instance" xmlns:us="http://x/us" xmlns:xbrldi="http://xbrl.org/2006/xbrldi"><context id="c"><entity><segment><xbrldi:explicitMember dimension="us:Ax">us:M</xbrldi:explicitMember></segment></entity><period><startDate>2024-01-01</startDate><endDate>2024-03-31</endDate></period></context><context id="i"><period><instant>2024-03-31</instant></period></context><unit id="u"><measure>iso4217:USD</measure></unit><us:Sales contextRef="c" unitRef="u" decimals="-3">1000</us:Sales><us:Name contextRef="i">Acme</us:Name></xbrl>'
    a, b = P.parse_instance(xml)
    assert (a["concept"], a["numeric_value"], a["unit"], a["decimals"], a["dimensions"], a["end_date"]) == ("us:Sales", 1000.0, "USD", -3, '{"us:Ax": "us:M"}', "2024-03-31")
    assert (b["text_value"], b["period_type"], b["instant_date"]) == ("Acme", "instant", "2024-03-31")
    cal = b'<linkbase xmlns="http://www.xbrl.org/2003/linkbase" xmlns:xlink="http://www.w3.org/1999/xlink"><calculationLink xlink:role="r"><loc xlink:label="a" xlink:href="x.xsd#us_Total"/><loc xlink:label="b" xlink:href="x.xsd#us_Part"/><calculationArc xlink:from="a" xlink:to="b" weight="-1" order="2"/></calculationLink></linkbase>'
    arc = P.parse_linkbase(cal)[0]
    assert (arc["source"], arc["target"], arc["weight"]) == ("us:Total", "us:Part", -1.0)
    xsd = b'<schema xmlns="http://www.w3.org/2001/XMLSchema" xmlns:xbrli="http://www.xbrl.org/2003/instance" xmlns:me="http://me" targetNamespace="http://me"><element name="Thing" xbrli:periodType="instant" abstract="true" type="t"/></schema>'
    assert P.parse_schema(xsd)[0]["concept"] == "me:Thing" and P.parse_schema(xsd)[0]["abstract"] is True


# Documents


def test_html():
    html = "<html><head><title>x</title></head><body><p>Hello&nbsp;<b>world</b></p><script>no()</script><table><tr><td rowspan=2>A</td><td colspan=2>B</td></tr><tr><td>$</td><td>1,000</td></tr></table>after</body></html>"
    text = O.html_to_text(html)
    assert text.startswith("Hello world") and "no()" not in text and "$1,000" in text and text.endswith("after")
    assert O.html_tables(html) == [[["A", "B", ""], ["", "$", "1,000"]]]
    a, b = O._read("<table><tr><td>H</td></tr><tr><td>1</td></tr></table><table><tr><td>H</td></tr><tr><td>2</td></tr></table>")
    assert [[c.text for c in r] for r in O.continue_table(a, b)] == [["H"], ["1"], ["2"]]


def test_pages_and_reflow():
    pages = "\n".join(f"ACME CORP 10-K\n\n{w} of page {k} goes on here and on and on until the line is long enough\nand then {w} ends.\n\n{k}" for k, w in enumerate(("prose", "talk", "speech", "words", "text"), 1))
    out = O.strip_pages(pages)
    assert "ACME" not in out and "speech of page 3" in out
    assert O.reflow("some prose line that is long enough to be unwrapped by the rule\nand its second line with more words in it.") == "some prose line that is long enough to be unwrapped by the rule and its second line with more words in it."
    assert O.heal_lines(["see table of", "contents here"], [("table", "of", "contents")]) == ["see table of contents here"]


def test_lexical():
    found = O.Phrases({"a": ["net income", "income tax expense"], "b": ["tax"]}).find("the net income tax expense")
    assert set(found) == {("a", "net income", 1), ("a", "income tax expense", 2), ("b", "tax", 3)}
    pack = O.Evidence("x", (O.Tier(3, ("net income", "total assets")),), frozenset({"draft"}))
    assert pack.score("net income and total assets") == ("x", 6, 0.94) and pack.score("draft net income")[0] == "no_match"
    assert O.classify("nothing", [pack]) == ("residual", 0, 0.0)
    assert [O.partition_kind({"a": 60, "b": 40}, 100), O.partition_kind({"a": 60, "b": 40, "c": 20}, 100, [("a", "c")]), O.partition_kind({"a": 60, "b": 40, "c": 100}, 100), O.partition_kind({"a": 1}, 5), O.partition_kind({"a": 70, "b": 80}, 100)] == ["CLEAN", "NESTED", "OVERLAPPING", "INCOMPLETE", "OVER_UNEXPLAINED"]


def test_render_and_handlers(spark):
    kind, text = O.render(b"<?xml version='1.0'?><doc><a>1</a><b><c>2</c><c>3</c></b></doc>", "4/A")
    assert kind == "xml:ownership" and text == "doc/a: 1\ndoc/b/c[1]: 2\ndoc/b/c[2]: 3"
    assert O.render(b"<html><p>x</p></html>")[1] == "x" and O.form_kind("10-K405") == "annual"
    mine = O.Handlers()
    mine.register("up")(str.upper)
    mine.register("fail")(lambda x: 1 / 0)
    with pytest.raises(ValueError):
        mine.register("up")(str.lower)
    got = {(r["key"], r["operation"]): r for r in mine.apply(spark.createDataFrame([(1, "a")], "k long, t string"), ["up", "fail"], "k", "t").collect()}
    assert got[1, "up"]["output"] == "A" and got[1, "fail"]["error"].startswith("ZeroDivisionError")


# Streams


def test_ledger_stream(spark, tmp_path):
    src = tmp_path / "in"
    kind = "accession string, source string, ts timestamp"
    one = spark.createDataFrame([("a", "x", None), ("a", "x", None), ("b", "x", None)], kind)
    one.write.parquet(f"{src}/1")
    stream = lambda: spark.readStream.schema(kind).parquet(f"{src}/*")
    T.feed_ledger(stream(), f"{tmp_path}/ledger", ["accession", "source"], f"{tmp_path}/cp").awaitTermination()
    spark.createDataFrame([("b", "x", None), ("c", "y", None)], kind).write.parquet(f"{src}/2")
    T.feed_ledger(stream(), f"{tmp_path}/ledger", ["accession", "source"], f"{tmp_path}/cp").awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/ledger").select("accession", "source"), "accession") == [("a", "x"), ("b", "x"), ("c", "y")]


def test_polled_feed(spark, tmp_path):
    spark.dataSource.register(T.PolledFeed)
    (tmp_path / "feed").mkdir()
    put = lambda n, *a: (tmp_path / "feed" / f"{n}.jsonl").write_text("\n".join(json.dumps({"accession": x, "source": "s", "accepted": "t"}) for x in a))
    put(0, "a", "b")
    read = lambda: spark.readStream.format("corvid_feed").option("path", str(tmp_path / "feed")).load().writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(processingTime="0 seconds").start()
    q = read()
    q.processAllAvailable()
    put(1, "c")
    q.processAllAvailable()
    q.stop()
    assert sorted(r[0] for r in spark.read.parquet(f"{tmp_path}/out").select("accession").collect()) == ["a", "b", "c"]


def test_watermark_counts(spark, tmp_path):
    spark.createDataFrame([("a", "2024-01-01 00:00:01"), ("b", "2024-01-01 00:00:02"), ("c", "2024-01-01 01:00:00")], "k string, t string").withColumn("t", F.to_timestamp("t")).write.parquet(f"{tmp_path}/in")
    s = spark.readStream.schema("k string, t timestamp").parquet(f"{tmp_path}/in")
    q = T.windowed_counts(s, "t", [], "10 minutes", "5 minutes").writeStream.outputMode("append").format("memory").queryName("corvid_counts").start()
    q.processAllAvailable()
    q.processAllAvailable()
    q.stop()
    assert [r["n"] for r in spark.sql("select n from corvid_counts").collect()] == [2]
