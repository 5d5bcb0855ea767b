"""Secret scan with corpus-wide ownership frequency.

Three base kinds are found by pattern in every whole text.  Every candidate
value (of a base kind, or a generic high-entropy token) is hashed, and the
hashes are aggregated over the corpus by distinct repositories and owners.  A
value in several owners' texts, or in many repositories even of few owners, is
a widely copied example.  Any other value is owner-specific, and of those the
ones that look live (enough entropy, no placeholder word, no run or sequence of
one character after another) are called ``live``.  Generic tokens become spans
of kind ``owner`` only where that aggregation calls them live; base spans always
stay and carry their verdict: example, live or dull.

Defined results: a null text is empty and has no spans; a null owner or
repository counts as one owner or repository of its own; repeated rows are
separate documents of one owner and repository; an empty table gives an empty result; other columns are
ignored, whatever their names.  Two spans that start together are ordered by
kind as listed in KINDS.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import by_bytes, table, text_of, written

KINDS = ("assign", "access", "hex", "owner")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the maximal runs of 32 or more
GENERIC = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: A text without a match of this (RE2, one linear pass) has no span of any kind.
MAYBE = r"(?i:password|passwd|secret|token|api_?key)|AKIA|[A-Za-z0-9+/_=-]{20,}"

#: Words of values that stand for a credential and aren't one.
PLACEHOLDER = re.compile("example|sample|changeme|placeholder|dummy|your[-_]?|xxxx|redacted|insert", re.IGNORECASE)

FOUND = "array<struct<kind:int,start:int,end:int,secret_sha256:string,live:boolean>>"
SCANNED = f"row long, id {{id}}, owner string, repo string, found {FOUND}"


def entropy(value: str) -> float:
    """Shannon entropy in bits a character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def looks_live(value: str, min_entropy: float) -> bool:
    """Enough entropy for its length, no placeholder word, and at most half its characters repeat, follow or precede the one before."""
    steps = sum(abs(ord(a) - ord(b)) <= 1 for a, b in zip(value, value[1:], strict=False))
    return entropy(value) >= min(min_entropy, 0.8 * math.log2(len(value))) and 2 * steps <= len(value) and not PLACEHOLDER.search(value)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value) of the base kinds, by start, then kind; positions are code points, the end exclusive."""
    spans = [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    spans += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], s[0]))


def generic_spans(text: str, base: list[tuple[int, int, int, str]], min_entropy: float) -> list[tuple[int, int, int, str]]:
    """High-entropy tokens with letters and digits that touch no base span."""
    out, merged = [], []
    for _, start, end, _ in base:
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    k = 0
    for m in GENERIC.finditer(text):
        value = m[0]
        while k < len(merged) and merged[k][1] <= m.start():
            k += 1
        if k < len(merged) and merged[k][0] < m.end():
            continue
        if re.search(r"[0-9]", value) and re.search(r"[A-Za-z]", value) and entropy(value) >= min_entropy:
            out.append((3, m.start(), m.end(), value))
    return out


def _scan(min_entropy: float):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("secret_sha256", pa.string()), ("live", pa.bool_())]))
        for batch in by_bytes(batches):
            texts = batch.column("text")
            maybe = pc.match_substring_regex(texts, MAYBE).to_pylist()
            found = []
            for i, hit in enumerate(maybe):
                spans = []
                if hit:
                    text = texts[i].as_py()
                    base = base_spans(text)
                    for k, s, e, value in sorted(base + generic_spans(text, base, min_entropy), key=lambda x: (x[1], x[0])):
                        spans.append({"kind": k, "start": s, "end": e, "secret_sha256": hashlib.sha256(value.encode()).hexdigest(), "live": looks_live(value, min_entropy)})
                found.append(spans)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("row", "id", "owner", "repo")] + [pa.array(found, kind)], names=["row", "id", "owner", "repo", "found"])

    return scan


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_cols: tuple[str, ...] = ("source", "lang"), example_owners: int = 3, example_repos: int = 6, min_entropy: float = 3.0) -> DataFrame:
    """One row per document: its id (as ``id_col``) and ``spans``, an array by start and kind of
    (kind, start, end, secret_sha256, n_docs, n_repos, n_owners, verdict).

    ``example_owners``, ``example_repos``: a value of so many distinct owners, or of so many distinct repositories, is an
    example; any other is owner-specific, and live or dull by its looks.
    The texts are read once; what is shuffled are candidate hashes (aggregated
    per owner and repository before each shuffle) and the documents that have candidates.
    """
    repo = F.concat_ws("/", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in repo_cols])
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col(f"`{owner_col}`").cast("string"), F.lit("\0")).alias("owner"), repo.alias("repo"), text_of(text_col).alias("text"),
    )
    scanned = written(rows.mapInArrow(_scan(min_entropy), SCANNED.format(id=rows.schema["id"].dataType.simpleString())), "secrets")
    found = scanned.where(F.size("found") > 0).select("row", "owner", "repo", F.inline("found"))
    stats = (
        found.groupBy("secret_sha256", "owner", "repo").agg(F.count("*").alias("n"), F.count_distinct("row").alias("d"))
        .groupBy("secret_sha256", "owner").agg(F.sum("d").alias("d"), F.count("*").alias("repos"))
        .groupBy("secret_sha256").agg(F.sum("d").alias("n_docs"), F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"))
        .withColumn("copied", (F.col("n_owners") >= example_owners) | (F.col("n_repos") >= example_repos))
    )
    names = F.array(*[F.lit(k) for k in KINDS])
    judged = (
        found.join(stats, "secret_sha256").withColumn("verdict", F.when(F.col("copied"), "example").when(F.col("live"), "live").otherwise("dull"))
        .where("kind < 3 or verdict = 'live'")
        .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "secret_sha256", "n_docs", "n_repos", "n_owners", "verdict"))).alias("s"))
        .select("row", F.transform("s", lambda x: F.struct(F.element_at(names, x["kind"] + 1).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), *[x[c].alias(c) for c in ("secret_sha256", "n_docs", "n_repos", "n_owners", "verdict")])).alias("spans"))
    )
    none = F.array().cast(judged.schema["spans"].dataType)
    quiet = scanned.where(F.size("found") == 0).select(F.col("id").alias(id_col), none.alias("spans"))
    loud = scanned.where(F.size("found") > 0).select("row", "id").join(judged, "row", "left").select(F.col("id").alias(id_col), F.coalesce("spans", none).alias("spans"))
    return quiet.unionByName(loud)


def digest(spans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The contract's columns from ``scan_secrets``: counts by base kind, the hash of the base spans, all spans as text."""
    said = lambda some: F.array_join(F.transform(some, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("spans", lambda x: x["kind"] != "owner")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return spans.select(
        id_col, count("assign"), count("access"), count("hex"), F.sha2(said(base), 256).alias("base_sha256"), said("spans").alias("spans"),
        F.size(F.filter("spans", lambda x: x["verdict"] == "example")).cast("long").alias("n_examples"),
        F.size(F.filter("spans", lambda x: x["verdict"] == "live")).cast("long").alias("n_live"),
    )


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(scan_secrets(table(spark, sf_dir, "documents")))
