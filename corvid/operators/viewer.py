"""Interactive reads: typed filters, search, paging without a count, column statistics, guarded SQL."""

from __future__ import annotations

import re
import threading
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDERABLE = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
COMPARE = {"eq": Column.__eq__, "ne": Column.__ne__, "gt": Column.__gt__, "ge": Column.__ge__, "lt": Column.__lt__, "le": Column.__le__}
MAX_ROWS, MAX_BYTES, TOP_VALUES, LOW_CARDINALITY = 10_000, 8 << 20, 5, 20


def filter_column(df: DataFrame, column: str, op: str, value: object = None) -> Column:
    """One typed filter; an unknown column or operator, or a range over text, is refused."""
    if column not in df.columns:
        raise ValueError(f"unknown filter column: {column!r}")
    c, text = F.col(f"`{column}`"), F.col(f"`{column}`").cast("string")
    match op:
        case "empty":
            return F.coalesce(text, F.lit("")) == ""
        case "not_empty":
            return F.coalesce(text, F.lit("")) != ""
        case "contains":
            return F.contains(F.lower(text), F.lit(str(value).lower()))
        case "not_contains":
            return ~F.contains(F.lower(text), F.lit(str(value).lower()))
        case _ if op in COMPARE:
            if op in ("gt", "ge", "lt", "le") and not isinstance(df.schema[column].dataType, ORDERABLE):
                raise ValueError(f"operator {op!r} is invalid for column {column!r}")
            return COMPARE[op](c, F.lit(value))
    raise ValueError(f"unknown filter operator: {op!r}")


def page(df: DataFrame, *, filters: Sequence[Mapping[str, object]] = (), search: str = "", sort: str | None = None, descending: bool = False, unique: Sequence[str] = (), offset: int = 0, limit: int = 100) -> DataFrame:
    """One row more than the page (so that a next page is known without a count).

    The search is any column that contains the text, and holds together with every filter.
    """
    out = df
    for f in filters:
        out = out.where(filter_column(df, f["column"], f["op"], f.get("value")))
    if search:
        out = out.where(reduce(or_, [F.coalesce(F.contains(F.lower(F.col(f"`{c}`").cast("string")), F.lit(search.lower())), F.lit(False)) for c in df.columns]))
    order = [(F.desc_nulls_last if descending else F.asc_nulls_last)(sort)] if sort else []
    return out.orderBy(*order, *unique).offset(offset).limit(limit + 1) if order or unique else out.offset(offset).limit(limit + 1)


def column_stats(df: DataFrame, exact: bool = False) -> DataFrame:
    """(column, rows, nulls, distinct): one pass over the table; distinct is approximate unless ``exact``."""
    count = F.count_distinct if exact else F.approx_count_distinct
    whole = df.agg(F.count("*").alias("rows"), *[F.struct(F.count(f"`{c}`").alias("n"), count(F.col(f"`{c}`")).alias("d")).alias(f"_{k}") for k, c in enumerate(df.columns)])
    told = F.array(*[F.struct(F.lit(c).alias("column"), (F.col("rows") - F.col(f"_{k}.n")).alias("nulls"), F.col(f"_{k}.d").alias("distinct")) for k, c in enumerate(df.columns)])
    return whole.select("rows", F.inline(told)).select("column", "rows", "nulls", "distinct")


def top_values(df: DataFrame, column: str, k: int = TOP_VALUES) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(k)


def profile(df: DataFrame, k: int = TOP_VALUES) -> list[dict]:
    """Statistics of every column, with the top values of text columns of at most twenty distinct ones."""
    out = [r.asDict() for r in column_stats(df).collect()]  # one row a column
    for column in out:
        low = isinstance(df.schema[column["column"]].dataType, T.StringType) and 0 < column["distinct"] <= LOW_CARDINALITY
        column["top_values"] = [(r["value"], r["n"]) for r in top_values(df, column["column"], k).collect()] if low else []
    return out


# Guarded SQL


class SqlGuardError(ValueError):
    """The text isn't one read-only statement."""


_TOKEN = re.compile(r"""(?P<skip>--[^\n]*|/\*.*?(?:\*/|\Z))|(?P<quoted>'(?:[^']|'')*(?:'|\Z)|"(?:[^"]|"")*(?:"|\Z)|`(?:[^`]|``)*(?:`|\Z))|(?P<end>;)|(?P<word>\w+)|(?P<other>.)""", re.DOTALL)
VERBS = ("SELECT", "WITH", "DESCRIBE", "EXPLAIN", "SHOW")
OUTSIDE = ("read_parquet", "read_csv", "read_json", "read_files", "parquet", "csv", "json", "text", "orc", "delta", "jdbc")


def validate_read_only(sql: str) -> str:
    """The statement without its last semicolons; more than one statement is reported before a wrong verb."""
    body = sql.strip().rstrip(";").strip()
    if not body:
        raise SqlGuardError("query is empty")
    tokens = [(m.lastgroup, m[0]) for m in _TOKEN.finditer(body)]
    if any(kind == "end" for kind, _ in tokens):
        raise SqlGuardError("multiple statements are not allowed")
    words = [(kind, said) for kind, said in tokens if kind != "skip" and said.strip()]
    if not words or words[0][0] != "word" or not (words[0][1].upper() in VERBS or [w.upper() for _, w in words[:2]] == ["PRAGMA", "TABLE_INFO"]):
        raise SqlGuardError("only SELECT, WITH, DESCRIBE, SHOW, EXPLAIN or PRAGMA table_info may run")
    return body


def validate_snapshot_query(sql: str) -> str:
    """Also refuse files: table functions, ``FROM 'path'`` and ``format.`path```."""
    body = validate_read_only(sql)
    words = [(m.lastgroup, m[0]) for m in _TOKEN.finditer(body) if m.lastgroup != "skip" and m[0].strip()]
    for (_, a), (kind, b) in zip(words, words[1:], strict=False):
        if a.upper() in ("FROM", "JOIN") and kind == "quoted" and b[0] == "'":
            raise SqlGuardError("a file can't be read here")
        if a.lower() in OUTSIDE and b in ("(", "."):
            raise SqlGuardError(f"{a} can't be read here")
    return body


def run_guarded(spark: SparkSession, sql: str, views: Mapping[str, DataFrame], limit: int = MAX_ROWS, timeout_s: float = 15.0, max_bytes: int = MAX_BYTES, offset: int = 0) -> tuple[list[Row], bool]:
    """(rows, more): a read-only statement over named views from row ``offset`` on, stopped at a row, byte or time limit.

    Pages fit together where the statement orders its rows; a page that was cut off by bytes goes on at ``offset`` plus its rows.
    """
    body = validate_snapshot_query(sql)
    if match := re.match(r"(?is)pragma\s+table_info\s*\(\s*'?(\w+)'?\s*\)$", body):
        body = f"DESCRIBE {match[1]}"
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    group = f"corvid-console-{id(body)}"
    spark.sparkContext.setJobGroup(group, body[:100], interruptOnCancel=True)
    timer = threading.Timer(timeout_s, spark.sparkContext.cancelJobGroup, [group])
    timer.start()
    try:
        found = spark.sql(body)
        rows = (found.offset(offset) if offset else found).limit(limit + 1).collect()
    finally:
        timer.cancel()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    kept, size = [], 0
    for row in rows[:limit]:
        size += len(str(row))
        if size > max_bytes:
            break
        kept.append(row)
    return kept, len(kept) < len(rows)


def result_pages(spark: SparkSession, sql: str, views: Mapping[str, DataFrame], size: int, **limits: float) -> Iterator[list[Row]]:
    """The pages of a statement, one after another, until it is told whole; each is a run of its own, so none is held."""
    at, more = 0, True
    while more:
        rows, more = run_guarded(spark, sql, views, size, offset=at, **limits)
        if more and not rows:
            raise SqlGuardError(f"row {at} alone is larger than a page may be")
        at += len(rows)
        yield rows


def keys_in(df: DataFrame, column: str, keys: Sequence[object], inline: int = 32) -> DataFrame:
    """Rows whose key is asked for: a list of up to ``inline`` keys in the scan, else a semi-join that Spark may broadcast."""
    if len(keys) <= inline:
        return df.where(F.col(column).isin(*keys)) if keys else df.limit(0)
    kind = df.schema[column].dataType.simpleString()
    return df.join(df.sparkSession.createDataFrame([(k,) for k in keys], f"{column} {kind}").distinct(), column, "left_semi")
