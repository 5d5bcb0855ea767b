"""Cohorts of entities: intake, set algebra with an expression grammar, differences, paging, sampling.

A cohort has one row a key: (ordinal, key, name); keys are digits, zero-padded
to ten.  Names prefer the left side where it has one.
"""

from __future__ import annotations

import ast
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.operators.relational import first_nonempty, with_ordinal

MAX_CHARS, MAX_NODES = 4096, 256
_KINDS = {ast.Add: "union", ast.BitAnd: "intersect", ast.Sub: "difference"}


@dataclass(frozen=True)
class Op:
    kind: str
    left: Op | str
    right: Op | str


def parse_expression(text: str) -> Op | str:
    """``a + b`` is union, ``a & b`` intersection, ``a - b`` difference; names and parentheses, nothing else."""
    if len(text) > MAX_CHARS:
        raise ValueError(f"an expression has at most {MAX_CHARS} characters")
    try:
        tree = ast.parse(text.strip(), mode="eval")
    except SyntaxError as e:
        raise ValueError(f"not an expression: {text!r}") from e
    if sum(1 for _ in ast.walk(tree)) > MAX_NODES:
        raise ValueError(f"an expression has at most {MAX_NODES} nodes")

    def read(node: ast.expr) -> Op | str:
        match node:
            case ast.Name(id=name):
                return name
            case ast.BinOp(left=left, op=op, right=right) if type(op) in _KINDS:
                return Op(_KINDS[type(op)], read(left), read(right))
        raise ValueError(f"only names, +, & and - are allowed: {ast.unparse(node)!r}")

    return read(tree.body)


def padded(key: Column) -> Column:
    return F.lpad(key.cast("string"), 10, "0")


def numbered(keyed: DataFrame) -> DataFrame:
    return with_ordinal(keyed, [F.col("key")], F.substring("key", 1, 7)).select("ordinal", "key", "name")


def ingest(rows: DataFrame, key: str, name: str, order: str) -> DataFrame:
    """One row a numeric key with its first name, in input order, that isn't empty; rows without a numeric key are left out."""
    valid = rows.select(F.expr(f"try_cast(`{key}` as bigint)").alias("_k"), F.trim(F.col(name).cast("string")).alias("name"), F.col(order).alias("_o")).where("_k is not null")
    return numbered(first_nonempty(valid, "_k", "name", "_o").select(padded(F.col("_k")).alias("key"), "name"))


def intake_quality(rows: DataFrame, key: str) -> DataFrame:
    """One row: rows, valid, invalid and duplicate keys."""
    number = F.expr(f"try_cast(`{key}` as bigint)")
    return rows.select(number.alias("k")).agg(
        F.count("*").alias("rows"), F.count("k").alias("valid"), F.count_if(F.expr("k is null")).alias("invalid"), (F.count("k") - F.count_distinct("k")).alias("duplicates"),
    )


def combine(left: DataFrame, right: DataFrame, kind: str) -> DataFrame:
    if kind == "union":
        both = left.select("key", "name", F.lit(0).alias("_side")).unionByName(right.select("key", "name", F.lit(1).alias("_side")))
        return first_nonempty(both, "key", "name", "_side")
    if kind == "intersect":
        return left.select("key", "name").join(right.select("key"), "key", "left_semi")
    return left.select("key", "name").join(right.select("key"), "key", "left_anti")


def evaluate(expression: str, cohorts: Mapping[str, DataFrame]) -> DataFrame:
    """The cohort an expression over named cohorts stands for, numbered once at the end."""

    def run(node: Op | str) -> DataFrame:
        if isinstance(node, str):
            if node not in cohorts:
                raise ValueError(f"no cohort named {node!r}")
            return cohorts[node].select("key", "name")
        return combine(run(node.left), run(node.right), node.kind)

    return numbered(run(parse_expression(expression)))


def diff_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row of six counts, from one full outer join."""
    both = left.select("key", F.lit(1).alias("l")).join(right.select("key", F.lit(1).alias("r")), "key", "full_outer")
    a, b = F.col("l").isNotNull(), F.col("r").isNotNull()
    return both.agg(
        F.count_if(a).alias("left_total"), F.count_if(b).alias("right_total"), F.count_if(a & b).alias("both"),
        F.count_if(a & ~b).alias("left_only"), F.count_if(b & ~a).alias("right_only"), F.count("*").alias("either"),
    )


def diff_sample(left: DataFrame, right: DataFrame, limit: int = 5) -> DataFrame:
    """The first keys of each side alone."""
    one = lambda a, b, side: combine(a, b, "difference").orderBy("key").limit(limit).select(F.lit(side).alias("side"), "key", "name")
    return one(left, right, "left").unionByName(one(right, left, "right"))


def page(cohort: DataFrame, key: str | None = None, name_part: str | None = None, limit: int = 25, offset: int = 0) -> tuple[int, DataFrame]:
    """(matching rows, one page by ordinal)."""
    found = cohort
    if key is not None:
        found = found.where(F.col("key") == key.zfill(10))
    if name_part:
        found = found.where(F.contains(F.lower("name"), F.lit(name_part.lower())))
    return found.count(), found.orderBy("ordinal").offset(offset).limit(limit)


def find_across(cohorts: Mapping[str, DataFrame], name_part: str, limit: int = 25) -> DataFrame:
    found = None
    for label, cohort in sorted(cohorts.items()):
        part = cohort.where(F.contains(F.lower("name"), F.lit(name_part.lower()))).select(F.lit(label).alias("cohort"), "ordinal", "key", "name")
        found = part if found is None else found.unionByName(part)
    return found.orderBy("cohort", "ordinal").limit(limit)
