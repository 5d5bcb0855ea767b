"""The engine's own queries: every module here registers functions and their SQL."""

from __future__ import annotations

import importlib
import pkgutil
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.operators.relational import latest
from corvid.registry import ORACLES, QUERIES, load

for _module in sorted(m.name for m in pkgutil.iter_modules(__path__)):
    importlib.import_module(f"{__name__}.{_module}")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest row per key over base and delta, then the first five of each priority by seeded digest order."""
    orders = load(spark, sf_dir, "orders")
    base = orders.where("o_orderdate < '1997-01-01'").withColumn("part", F.lit(0))
    delta = orders.where("o_orderdate >= '1996-06-01'").withColumns({"o_totalprice": F.col("o_totalprice") + 1, "part": F.lit(1)})
    merged = latest(base.unionByName(delta), ["o_orderkey"], [F.desc("part")])
    draw = F.sha2(F.concat(F.lit("seed:"), F.col("o_orderkey").cast("string")), 256)
    return latest(merged.withColumn("draw", draw), ["o_orderpriority"], [F.col("draw"), F.col("o_orderkey")], 5).select("o_orderkey", "o_orderpriority", "o_totalprice", "draw")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
