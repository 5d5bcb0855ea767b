"""Work journals and incremental refreshes.

A journal is an append-only folder of Parquet rows (key, status, at, detail):
recording is one append, and a key's state is its last row.  A refresh computes
anew only what changed and carries the rest over.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.operators.relational import latest
from corvid.operators.versioning import SnapshotStore, carried
from corvid.scratch import written

KIND = "key string, status string, at timestamp, detail string"


class Journal:
    """Outcomes by key under a folder that every machine sees."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def record(self, outcomes: DataFrame) -> None:
        """Append rows (key, status, at, detail); an empty frame adds nothing."""
        outcomes.select("key", "status", "at", "detail").write.mode("append").parquet(self.path)

    def states(self) -> DataFrame:
        """The last row of each key; of rows at one time the greatest status."""
        rows = self.spark.read.schema(KIND).parquet(self.path)
        return latest(rows, ["key"], [F.desc("at"), F.desc("status"), F.desc_nulls_last("detail")])

    def completed(self) -> DataFrame:
        return self.states().where("status = 'done'").select("key")

    def counts(self) -> DataFrame:
        return self.states().groupBy("status").agg(F.count("*").alias("n"))

    def open(self, expected: DataFrame, key: str = "key") -> DataFrame:
        """The expected keys that aren't done."""
        return expected.join(self.completed().withColumnRenamed("key", key), key, "left_anti")


def outcomes(units: DataFrame, key: str, work: Callable[[DataFrame], DataFrame], failed: str) -> DataFrame:
    """(key, status, at, detail) of a step that gives each unit a row with the column ``failed`` (null where it went well);
    a unit that the step gave no row is ``lost``."""
    told = work(units).select(key, F.col(failed).alias("_f")).withColumn("_there", F.lit(True))
    status = F.when(F.col("_there").isNull(), "lost").when(F.col("_f").isNull(), "done").otherwise("failed")
    return units.select(key).join(told, key, "left").select(F.col(key).cast("string").alias("key"), status.alias("status"), F.current_timestamp().alias("at"), F.col("_f").alias("detail"))


def refreshed(now: DataFrame, before: DataFrame, features: DataFrame, key: str, order: list[str], value: str, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Features of ``now`` by key: computed for keys whose rows are new or changed since ``before``, carried over from ``features`` for
    the others, gone for keys that are gone; the same as computing all."""
    states = carried(now, before, key, order, value)
    anew = compute(now.join(states.where("state in ('new', 'changed')").select(key), key, "left_semi"))
    return anew.unionByName(features.join(states.where("state = 'carried'").select(key), key, "left_semi"))


def publish_run(store: SnapshotStore, journal: Journal, relations: Mapping[str, DataFrame], keys: Mapping[str, str], expected: DataFrame, branch: str = "main", allow_failures: bool = False) -> str:
    """Publish what a run made, with its outcomes as the relation ``outcomes``, on the branch's present tip; ValueError while expected
    keys have no outcome, or where some failed and that isn't allowed."""
    states = written(journal.states(), "outcomes")
    missing = expected.join(states.select(F.col("key").alias(expected.columns[0])), expected.columns[0], "left_anti").count()
    failed = states.where("status <> 'done'").count()
    if missing or (failed and not allow_failures):
        raise ValueError(f"{missing} keys without an outcome, {failed} that aren't done")
    return store.publish({**relations, "outcomes": states}, {**keys, "outcomes": "key"}, branch, store.tip(branch))
