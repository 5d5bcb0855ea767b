"""An event ledger fed by a stream: each batch appends only (key) rows that the ledger doesn't have.

The anti-join runs per batch against the whole ledger, so old keys are never
forgotten; a stream that may forget uses ``deduplicated`` with a watermark.  A
batch that runs again writes the same partition again, so a restart repeats
nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from corvid.operators.relational import latest
from corvid.operators.versioning import append_unseen


def read_ledger(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    shape = StructType([*like.schema.fields, StructField("batch", LongType())])
    try:
        return spark.read.schema(shape).parquet(path)
    except Exception as e:  # the ledger's first batch
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], shape)


def feed_ledger(events: DataFrame, path: str, keys: Sequence[str], checkpoint: str, order: str | None = None) -> StreamingQuery:
    """Start the append; ``availableNow`` takes what there is and stops.  ``order``: of a batch's rows with one key the least stays."""

    def append(batch: DataFrame, number: int) -> None:
        known = read_ledger(batch.sparkSession, path, batch).where(F.col("batch") < number)
        new = append_unseen(known, latest(batch, keys, [F.col(order)]) if order else batch, keys).withColumn("batch", F.lit(number).cast("long"))
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    return events.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def deduplicated(events: DataFrame, keys: Sequence[str], time: str, late: str) -> DataFrame:
    """Events once each, with keys forgotten once they are ``late`` behind the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


def windowed_counts(events: DataFrame, time: str, by: Sequence[str], window: str, late: str) -> DataFrame:
    """Counts and sums a window and group, closed by the watermark."""
    return events.withWatermark(time, late).groupBy(F.window(time, window), *by).agg(F.count("*").alias("n"))


class _PolledReader(SimpleDataSourceStreamReader):
    """Reads pages (JSON-lines files named by number) after the last one seen."""

    def __init__(self, options):
        self.root = options["path"]

    def initialOffset(self):
        return {"page": -1}

    def _pages(self, after: int, upto: int | None = None):
        import os

        found = sorted(int(f.split(".")[0]) for f in os.listdir(self.root) if f.endswith(".jsonl") and f.split(".")[0].isdigit())
        return [p for p in found if p > after and (upto is None or p <= upto)]

    def _rows(self, pages):
        import json

        for p in pages:
            with open(f"{self.root}/{p}.jsonl") as f:
                for line in f:
                    e = json.loads(line)
                    yield (e.get("accession"), e.get("source"), e.get("accepted"))

    def read(self, start):
        pages = self._pages(start["page"])
        return iter(list(self._rows(pages))), {"page": pages[-1] if pages else start["page"]}

    def readBetweenOffsets(self, start, end):
        return self._rows(self._pages(start["page"], end["page"]))


class PolledFeed(DataSource):
    """``corvid_feed``: a polled feed's pages as a stream; the offset is the last page, so a restart reads no page twice."""

    @classmethod
    def name(cls):
        return "corvid_feed"

    def schema(self):
        return "accession string, source string, accepted string"

    def simpleStreamReader(self, schema):
        return _PolledReader(self.options)


__all__ = ["PolledFeed", "deduplicated", "feed_ledger", "read_ledger", "windowed_counts"]
