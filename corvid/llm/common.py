"""What the operators of this subpackage share: scratch tables, table loading, batch slicing."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.scratch import mark, release, scratch_path, shared_dir, written

__all__ = ["by_bytes", "fresh", "mark", "release", "scratch_path", "shared_dir", "table", "text_of", "trim", "written"]

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't have, for internal columns beside a caller's own."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def text_of(column: str):
    """The text column as a string; null counts as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def trim() -> None:
    """Give freed memory back at the end of a task: workers are used again, and what one stage cached is no use to the next."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def by_bytes(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts hold about ``most`` bytes (one longer text is a slice of its own)."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        start, held = 0, 0
        sizes = pc.binary_length(texts).to_pylist()
        for i, n in enumerate(sizes):
            if held and held + (n or 0) > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        if start < batch.num_rows:
            yield batch.slice(start)
