"""Payloads as zstd frames, in Arrow batches."""

from __future__ import annotations

import pandas as pd
import zstandard
from pyspark.sql import Column
from pyspark.sql import functions as F


def compressed(column: Column, level: int = 3) -> Column:
    """A binary or text column as zstd frames; null stays null."""

    @F.pandas_udf("binary")
    def run(values: pd.Series) -> pd.Series:
        press = zstandard.ZstdCompressor(level=level, write_content_size=True)
        return values.map(lambda x: None if x is None else press.compress(bytes(x)))

    return run(column.cast("binary"))


def decompressed(column: Column) -> Column:
    """The bytes of zstd frames; null stays null, and anything else raises."""

    @F.pandas_udf("binary")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda x: None if x is None else zstandard.ZstdDecompressor().decompressobj().decompress(bytes(x)))

    return run(column)
