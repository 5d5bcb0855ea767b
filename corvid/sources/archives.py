"""A content-addressed store of archives with a written member index, and Parquet files under another schema.

An archive is kept once under its SHA-256; its central directory is a table, so
a member is found by a join and read by its offset, and the archive isn't
listed again.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.scratch import Files
from corvid.sources.readers import write_parquet, zip_members


class ArchiveStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, str(root).rstrip("/"), Files(spark, root)

    def put(self, path: str) -> str:
        """Keep the archive at ``path`` and its index; its digest.  A second time nothing is written."""
        rows = self.spark.read.format("binaryFile").load(path).select(F.sha2("content", 256)).collect()
        if len(rows) != 1:
            raise ValueError(f"{path}: {len(rows)} files")
        digest = rows[0][0]
        if not self.files.exists(f"index/{digest}/_SUCCESS"):
            fs, at = self.files.fs, self.files._at(f"archives/{digest}.zip")
            source = self.files.jvm.org.apache.hadoop.fs.Path(path)
            conf = self.spark.sparkContext._jsc.hadoopConfiguration()
            self.files.jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, fs, at, False, True, conf)
            zip_members(self.spark, f"{self.root}/archives/{digest}.zip").withColumn("archive", F.lit(digest)).write.mode("overwrite").parquet(f"{self.root}/index/{digest}")
        return digest

    def archives(self) -> list[str]:
        return self.files.names("index")

    def index(self, digest: str) -> DataFrame:
        """(path, member, crc32, compressed_size, uncompressed_size, header_offset, archive)."""
        return self.spark.read.parquet(f"{self.root}/index/{digest}")

    def read(self, digest: str, members: Sequence[str]) -> DataFrame:
        """(member, content, error) of each member asked for; one that isn't there is an error row."""
        wanted = list(members)

        def take(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for data in frame["content"]:
                    with zipfile.ZipFile(io.BytesIO(data)) as z:
                        have = set(z.namelist())
                        for name in wanted:
                            if name not in have:
                                yield pd.DataFrame({"member": [name], "content": [None], "error": ["no such member"]})
                                continue
                            try:
                                yield pd.DataFrame({"member": [name], "content": [z.read(name)], "error": [None]})
                            except zipfile.BadZipFile as e:
                                yield pd.DataFrame({"member": [name], "content": [None], "error": [str(e)]})

        files = self.spark.read.format("binaryFile").load(f"{self.root}/archives/{digest}.zip").select("content")
        return files.mapInPandas(take, "member string, content binary, error string")

    def verify(self, digest: str) -> bool:
        found = self.spark.read.format("binaryFile").load(f"{self.root}/archives/{digest}.zip").select(F.sha2("content", 256)).first()[0]
        return found == digest


def rewrite_schema(spark: SparkSession, source: str, destination: str, schema: T.StructType) -> None:
    """The table at ``source`` written under another schema: columns by name, in its order, cast and checked for nulls."""
    write_parquet(spark.read.parquet(source).to(schema), destination, schema)


def footer_stats(spark: SparkSession, path: str, key: str | None = None) -> dict[str, object]:
    """{rows, low, high} of a table; Spark answers from Parquet footers where ``spark.sql.parquet.aggregatePushdown`` is on."""
    parts = [F.count("*").alias("rows")] + ([F.min(key).alias("low"), F.max(key).alias("high")] if key else [])
    return spark.read.parquet(path).agg(*parts).first().asDict()
