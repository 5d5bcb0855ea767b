"""Table sources and sinks: explicit part lists, delimited text with a header test, JSON lines, ZIP members, vintages."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEPARATORS = {"csv": ",", "tsv": "\t"}


def read_parts(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Parquet parts from a manifest's list, not from a directory listing; without a schema columns are united by name."""
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", "true")
    return reader.parquet(*paths)


def read_table(spark: SparkSession, path: str, kind: str, schema: T.StructType | str | None = None) -> DataFrame:
    """parquet, csv, tsv or json (one object a line)."""
    reader = spark.read.schema(schema) if schema else spark.read
    match kind:
        case "parquet":
            return reader.parquet(path)
        case "csv" | "tsv":
            return reader.csv(path, header=True, sep=SEPARATORS[kind])
        case "json":
            return reader.json(path)
    raise ValueError(f"unknown format: {kind!r}")


def read_cohort(spark: SparkSession, path: str, kind: str = "csv", sep: str | None = None) -> DataFrame:
    """(key, name) rows of a file with or without a header: a header has a column named cik, else the first column is the key."""
    if kind in ("parquet", "json"):
        df = read_table(spark, path, kind)
    else:
        df = spark.read.csv(path, header=True, sep=sep or SEPARATORS[kind])
        if not any("cik" in c.lower() for c in df.columns):
            df = spark.read.csv(path, header=False, sep=sep or SEPARATORS[kind])
    key = next((c for c in df.columns if c.lower() in ("cik", "cik_padded", "cik_str")), next((c for c in df.columns if "cik" in c.lower()), df.columns[0]))
    name = next((c for c in df.columns if c != key and c.lower() in ("name", "company_name", "title", "entity")), next((c for c in df.columns if c != key), None))
    label = F.col(f"`{name}`").cast("string") if name else F.lit("")
    return df.select(F.col(f"`{key}`").cast("string").alias("key"), label.alias("name"))


def write_parquet(df: DataFrame, path: str, schema: T.StructType | None = None, rows_per_file: int = 0, mode: str = "errorifexists") -> None:
    """zstd Parquet under a declared schema; Spark's committer makes the write all or nothing."""
    out = df.to(schema) if schema else df
    writer = out.write.mode(mode).option("compression", "zstd")
    (writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer).parquet(path)


def write_vintage(df: DataFrame, path: str, set_id: str, vintage: str, archive_sha: str) -> None:
    """Replace one (set, vintage) slice of a store and leave the others; the session needs dynamic partition overwrite."""
    lineage = df.withColumns({"archive_sha": F.lit(archive_sha), "set_id": F.lit(set_id), "vintage": F.lit(vintage)})
    lineage.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("set_id", "vintage").parquet(path)


MEMBERS = "path string, member string, crc32 long, compressed_size long, uncompressed_size long, header_offset long"


def zip_members(spark: SparkSession, path: str) -> DataFrame:
    """One row a member of each archive: its central directory entry."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at, data in zip(frame["path"], frame["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(data)) as z:
                    yield pd.DataFrame([(at, i.filename, i.CRC, i.compress_size, i.file_size, i.header_offset) for i in z.infolist() if not i.is_dir()], columns=["path", "member", "crc32", "compressed_size", "uncompressed_size", "header_offset"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(read, MEMBERS)


def read_members(spark: SparkSession, path: str, names: Sequence[str] | None = None, most: int = 256 << 20) -> DataFrame:
    """(path, member, content) of archive members; one that is larger than ``most`` bytes or fails its checksum is an error row."""
    wanted = set(names) if names is not None else None

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at, data in zip(frame["path"], frame["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(data)) as z:
                    for i in z.infolist():
                        if i.is_dir() or (wanted is not None and i.filename not in wanted):
                            continue
                        body, error = None, None
                        if i.file_size > most:
                            error = "too large"
                        else:
                            try:
                                body = z.read(i)
                            except (zipfile.BadZipFile, zlib.error) as e:
                                error = str(e)
                        yield pd.DataFrame({"path": [at], "member": [i.filename], "content": [body], "error": [error]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(read, "path string, member string, content binary, error string")


def member_changes(new: DataFrame, old: DataFrame) -> DataFrame:
    """(member, state): new, changed, carried or removed, by checksum."""
    a, b = new.select("member", F.col("crc32").alias("_n")), old.select("member", F.col("crc32").alias("_o"))
    state = F.when(F.col("_o").isNull(), "new").when(F.col("_n").isNull(), "removed").when(F.col("_n") == F.col("_o"), "carried").otherwise("changed")
    return a.join(b, "member", "full_outer").select("member", state.alias("state"))


def set_closure(merged: DataFrame, base: DataFrame, fetched: DataFrame, key: str) -> Mapping[str, int]:
    """Keys that a merge lost or invented: both counts are zero when merged is base with fetched."""
    whole = base.select(key).union(fetched.select(key)).distinct()
    return {"lost": whole.subtract(merged.select(key)).count(), "invented": merged.select(key).subtract(whole).count()}


class StagedWriter:
    """Batches appended to a staging folder, then moved to their place once the expected count is there; a restart goes on where it stopped."""

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key, self.staging = spark, path, key, path.rstrip("/") + ".staging"

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        return at(self.staging).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def staged(self) -> DataFrame | None:
        fs, at = self._fs()
        return self.spark.read.parquet(self.staging) if fs.exists(at(self.staging)) else None

    def append(self, batch: DataFrame) -> None:
        """Rows whose key isn't staged yet."""
        known = self.staged()
        new = batch if known is None else batch.join(known.select(self.key), self.key, "left_anti")
        new.write.mode("append").option("compression", "zstd").parquet(self.staging)

    def commit(self, expected: int | None = None) -> int:
        done = self.staged()
        n = 0 if done is None else done.count()
        if expected is not None and n != expected:
            raise ValueError(f"{n} rows are staged, {expected} were expected")
        fs, at = self._fs()
        if not fs.rename(at(self.staging), at(self.path)):
            raise OSError(f"{self.path} can't be put in place")
        return n
