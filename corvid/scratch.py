"""Folders and files that every machine of a cluster sees: scratch tables, and small files by the Hadoop file system.

Intermediate tables go to the folder that the cluster names in
``spark.checkpoint.dir`` (only where it is unset on a single machine, as in
tests, a local one is made).  A written table cuts lineage: a lost executor
costs a re-read, not a re-computation, and every executor sees the same rows.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors and the driver see: ``spark.checkpoint.dir``; a local one is set only where it is unset and one machine runs all."""
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not place:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir to a folder that every machine sees: {master} has more than one")
        place = "file://" + tempfile.mkdtemp(prefix="corvid-shared-")
        spark.conf.set("spark.checkpoint.dir", place)
    return place.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; ``release`` and the end of the driver remove it."""
    path = f"{shared_dir(spark)}/corvid/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read again with the same schema."""
    spark, schema = df.sparkSession, df.schema
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def mark() -> int:
    """A place in the list of scratch tables, for ``release``."""
    return len(_written)


def release(spark: SparkSession, since: int = 0, but: tuple[str, ...] = ()) -> int:
    """Remove this session's scratch tables, those from the mark on, without those that ``but`` names; call it when no result that reads one is needed any more."""
    mine = [x for x in _written[since:] if x[0] is spark and not any(f"/{name}-" in x[1] for name in but)]
    for x in mine:
        Files(*x).delete("")
        _written.remove(x)
    return len(mine)


@atexit.register
def _at_end() -> None:
    for spark, path in _written:
        try:
            if spark.sparkContext._jsc is not None:
                Files(spark, path).delete("")
        except Exception:  # noqa: BLE001  the JVM may be gone already
            return


class Files:
    """Small files under a root, by the Hadoop file system of its scheme."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.root = str(root).rstrip("/")
        at = self._at("")
        self.fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.local = self.fs.getScheme() == "file"

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _plain(self, name: str) -> str:
        return self._at(name).toUri().getPath()

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._at(name))

    def names(self, name: str) -> list[str]:
        """The names in a folder, sorted, without those that begin with a dot; none where there is no folder."""
        if not self.exists(name):
            return []
        return sorted(n for s in self.fs.listStatus(self._at(name)) if not (n := s.getPath().getName()).startswith("."))

    def make(self, name: str) -> None:
        self.fs.mkdirs(self._at(name))

    def delete(self, name: str) -> None:
        self.fs.delete(self._at(name), True)

    def read(self, name: str) -> str:
        source = self.fs.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    def _write(self, name: str, text: str, overwrite: bool) -> None:
        out = self.fs.create(self._at(name), overwrite)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def move(self, old: str, new: str) -> None:
        if not self.fs.rename(self._at(old), self._at(new)):
            raise OSError(f"{self.root}: {old} wasn't moved to {new}")

    def put(self, name: str, text: str) -> None:
        """A new file that is seen whole or not at all."""
        folder, _, last = name.rpartition("/")
        draft = f"{folder}/.draft-{uuid.uuid4().hex}-{last}" if folder else f".draft-{uuid.uuid4().hex}-{last}"
        self._write(draft, text, False)
        self.move(draft, name)

    def claim(self, name: str, text: str) -> bool:
        """Make a file that isn't there; false where another made it first.  One of several at once wins: by a hard link
        on a local disk, and by the file system's own exclusive create elsewhere."""
        if self.local:
            draft = f"{self._plain(name)}.{uuid.uuid4().hex}"
            folder, _, last = draft.rpartition("/")
            draft = f"{folder}/.{last}"
            os.makedirs(folder, exist_ok=True)
            with open(draft, "x", encoding="utf-8") as out:
                out.write(text)
            try:
                os.link(draft, self._plain(name))
            except FileExistsError:
                return False
            finally:
                os.remove(draft)
            return True
        from py4j.protocol import Py4JJavaError

        try:
            self._write(name, text, False)
        except Py4JJavaError:
            if self.exists(name):
                return False
            raise
        return True
