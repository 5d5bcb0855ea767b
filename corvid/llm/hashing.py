"""Hashed word features of a batch of texts, shared by the two classifiers; and bounded samples of labelled rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from corvid.llm.common import by_bytes, trim, written

SLICE = 2 << 20  # bytes of text scored at once: the arrays of its features take some thirty times that
TRIM = "\"'`.,;:!?()[]{}<>*&%$#@|~^-_=+/\\"


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(distinct word at each place, words in each text, distinct words): lower-cased, split at ASCII white space, without punctuation around them."""
    split = pc.ascii_split_whitespace(pc.utf8_lower(texts))
    sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = split.flatten().dictionary_encode()
    return coded.indices.to_numpy(), sizes, pc.utf8_trim(coded.dictionary, characters=TRIM).to_pylist()


def hashes(distinct: list[str], prefix: str = "") -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(prefix + w) for w in distinct), np.uint64, len(distinct))


def held_out(id_col: str, parts: int, part: int) -> Column:
    """crc32 of the id as text, modulo ``parts``, is ``part``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % parts == part, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int, parts: int, part: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, list[int]]:
    """(id, text, y) of at most ``bound`` labelled ids (half of each class, in order of a hash of the id) that are not held out, and the class sizes.

    Rows with a null label or id are left out; an id labelled twice takes the larger label.
    """
    known = labels.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").alias("id")).agg(F.max(F.when(F.col(f"`{label}`") > 0, 1).otherwise(0)).alias("y"))
    free = known.where(~held_out("id", parts, part))
    sizes = {r["y"]: r["count"] for r in free.groupBy("y").count().collect()}
    some = [free.where(f"y = {y}").orderBy(F.xxhash64("id"), "id").limit(bound // 2) for y in (0, 1)]
    chosen = some[0].unionByName(some[1])  # at most ``bound`` rows of two numbers, whatever the input
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return rows.join(F.broadcast(chosen), "id").select("id", "text", "y"), [sizes.get(0, 0), sizes.get(1, 0)]


def bounded(rows: DataFrame, features: list[str], max_bytes: int) -> list[Row]:
    """The rows (id, features, y) a model is fitted on, sorted: one a labelled id (of rows that repeat it, the least), in order of
    a hash of the id while their features stay within ``max_bytes`` together, so that what the driver holds is bounded whatever the texts.

    The running sum is over ids and sizes only: at most as many rows as the sample has ids.
    """
    size = reduce(add, [F.length(f) for f in features]).cast("long")
    told = written(rows.withColumns({"size": size, "hash": F.xxhash64(*features)}), "features")
    one = told.groupBy("id").agg(F.min(F.struct("size", "hash", "y")).alias("r")).select("id", "r.*")
    upto = F.sum("size").over(W.Window.orderBy(F.xxhash64("id"), "id").rowsBetween(W.Window.unboundedPreceding, W.Window.currentRow))
    some = one.withColumn("upto", upto).where(F.col("upto") <= max_bytes).drop("upto")
    chosen = told.join(F.broadcast(some), ["id", "size", "hash", "y"], "left_semi").dropDuplicates(["id"])
    return sorted(chosen.select(*features, "y").collect())


def scored(docs: DataFrame, score: Callable[[pa.Array], np.ndarray], id_col: str, text_col: str) -> DataFrame:
    """(id, score): ``score`` maps the texts of a batch to scores."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, most=SLICE):
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(score(batch.column("text")).astype(np.float64))], names=["id", "score"])
        trim()

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, score double")


def with_scores(docs: DataFrame, score: Callable[[pa.Array], np.ndarray], text_col: str, out: str) -> DataFrame:
    """``docs`` with the column ``out``: the score of the text, every other column as it is."""
    names = docs.columns
    place = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_bytes([whole], text_col, SLICE):
                texts = pc.fill_null(batch.column(place).cast(pa.string()), "")
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score(texts).astype(np.float64))], names=[*names, out])
        trim()

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))
