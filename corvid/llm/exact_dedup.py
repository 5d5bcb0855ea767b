"""Exact deduplication: two-pass Bloom filtering, DataFrame functions only.

Texts are equal when identical after each run of ASCII white space became one
space.  Every text is normalised and hashed (SHA-256) once, into a written
table.  Pass one counts how often each of the filter's bit positions is hit; a
position hit twice is set.  Pass two tests every row against that filter: a row
with an unset position holds a hash that occurs once, and passes straight
through.  Only the other rows shuffle, to be grouped by the full hash, so false
positives cost a little work and never a wrong result.

A filter is broadcast, and holds ``max_bits`` at most (32 MB).  More rows than
that serves (16 bits a row) are split by hash into ranges, each with a filter of
its own, built and tested one after another: equal hashes share a range, so
results are the same, and no broadcast grows with the data.

Pass one sends two positions a row, combined before they are sent, and neither
hash, id nor text.  Bitmaps made in each partition and then united would send
the whole filter once a partition, which grows with the square of the rows.

Defined results: null text is empty text, and equals it; null ids sort after
all others; of rows that repeat id and text exactly one stays; ties are
impossible otherwise; an empty table gives an empty result; other columns are
passed through by ``drop_copies`` and ignored by ``copies``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.llm.common import fresh, scratch_path, table, text_of, written

WHITE = r"[\x20\x09-\x0D]+"
PAGE = 1 << 15  # bits in one bitmap of bitmap_construct_agg


def text_hash(text_col: str) -> Column:
    """SHA-256 of the normalised text in UTF-8, as 32 bytes."""
    return F.unhex(F.sha2(F.regexp_replace(text_of(text_col), WHITE, " "), 256))


def filter_bits(rows: int, max_bits: int) -> tuple[int, int]:
    """(ranges, bits of each range's filter): 16 bits a row, a power of two, at most ``max_bits``."""
    most = max(PAGE, max_bits)
    ranges = max(1, -(-16 * rows // most))
    return ranges, max(PAGE, min(most, 1 << (16 * rows // ranges).bit_length()))


def _positions(sha: Column, bits: int) -> list[Column]:
    h = F.xxhash64(sha)
    return [h.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1))]


def repeat_filter(hashes: DataFrame, bits: int) -> DataFrame:
    """The filter as rows (page, map): bit p is set if at least two hash insertions hit position p."""
    return (
        hashes.select(F.explode(F.array(*_positions(F.col("sha"), bits))).alias("p"))
        .groupBy("p").agg(F.count("*").alias("n")).where("n > 1")
        .groupBy(F.shiftright("p", 15).alias("page")).agg(F.bitmap_construct_agg(F.col("p") % PAGE).alias("map"))
    )


def with_repeat_test(rows: DataFrame, sha: str, bloom: DataFrame, bits: int, out: str) -> DataFrame:
    """``rows`` with the boolean ``out``: false means that no other row has this hash."""
    test = F.lit(True)
    mine = rows
    names = fresh(rows, "_page0", "_map0", "_page1", "_map1")
    for k, p in enumerate(_positions(F.col(sha), bits)):
        page, bitmap = names[2 * k], names[2 * k + 1]
        # at most max_bits / PAGE rows of 4 KB: a bound that does not depend on the data
        mine = mine.join(F.broadcast(bloom.select(F.col("page").alias(page), F.col("map").alias(bitmap))), F.shiftright(p, 15) == F.col(page), "left")
        byte = F.conv(F.hex(F.substring(F.col(bitmap), F.shiftright(p.bitwiseAND(F.lit(PAGE - 1)), 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        bit = F.call_function("shiftright", byte, p.bitwiseAND(F.lit(7)).cast("int")).bitwiseAND(F.lit(1))
        test = test & F.coalesce(bit == 1, F.lit(False))
    return mine.withColumn(out, test).drop(*names)


def _range(ranges: int) -> Column:
    """The hash range of a row, from bits that the filter's positions don't use."""
    return F.pmod(F.xxhash64("sha", F.lit(1)), F.lit(ranges)).cast("int")


def tested(rows: DataFrame, ranges: int, bits: int) -> DataFrame:
    """``rows`` (with the columns ``sha`` and ``range``) with ``suspected``: false means that no other row has this hash."""
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "tested")
    for k in range(ranges):
        mine = rows.where(F.col("range") == k)
        bloom = written(repeat_filter(mine, bits), "bloom")
        flagged = with_repeat_test(mine, "sha", bloom, bits, "suspected")
        if ranges == 1:
            return flagged
        flagged.write.mode("append").parquet(path)
    return spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("suspected", T.BooleanType())])).parquet(path)


def _hashed(docs: DataFrame, ranges: int, name: str) -> DataFrame:
    """``docs`` (with ``sha``) written with ``row`` and ``range``, a folder a range where there are several."""
    rows = docs.withColumns({"row": F.monotonically_increasing_id(), "range": _range(ranges)})
    if ranges == 1:
        return written(rows, name)
    path = scratch_path(docs.sparkSession, name)
    rows.write.partitionBy("range").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path).select(rows.columns)


def _groups(suspects: DataFrame) -> DataFrame:
    """(sha, first, group_size); written, so that both sides of a join with it are plain exchanges, of which Spark can split a hot hash's partition."""
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first")
    return written(suspects.groupBy("sha").agg(first, F.count("*").alias("group_size")), "groups")


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 1 << 28) -> DataFrame:
    """A row per document: (id, sha, keep_id, group_size, kept, suspected).  Of equal texts the row with the smallest id stays."""
    ranges, bits = filter_bits(docs.count(), max_bits)
    rows = tested(_hashed(docs.select(F.col(f"`{id_col}`").alias("id"), text_hash(text_col).alias("sha")), ranges, "hashes"), ranges, bits)
    alone = rows.where("not suspected").select("id", "sha", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "suspected")
    suspects = rows.where("suspected")
    grouped = suspects.join(_groups(suspects), "sha")
    return alone.unionByName(grouped.select("id", "sha", F.col("first.id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"), "suspected"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 1 << 28) -> DataFrame:
    """``docs`` without the later copies; rows whose hash occurs once pass straight through, text and all.

    The documents are written once, with their hash and a row number; the rows
    that go are a table of row numbers, which no group of copies makes hot.
    """
    ranges, bits = filter_bits(docs.count(), max_bits)
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    rows = tested(_hashed(docs.select(own, F.col(f"`{id_col}`").alias("id"), text_hash(text_col).alias("sha")), ranges, "hashed"), ranges, bits)
    suspects = rows.where("suspected")
    # a table that is written has a known size: Spark broadcasts it where that is small, and shuffles the suspected rows by row number where it isn't
    gone = written(suspects.select("id", "row", "sha").join(_groups(suspects.select("id", "row", "sha")), "sha").where("row <> first.row").select("row"), "gone")
    return rows.where("not suspected").select("own.*").unionByName(suspects.join(gone, "row", "left_anti").select("own.*"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = copies(table(spark, sf_dir, "documents"))
    return report.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


SQL = r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM n
"""
