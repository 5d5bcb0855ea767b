"""A corpus pipeline: each stage reads what its predecessor wrote.

Toxic documents go, exact copies go, one document of each near-duplicate class
stays, sources are mixed by temperature (every document is kept, and smaller
sources are repeated up to ``REPEATS`` times), and the rest is encoded.

Defined results of every stage: an empty table gives an empty table; columns
that aren't named here pass through the first four stages, whatever their names
and with their nulls.  A null text counts as empty, a null source as a source
of its own, and a null id sorts after all others and is nobody's label.  Each
stage's own cases (ties, repeated rows) stand in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm import byte_bpe, exact_dedup, mixing, simhash, toxicity
from corvid.llm.common import mark, release, table, written

REPEATS = 1.25
#: SQL can't express the classifier, SimHash or the merges: tests/llm hold run() against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score 0.5 or more go.  Equal texts score alike, so repeated rows go or stay together; without labels all rows stay."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal normalised texts the one with the smallest id stays; of rows that repeat id and text exactly one."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash class the row with the smallest id stays; of rows that repeat it exactly one.  All empty texts are one class."""
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row stays, some more than once.  Rows that repeat an id are drawn together; a source without words keeps one epoch."""
    return mixing.mix(docs, repeat_limit=REPEATS, cover=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens): the token ids of every row that is left, repeated rows each; an empty text has none.

    The ids are decoded again and held against the text: ValueError where they differ.
    """
    import public_tokenizers

    coded = byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, check=True)
    return coded.select(F.col("id").alias("doc_id"), "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("source mixing", mix_sources),
    ("byte-level bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; what a stage needed besides its result is removed once that is written."""
    docs, begun = table(spark, sf_dir, "documents"), mark()
    for name, stage in STAGES[:-1]:
        kept = name.replace(" ", "-")
        docs = written(stage(spark, docs, sf_dir), kept)
        release(spark, begun, but=(kept,))
    return STAGES[-1][1](spark, docs, sf_dir)
