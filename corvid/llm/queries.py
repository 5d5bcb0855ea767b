"""The registered queries of this subpackage, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from corvid.llm import byte_bpe, chat, exact_dedup, mixing, mpeg_audio, quality, secrets, simhash, token_files, toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scan": secrets.op1_secret_scan,
        "op2_exact_dedup": exact_dedup.op2_exact_dedup,
        "op3_simhash": simhash.op3_simhash,
        "op4_token_files": token_files.op4_token_files,
        "op5_source_mixing": mixing.op5_source_mixing,
        "op6_byte_bpe": byte_bpe.op6_byte_bpe,
        "op7_quality": quality.op7_quality,
        "op8_toxicity": toxicity.op8_toxicity,
        "op9_mpeg_audio": mpeg_audio.op9_mpeg_audio,
        "op10_chat_format": chat.op10_chat_format,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": exact_dedup.SQL, "op5_source_mixing": mixing.SQL, "op10_chat_format": chat.SQL}
