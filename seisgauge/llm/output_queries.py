"""Registered queries of token files and packing. SQL has no tokenizer."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from seisgauge.sources.staging import staging_path

from .inputs import documents
from .packing import pack
from .token_files import read_token_files, with_global_starts, write_token_files

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = staging_path(spark, "tokens")
    index = write_token_files(documents(spark, sf_dir), root, TOKENIZER, end_id=1)
    rows = with_global_starts(read_token_files(index, digest=True), index)
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), TOKENIZER, end_id=2)
