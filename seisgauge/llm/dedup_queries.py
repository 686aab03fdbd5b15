"""Registered queries of deduplication and decontamination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .automaton_dedup import remove_passages
from .decontamination import decontaminate
from .inputs import documents
from .near_duplicates import near_duplicates
from .suffix_dedup import remove_repeats


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_passages(documents(spark, sf_dir))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), length=4)
