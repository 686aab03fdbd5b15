"""Registered query of the quality classifier. A fit isn't SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .inputs import documents
from .quality_classifier import fit, held_out, score


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    ranking = fit(docs, labels.where(~held_out(F.col("doc_id"))))
    return score(docs, ranking).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
