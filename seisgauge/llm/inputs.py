"""What the operators of this subpackage share about their input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than blank, tab, line feed, vertical tab, form feed and
#: carriage return.
BLANKS = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` as long and ``text``, a null text being empty; other columns are left behind."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def words(text: Column) -> Column:
    """The words of a text, in order; none for an empty text."""
    return F.array_remove(F.split(text, BLANKS), "")


def partitions_for(spark: SparkSession, size: int, share: int) -> int:
    """Partitions so that each gets about ``share`` of ``size``, and all cores have work."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(size) // share), 1)
