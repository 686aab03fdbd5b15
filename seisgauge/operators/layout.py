"""Physical layout of the fact tables.

Every query asks for a metric and a range of days, so the facts are stored by metric and
block of days, and sorted by day and channel within each file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTITION_COLUMNS = ["fkmetricid", "date_block"]
# A directory is what a batch rewrites and a query prunes: the more facts a metric has per
# day, the fewer days it should hold.
BLOCK_DAYS = 100


def block_of(day: Column, block_days: int) -> Column:
    return F.floor(day / F.lit(block_days)).cast("int")


def marked(facts: DataFrame, block_days: int) -> DataFrame:
    """Stored facts with the size of their blocks noted on the block column."""
    return facts.withMetadata("date_block", {"days": block_days})


def days_per_block(facts: DataFrame) -> int | None:
    """Days per block of facts in the stored layout, None for any other facts."""
    if "date_block" not in facts.columns:
        return None
    return facts.schema["date_block"].metadata.get("days")


def optimize_layout(facts: DataFrame, block_days: int = BLOCK_DAYS) -> DataFrame:
    """Facts gathered and sorted for ``write.partitionBy(*PARTITION_COLUMNS)``.

    The rebalance hint lets the runtime merge small directories into one task and split a
    large one, e.g. a metric with a third of all rows, over many tasks and files of about
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` each.
    """
    return (
        facts.withColumn("date_block", block_of(F.col("date"), block_days))
        .hint("rebalance", *[F.col(c) for c in PARTITION_COLUMNS])
        .sortWithinPartitions(*PARTITION_COLUMNS, "date", "fkchannelid")
    )
