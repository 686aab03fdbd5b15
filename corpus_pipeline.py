"""Documents to packed sequences: quality, near duplicates, benchmark passages, personal data,
packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept. All but the
last return the columns of ``docs``; the last returns the pieces of the packed sequences.

Nulls and odd rows: documents without an id are judged by their text alone, and come last among near
duplicates. Each row has its own verdict on near duplicates and benchmark passages: of repeated rows
one stays, and rows of one id with different texts don't share a verdict. An empty table gives no
pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seisgauge.llm.decontamination import findings
from seisgauge.llm.inputs import documents
from seisgauge.llm.near_duplicates import near_duplicates
from seisgauge.llm.output_queries import TOKENIZER
from seisgauge.llm.packing import pack
from seisgauge.llm.personal_data import redact
from seisgauge.llm.quality_classifier import fit, held_out, keep_good
from seisgauge.llm.shipping import shipped
from seisgauge.sources.staging import stage

END_ID = 2


ROW = "_row"


def _numbered(docs: DataFrame) -> DataFrame:
    """Rows with a number each, in the order of doc_id, nulls last."""
    order = [F.col("doc_id").cast("long").asc_nulls_last(), F.xxhash64("text")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return stage(dealt.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def _by_row(docs: DataFrame) -> DataFrame:
    return docs.select(F.col(ROW).alias("doc_id"), "text")


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    rest = docs.join(dropped.select(F.col("doc_id").alias(ROW)), ROW, "left_anti")
    return rest.drop(ROW)


@shipped
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be of quality 1."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return keep_good(docs, fit(docs, labels.where(~held_out(F.col("doc_id")))))


@shipped
def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each group of near duplicates."""
    rows = _numbered(docs)
    return _without(rows, near_duplicates(_by_row(rows)).where("not kept")).select(*docs.columns)


@shipped
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    # Rows of one id and text have one verdict.
    rows = docs.withColumn(ROW, F.xxhash64("doc_id", "text"))
    return _without(rows, findings(_by_row(rows), benchmark).where("n_items > 0")).select(*docs.columns)


@shipped
def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data replaced by their kind; ``n_chars`` follows."""
    hidden = redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        hidden = hidden.withColumn("n_chars", F.coalesce(F.length("text"), "n_chars").cast(kind))
    return hidden.select(*docs.columns)


@shipped
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the sequences of at most 4096 tokens."""
    return pack(docs, TOKENIZER, END_ID)


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", deduplicate),
    ("benchmark decontamination", decontaminate),
    ("personal data", hide_personal_data),
    ("packing", packed),
]

#: A fit, a tokenizer and components aren't SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir)
    for name, function in STAGES[:-1]:
        rows = stage(function(spark, rows, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, rows, sf_dir)
