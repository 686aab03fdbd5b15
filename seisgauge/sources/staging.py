"""Intermediate tables that several later steps read.

A staged table is written to the shared folder named by ``spark.checkpoint.dir``, so it
cuts the lineage, is computed once, and outlives the executors that wrote it.
"""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Options for rows with digests in hex, which take half the space so.
SMALL_DIGESTS = {"compression": "zstd"}

# Folders made up for sessions of one process that name none, by application.
_LOCAL_FOLDERS: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    # ``local`` and ``local[n]`` run driver and tasks in one process; ``local-cluster`` doesn't.
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="seisgauge-")
    return _LOCAL_FOLDERS[application]


def staging_path(spark: SparkSession, name: str) -> str:
    return f"{staging_root(spark)}/seisgauge/{name}-{uuid.uuid4().hex}"


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK = threading.Lock()
# Writes under way by session, and what the setting was before the first of them.
_WRITES: Counter[int] = Counter()
_SETTINGS: dict[int, str | None] = {}


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Writes within give back the disk of their shuffles as they end.

    Otherwise it stays taken until the driver happens to collect garbage, so the shuffles of all
    steps of a job add up. What is written is read from then on, so nobody reads them again.
    """
    session = id(spark)
    with _LOCK:
        if not _WRITES[session]:
            _SETTINGS[session] = spark.conf.get(_RELEASE, None)
            spark.conf.set(_RELEASE, "true")
        _WRITES[session] += 1
    try:
        yield
    finally:
        with _LOCK:
            _WRITES[session] -= 1
            if not _WRITES[session]:
                del _WRITES[session]
                before = _SETTINGS.pop(session)
                if before is None:
                    spark.conf.unset(_RELEASE)
                else:
                    spark.conf.set(_RELEASE, before)


def stage(rows: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``rows`` once and return a DataFrame that reads them back; ``options`` are the writer's."""
    spark = rows.sparkSession
    path = staging_path(spark, name)
    with released(spark):
        rows.write.options(**options).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
