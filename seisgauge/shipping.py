"""The package for the executors' Python workers, which may not have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).resolve().parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package's modules to the executors, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="seisgauge-modules-")) / "seisgauge_modules.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for module in sorted(_PACKAGE.rglob("*.py")):
            file.write(module, module.relative_to(_PACKAGE.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def shipped(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A query (spark, ...) before which the modules are sent."""

    @wraps(query)
    def run(spark: SparkSession, *inputs) -> DataFrame:
        ship(spark)
        return query(spark, *inputs)

    return run
