"""Aggregates and scores of a date window, per channel or per station.

How a metric is aggregated is decided by its compute type: a mean over readings, a total,
or the age in days of the last calibration. All three are distributive, so the bulk form
reduces the facts to one row per (channel, metric) before any dimension is joined: what is
shuffled is bounded by the number of channels per task, not by the number of facts, and a
station or metric that holds a third of all rows costs nothing extra.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import julian_number, numeric_text, record, round_numeric, score, score_text
from ..schemas import (
    AVERAGE,
    CALIBRATION_AGE,
    CALIBRATION_AVERAGE,
    DAY_AVERAGE,
    TOTAL,
    Model,
)
from .windows import Ids, pick, station_channels, window_facts

# Decimals kept per level and compute type.
DIGITS = {
    "channel": {AVERAGE: 2, TOTAL: 0, CALIBRATION_AGE: 0},
    "station": {AVERAGE: 4, TOTAL: 0, CALIBRATION_AGE: 4},
}

# The word each query answers with where it computes nothing. Compute types
# that are not listed answer "Error".
STATUS_WORDS: dict[str, dict[int, str | None]] = {
    "channel_data": {DAY_AVERAGE: "2", CALIBRATION_AVERAGE: "6"},
    "station_data": {DAY_AVERAGE: "2", CALIBRATION_AVERAGE: None},
    "channel_plot": {DAY_AVERAGE: "2", CALIBRATION_AGE: "5", CALIBRATION_AVERAGE: "6"},
    "station_plot": {DAY_AVERAGE: "2", CALIBRATION_AGE: "5", CALIBRATION_AVERAGE: "6"},
}
COMPUTED = {
    "channel_data": (AVERAGE, TOTAL, CALIBRATION_AGE),
    "station_data": (AVERAGE, TOTAL, CALIBRATION_AGE),
    "channel_plot": (AVERAGE, TOTAL),
    "station_plot": (AVERAGE, TOTAL),
}


def scorecard(
    model: Model,
    begin: dt.date | str,
    end: dt.date | str,
    level: str = "station",
    compute_types: Sequence[int] = (AVERAGE, TOTAL, CALIBRATION_AGE),
    metric_id: int | None = None,
    ids: Ids = None,
) -> DataFrame:
    """(id, fkmetricid, metric, value, score, record) of every channel or station.

    The window start does not apply to calibration ages: they count from the last
    calibration on or before ``end``. Ignored channels count at channel level only.
    """
    branches = []
    computed = set(compute_types) & {AVERAGE, TOTAL}
    digits = DIGITS[level]
    if computed:
        facts = window_facts(model["metricdata"], begin, end, metric_id)
        totals = _aggregate(
            facts.join(_metrics(model, computed), "fkmetricid", "left_semi"),
            model,
            level,
            ids,
            first={"total": F.sum("value"), "readings": F.count(F.lit(1))},
            again={"total": F.sum("total"), "readings": F.sum("readings")},
        )
        mean = F.col("total") / F.col("readings")
        kind = F.col("fkcomputetypeid")

        def either(render: Callable[[Column, int], Column]) -> Column:
            return F.when(kind == AVERAGE, render(mean, digits[AVERAGE])).otherwise(
                render(F.col("total"), digits[TOTAL])
            )

        branches.append(
            totals.join(_metrics(model, computed), "fkmetricid").select(
                "id",
                "fkmetricid",
                "metric",
                either(round_numeric).alias("value"),
                either(numeric_text).alias("value_text"),
            )
        )
    if CALIBRATION_AGE in compute_types:
        facts = window_facts(model["metricstringdata"], None, end, metric_id)
        metrics = _metrics(model, {CALIBRATION_AGE})
        ages = _aggregate(
            facts.join(metrics, "fkmetricid", "left_semi"),
            model,
            level,
            ids,
            first={"last_day": F.max("date")},
            again={"last_day": F.max("last_day")},
        )
        days = F.lit(julian_number(end)) - F.col("last_day")
        decimals = digits[CALIBRATION_AGE]
        branches.append(
            ages.join(metrics, "fkmetricid").select(
                "id",
                "fkmetricid",
                "metric",
                days.cast("double").alias("value"),
                F.concat(
                    days.cast("string"), F.lit("." + "0" * decimals if decimals else "")
                ).alias("value_text"),
            )
        )
    scored = reduce(DataFrame.unionByName, branches).withColumn(
        "score", score(F.col("value"), F.col("metric"))
    )
    line = record(
        F.col("id"), F.col("value_text"), score_text(F.col("score"), F.col("metric"))
    )
    return scored.select("id", "fkmetricid", "metric", "value", "score", line.alias("record"))


def channel_data(
    model: Model, channel_ids: Ids, metric_id: int, begin: dt.date | str, end: dt.date | str
) -> DataFrame:
    """(id, value, score, record) of the given channels; ignored channels included."""
    return _data(model, "channel", channel_ids, metric_id, begin, end)


def station_data(
    model: Model, station_ids: Ids, metric_id: int, begin: dt.date | str, end: dt.date | str
) -> DataFrame:
    """(id, value, score, record) of the given stations, pooled over their channels."""
    return _data(model, "station", station_ids, metric_id, begin, end)


def compute_type_status(model: Model) -> DataFrame:
    """Per metric the word each query answers with; ``data`` where it returns rows."""

    def answer(query: str) -> Column:
        kind = F.col("fkcomputetypeid")
        words = F.when(kind.isin(list(COMPUTED[query])), "data")
        for compute_type, word in STATUS_WORDS[query].items():
            words = words.when(kind == compute_type, F.lit(word))
        return words.otherwise("Error").alias(query)

    return model["metric"].select(
        F.col("pkmetricid").alias("fkmetricid"),
        F.col("name").alias("metric"),
        *[answer(query) for query in STATUS_WORDS],
    )


def metric_compute_type(model: Model, metric_id: int) -> int | None:
    """Compute type of one metric; reads a single row of the metric table."""
    row = model["metric"].where(F.col("pkmetricid") == metric_id).select("fkcomputetypeid").first()
    return None if row is None else row[0]


def status_row(model: Model, query: str, compute_type: int | None, columns: str) -> DataFrame:
    """One row whose ``record`` is the answer to a metric the query does not compute."""
    word = STATUS_WORDS[query].get(compute_type, "Error")
    return model["metric"].sparkSession.createDataFrame(
        [(None,) * (columns.count(",") + 1) + (word,)], f"{columns}, record string"
    )


def _data(
    model: Model,
    level: str,
    ids: Ids,
    metric_id: int,
    begin: dt.date | str,
    end: dt.date | str,
) -> DataFrame:
    kind = metric_compute_type(model, metric_id)
    query = f"{level}_data"
    if kind not in COMPUTED[query]:
        return status_row(model, query, kind, "id int, value double, score double")
    rows = scorecard(model, begin, end, level, (kind,), metric_id, ids)
    return rows.select("id", "value", "score", "record")


def _metrics(model: Model, kinds: set[int]) -> DataFrame:
    return (
        model["metric"]
        .where(F.col("fkcomputetypeid").isin(sorted(kinds)))
        .select(
            F.col("pkmetricid").alias("fkmetricid"),
            F.col("name").alias("metric"),
            "fkcomputetypeid",
        )
    )


def _aggregate(
    facts: DataFrame,
    model: Model,
    level: str,
    ids: Ids,
    first: dict[str, Column],
    again: dict[str, Column],
) -> DataFrame:
    first_pass = [column.alias(name) for name, column in first.items()]
    if level == "channel":
        picked = pick(facts, "fkchannelid", ids)
        return (
            picked.groupBy("fkchannelid", "fkmetricid")
            .agg(*first_pass)
            .withColumnRenamed("fkchannelid", "id")
        )
    members = station_channels(model, ids)
    if ids is not None:
        # A few stations: drop the other stations' facts before aggregating.
        return (
            facts.join(members, "fkchannelid")
            .groupBy(F.col("fkstationid").alias("id"), "fkmetricid")
            .agg(*first_pass)
        )
    return (
        facts.groupBy("fkchannelid", "fkmetricid")
        .agg(*first_pass)
        .join(members, "fkchannelid")
        .groupBy(F.col("fkstationid").alias("id"), "fkmetricid")
        .agg(*[column.alias(name) for name, column in again.items()])
    )
