"""Daily series of channels and stations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import from_julian_day, numeric_text, record, round_numeric
from ..schemas import AVERAGE, TOTAL, Model
from .scorecards import COMPUTED, metric_compute_type, status_row
from .windows import Ids, pick, station_channels, window_facts

# Fixed value: decimals kept in a plot, for means and totals alike.
PLOT_DIGITS = 4


def channel_plots(
    model: Model,
    begin: dt.date | str,
    end: dt.date | str,
    metric_id: int | None = None,
    channel_ids: Ids = None,
) -> DataFrame:
    """(id, fkmetricid, day, value, record) of every channel: a scan without a shuffle.

    Ignored channels are included.
    """
    facts = window_facts(model["metricdata"], begin, end, metric_id)
    facts = pick(facts, "fkchannelid", channel_ids).join(
        _plotted(model).select("fkmetricid"), "fkmetricid", "left_semi"
    )
    return _points(facts.withColumnRenamed("fkchannelid", "id"), F.col("value"))


def station_plots(
    model: Model,
    begin: dt.date | str,
    end: dt.date | str,
    metric_id: int | None = None,
    station_ids: Ids = None,
) -> DataFrame:
    """(id, fkmetricid, day, value, record) of every station over its channels in use."""
    facts = window_facts(model["metricdata"], begin, end, metric_id)
    daily = (
        facts.join(_plotted(model), "fkmetricid")
        .join(station_channels(model, station_ids), "fkchannelid")
        .groupBy(F.col("fkstationid").alias("id"), "fkmetricid", "fkcomputetypeid", "date")
        .agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("readings"))
    )
    value = F.when(
        F.col("fkcomputetypeid") == AVERAGE, F.col("total") / F.col("readings")
    ).otherwise(F.col("total"))
    return _points(daily, value)


def channel_plot(
    model: Model, channel_id: int, metric_id: int, begin: dt.date | str, end: dt.date | str
) -> DataFrame:
    """(day, value, record) of one channel."""
    return _one(model, "channel_plot", channel_id, metric_id, begin, end)


def station_plot(
    model: Model, station_id: int, metric_id: int, begin: dt.date | str, end: dt.date | str
) -> DataFrame:
    """(day, value, record) of one station."""
    return _one(model, "station_plot", station_id, metric_id, begin, end)


def _plotted(model: Model) -> DataFrame:
    return (
        model["metric"]
        .where(F.col("fkcomputetypeid").isin(AVERAGE, TOTAL))
        .select(F.col("pkmetricid").alias("fkmetricid"), "fkcomputetypeid")
    )


def _points(daily: DataFrame, value: Column) -> DataFrame:
    day = from_julian_day(F.col("date"))
    return daily.select(
        "id",
        "fkmetricid",
        day.alias("day"),
        round_numeric(value, PLOT_DIGITS).alias("value"),
        record(day, numeric_text(value, PLOT_DIGITS)).alias("record"),
    )


def _one(
    model: Model,
    query: str,
    owner: int,
    metric_id: int,
    begin: dt.date | str,
    end: dt.date | str,
) -> DataFrame:
    kind = metric_compute_type(model, metric_id)
    if kind not in COMPUTED[query]:
        return status_row(model, query, kind, "day date, value double")
    plots = channel_plots if query == "channel_plot" else station_plots
    return plots(model, begin, end, metric_id, [owner]).select("day", "value", "record")
