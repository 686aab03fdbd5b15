"""Facts of a date window and the dimension rows they hang on."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import julian_number
from ..schemas import Model
from .layout import days_per_block

Ids = Sequence[int] | DataFrame | None

# The most channels whose ids and names are broadcast: two ids, or four names of at most 36
# characters each, make this some 100 MB at the worst.
BROADCAST_CHANNELS = 500_000


def window_facts(
    facts: DataFrame,
    begin: dt.date | str | None,
    end: dt.date | str | None,
    metric_id: int | None = None,
) -> DataFrame:
    """Facts from ``begin`` to ``end``, both included, as literals the scan can use; None
    leaves that side open.

    A fact table in the stored layout is partitioned by metric and block of days, so the
    bounds are repeated on the block to prune directories as well as row groups.
    """
    block_days = days_per_block(facts)
    kept = facts
    if end is not None:
        last = julian_number(end)
        kept = kept.where(F.col("date") <= last)
        if block_days:
            kept = kept.where(F.col("date_block") <= last // block_days)
    if begin is not None:
        first = julian_number(begin)
        kept = kept.where(F.col("date") >= first)
        if block_days:
            kept = kept.where(F.col("date_block") >= first // block_days)
    if metric_id is not None:
        kept = kept.where(F.col("fkmetricid") == metric_id)
    return kept


def pick(rows: DataFrame, column: str, ids: Ids) -> DataFrame:
    """Rows whose ``column`` is among ``ids``: a short list, or a DataFrame with ``id``."""
    if ids is None:
        return rows
    if isinstance(ids, DataFrame):
        wanted = ids.select(F.col("id").cast("int").alias(column))
        return rows.join(wanted, column, "left_semi")
    return rows.where(F.col(column).isin(list(ids)))


def station_channels(model: Model, station_ids: Ids = None) -> DataFrame:
    """(fkchannelid, fkstationid) of every channel that is not ignored."""
    channels = (
        model["channel"]
        .where(~F.col("isignored"))
        .select(F.col("pkchannelid").alias("fkchannelid"), "fksensorid")
    )
    sensors = model["sensor"].select(F.col("pksensorid").alias("fksensorid"), "fkstationid")
    members = channels.join(pick(sensors, "fkstationid", station_ids), "fksensorid")
    return broadcast_by_channels(model, members.select("fkchannelid", "fkstationid"))


def broadcast_by_channels(model: Model, rows: DataFrame) -> DataFrame:
    """Have ``rows``, one per channel at most, broadcast if the channels are few enough.

    The optimizer multiplies the sizes of joined tables, so it would take even a handful of
    joined dimension rows for too many and shuffle the facts to meet them. The channels are
    counted instead, which for Parquet only reads footers. Too many of them are left to a
    shuffled join, where adaptive execution splits channels that hold too many facts.
    """
    few = model["channel"].count() <= BROADCAST_CHANNELS
    return F.broadcast(rows) if few else rows


def channel_paths(model: Model) -> DataFrame:
    """Natural key of every channel: (network, station, location, channel, fkchannelid)."""
    groups = model["group"].select(
        F.col("pkgroupid").alias("fknetworkid"), F.col("name").alias("network")
    )
    stations = model["station"].select(
        F.col("pkstationid").alias("fkstationid"), "fknetworkid", F.col("name").alias("station")
    )
    sensors = model["sensor"].select(
        F.col("pksensorid").alias("fksensorid"), "fkstationid", "location"
    )
    channels = model["channel"].select(
        F.col("pkchannelid").alias("fkchannelid"), "fksensorid", F.col("name").alias("channel")
    )
    paths = (
        channels.join(sensors, "fksensorid")
        .join(stations, "fkstationid")
        .join(groups, "fknetworkid")
        .select("network", "station", "location", "channel", "fkchannelid")
    )
    return broadcast_by_channels(model, paths)


def metric_names(model: Model) -> DataFrame:
    return model["metric"].select(
        F.col("pkmetricid").alias("fkmetricid"), F.col("name").alias("metric")
    )
