"""Listings of the dimensions, each with the comma record a front end reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import display_name, record
from ..schemas import Model
from .windows import Ids, pick


def channels(model: Model, station_ids: Ids = None) -> DataFrame:
    """``C,id,name,location,station`` of the channels in use of the given stations."""
    sensors = model["sensor"].select(
        F.col("pksensorid").alias("fksensorid"), "location", "fkstationid"
    )
    return (
        model["channel"]
        .where(~F.col("isignored"))
        .join(pick(sensors, "fkstationid", station_ids), "fksensorid")
        .select(
            F.col("pkchannelid").alias("id"),
            "name",
            "location",
            "fkstationid",
            record(
                "C", F.col("pkchannelid"), F.col("name"), F.col("location"), F.col("fkstationid")
            ).alias("record"),
        )
    )


def date_bounds(model: Model) -> DataFrame:
    """``DS,first day`` and ``DE,last day``; without days the bounds are empty."""
    bounds = model["date"].agg(F.min("date").alias("first"), F.max("date").alias("last"))
    sides = F.array(
        F.struct(F.lit("DS").alias("bound"), F.col("first").alias("day")),
        F.struct(F.lit("DE").alias("bound"), F.col("last").alias("day")),
    )
    return bounds.select(F.inline(sides)).select(
        "bound", "day", record(F.col("bound"), F.col("day")).alias("record")
    )


def groups(model: Model) -> DataFrame:
    """``G,id,name,type`` of every group, once each, in record order."""
    line = record("G", F.col("pkgroupid"), F.col("name"), F.col("fkgrouptypeid"))
    return (
        model["group"]
        .select(F.col("pkgroupid").alias("id"), "name", "fkgrouptypeid", line.alias("record"))
        .distinct()
        .orderBy("record")
    )


def group_types(model: Model) -> DataFrame:
    """``T,id,name,group,group,...`` with groups by name; types without groups vanish."""
    types = model["grouptype"].select(
        F.col("pkgrouptypeid").alias("fkgrouptypeid"), F.col("name").alias("type_name")
    )
    members = (
        model["group"]
        .where(F.col("fkgrouptypeid").isNotNull())
        .groupBy("fkgrouptypeid")
        .agg(F.array_sort(F.collect_list(F.struct("name", "pkgroupid"))).alias("members"))
    )
    ids = F.array_join(F.transform("members", lambda m: m["pkgroupid"].cast("string")), ",")
    return (
        types.join(members, "fkgrouptypeid")
        .select(
            F.col("fkgrouptypeid").alias("id"),
            F.col("type_name").alias("name"),
            ids.alias("group_ids"),
            record("T", F.col("fkgrouptypeid"), F.col("type_name"), ids).alias("record"),
        )
        .orderBy("name")
    )


def metrics(model: Model) -> DataFrame:
    """``M,id,label`` of every metric."""
    label = display_name(F.col("displayname"), F.col("name"))
    return model["metric"].select(
        F.col("pkmetricid").alias("id"),
        label.alias("label"),
        record("M", F.col("pkmetricid"), label).alias("record"),
    )


def stations(model: Model) -> DataFrame:
    """``S,id,network,name,group,group,...``; stations in no group vanish."""
    networks = model["group"].select(F.col("pkgroupid").alias("fknetworkid"))
    ties = (
        model["stationgrouptie"]
        .groupBy(F.col("fkstationid").alias("pkstationid"))
        .agg(F.array_sort(F.collect_list("fkgroupid")).alias("ids"))
    )
    ids = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    return (
        model["station"]
        .join(networks, "fknetworkid", "left_semi")
        .join(ties, "pkstationid")
        .select(
            F.col("pkstationid").alias("id"),
            "fknetworkid",
            "name",
            ids.alias("group_ids"),
            record(
                "S", F.col("pkstationid"), F.col("fknetworkid"), F.col("name"), ids
            ).alias("record"),
        )
    )
