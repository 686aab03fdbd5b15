from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from seisgauge.operators import listings, lookups
from seisgauge.operators.listing import hash_listing
from seisgauge.operators.plots import channel_plot, station_plot
from seisgauge.operators.scorecards import (
    channel_data,
    compute_type_status,
    scorecard,
    station_data,
)

from .tiny import DAY1, DAY2, lines, tiny_model


@pytest.fixture(scope="module")
def model(spark):
    return tiny_model(spark)


def test_channel_data(model):
    assert sorted(lines(channel_data(model, [1, 2], 1, DAY1, DAY2))) == [
        "1,98.88,98.88",
        "2,50.00,50",
    ]
    assert lines(channel_data(model, [1], 2, DAY1, DAY2)) == ["1,2,69.7994959677419"]
    # The start of the window does not matter for the days since a calibration.
    assert lines(channel_data(model, [1], 3, DAY1, DAY1)) == ["1,10,99.9924939012948"]
    assert lines(channel_data(model, [1], 1, DAY2, DAY2)) == ["1,98.25,98.25"]
    assert lines(channel_data(model, [1], 1, DAY2, DAY1)) == []
    assert lines(channel_data(model, [3], 1, DAY1, DAY2)) == []


def test_station_data(spark, model):
    assert lines(station_data(model, [1], 1, DAY1, DAY2)) == ["1,98.8750,98.875"]
    assert lines(station_data(model, [1, 2], 2, DAY1, DAY2)) == ["1,2,69.7994959677419"]
    assert lines(station_data(model, [1], 3, DAY1, DAY1)) == ["1,10.0000,99.9924939012948"]
    wanted = spark.createDataFrame([(1,), (2,)], "id int")
    assert lines(station_data(model, wanted, 1, DAY1, DAY2)) == ["1,98.8750,98.875"]


@pytest.mark.parametrize(
    "metric, channel, station, plot",
    [(4, "2", "2", "2"), (6, "6", None, "6"), (5, "Error", "Error", "Error"),
     (7, "Error", "Error", "Error"), (99, "Error", "Error", "Error")],
)
def test_answers_of_metrics_not_computed(model, metric, channel, station, plot):
    assert lines(channel_data(model, [1], metric, DAY1, DAY2)) == [channel]
    assert lines(station_data(model, [1], metric, DAY1, DAY2)) == [station]
    assert lines(channel_plot(model, 1, metric, DAY1, DAY2)) == [plot]
    assert lines(station_plot(model, 1, metric, DAY1, DAY2)) == [plot]


def test_plots(model):
    assert sorted(lines(channel_plot(model, 1, 1, DAY1, DAY2))) == [
        "2014-02-15,99.5000",
        "2014-02-16,98.2500",
    ]
    assert sorted(lines(station_plot(model, 1, 2, DAY1, DAY2))) == [
        "2014-02-15,0.0000",
        "2014-02-16,2.0000",
    ]
    assert lines(channel_plot(model, 1, 3, DAY1, DAY2)) == ["5"]
    # A channel in no use has a plot of its own, but no part in its station's.
    assert len(lines(channel_plot(model, 2, 1, DAY1, DAY2))) == 2
    assert sorted(lines(station_plot(model, 1, 1, DAY1, DAY2)))[0] == "2014-02-15,99.5000"


def test_scorecard_is_all_single_answers(model):
    for level, single, ids in (("channel", channel_data, [1, 2, 3]), ("station", station_data, [1, 2])):
        bulk = scorecard(model, DAY1, DAY2, level)
        for metric in (1, 2, 3):
            one = lines(single(model, ids, metric, DAY1, DAY2))
            assert sorted(lines(bulk.where(F.col("fkmetricid") == metric))) == sorted(one)


def test_station_mean_is_weighted_mean_of_channel_means(model):
    everything = {**model, "channel": model["channel"].withColumn("isignored", F.lit(False))}
    station = scorecard(everything, DAY1, DAY2, "station", (1,)).first()["value"]
    channels = scorecard(model, DAY1, DAY2, "channel", (1,)).agg(F.avg("value")).first()[0]
    assert station == pytest.approx(channels, abs=0.01)


def test_status(model):
    row = compute_type_status(model).where("fkmetricid = 3").first()
    assert tuple(row)[2:] == ("data", "data", "5", "5")


def test_listings(spark, model):
    assert lines(listings.channels(model, [1])) == ["C,1,BHZ,00,1"]
    assert sorted(lines(listings.date_bounds(model))) == ["DE,2014-02-16", "DS,2014-02-15"]
    empty = {**model, "date": model["date"].where("false")}
    assert sorted(lines(listings.date_bounds(empty))) == ["DE,", "DS,"]
    assert lines(listings.groups(model)) == ["G,1,IU,1", "G,2,Asia,4", "G,3,Solo,"]
    assert lines(listings.group_types(model)) == ["T,1,Network Code,1", "T,4,Regions,2"]
    assert sorted(lines(listings.metrics(model)))[:2] == ["M,1,Avail", "M,2,GapCountMetric"]
    assert lines(listings.stations(model)) == ["S,1,1,ANMO,1,2"]


def test_groups_of_a_type_are_ordered_by_name(spark, model):
    from seisgauge.schemas import small_table, table_schema

    rows = [(10, "b", False, 2), (9, "c", False, 2), (11, "a", False, 2)]
    other = {**model, "group": small_table(spark, rows, table_schema("group"))}
    assert lines(listings.group_types(other)) == ["T,2,Groups,11,10,9"]


def test_lookups(spark, model):
    series = ("IU", "ANMO", "00", "BHZ", "AvailabilityMetric")
    day = dt.date(2014, 2, 15)
    rows = [(day, *series), (dt.date(2014, 2, 20), *series), (day, "IU", "ADK", "", "BHZ", "x")]
    requests = spark.createDataFrame(
        rows,
        "date date, network string, station string, location string, channel string, metric string",
    )
    values = lookups.metric_values(model, requests).collect()
    assert sorted((r["date"].day, r["station"], r["value"]) for r in values if r["value"]) == [
        (15, "ANMO", 99.5)
    ]
    assert len(values) == 3
    digests = lookups.metric_digests(model, requests).where("hash is not null").collect()
    assert [r["hash"] for r in digests] == [b"\xa1"]
    known = lookups.has_any_hash(model, requests).collect()
    assert sorted((r["station"], r["has_hash"]) for r in known) == [
        ("ADK", False),
        ("ANMO", True),
        ("ANMO", True),
    ]


def test_hash_listing(model):
    listed = hash_listing(model, DAY1, DAY2, channel="BH_", metric="Gap%").collect()
    assert sorted(tuple(r) for r in listed) == [
        ("2014-02-15", "IU", "ANMO", "00", "BHZ", "GapCountMetric", "0", "a5"),
        ("2014-02-16", "IU", "ANMO", "00", "BHZ", "GapCountMetric", "2", "a6"),
    ]
    assert hash_listing(model, DAY1, DAY1, network="U%").count() == 0
