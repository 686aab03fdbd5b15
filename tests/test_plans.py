"""What the physical plans must look like on the stored layout."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from seisgauge.functions import from_julian_day
from seisgauge.operators.listing import hash_listing
from seisgauge.operators.lookups import NAMES
from seisgauge.operators.plots import channel_plots, station_plots
from seisgauge.operators.scorecards import scorecard, station_data
from seisgauge.operators.windows import channel_paths, metric_names
from seisgauge.plans.stations import WINDOW, station_model
from seisgauge.sources.store import load_model, save_model

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark, tmp_path_factory):
    spark.conf.set("spark.sql.maxMetadataStringLength", 10000)
    root = str(tmp_path_factory.mktemp("plans") / "store")
    save_model(spark, station_model(spark, SF), root, block_days=400)
    return load_model(spark, root)


def plan_of(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


def fact_scan(plan: str) -> str:
    return next(line for line in plan.splitlines() if "FileScan" in line and "date_block" in line)


def test_metric_and_days_prune_directories_and_row_groups(model):
    plan = plan_of(station_data(model, [1, 2], 1, *WINDOW))
    scan = fact_scan(plan)
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters: \[(.*?)\]", scan)
    assert "fkmetricid" in filters[1] and "date_block" in filters[1]
    assert "GreaterThanOrEqual(date,2450815)" in filters[2]
    assert "fkhashid" not in re.search(r"ReadSchema: (.*)", scan)[1]


def test_bulk_scorecard_prunes_metrics_at_run_time(model):
    scan = fact_scan(plan_of(scorecard(model, *WINDOW, "station", (1,))))
    assert "dynamicpruning" in scan


@pytest.mark.parametrize("query", [station_plots, channel_plots, scorecard])
def test_no_python_and_no_row_by_row_join(model, query):
    plan = plan_of(query(model, *WINDOW))
    assert "BroadcastHashJoin" in plan
    for node in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, node


def test_facts_are_not_shuffled_to_meet_their_dimensions(model):
    plan = plan_of(station_plots(model, *WINDOW))
    assert re.findall(r"Exchange hashpartitioning\((\w+)", plan) == ["fkstationid"]
    assert plan_of(channel_plots(model, *WINDOW)).count("Exchange hashpartitioning") == 0
    listing = plan_of(hash_listing(model, *WINDOW))
    assert set(re.findall(r"Exchange hashpartitioning\((\w+)", listing)) <= {"fkhashid"}


def test_aggregation_starts_before_the_shuffle(model):
    plan = plan_of(scorecard(model, *WINDOW, "station", (1, 3)))
    assert "partial_sum(value" in plan


def test_lookups_open_the_directories_that_are_asked_for(spark, model):
    from seisgauge.operators.lookups import has_any_hash, metric_values

    named = _named_readings(model).where("metric in ('AvailabilityMetric', 'MeanError')").limit(40)
    for rows in (metric_values(model, named), has_any_hash(model, named.drop("date"))):
        scans = [line for line in plan_of(rows).splitlines() if "FileScan" in line]
        scan = next(line for line in scans if "/metricdata/" in line and "> 0)" in line)
        pruned = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", scan)[1]
        assert re.search(r"dynamicpruning\w*\(fkmetricid#", pruned)
        if "date" in rows.columns:
            assert re.search(r"dynamicpruning\w*\(date_block#", pruned)
    # Requests are worked out once, when they are staged.
    scans = [line for line in plan_of(metric_values(model, named)).splitlines() if "FileScan" in line]
    assert sum("/metricdata/" in line for line in scans) == 1
    assert all("/metricdata/" in line or "/requests-" in line for line in scans)


def test_a_lookup_answers_each_request_once(spark, model):
    from seisgauge.operators.lookups import metric_digests, metric_values

    named = _named_readings(model).limit(30).cache()
    odd = named.withColumn("request", F.lit(7)).withColumn("metric", F.lit("none of ours"))
    wanted = named.withColumn("request", F.lit(1)).union(named.withColumn("request", F.lit(1))).union(odd)
    values = metric_values(model, wanted)
    assert values.columns == [*wanted.columns, "value"]
    assert values.where("value is not null").count() == 60 and values.where("value is null").count() == 30
    digests = metric_digests(model, wanted)
    assert digests.where("hash is not null and request = 1").count() == 60
    assert metric_values(model, wanted.where("false")).count() == 0


def _named_readings(model):
    return (
        model["metricdata"]
        .join(metric_names(model), "fkmetricid")
        .join(channel_paths(model), "fkchannelid")
        .select(from_julian_day(F.col("date")).alias("date"), *NAMES)
        .orderBy("date", *NAMES)
    )
