"""What the ingest shuffles and stages, and ids for keys that have some already."""

from __future__ import annotations

from pyspark.sql import functions as F

from seisgauge.operators import ingest as step
from seisgauge.operators.identifiers import assign_ids
from seisgauge.plans.stations import measurements

from .tiny import batch, tiny_model

SF = "/root/testdata/sf0.001"


def test_keys_keep_the_ids_they_have(spark, tmp_path):
    keys = spark.range(200).selectExpr("id as k", "case when id % 4 = 0 then 1000 + id end as n")

    def keep(rows):
        rows.write.parquet(str(tmp_path / "placed"))
        return spark.read.parquet(str(tmp_path / "placed"))

    for kept in (None, keep):
        found = {r["k"]: r["n"] for r in assign_ids(keys, ["k"], "n", 10, slices=16, keep=kept).collect()}
        assert all(found[k] == 1000 + k for k in range(0, 200, 4))
        assert sorted(n for k, n in found.items() if k % 4) == list(range(11, 161))


def test_measurements_are_not_shuffled_to_meet_their_networks(spark):
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "1k")
    try:
        plan = measurements(spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(conf, before)
    assert "hashpartitioning(l_suppkey" not in plan


def test_good_rows_are_staged_without_their_texts(spark, monkeypatch):
    staged = {}

    def spy(rows, name):
        staged[name] = rows
        return stage(rows, name)

    stage = step.stage
    monkeypatch.setattr(step, "stage", spy)
    done = step.ingest(tiny_model(spark), batch(spark))
    rows = staged["measurements"]
    texts = rows.where("coalesce(date_text, value_text, hash_text) is not null")
    assert texts.where("problem is null").count() == 0
    assert texts.count() == rows.where("problem is not null").count() == done.rejected.count() > 0
    # Names are numbered by themselves, not by pairs of channel and metric.
    good = rows.where(F.col("problem").isNull())
    assert staged["paths"].count() == good.select(*step.PATH).distinct().count()
    assert staged["names"].count() == good.select("metric").distinct().count()
