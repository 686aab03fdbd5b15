"""What steps leave on disk: shuffles of what is staged or stored go as soon as it is written."""

from __future__ import annotations

import re
import time
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from seisgauge.operators import lookups, sync
from seisgauge.operators.ingest import ingest
from seisgauge.operators.listing import hash_listing
from seisgauge.plans import catalog
from seisgauge.sources import staging
from seisgauge.sources.measurements import write_sync_csv
from seisgauge.sources.store import commit_ingest, load_model, save_model

from .test_shuffles import _requests
from .tiny import batch, tiny_model

SF = "/root/testdata/sf0.001"


def _shuffles(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while files.hasNext():
        names.add(files.next().getName())
    return {name.split("_")[1] for name in names if name.startswith("shuffle_")}


def _left(spark, before: set[str]) -> set[str]:
    """Shuffles since ``before`` that are still there; they are removed in the background."""
    for _ in range(50):
        if not _shuffles(spark) - before:
            break
        time.sleep(0.2)
    return _shuffles(spark) - before


@pytest.fixture
def staged(monkeypatch):
    """Names and rows of what is staged, in order."""
    seen = []

    def spy(rows, name, **options):
        held = staging.stage(rows, name, **options)
        seen.append((name, rows, held))
        return held

    for module in (catalog, lookups, sync):
        monkeypatch.setattr(module, "stage", spy)
    return seen


def _executed(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


def test_writes_give_back_the_disk_of_their_shuffles(spark, tmp_path):
    rows = spark.range(5000).groupBy((F.col("id") % 100).alias("k")).count()
    texts = rows.select(*[F.lit("x").alias(c) for c in sync.MEASUREMENT_COLUMNS[1:]], F.col("k").cast("string").alias("date"))
    before = _shuffles(spark)
    assert staging.stage(rows, "counts").count() == 100
    write_sync_csv(texts, str(tmp_path / "csv"))
    assert not _left(spark, before)
    # What is not written is left alone, so that a second action finds it.
    assert spark.conf.get(staging._RELEASE) == "false" and not staging._WRITES
    rows.collect()
    assert _shuffles(spark) - before


def test_a_setting_outlives_writes_that_fail(spark):
    spark.conf.set(staging._RELEASE, "true")
    try:
        with pytest.raises(ZeroDivisionError), staging.released(spark), staging.released(spark):
            1 / 0
        assert spark.conf.get(staging._RELEASE) == "true"
    finally:
        spark.conf.unset(staging._RELEASE)


def test_listings_are_staged_in_half_the_space(spark):
    held = catalog._staged_listing(spark, SF)
    assert all(".zstd." in Path(name).name for name in held.inputFiles())


def test_a_closure_works_out_its_differences_once(spark, staged, monkeypatch):
    # Without the ingests in between.
    monkeypatch.setattr(catalog, "ingest", lambda model, rows: SimpleNamespace(model=model))
    found = catalog._sync_closure(spark, SF)
    assert [name for name, *_ in staged] == ["listing", "missing", "listing"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 1
    assert staged[1][2].count() == catalog._sync_diff(spark, SF).count() > 0


def test_facts_are_not_shuffled_to_meet_the_days_that_differ(spark, tmp_path, staged):
    roots = [str(tmp_path / name) for name in ("behind", "ahead")]
    for root in roots:
        save_model(spark, tiny_model(spark), root, checksums=True)
    commit_ingest(spark, ingest(load_model(spark, roots[1]), batch(spark)), roots[1])
    behind, ahead = (load_model(spark, root) for root in roots)
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "-1")
    try:
        found = sync.diff_models(ahead, behind)
        assert [name for name, *_ in staged] == ["unequal-days"]
        # Facts are not shuffled to meet the days that differ.
        assert not re.search(r"hashpartitioning\((fkmetricid#\d+, date#|date#\d+, fkmetricid#)", _executed(found))
    finally:
        spark.conf.set(conf, before)
    wanted = sync.diff(hash_listing(ahead), hash_listing(behind))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))


def test_names_and_digests_of_requests_are_shuffled_once(spark, staged):
    model = tiny_model(spark)
    wanted = _requests(model)
    found = lookups.metric_digests(model, wanted.unionByName(wanted))
    names = [name for name, *_ in staged]
    assert names == ["requests", "digests"]
    plan = staged[0][1]._jdf.queryExecution().optimizedPlan().toString()
    assert ".network AS" not in plan and ".metric AS" not in plan
    # Requests that repeat meet their digest each, and are not dealt to be made distinct first.
    assert "Aggregate [fkmetricid" not in staged[1][1]._jdf.queryExecution().optimizedPlan().toString()
    assert found.where("hash is not null").count() == 2 * wanted.count() > 0
