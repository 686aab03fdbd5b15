"""Every registered query against its SQL in DuckDB.

The queries that ingest take some ten seconds each in local mode, whatever the data; they
run when ``SEISGAUGE_FULL`` is set, and always in ``python -m tests.compare``.
"""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry
from seisgauge.plans.catalog import QUERIES
from seisgauge.plans.oracle import ORACLE_SQL
from seisgauge.operators.scorecards import scorecard
from seisgauge.plans.stations import WINDOW, station_model

from .compare import compare, connect

SF = "/root/testdata/sf0.001"
SLOW = {name for name in QUERIES if name.startswith("ingest") or name == "sync_closure"}


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    if name in SLOW and not os.environ.get("SEISGAUGE_FULL"):
        pytest.skip("set SEISGAUGE_FULL to run the ingest queries")
    assert compare(spark, connection, QUERIES[name], ORACLE_SQL[name], SF) is None


def test_known_row_counts(spark):
    model = station_model(spark, SF)
    assert model["metricdata"].count() == 5772
    assert model["metricstringdata"].count() == 222
    counts = {
        (level, kind): scorecard(model, *WINDOW, level, (kind,)).count()
        for level in ("station", "channel")
        for kind in (1, 3, 5)
    }
    assert list(counts.values()) == [209, 20, 10, 789, 79, 54]
    assert entry(spark).count() == 209
