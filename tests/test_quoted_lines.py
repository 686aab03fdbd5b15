"""Records over lines: what a line does to an open quote, and how often the lines are read."""

from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import functions as F

from seisgauge.sources import quoted_lines
from seisgauge.sources.measurements import MEASUREMENT_COLUMNS, read_measurements, write_sync_csv

# Possessive, so that each part takes all it can: what a CSV reader does.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
_OPEN = rf'^(?:\s*+(?:{_QUOTED}"[^,]*+|[^",\s][^,]*+|),)*+\s*+{_QUOTED}\z'


def test_lines_open_and_keep_quotes_as_a_reader_says(spark):
    chance = random.Random(5)
    lines = ["".join(chance.choices('"",, ax\r\t\x0b\x0cé', k=chance.randrange(12))) for _ in range(4000)]
    rows = spark.createDataFrame([(line,) for line in lines], "value string").select(
        F.col("value").rlike(_OPEN).alias("opened"),
        F.when(F.contains("value", F.lit('"')), F.concat(F.lit('"'), "value").rlike(_OPEN)).alias("kept"),
    )
    wanted = [(opened, True if kept is None else kept) for opened, kept in rows.collect()]
    assert list(zip(*map(list, quoted_lines._flags(pa.array(lines))))) == wanted
    assert {True, False} == {opened for opened, _ in wanted} == {kept for _, kept in wanted}


def test_lines_are_read_twice(spark, tmp_path, monkeypatch):
    """Once for what they do to quotes, ends of splits included, and once to be joined."""
    staged = []

    def spy(rows, name):
        staged.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return stage(rows, name)

    stage = quoted_lines.stage
    monkeypatch.setattr(quoted_lines, "stage", spy)
    given = [[f"{k}", *['a\n"b'] * 6, "h"] for k in range(50)]
    write_sync_csv(spark.createDataFrame(given, [*MEASUREMENT_COLUMNS]), str(tmp_path / "in"), multiline=True)
    rows = read_measurements(spark, str(tmp_path / "in"), multiline=True)
    assert sorted(map(list, rows.select(*MEASUREMENT_COLUMNS).collect())) == sorted(given)
    plans = [*staged, rows._jdf.queryExecution().optimizedPlan().toString()]
    assert sum(line.endswith("] text") for plan in plans for line in plan.splitlines()) == 2
