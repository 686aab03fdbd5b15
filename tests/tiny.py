"""A model small enough to work out every answer by hand."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from seisgauge.schemas import Model, blank_model, small_table, table_schema

DAY1, DAY2 = "2014-02-15", "2014-02-16"

ROWS: dict[str, list[tuple]] = {
    "group": [(1, "IU", False, 1), (2, "Asia", False, 4), (3, "Solo", False, None)],
    "station": [(1, 1, "ANMO"), (2, 1, "ADK")],
    "stationgrouptie": [(1, 1), (2, 1)],
    "sensor": [(1, 1, "00"), (2, 2, "")],
    "channel": [(1, 1, "BHZ", 0, False), (2, 1, "BH1", 0, True), (3, 2, "BHZ", 0, False)],
    "metric": [
        (1, "AvailabilityMetric", None, None, 1, "Avail"),
        (2, "GapCountMetric", None, None, 3, None),
        (3, "CalibrationMetric", None, None, 5, None),
        (4, "Day", None, None, 2, None),
        (5, "Parent", None, None, 4, None),
        (6, "CalAvg", None, None, 6, None),
        (7, "None", None, None, 7, None),
    ],
    "metricdata": [
        (1, 2456704, 1, 99.5, 1),
        (1, 2456705, 1, 98.25, 2),
        (2, 2456704, 1, 50.0, 3),
        (2, 2456705, 1, 50.0, 4),
        (1, 2456704, 2, 0.0, 5),
        (1, 2456705, 2, 2.0, 6),
    ],
    "metricstringdata": [(1, 2456694, 3, "cal", 7)],
    "hash": [(i, bytes([0xA0 + i])) for i in range(1, 8)],
    "date": [(2456704, dt.date(2014, 2, 15)), (2456705, dt.date(2014, 2, 16))],
}

BATCH = [
    ("2014-02-15", "IU", "ANMO", "00", "BHZ", "AvailabilityMetric", "90", "0a"),
    ("2014-02-15", "IU", "ANMO", "00", "BHZ", "AvailabilityMetric", "91", "0b"),
    ("2014-02-17", "XX", "NEW", "10", "LHZ", "BrandNew", "1", "0c"),
    ("2014-02-17", "IU", "ANMO", "00", "BHZ", "AvailabilityMetric", "NaN", "0d"),
    ("2014-02-17", "IU", "ANMO", "00", "BHZ", "AvailabilityMetric", "1d", "0d"),
    ("2014-02-17", "IU", "ANMO", "00", "BHZ", "AvailabilityMetric", "Infinity", "0d"),
    ("2014-02-17", "IU", "ANMO", "00", "BHZ", "AvailabilityMetric", "", "0d"),
    ("2014-02-30", "IU", "ANMO", "00", "BHZ", "AvailabilityMetric", "1", "0d"),
    ("2014-02-17", "IU", "ANMO", "00", "BHZ", "AvailabilityMetric", "1", "zz"),
    ("2014-046", "IU", "ADK", "", "BHZ", "GapCountMetric", "-.5", "0e"),
    ("2014-02-15", "Asia", "TOK", "00", "BHZ", "AvailabilityMetric", "80", "0f"),
]


def tiny_model(spark: SparkSession) -> Model:
    model = blank_model(spark)
    for name, rows in ROWS.items():
        model[name] = small_table(spark, rows, table_schema(name))
    return model


def batch(spark: SparkSession, rows: list[tuple] = BATCH) -> DataFrame:
    numbered = [row + (place,) for place, row in enumerate(rows)]
    return spark.createDataFrame(
        numbered,
        "date string, network string, station string, location string, channel string, "
        "metric string, value string, hash string, arrival int",
    )


def lines(rows: DataFrame) -> list[str]:
    return [row["record"] for row in rows.select("record").collect()]
