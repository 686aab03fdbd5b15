from __future__ import annotations

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from seisgauge import functions as S
from seisgauge.functions.days import as_date

# Metric, then the score of 0.9, -2 and 30.
GOLDEN_SCORES = [
    ("AvailabilityMetric", "0.9", "0", "30"),
    ("GapCountMetric", "86.432560483871", "100", "0"),
    ("MassPositionMetric", "100", "100", "63.1881371640408"),
    ("TimingQualityMetric", "0.9", "0", "30"),
    ("DeadChannelMetric:4-8", "90", "0", "100"),
    ("CoherencePBM:4-8", "60.2122015915119", "0", "100"),
    ("CoherencePBM:18-22", "88.75", "0", "100"),
    ("CoherencePBM:90-110", "86.646884272997", "0", "100"),
    ("CoherencePBM:200-500", "100", "0", "100"),
    ("DifferencePBM:4-8", "61.6379310344828", "14.2241379310345", "0"),
    ("DifferencePBM:18-22", "88.5897435897436", "74.4871794871795", "0"),
    ("DifferencePBM:90-110", "97.2317596566524", "93.6909871244635", "3.56223175965665"),
    ("DifferencePBM:200-500", "97.8140703517588", "95.0502512562814", "24.6984924623116"),
    ("StationDeviationMetric:4-8", "96.4307228915663", "91.460843373494", "0"),
    ("StationDeviationMetric:18-22", "95.7392996108949", "89.3190661478599", "0"),
    ("StationDeviationMetric:90-110", "95.4166666666667", "89.6875", "0"),
    ("StationDeviationMetric:200-500", "95.7068965517241", "90.0172413793103", "0"),
    ("NLNMDeviationMetric:4-8", "100", "100", "68.072625698324"),
    ("NLNMDeviationMetric:18-22", "100", "100", "80.3125"),
    ("NLNMDeviationMetric:90-110", "100", "100", "83.3367139959432"),
    ("NLNMDeviationMetric:200-500", "100", "100", "90.7952286282306"),
    ("CalibrationMetric", "99.9999392006005", "99.9996997560518", "99.9324451116532"),
    ("MeanError", "0", "100", "0"),
    ("SomethingElse", "n", "n", "n"),
    (None, "n", "n", "n"),
]


def _map(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    found = rows.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()
    return [row["r"] for row in found]


def test_scores(spark):
    rows = [
        (name, x, text)
        for name, *texts in GOLDEN_SCORES
        for x, text in zip((0.9, -2.0, 30.0), texts)
    ]
    scored = spark.createDataFrame(rows, "m string, x double, t string").withColumn(
        "s", S.score(F.col("x"), F.col("m"))
    )
    wrong = scored.where(~S.score_text(F.col("s"), F.col("m")).eqNullSafe(F.col("t"))).collect()
    assert wrong == []
    assert scored.where("s < 0 or s > 100").count() == 0


def test_score_of_nan_and_null(spark):
    rows = spark.createDataFrame(
        [(float("nan"), "MeanError"), (None, "MeanError")], "x double, m string"
    )
    scores = [r[0] for r in rows.select(S.score(F.col("x"), F.col("m"))).collect()]
    assert scores == [100.0, None]


def test_rounding_and_printing(spark):
    rng = random.Random(7)
    values = [1.0049999999999999, 0.1234567890123455, 5e-5, -2.5, 1e14, 123456789012.5, -0.0, 0.0]
    values += [4.9999999999999e-5, 98.875, 1e15, -1e20, 1e-7, 0.0001, 9.99999999999999999e-5]
    values += [rng.uniform(0, 100) for _ in range(2000)]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-12, 14) for _ in range(2000)]

    def rounded(x: float, digits: int) -> Decimal:
        step = Decimal(1).scaleb(-digits)
        return Decimal("%.14e" % x).quantize(step, rounding=ROUND_HALF_UP)

    for digits in (0, 2, 4):
        wanted = [rounded(x, digits) for x in values]
        texts = [format(d.copy_abs() if d == 0 else d, "f") for d in wanted]
        assert _map(spark, values, "double", lambda c: S.numeric_text(c, digits)) == texts
        assert _map(spark, values, "double", lambda c: S.round_numeric(c, digits)) == [
            float(d) for d in wanted
        ]
    assert _map(spark, values, "double", S.float_text) == ["%.15g" % x for x in values]
    special = [float("nan"), float("inf"), float("-inf"), None]
    assert _map(spark, special, "double", S.float_text) == ["NaN", "Infinity", "-Infinity", None]


def test_numeric_text(spark):
    good = ["1", " 1 ", "1e5", "-.5", "1.", "+2", None]
    bad = ["NaN", "nan", " NaN ", "Infinity", "", "abc", "0x1", "1d", "1f", ".", "1e", "1 2"]
    assert _map(spark, good + bad, "string", S.is_numeric) == [True] * 7 + [False] * len(bad)


def test_julian_days(spark):
    days = {
        dt.date(1970, 1, 1): 2440588,
        dt.date(2000, 1, 1): 2451545,
        dt.date(2012, 3, 1): 2455988,
        dt.date(2012, 3, 31): 2456018,
        dt.date(2014, 2, 15): 2456704,
    }
    assert _map(spark, list(days), "date", S.julian_day) == list(days.values())
    assert _map(spark, list(days.values()), "int", S.from_julian_day) == list(days)
    assert [S.julian_number(day) for day in days] == list(days.values())


def test_parse_day(spark):
    expected = {
        "2014-02-15": dt.date(2014, 2, 15),
        "2014-2-5": dt.date(2014, 2, 5),
        "2014-046": dt.date(2014, 2, 15),
        "2012-366": dt.date(2012, 12, 31),
        "2014-366": None,
        "2014-000": None,
        "2014-02-30": None,
        "20140215": None,
        "2014-02-15T01:00": None,
        "soon": None,
        "": None,
    }
    assert _map(spark, list(expected), "string", S.parse_day) == list(expected.values())


def test_day_spine(spark):
    def days(a, b):
        return [r["day"].isoformat() for r in S.day_spine(spark, a, b).orderBy("day").collect()]

    assert days("2014-02-27", "2014-03-01") == ["2014-02-27", "2014-02-28", "2014-03-01"]
    assert days("2014-02-27", "2014-02-27") == ["2014-02-27"]
    assert days("2014-03-01", "2014-02-27") == []


def test_records_and_messages(spark):
    rows = spark.createDataFrame([(1, None, "x")], "a int, b string, c string")
    line, text, names = rows.select(
        S.record("G", F.col("a"), F.col("b"), F.col("c"), F.col("b")),
        S.message("a", F.col("b")),
        S.display_name(F.col("b"), F.col("b")),
    ).first()
    assert (line, text, names) == ("G,1,,x,", None, "No name")


def test_hash_bytes(spark):
    found = _map(spark, ["0a", "0A1b", "", "zz", "abc", None], "string", S.hash_bytes)
    assert found == [b"\x0a", b"\x0a\x1b", b"", None, None, None]


@pytest.mark.parametrize("text", ["2014-02-05", "2014-2-5", "2014-036"])
def test_bounds_of_windows(text):
    assert as_date(text) == dt.date(2014, 2, 5)


@pytest.mark.parametrize("text", ["2014-366", "2014-000", "2014", "2014-13-01", "x"])
def test_what_is_no_bound(text):
    with pytest.raises(ValueError):
        as_date(text)
