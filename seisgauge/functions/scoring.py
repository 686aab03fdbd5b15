"""Conversion of a measured value to a 0-100 score, one curve per metric name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import float_text

# Metric name, curve, reference level, spread.
SCORE_CURVES = [
    ("AvailabilityMetric", "percent", None, None),
    ("GapCountMetric", "above", 0.00274, 0.992),
    ("MassPositionMetric", "above", 3.52, 10.79),
    ("TimingQualityMetric", "percent", None, None),
    ("DeadChannelMetric:4-8", "fraction", None, None),
    ("CoherencePBM:4-8", "below", 1.0, 0.0377),
    ("CoherencePBM:18-22", "below", 0.99, 0.12),
    ("CoherencePBM:90-110", "below", 0.93, 0.0337),
    ("CoherencePBM:200-500", "below", 0.83, 0.346),
    ("DifferencePBM:4-8", "away", 0.01, 0.348),
    ("DifferencePBM:18-22", "away", 0.01, 1.17),
    ("DifferencePBM:90-110", "away", 0.04, 4.66),
    ("DifferencePBM:200-500", "away", 0.03, 5.97),
    ("StationDeviationMetric:4-8", "away", 0.11, 3.32),
    ("StationDeviationMetric:18-22", "away", 0.17, 2.57),
    ("StationDeviationMetric:90-110", "away", 0.02, 2.88),
    ("StationDeviationMetric:200-500", "away", 0.07, 2.90),
    ("NLNMDeviationMetric:4-8", "above", 3.33, 12.53),
    ("NLNMDeviationMetric:18-22", "above", 13.41, 12.64),
    ("NLNMDeviationMetric:90-110", "above", 13.57, 14.79),
    ("NLNMDeviationMetric:200-500", "above", 20.74, 15.09),
    ("CalibrationMetric", "age", None, None),
    ("MeanError", "error", None, None),
]

# A curve maps (value, reference level, spread) to an unclamped score. The order of the
# operations matters: it decides the last bit of the result.
_CURVES: dict[str, Callable[[Column, Column, Column], Column]] = {
    "percent": lambda x, level, spread: x,
    "fraction": lambda x, level, spread: x * 100,
    "above": lambda x, level, spread: 100.0 - (15 * (x - level)) / spread,
    "below": lambda x, level, spread: 100.0 - (15 * (level - x)) / spread,
    "away": lambda x, level, spread: 100.0 - (15 * (F.abs(x) - level)) / spread,
    "age": lambda x, level, spread: 100.0 - 10 * F.pow(x / 365, F.lit(2.0)),
    "error": lambda x, level, spread: 100.0 - 500 * x,
}


# Parameters by metric name, as literal maps.
_CURVE, _LEVEL, _SPREAD = (
    "map("
    + ", ".join(
        f"'{row[0]}', {row[place]!r}" + ("D" if place > 1 else "")
        for row in SCORE_CURVES
        if row[place] is not None
    )
    + ")"
    for place in (1, 2, 3)
)


def score(value: Column, metric_name: Column) -> Column:
    """Score of a rounded aggregate; NULL for a metric without a curve."""
    value = value.cast("double")
    # Looked up by name, so that the value appears once per curve, not once per metric: a
    # filter on the score is pushed below it with a copy of the whole expression.
    curve, level, spread = (
        F.element_at(F.expr(entries), metric_name) for entries in (_CURVE, _LEVEL, _SPREAD)
    )
    raw = F
    for name, formula in _CURVES.items():
        raw = raw.when(curve == name, formula(value, level, spread))
    # least and greatest skip NULLs, so those must not get that far.
    return F.when(
        value.isNotNull() & curve.isNotNull(), F.greatest(F.lit(0.0), F.least(raw, F.lit(100.0)))
    )


def score_text(scored: Column, metric_name: Column) -> Column:
    """Printed score; ``n`` marks a metric without a curve."""
    known = F.element_at(F.expr(_CURVE), metric_name).isNotNull()
    return F.when(known, float_text(scored)).otherwise("n")
