"""A station model derived from the shared order tables.

The tables hold no seismic data, so suppliers stand for stations, nations for networks,
regions for regional groups, and each line item is one measurement. Line items that meet in
the same (metric, day, channel) are corrections of one another: the last one counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import SCORE_CURVES
from ..functions.days import UNIX_EPOCH_JULIAN_DAY
from ..operators.windows import BROADCAST_CHANNELS
from ..schemas import CALIBRATION_AGE, Model, blank_model, small_table, table_schema

WINDOW = ("1998-01-01", "1999-12-31")

# Compute type and multiplier of each metric, in the order of the score
# curves, then five metrics without a curve.
_SCORED_TYPES = [1, 3, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 5, 3]
_SCORED_SCALES = [
    90, 1, 30, 95, 1, 1, 1, 1, 1, 1, -1, 10, -10, 5, -5, 5, 5, 60, 60, 60, 60, 1, 0.05
]
_UNSCORED = [
    ("DayMeanMetric", 2, 1),
    ("ParentMetric", 4, 1),
    ("CalMeanMetric", 6, 1),
    ("NoneMetric", 7, 1),
    ("UnscoredMetric", 1, 1),
]
METRICS: list[tuple[str, int, float]] = [
    (curve[0], kind, scale)
    for curve, kind, scale in zip(SCORE_CURVES, _SCORED_TYPES, _SCORED_SCALES)
] + _UNSCORED
CHANNEL_NAMES = ["BHZ", "BH1", "BH2"]
LOCATIONS = ["", "10"]


def metric_parents() -> list[int | None]:
    """Each frequency band is below the next lower one, the lowest below ParentMetric."""
    names = [name for name, *_ in METRICS]
    parents: list[int | None] = []
    for place, name in enumerate(names):
        family = name.split(":")[0]
        if ":" not in name:
            parents.append(None)
        elif place and names[place - 1].split(":")[0] == family:
            parents.append(place)
        else:
            parents.append(names.index("ParentMetric") + 1)
    return parents


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _array(values: list) -> str:
    return f"array({', '.join(f'{v}D' if isinstance(v, float) else repr(v) for v in values)})"


def _lookup(values: list, place: str) -> str:
    return f"element_at({_array(values)}, {place})"


_METRIC = f"cast(l_partkey % {len(METRICS)} + 1 as int)"
# Order of arrival: (order, line, price) in one number of 38 digits, which holds every order key
# and keeps the last-wins aggregation in the hash aggregate of generated code. A line of 100 000
# or a price of 10^12 is out of range and fails, loudly.
_CENTS = "cast(l_extendedprice * 100 as decimal(30,0))"
_ARRIVAL = f"""
    case when l_orderkey >= 0 and l_linenumber between 0 and 99999
              and {_CENTS} between 0 and 99999999999999
         then cast(cast(l_orderkey as decimal(19,0)) * cast('10000000000000000000' as decimal(20,0)) as decimal(38,0))
              + cast(l_linenumber as decimal(10,0)) * cast('100000000000000' as decimal(15,0)) + {_CENTS}
         else raise_error('line item outside the range of the arrival order') end
"""
_RAW = {
    "fkchannelid": "cast((l_suppkey * 2 + l_linenumber % 2) * 3 + l_partkey % 3 + 1 as int)",
    "date": f"unix_date(cast(l_shipdate as date)) + {UNIX_EPOCH_JULIAN_DAY}",
    "day": "cast(l_shipdate as date)",
    "fkmetricid": _METRIC,
    "fkcomputetypeid": _lookup([kind for _, kind, _ in METRICS], _METRIC),
    "value": "(l_discount * 10 + l_tax) * "
    + _lookup([float(scale) for _, _, scale in METRICS], _METRIC),
    "arrival": f"cast({_ARRIVAL} as decimal(38,0))",
    # Stands for what the digest is made of.
    "hashid": f"xxhash64(l_orderkey, l_linenumber, {_CENTS})",
    "hash": "md5(concat_ws('|', l_orderkey, l_linenumber, cast(l_extendedprice as decimal(12,2))))",
    "station": "concat('S', l_suppkey)",
    "location": _lookup(LOCATIONS, "l_linenumber % 2 + 1"),
    "channel": _lookup(CHANNEL_NAMES, "cast(l_partkey % 3 + 1 as int)"),
    "metric": _lookup([name for name, *_ in METRICS], _METRIC),
}


def raw_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: ids, names, day, value, digest and order of arrival."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey",
        "l_returnflag",
        "l_linestatus",
        *[f"{expression} as {name}" for name, expression in _RAW.items()],
    )


def networks(spark: SparkSession, sf_dir: str, once: bool = False) -> DataFrame:
    """(l_suppkey, network) of every supplier, with ``once`` without repeated rows."""
    supplier = table(spark, sf_dir, "supplier")
    rows = (
        supplier.join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .selectExpr("s_suppkey as l_suppkey", "n_name as network")
    )
    rows = rows.distinct() if once else rows
    # Counted, as for channels: the optimizer takes the joined tables for too large.
    return F.broadcast(rows) if supplier.count() <= BROADCAST_CHANNELS else rows


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw measurements by name, in the interchange columns, plus what made them."""
    raw = raw_measurements(spark, sf_dir)
    return raw.join(networks(spark, sf_dir), "l_suppkey").selectExpr(
        "cast(day as string) as date",
        "network",
        "station",
        "location",
        "channel",
        "metric",
        "cast(value as string) as value",
        "hash",
        "arrival",
        "fkcomputetypeid",
        "l_returnflag",
        "l_linestatus",
    )


def latest(raw: DataFrame) -> DataFrame:
    """The last raw measurement per key, in the columns of a fact."""
    return (
        raw.groupBy("fkchannelid", "date", "fkmetricid")
        .agg(F.max_by("value", "arrival").alias("value"), F.max_by("hashid", "arrival").alias("fkhashid"))
        .select("fkchannelid", "date", "fkmetricid", "value", "fkhashid")
    )


def station_model(
    spark: SparkSession, sf_dir: str, raw: DataFrame | None = None
) -> Model:
    """The model of all raw measurements, or of the given part of them."""
    if raw is None:
        raw = raw_measurements(spark, sf_dir)
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")

    model = blank_model(
        spark, ["grouptype", "computetype", "calibrationdata", "errorlog", "metadata"]
    )
    model["group"] = nation.selectExpr(
        "n_nationkey + 1 as pkgroupid", "n_name as name", "false as isignored", "1 as fkgrouptypeid"
    ).union(
        region.selectExpr("r_regionkey + 1001", "r_name", "false", "4")
    )
    model["station"] = supplier.selectExpr(
        "cast(s_suppkey + 1 as int) as pkstationid",
        "s_nationkey + 1 as fknetworkid",
        "concat('S', s_suppkey) as name",
    )
    model["stationgrouptie"] = (
        supplier.where("(s_suppkey + 1) % 10 <> 0")
        .join(nation.withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey")
        .selectExpr(
            "explode(array(s_nationkey + 1, n_regionkey + 1001)) as fkgroupid",
            "cast(s_suppkey + 1 as int) as fkstationid",
        )
    )
    model["sensor"] = supplier.selectExpr(
        "cast(s_suppkey + 1 as int) as fkstationid",
        f"posexplode({_array(LOCATIONS)}) as (place, location)",
    ).selectExpr("(fkstationid - 1) * 2 + place + 1 as pksensorid", "fkstationid", "location")
    model["channel"] = (
        model["sensor"]
        .selectExpr("pksensorid", f"posexplode({_array(CHANNEL_NAMES)}) as (place, name)")
        .selectExpr(
            "(pksensorid - 1) * 3 + place + 1 as pkchannelid",
            "pksensorid as fksensorid",
            "name",
            "0 as derived",
            "((pksensorid - 1) * 3 + place + 1) % 10 = 0 as isignored",
        )
    )
    model["metric"] = small_table(
        spark,
        [
            (place + 1, name, parent, None, kind, None)
            for place, ((name, kind, _), parent) in enumerate(zip(METRICS, metric_parents()))
        ],
        table_schema("metric"),
    )
    numeric = raw.where(F.col("fkcomputetypeid") != CALIBRATION_AGE)
    textual = raw.where(F.col("fkcomputetypeid") == CALIBRATION_AGE)
    model["metricdata"] = latest(numeric)
    model["metricstringdata"] = latest(textual.withColumn("value", F.col("value").cast("string")))
    model["date"] = raw.select(F.col("date").alias("pkdateid"), F.col("day").alias("date")).distinct()
    # Dealt by the id alone, which serves both the rows' distinctness and the join that meets it.
    model["hash"] = (
        raw.select(F.col("hashid").alias("pkhashid"), F.unhex("hash").alias("hash"))
        .repartition("pkhashid")
        .distinct()
    )
    return model
