"""The fifteen tables of the model: types, defaults, keys, lengths and seed rows."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# A model is a plain mapping from table name to DataFrame.
Model = dict[str, DataFrame]

# Column name, type, nullable, and the longest text a column may hold.
_INT, _LONG, _SHORT, _TEXT, _BOOL = "int", "bigint", "smallint", "string", "boolean"
TABLES: dict[str, list[tuple[str, str, bool, int | None]]] = {
    "group": [
        ("pkgroupid", _INT, False, None),
        ("name", _TEXT, False, 36),
        ("isignored", _BOOL, False, None),
        ("fkgrouptypeid", _INT, True, None),
    ],
    "grouptype": [("pkgrouptypeid", _INT, False, None), ("name", _TEXT, False, 16)],
    "stationgrouptie": [("fkgroupid", _INT, False, None), ("fkstationid", _INT, False, None)],
    "calibrationdata": [
        ("pkcalibrationdataid", _INT, False, None),
        ("fkchannelid", _INT, False, None),
        ("year", _SHORT, False, None),
        ("month", _SHORT, False, None),
        ("day", _SHORT, False, None),
        ("date", "date", False, None),
        ("calyear", _INT, False, None),
        ("calmonth", _SHORT, False, None),
        ("calday", _SHORT, False, None),
        ("caldate", "date", False, None),
        ("fkmetcaltypeid", _INT, False, None),
        ("value", "double", False, None),
        ("fkmetricid", _INT, False, None),
    ],
    "channel": [
        ("pkchannelid", _INT, False, None),
        ("fksensorid", _INT, False, None),
        ("name", _TEXT, False, 16),
        ("derived", _INT, False, None),
        ("isignored", _BOOL, False, None),
    ],
    "computetype": [
        ("pkcomputetypeid", _INT, False, None),
        ("name", _TEXT, False, 8),
        ("description", _TEXT, True, 2000),
        ("iscalibration", _BOOL, False, None),
    ],
    "date": [("pkdateid", _INT, False, None), ("date", "date", False, None)],
    "errorlog": [
        ("pkerrorlogid", _INT, False, None),
        ("errortime", "timestamp_ntz", True, None),
        ("errormessage", _TEXT, True, 20480),
    ],
    "hash": [("pkhashid", _LONG, False, None), ("hash", "binary", False, None)],
    "metadata": [
        ("fkchannelid", _INT, False, None),
        ("epoch", "timestamp_ntz", False, None),
        ("sensor_info", _TEXT, True, 64),
        ("raw_metadata", "binary", True, None),
    ],
    "metric": [
        ("pkmetricid", _INT, False, None),
        ("name", _TEXT, False, 64),
        ("fkparentmetricid", _INT, True, None),
        ("legend", _TEXT, True, 128),
        ("fkcomputetypeid", _INT, False, None),
        ("displayname", _TEXT, True, 64),
    ],
    "metricdata": [
        ("fkchannelid", _INT, False, None),
        ("date", _INT, False, None),
        ("fkmetricid", _INT, False, None),
        ("value", "double", False, None),
        ("fkhashid", _LONG, False, None),
    ],
    "metricstringdata": [
        ("fkchannelid", _INT, False, None),
        ("date", _INT, False, None),
        ("fkmetricid", _INT, False, None),
        ("value", _TEXT, False, None),
        ("fkhashid", _LONG, False, None),
    ],
    "sensor": [
        ("pksensorid", _INT, False, None),
        ("fkstationid", _INT, False, None),
        ("location", _TEXT, False, 16),
    ],
    "station": [
        ("pkstationid", _INT, False, None),
        ("fknetworkid", _INT, False, None),
        ("name", _TEXT, False, 16),
    ],
}

# Defaults of columns that are left out.
DEFAULTS: dict[tuple[str, str], object] = {
    ("group", "isignored"): False,
    ("channel", "derived"): 0,
    ("channel", "isignored"): False,
    ("computetype", "iscalibration"): False,
}

# The group and compute types every model starts with.
GROUP_TYPES = [(1, "Network Code"), (2, "Groups"), (3, "Countries"), (4, "Regions")]
COMPUTE_TYPES = [
    (1, "AVG_CH", "Values are averaged over channel and number o", False),
    (2, "AVG_DAY", "Values are averaged over number of days.", False),
    (3, "VALUE_CO", "Values are totalled over the window of time.", False),
    (4, "PARENT", "Not used in computations.", False),
    (5, "CAL_DATE", "Value is the difference between the Calibrati", True),
    (6, "CAL_AVG", "Values are averaged over the number of values", True),
    (7, "NONE", "Values are not computed", False),
]
NETWORK_GROUP_TYPE = 1
AVERAGE, DAY_AVERAGE, TOTAL, CALIBRATION_AGE, CALIBRATION_AVERAGE = 1, 2, 3, 5, 6

FACT_TABLES = ("metricdata", "metricstringdata")


@dataclass(frozen=True)
class Unique:
    """A primary key, or a UNIQUE constraint if ``primary`` is false."""

    table: str
    columns: tuple[str, ...]
    primary: bool = True


# Primary keys, then UNIQUE constraints.
UNIQUES = [
    Unique("stationgrouptie", ("fkgroupid", "fkstationid")),
    Unique("hash", ("pkhashid",)),
    Unique("metricdata", ("fkmetricid", "date", "fkchannelid")),
    Unique("metricstringdata", ("fkmetricid", "date", "fkchannelid")),
    Unique("grouptype", ("pkgrouptypeid",)),
    Unique("calibrationdata", ("pkcalibrationdataid",)),
    Unique("channel", ("pkchannelid",)),
    Unique("computetype", ("pkcomputetypeid",)),
    Unique("date", ("pkdateid",)),
    Unique("errorlog", ("pkerrorlogid",)),
    Unique("metric", ("pkmetricid",)),
    Unique("group", ("pkgroupid",)),
    Unique("sensor", ("pksensorid",)),
    Unique("station", ("pkstationid",)),
    Unique(
        "calibrationdata",
        ("fkchannelid", "year", "month", "day", "calyear", "calmonth", "calday", "fkmetcaltypeid"),
        False,
    ),
    Unique("channel", ("fksensorid", "name"), False),
    Unique("computetype", ("name",), False),
    Unique("date", ("date",), False),
    Unique("metadata", ("fkchannelid", "epoch"), False),
    Unique("sensor", ("fkstationid", "location"), False),
    Unique("station", ("fknetworkid", "name"), False),
    Unique("grouptype", ("name",), False),
    Unique("group", ("name", "fkgrouptypeid"), False),
    Unique("hash", ("hash",), False),
    Unique("metric", ("name",), False),
]


@dataclass(frozen=True)
class ForeignKey:
    """``child.column`` refers to ``parent.key``; ``on_delete`` is cascade or refuse."""

    child: str
    column: str
    parent: str
    key: str
    on_delete: str


# The references between the tables. (The hash id of a fact has none.)
FOREIGN_KEYS = [
    ForeignKey("calibrationdata", "fkchannelid", "channel", "pkchannelid", "refuse"),
    ForeignKey("calibrationdata", "fkmetricid", "metric", "pkmetricid", "refuse"),
    ForeignKey("metricdata", "fkchannelid", "channel", "pkchannelid", "cascade"),
    ForeignKey("metric", "fkcomputetypeid", "computetype", "pkcomputetypeid", "cascade"),
    ForeignKey("stationgrouptie", "fkgroupid", "group", "pkgroupid", "cascade"),
    ForeignKey("metric", "fkparentmetricid", "metric", "pkmetricid", "cascade"),
    ForeignKey("metricdata", "fkmetricid", "metric", "pkmetricid", "cascade"),
    ForeignKey("station", "fknetworkid", "group", "pkgroupid", "cascade"),
    ForeignKey("channel", "fksensorid", "sensor", "pksensorid", "cascade"),
    ForeignKey("sensor", "fkstationid", "station", "pkstationid", "cascade"),
    ForeignKey("stationgrouptie", "fkstationid", "station", "pkstationid", "refuse"),
    ForeignKey("group", "fkgrouptypeid", "grouptype", "pkgrouptypeid", "refuse"),
    ForeignKey("metricstringdata", "fkchannelid", "channel", "pkchannelid", "cascade"),
    ForeignKey("metricstringdata", "fkmetricid", "metric", "pkmetricid", "cascade"),
]


def table_schema(table: str) -> T.StructType:
    fields = ", ".join(
        f"`{name}` {kind}{'' if nullable else ' NOT NULL'}"
        for name, kind, nullable, _ in TABLES[table]
    )
    return T.StructType.fromDDL(fields)


def model_schemas() -> dict[str, T.StructType]:
    return {table: table_schema(table) for table in TABLES}


def columns_of(table: str) -> list[str]:
    return [name for name, *_ in TABLES[table]]


def length_limit(table: str, column: str) -> int | None:
    return next(size for name, _, _, size in TABLES[table] if name == column)


def small_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few literal rows as an Arrow table: unlike a local list, which becomes an RDD, its
    size is known to the optimizer, so that joins broadcast it."""
    columns = [
        pa.array([row[i] for row in rows], type=_ARROW_TYPES[field.dataType.simpleString()])
        for i, field in enumerate(schema.fields)
    ]
    return spark.createDataFrame(pa.Table.from_arrays(columns, names=schema.names), schema)


_ARROW_TYPES = {
    "smallint": pa.int16(),
    "int": pa.int32(),
    "bigint": pa.int64(),
    "double": pa.float64(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "binary": pa.binary(),
    "date": pa.date32(),
    "timestamp_ntz": pa.timestamp("us"),
}


def seed_reference_data(spark: SparkSession) -> Model:
    """The group types and compute types a blank model ships with."""
    return {
        "grouptype": small_table(spark, GROUP_TYPES, table_schema("grouptype")),
        "computetype": small_table(spark, COMPUTE_TYPES, table_schema("computetype")),
    }


def blank_model(spark: SparkSession, tables: Iterable[str] = tuple(TABLES)) -> Model:
    """The given tables (all fifteen by default), empty but for the seed rows."""
    seeds = seed_reference_data(spark)
    return {
        t: seeds[t] if t in seeds else small_table(spark, [], table_schema(t)) for t in tables
    }
