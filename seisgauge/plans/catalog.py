"""The registered queries: every operator over the whole of the shared tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (
    day_spine,
    from_julian_day,
    is_numeric,
    julian_day,
    parse_day,
    round_numeric,
    score,
)
from ..operators import integrity, listings, lookups
from ..operators.ingest import IngestResult, ingest
from ..operators.listing import hash_listing
from ..operators.plots import channel_plots, station_plots
from ..operators.rollup import rollup_windows, stored_window_totals, window_totals
from ..operators.scorecards import compute_type_status, scorecard
from ..operators.sync import diff, diff_models, differences_per_day
from ..operators.windows import channel_paths, metric_names
from ..schemas import (
    AVERAGE,
    CALIBRATION_AGE,
    FOREIGN_KEYS,
    TOTAL,
    UNIQUES,
    Model,
    blank_model,
)
from ..sources.measurements import (
    MEASUREMENT_COLUMNS,
    read_measurements,
    write_records,
    write_sync_csv,
)
from ..sources.staging import SMALL_DIGESTS, stage, staging_path
from ..sources.store import commit_ingest, delete_rows, load_model, save_model
from .stations import (
    WINDOW,
    measurements,
    networks,
    raw_measurements,
    station_model,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]

BEGIN, END = WINDOW
SCORE_DIGITS = 6


def _scorecard(level: str, kind: int) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        card = scorecard(station_model(spark, sf_dir), BEGIN, END, level, (kind,))
        return card.select(
            "id", "metric", "value", round_numeric(F.col("score"), SCORE_DIGITS).alias("score")
        )

    return query


def _station_plot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return station_plots(station_model(spark, sf_dir), BEGIN, END).drop("record")


def _channel_plot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return channel_plots(station_model(spark, sf_dir), BEGIN, END).drop("record")


def _in_use(model: Model) -> Model:
    """The model with the number of facts of every metric, 0 for one without."""
    counts = (
        model["metricdata"]
        .select("fkmetricid")
        .unionByName(model["metricstringdata"].select("fkmetricid"))
        .groupBy(F.col("fkmetricid").alias("pkmetricid"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    used = (
        model["metric"].select("pkmetricid").join(counts, "pkmetricid", "left")
        .select("pkmetricid", F.coalesce("n", F.lit(0)).alias("n_facts"))
    )
    return {**model, "used": used}


def _compute_type_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _in_use(station_model(spark, sf_dir))
    counts = model["used"].withColumnRenamed("pkmetricid", "fkmetricid")
    return compute_type_status(model).join(counts, "fkmetricid").drop("fkmetricid")


def _list_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.channels(station_model(spark, sf_dir)).select("id", "record")


def _list_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.stations(station_model(spark, sf_dir)).select("id", "record")


def _list_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.groups(station_model(spark, sf_dir)).select("id", "record")


def _list_group_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.group_types(station_model(spark, sf_dir)).select("id", "record")


def _list_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.metrics(_in_use(station_model(spark, sf_dir))).select("id", "record")


def _date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.date_bounds(station_model(spark, sf_dir)).select("bound", "record")


def named_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests: every series on each of its days and on the day after."""
    raw, day = raw_measurements(spark, sf_dir), F.col("day")
    # The names that follow from a supplier come after the shuffle.
    asked = raw.select(
        F.explode(F.array(day, F.date_add(day, 1))).alias("date"),
        "l_suppkey",
        "location",
        "channel",
        "metric",
    ).distinct()
    station = F.concat(F.lit("S"), "l_suppkey").alias("station")
    return asked.join(networks(spark, sf_dir, once=True), "l_suppkey").select(
        "date", "network", station, "location", "channel", "metric"
    )


def _metric_value_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lookups.metric_values(station_model(spark, sf_dir), named_days(spark, sf_dir))
    return found.withColumn("value", round_numeric(F.col("value"), SCORE_DIGITS))


def _digest_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lookups.metric_digests(station_model(spark, sf_dir), named_days(spark, sf_dir))
    return found.withColumn("hash", F.lower(F.hex("hash")))


def _has_any_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests: every series, and the same series at the station's other location."""
    rows = measurements(spark, sf_dir)
    swapped = F.when(F.col("location") == "", "10").otherwise("")
    requests = rows.select(
        "network",
        "station",
        F.explode(F.array("location", swapped)).alias("location"),
        "channel",
        "metric",
    ).distinct()
    return lookups.has_any_hash(station_model(spark, sf_dir), requests)


def _score_all_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = station_model(spark, sf_dir)
    value = round_numeric(F.col("value"), 4)
    return (
        model["metricdata"]
        .join(metric_names(model), "fkmetricid")
        .withColumn("value", value)
        .select(
            "fkchannelid",
            "date",
            "metric",
            "value",
            round_numeric(score(F.col("value"), F.col("metric")), SCORE_DIGITS).alias("score"),
        )
    )


def _numeric_text_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items written as numbers, and as things that look like numbers."""
    part = F.col("l_partkey").cast("string")
    line = F.col("l_linenumber")
    text = (
        F.when(line == 1, part)
        .when(line == 2, F.concat(F.lit(" "), part, F.lit(". ")))
        .when(line == 3, F.concat(part, F.lit("e-"), line.cast("string")))
        .when(line == 4, F.concat(F.lit("-."), part))
        .when(line == 5, F.concat(part, F.lit("d")))
        .when(line == 6, F.concat(F.lit("0x"), part))
        .when(F.col("l_returnflag") == "A", "NaN")
        .when(F.col("l_returnflag") == "N", "Infinity")
        .otherwise("")
    )
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(text.alias("text"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("text", is_numeric(F.col("text")).alias("numeric"), "n")
    )


def _julian_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("day"))
    ordered = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    return (
        shipped.union(ordered)
        .groupBy("day")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("julian", julian_day(F.col("day")))
        .withColumn("back", from_julian_day(F.col("julian")))
    )


def _parse_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ship dates written in both accepted forms and in three that are refused."""
    day = F.col("l_shipdate").cast("date")
    year = F.year(day).cast("string")
    forms = F.array(
        F.date_format(day, "yyyy-MM-dd"),
        F.concat(year, F.lit("-"), F.lpad(F.dayofyear(day).cast("string"), 3, "0")),
        F.date_format(day, "yyyyMMdd"),
        F.concat(year, F.lit("-02-30")),
        F.concat(year, F.lit("-367")),
    )
    return (
        table(spark, sf_dir, "lineitem")
        .select(F.explode(forms).alias("text"))
        .groupBy("text")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("text", parse_day(F.col("text")).alias("day"), "n")
    )


def _day_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_shipdate").cast("date").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        day_spine(spark, BEGIN, END)
        .join(shipped, "day", "left")
        .select("day", F.coalesce("n", F.lit(0)).alias("n"))
    )


def _kind(text_values: bool) -> Column:
    calibration = F.col("fkcomputetypeid") == CALIBRATION_AGE
    return calibration if text_values else ~calibration


def _state(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> Model:
    """A model to ingest into, its digests staged as they are read several times."""
    model = station_model(spark, sf_dir, raw)
    model["hash"] = stage(model["hash"], "stored-hashes")
    return model


def _ingest_second_half(spark: SparkSession, sf_dir: str, text_values: bool) -> IngestResult:
    """Filled line items are the state, open ones the batch that comes on top."""
    raw = raw_measurements(spark, sf_dir)
    state = _state(spark, sf_dir, raw.where(F.col("l_linestatus") == "F"))
    rows = measurements(spark, sf_dir)
    batch = rows.where((F.col("l_linestatus") == "O") & _kind(text_values))
    return ingest(state, batch, text_values)


def _named_facts(model: Model, fact_table: str) -> DataFrame:
    """Facts by natural key, free of surrogate ids."""
    hashes = model["hash"].select(F.col("pkhashid").alias("fkhashid"), "hash")
    return (
        model[fact_table]
        .join(hashes, "fkhashid")
        .join(metric_names(model), "fkmetricid")
        .join(channel_paths(model), "fkchannelid")
        .select(
            from_julian_day(F.col("date")).alias("day"),
            *lookups.NAMES,
            round_numeric(F.col("value").cast("double"), SCORE_DIGITS).alias("value"),
            F.lower(F.hex("hash")).alias("hash"),
        )
    )


def _ingest_upsert_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named_facts(_ingest_second_half(spark, sf_dir, False).model, "metricdata")


def _ingest_upsert_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named_facts(_ingest_second_half(spark, sf_dir, True).model, "metricstringdata")


def _ingest_both(model: Model, rows: DataFrame) -> Model:
    """The model after the numeric rows of a batch and then its calibrations came in."""
    for text_values in (False, True):
        model = ingest(model, rows.where(_kind(text_values)), text_values).model
    return model


def _ingest_everything(spark: SparkSession, sf_dir: str) -> Model:
    """All measurements into a model that knows nothing but the regions."""
    model = blank_model(spark)
    model["group"] = station_model(spark, sf_dir)["group"].where(F.col("fkgrouptypeid") == 4)
    return _ingest_both(model, measurements(spark, sf_dir))


def _ingest_open_half(spark: SparkSession, sf_dir: str) -> Model:
    """All open line items on top of the filled ones."""
    raw = raw_measurements(spark, sf_dir)
    state = _state(spark, sf_dir, raw.where(F.col("l_linestatus") == "F"))
    return _ingest_both(state, measurements(spark, sf_dir).where(F.col("l_linestatus") == "O"))


def _ingest_new_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _ingest_everything(spark, sf_dir)
    station = model["station"].join(
        model["group"].select(F.col("pkgroupid").alias("fknetworkid"), F.col("name").alias("up")),
        "fknetworkid",
    )
    sensor = model["sensor"].join(
        model["station"].select(
            F.col("pkstationid").alias("fkstationid"), F.col("name").alias("up")
        ),
        "fkstationid",
    )

    def named(level: str, rows: DataFrame, name: Column) -> DataFrame:
        return rows.select(F.lit(level).alias("level"), name.alias("name"))

    paths = channel_paths(model)
    full = F.concat_ws(".", "network", "station", "location", "channel")
    return (
        named("group", model["group"], F.concat_ws(".", "name", "fkgrouptypeid"))
        .union(named("station", station, F.concat_ws(".", "up", "name")))
        .union(named("sensor", sensor, F.concat_ws(".", "up", "location")))
        .union(named("channel", paths, full))
        .union(
            named("metric", model["metric"], F.concat_ws(".", "displayname", "fkcomputetypeid"))
        )
        .union(named("date", model["date"], F.concat_ws(".", "pkdateid", "date")))
    )


def _ingest_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Are the ids handed out dense and unique? One line per table."""
    model = _ingest_everything(spark, sf_dir)

    def summary(name: str, key: str) -> DataFrame:
        return model[name].agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("n"),
            F.count_distinct(key).alias("ids"),
            F.min(key).cast("bigint").alias("lowest"),
            F.max(key).cast("bigint").alias("highest"),
        )

    lines = [
        summary("station", "pkstationid"),
        summary("sensor", "pksensorid"),
        summary("channel", "pkchannelid"),
        summary("metric", "pkmetricid"),
        summary("hash", "pkhashid"),
    ]
    result = lines[0]
    for line in lines[1:]:
        result = result.union(line)
    return result


def _ingest_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _ingest_open_half(spark, sf_dir)
    return (
        model["stationgrouptie"]
        .join(
            model["group"].select(
                F.col("pkgroupid").alias("fkgroupid"), F.col("name").alias("group_name")
            ),
            "fkgroupid",
        )
        .join(
            model["station"].select(
                F.col("pkstationid").alias("fkstationid"), F.col("name").alias("station")
            ),
            "fkstationid",
        )
        .select("group_name", "station")
    )


def _ingest_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingest_open_half(spark, sf_dir)["date"].select("pkdateid", "date")


def _soiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All measurements; zero readings and those of three metrics are damaged in some way."""
    rows = measurements(spark, sf_dir)
    value, flag = F.col("value"), F.col("l_returnflag")
    zero = value.cast("double") == 0
    damaged_value = (
        F.when(zero & (flag == "A"), "NaN")
        .when(zero & (flag == "N"), "1d")
        .when(zero & (flag == "R"), "")
        .otherwise(value)
    )
    damaged_hash = F.when(F.col("metric") == "NoneMetric", F.concat("hash", F.lit("z"))).otherwise(
        F.col("hash")
    )
    damaged_date = F.when(
        F.col("metric") == "ParentMetric", F.concat(F.substring("date", 1, 5), F.lit("02-30"))
    ).otherwise(F.col("date"))
    damaged_station = F.when(
        F.col("metric") == "DayMeanMetric", F.concat_ws(".", "network", "station", "metric")
    ).otherwise(F.col("station"))
    return rows.select(
        damaged_date.alias("date"),
        "network",
        damaged_station.alias("station"),
        "location",
        "channel",
        "metric",
        damaged_value.alias("value"),
        damaged_hash.alias("hash"),
        "arrival",
    )


def _ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = ingest(_state(spark, sf_dir), _soiled(spark, sf_dir))
    return result.rejected.select(
        F.col("date_text").alias("date"),
        *lookups.NAMES,
        F.col("value_text").alias("value"),
        F.col("hash_text").alias("hash"),
        "problem",
    )


def _ingest_error_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = ingest(_state(spark, sf_dir), _soiled(spark, sf_dir))
    return (
        result.model["errorlog"]
        .groupBy("errormessage")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _hash_listing_wildcard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_listing(
        station_model(spark, sf_dir),
        channel="BH_",
        metric="Coherence%",
        network="NATION_1%",
    )


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_listing(station_model(spark, sf_dir))


def _staged_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For queries that make both sides of a comparison from it."""
    return stage(_listing(spark, sf_dir), "listing", **SMALL_DIGESTS)


def other_side(listing: DataFrame) -> DataFrame:
    """The same deployment after it lost every eleventh day and re-ran every seventh."""
    julian = julian_day(F.col("date").cast("date"))
    return listing.where(julian % 11 != 0).withColumn(
        "hash", F.when(julian % 7 == 0, F.md5(F.lit("x"))).otherwise(F.col("hash"))
    )


def _sync_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _staged_listing(spark, sf_dir)
    return diff(source, other_side(source))


def _sync_diff_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other side holds an earlier row of every key as well."""
    source = _staged_listing(spark, sf_dir)
    early = source.withColumn("hash", F.md5(F.lit("early"))).withColumn("arrival", F.lit(0))
    late = other_side(source).withColumn("arrival", F.lit(1))
    return diff(source, late.unionByName(early))


def _sync_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return differences_per_day(_sync_diff(spark, sf_dir), BEGIN, END)


def _sync_diff_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stores that keep checksums: all numeric measurements, and half of them with a part of
    the others ingested on top."""
    roots = [staging_path(spark, "store") for _ in range(2)]
    raw = raw_measurements(spark, sf_dir)
    filled = station_model(spark, sf_dir, raw.where(F.col("l_linestatus") == "F"))
    for root, model in zip(roots, (station_model(spark, sf_dir), filled)):
        save_model(spark, model, root, block_days=1000, checksums=True)
    rows = measurements(spark, sf_dir).where((F.col("l_linestatus") == "O") & _kind(False))
    batch = rows.where(F.substring("hash", 1, 1) < "5")
    commit_ingest(spark, ingest(load_model(spark, roots[1]), batch), roots[1])
    source, destination = (load_model(spark, root) for root in roots)
    return diff_models(source, destination, None, None)


def _sync_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences before and after the destination ingested the first ones."""
    source = _staged_listing(spark, sf_dir)
    other = other_side(source)
    # Both counted and ingested.
    missing = stage(diff(source, other), "missing", **SMALL_DIGESTS)
    # The destination starts with its own listing and then receives the difference.
    held = ingest(blank_model(spark), other)
    synced = ingest(held.model, missing)
    after = diff(source, stage(hash_listing(synced.model), "listing", **SMALL_DIGESTS))

    def counted(when: str, rows: DataFrame) -> DataFrame:
        return rows.agg(F.lit(when).alias("moment"), F.count(F.lit(1)).alias("n"))

    return counted("before", missing).union(counted("after", after))


def _check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw measurements repeat keys of the facts; order lines repeat theirs."""
    raw = raw_measurements(spark, sf_dir)
    model = station_model(spark, sf_dir)
    model["metricdata"] = raw.where(_kind(False))
    model["metricstringdata"] = raw.where(_kind(True))
    model["date"] = raw.select(
        F.trunc("day", "month").alias("date"), F.col("date").alias("pkdateid")
    ).distinct()
    return integrity.check_uniques(model, UNIQUES)


def _check_foreign_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop the ignored channels, the regions and one metric: what still refers to them?"""
    model = station_model(spark, sf_dir)
    model["channel"] = model["channel"].where(~F.col("isignored"))
    model["group"] = model["group"].where(F.col("fkgrouptypeid") != 4)
    model["metric"] = model["metric"].where(~F.col("name").like("CoherencePBM%"))
    return integrity.check_foreign_keys(model, FOREIGN_KEYS)


def _faulty_batch(spark: SparkSession, sf_dir: str) -> tuple[Model, Model]:
    """The filled line items as stored, and a batch on top with planted faults: stations of even
    number once more under other ids, channels of sensors that don't exist, and raw measurements,
    which repeat keys, some of channels or metrics that don't exist."""
    raw = raw_measurements(spark, sf_dir)
    stored = station_model(spark, sf_dir, raw.where(F.col("l_linestatus") == "F"))
    far = 1_000_000
    metric = F.col("fkmetricid")
    added = {
        "station": stored["station"]
        .where(F.col("pkstationid") % 2 == 0)
        .withColumn("pkstationid", F.col("pkstationid") + far),
        "channel": stored["channel"]
        .where("isignored")
        .withColumns({"pkchannelid": F.col("pkchannelid") + far, "fksensorid": F.col("fksensorid") + far}),
        "metricdata": raw.where((F.col("l_linestatus") == "O") & _kind(False)).withColumns(
            {
                "fkchannelid": F.col("fkchannelid") + F.when(metric == 1, 2 * far).when(metric == 3, far).otherwise(0),
                "fkmetricid": F.when(metric == 2, metric + far).otherwise(metric),
            }
        ),
    }
    return stored, added


def _check_batch_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.check_new_uniques(*_faulty_batch(spark, sf_dir))


def _check_batch_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.check_new_references(*_faulty_batch(spark, sf_dir))


def _incomplete(spark: SparkSession, sf_dir: str) -> Model:
    """Zero readings unknown, blank locations unknown, names spelled out in full."""
    model = station_model(spark, sf_dir)
    paths = channel_paths(model)
    model["metricdata"] = model["metricdata"].withColumn("value", F.expr("nullif(value, 0)"))
    model["sensor"] = model["sensor"].withColumn("location", F.expr("nullif(location, '')"))
    model["channel"] = model["channel"].join(
        paths.select(
            F.col("fkchannelid").alias("pkchannelid"),
            F.concat_ws(".", "network", "station", "location", "channel").alias("full"),
        ),
        "pkchannelid",
    ).select("pkchannelid", "fksensorid", F.col("full").alias("name"), "derived", "isignored")
    return model


def _check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _incomplete(spark, sf_dir)
    found = [integrity.check_not_null(rows, name) for name, rows in model.items()]
    return integrity.union_all(found)


def _check_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _incomplete(spark, sf_dir)
    found = [integrity.check_lengths(rows, name) for name, rows in model.items()]
    return integrity.union_all(found)


def _table_sizes(model: Model) -> DataFrame:
    names = ["group", "stationgrouptie", "station", "sensor", "channel", "metric"]
    names += ["metricdata", "metricstringdata"]
    return integrity.union_all(
        model[name].agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"))
        for name in names
    )


def _cascade_delete_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the regional groups, whose ties would block it, delete some networks."""
    model = station_model(spark, sf_dir)
    model = integrity.cascade_delete(model, "group", F.col("fkgrouptypeid") == 4)
    model = integrity.cascade_delete(model, "group", F.col("name").like("NATION_1%"))
    return _table_sizes(model)


def _cascade_delete_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = station_model(spark, sf_dir)
    return _table_sizes(
        integrity.cascade_delete(model, "metric", F.col("name") == "CoherencePBM:18-22")
    )


def _store_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions, then some networks, then a metric with all below it deleted from a store."""
    root = staging_path(spark, "store")
    save_model(spark, station_model(spark, sf_dir), root, block_days=1000)
    delete_rows(spark, root, "group", F.col("fkgrouptypeid") == 4)
    delete_rows(spark, root, "group", F.col("name").like("NATION_1%"))
    delete_rows(spark, root, "metric", F.col("name") == "CoherencePBM:18-22")
    return _table_sizes(load_model(spark, root))


def _cascade_blockers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deleting every network is refused: these stations are tied to a region, too."""
    model = station_model(spark, sf_dir)
    return integrity.plan_cascade(model, "group", F.col("fkgrouptypeid") == 1).blockers


def _metric_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts measured for each metric and all metrics below it."""
    model = _in_use(station_model(spark, sf_dir))
    return (
        integrity.metric_descendants(model)
        .join(model["used"], "pkmetricid")
        .groupBy("ancestor")
        .agg(
            F.count(F.lit(1)).alias("metrics"),
            F.max("depth").alias("depth"),
            F.sum("n_facts").alias("n_facts"),
        )
    )


def _window_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = station_model(spark, sf_dir)
    totals = window_totals(model, rollup_windows(model["metricdata"]), BEGIN, END)
    return totals.withColumn("total", round_numeric(F.col("total"), 4))


LONG_WINDOW = ("1995-03-05", "2001-09-17")


def _corrections(rows: DataFrame) -> DataFrame:
    """A third or so of the measurements once more, with twice the value."""
    doubled = (F.col("value").cast("double") * 2).cast("string")
    return rows.where(F.substring("hash", 1, 1) < "5").withColumn("value", doubled)


def _stored_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the numeric measurements saved, the other half and then corrections ingested; the
    window comes from the sums that the store keeps and the facts of its edge days."""
    root = staging_path(spark, "store")
    raw = raw_measurements(spark, sf_dir)
    filled = station_model(spark, sf_dir, raw.where(F.col("l_linestatus") == "F"))
    save_model(spark, filled, root, block_days=1000, rollup=True)
    rows = measurements(spark, sf_dir).where((F.col("l_linestatus") == "O") & _kind(False))
    for batch in (rows, _corrections(rows)):
        commit_ingest(spark, ingest(load_model(spark, root), batch), root)
    model = load_model(spark, root)
    totals = stored_window_totals(model, model.rollup, *LONG_WINDOW)
    return totals.withColumn("total", round_numeric(F.col("total"), 4))


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "csv")
    write_sync_csv(_listing(spark, sf_dir), path)
    return read_measurements(spark, path).select(*MEASUREMENT_COLUMNS)


def _csv_roundtrip_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with commas, quotes and blanks at their ends."""
    path = staging_path(spark, "csv")
    rows = _listing(spark, sf_dir).withColumns(
        {
            "station": F.concat("station", F.lit(',"x", ')),
            "location": F.concat(F.lit(" "), "location"),
        }
    )
    write_sync_csv(rows, path)
    return read_measurements(spark, path).select(*MEASUREMENT_COLUMNS)


def _csv_roundtrip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with line breaks of both kinds, quotes before them, and empty lines."""
    path = staging_path(spark, "csv")
    rows = _listing(spark, sf_dir).withColumns(
        {
            "station": F.concat("station", F.lit('\n"x",\n\n')),
            "location": F.concat(F.lit("\r\n"), "location"),
        }
    )
    write_sync_csv(rows, path, multiline=True)
    return read_measurements(spark, path, multiline=True).select(*MEASUREMENT_COLUMNS)


def _store_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the measurements saved, the other half ingested in two commits, then listed."""
    root = staging_path(spark, "store")
    raw = raw_measurements(spark, sf_dir)
    save_model(spark, station_model(spark, sf_dir, raw.where(F.col("l_linestatus") == "F")), root, block_days=1000)
    rows = measurements(spark, sf_dir).where(F.col("l_linestatus") == "O")
    for text_values in (True, False):
        result = ingest(load_model(spark, root), rows.where(_kind(text_values)), text_values)
        commit_ingest(spark, result, root)
    model = load_model(spark, root)
    repeated = integrity.check_uniques(model).first()
    if repeated is not None:
        raise RuntimeError(f"the store repeats {repeated}")
    numeric, text = (
        _named_facts(model, name).withColumn("fact_table", F.lit(name))
        for name in ("metricdata", "metricstringdata")
    )
    return numeric.unionByName(text)


def _text_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "records")
    model = station_model(spark, sf_dir)
    write_records(scorecard(model, BEGIN, END, "station", (AVERAGE, TOTAL, CALIBRATION_AGE)), path)
    return spark.read.text(path).select(F.col("value").alias("record"))


def _station_plot_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "records")
    write_records(station_plots(station_model(spark, sf_dir), BEGIN, END), path)
    lines = spark.read.text(path).groupBy(F.col("value").alias("record"))
    return lines.agg(F.count(F.lit(1)).alias("n"))


QUERIES: dict[str, Query] = {
    "station_scorecard_avg": _scorecard("station", AVERAGE),
    "station_scorecard_sum": _scorecard("station", TOTAL),
    "station_scorecard_caldays": _scorecard("station", CALIBRATION_AGE),
    "channel_scorecard_avg": _scorecard("channel", AVERAGE),
    "channel_scorecard_sum": _scorecard("channel", TOTAL),
    "channel_scorecard_caldays": _scorecard("channel", CALIBRATION_AGE),
    "station_plot_daily": _station_plot,
    "channel_plot_daily": _channel_plot,
    "compute_type_status": _compute_type_status,
    "list_channels": _list_channels,
    "list_stations": _list_stations,
    "list_groups": _list_groups,
    "list_group_types": _list_group_types,
    "list_metrics": _list_metrics,
    "date_bounds": _date_bounds,
    "metric_value_lookup": _metric_value_lookup,
    "digest_lookup": _digest_lookup,
    "has_any_hash": _has_any_hash,
    "score_all_metrics": _score_all_metrics,
    "numeric_text_check": _numeric_text_check,
    "julian_roundtrip": _julian_roundtrip,
    "parse_day": _parse_day,
    "day_spine": _day_spine,
    "ingest_upsert_numeric": _ingest_upsert_numeric,
    "ingest_upsert_string": _ingest_upsert_string,
    "ingest_new_dimensions": _ingest_new_dimensions,
    "ingest_ids": _ingest_ids,
    "ingest_ties": _ingest_ties,
    "ingest_dates": _ingest_dates,
    "ingest_quarantine": _ingest_quarantine,
    "ingest_error_log": _ingest_error_log,
    "hash_listing_wildcard": _hash_listing_wildcard,
    "sync_diff": _sync_diff,
    "sync_diff_stored": _sync_diff_stored,
    "sync_days": _sync_days,
    "sync_closure": _sync_closure,
    "check_unique": _check_unique,
    "check_foreign_keys": _check_foreign_keys,
    "check_batch_unique": _check_batch_unique,
    "check_batch_references": _check_batch_references,
    "check_not_null": _check_not_null,
    "check_lengths": _check_lengths,
    "cascade_delete_network": _cascade_delete_network,
    "cascade_delete_metric": _cascade_delete_metric,
    "store_delete": _store_delete,
    "cascade_blockers": _cascade_blockers,
    "metric_descendants": _metric_descendants,
    "window_rollup": _window_rollup,
    "stored_rollup": _stored_rollup,
    "csv_roundtrip": _csv_roundtrip,
    "csv_roundtrip_quoted": _csv_roundtrip_quoted,
    "csv_roundtrip_lines": _csv_roundtrip_lines,
    "store_ingest": _store_ingest,
    "sync_diff_duplicates": _sync_diff_duplicates,
    "text_records": _text_records,
    "station_plot_records": _station_plot_records,
}
