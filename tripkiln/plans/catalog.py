"""Registered queries over the test tables, and their DuckDB oracles.

Every query reads the whole test tables (through the deterministic trip
projection of :mod:`tripkiln.sources.fixtures`) and exercises one operator
or one stage. ``ORACLES`` holds, per query, an independent SQL formulation
for DuckDB; computed columns carry the same names on both sides.

Oracle notes: DuckDB rounds a double half-to-even on its binary value while
Spark rounds the decimal text HALF_UP, so oracles round through an exact
decimal (``_r``); a cast of 2.9 to integer rounds in DuckDB and truncates in
Spark (``trunc``); ``x/0`` is ``inf`` in DuckDB (``nullif``).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripkiln.config import SilverConfig
from tripkiln.functions.columns import parse_timestamp
from tripkiln.operators import aggregates as A
from tripkiln.operators import cleanse, features, insights, privacy, quality
from tripkiln.operators.encode import encode_ordinal
from tripkiln.operators.impute import impute_mean, impute_mode
from tripkiln.plans.gold import gold, gold_slices
from tripkiln.plans.runs import run_gold, run_silver
from tripkiln.plans.silver import silver
from tripkiln.schema import CAST_SPEC
from tripkiln.session import checkpoint_dir
from tripkiln.sources import ledger, tables
from tripkiln.sources.files import read_raw_csv
from tripkiln.sources.fixtures import (
    MORE,
    MORE_DOUBLES,
    MORE_INTS,
    MORE_TEXTS,
    RAW_TRIPS_SQL,
    TRIP_KEYS,
    TRIPS_SQL,
    kept_raw_trips,
    raw_slices,
    raw_trips,
    slices,
    trips,
)
from tripkiln.sources.sinks import write_csv, write_fanout, write_parquet
from tripkiln.sources.staging import remove, shuffles_end, stage_all, staged
from tripkiln.streaming.ingest import gold_stream, silver_stream

# fixed batch time of the registered silver runs (keeps results comparable)
BATCH_TIME = _dt.datetime(2024, 1, 1, 0, 0, 0)
BATCH_EPOCH = 1704067200
# trips picked up before this time count as already loaded into the target
LOADED_BEFORE = "1999-01-01 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
KEYS = list(TRIP_KEYS)


def _keys_and(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*KEYS, *cols)


# ---------------------------------------------------------------------------
# Spark queries
# ---------------------------------------------------------------------------

def q_trips_fixture(spark, sf):
    return trips(spark, sf)


def q_cast_types(spark, sf):
    return cleanse.cast_columns(raw_trips(spark, sf), CAST_SPEC)


def q_impute_mean(spark, sf):
    return impute_mean(trips(spark, sf))


def q_impute_mode(spark, sf):
    return impute_mode(trips(spark, sf))


def q_drop_incomplete(spark, sf):
    return cleanse.drop_incomplete(trips(spark, sf))


def q_split_name(spark, sf):
    out = privacy.split_names(
        trips(spark, sf), {"passenger_fullname": ("passenger_first_name", "passenger_last_name")}
    )
    return _keys_and(out, "passenger_fullname", "passenger_first_name", "passenger_last_name")


def q_mask_partial(spark, sf):
    out = privacy.mask_partial_columns(trips(spark, sf), ("passenger_phone_number", "passenger_credit_card"))
    return _keys_and(out, "passenger_phone_number", "passenger_credit_card")


def q_mask_full(spark, sf):
    out = privacy.mask_full_columns(trips(spark, sf), ("passenger_credit_card", "passenger_phone_number"))
    return _keys_and(out, "passenger_credit_card", "passenger_phone_number")


def q_mask_script_variant(spark, sf):
    """Keep-3 partial mask and null-preserving full mask."""
    t = trips(spark, sf)
    t = privacy.mask_partial_columns(t, ("passenger_phone_number",), keep=3)
    t = privacy.mask_full_columns(t, ("store_and_fwd_flag",), keep_null=True)
    return _keys_and(t, "passenger_phone_number", "store_and_fwd_flag")


def q_time_parts(spark, sf):
    t = trips(spark, sf).withColumnRenamed("lpep_pickup_datetime", "pickup_datetime")
    t = t.transform(features.pickup_hour).transform(features.pickup_day_of_week).transform(features.pickup_month)
    return _keys_and(t, "pickup_datetime", "pickup_hour", "pickup_day_of_week", "month")


def _renamed_trips(spark, sf):
    return cleanse.rename_columns(trips(spark, sf))


def q_trip_durations(spark, sf):
    t = _renamed_trips(spark, sf).transform(features.trip_duration).transform(features.request_to_pickup_delay)
    return _keys_and(t, "trip_duration_minute", "request_to_pickup_delay_min")


def q_fare_ratios(spark, sf):
    t = _renamed_trips(spark, sf)
    for step in (
        features.trip_duration,
        features.trip_distance_km,
        features.total_tip_percentage,
        features.fare_per_distance,
        features.revenue_per_minute,
    ):
        t = t.transform(step)
    return _keys_and(t, "trip_distance_km", "total_tip_percentage", "fare_per_distance", "revenue_per_minute")


def q_speed_flags(spark, sf):
    t = _renamed_trips(spark, sf)
    for step in (
        features.pickup_hour,
        features.trip_duration,
        features.is_daylight,
        features.is_rush_hour,
        features.average_speed,
        features.route,
    ):
        t = t.transform(step)
    return _keys_and(t, "average_speed", "is_daylight", "is_rush_hour", "route")


def q_busy_area(spark, sf):
    return A.busy_area(trips(spark, sf))


def q_passenger_loyalty(spark, sf):
    return _keys_and(A.passenger_loyalty(trips(spark, sf)), "passenger_email", "passenger_loyalty")


def q_driver_experience(spark, sf):
    return _keys_and(A.driver_experience_level(trips(spark, sf)), "driver_email", "driver_experience_level")


def _loaded_and_source(spark, sf):
    """The target holds the trips picked up before the cut; the source all."""
    t = trips(spark, sf)
    loaded = t.where(F.col("lpep_pickup_datetime") < F.lit(LOADED_BEFORE).cast("timestamp_ntz"))
    return loaded, t


def q_high_water_mark(spark, sf):
    loaded, _ = _loaded_and_source(spark, sf)
    return A.high_water_mark(loaded, "lpep_pickup_datetime")


def q_incremental_load(spark, sf):
    loaded, source = _loaded_and_source(spark, sf)
    mark = tables.last_value(loaded, "lpep_pickup_datetime")
    return tables.newer_than(source, "lpep_pickup_datetime", mark)


def q_encode_ordinal(spark, sf):
    out = encode_ordinal(trips(spark, sf), ("store_and_fwd_flag",))
    return _keys_and(out, "store_and_fwd_flag", "store_and_fwd_flag_index")


def q_split_name_exploded(spark, sf):
    out = privacy.split_names_exploded(
        trips(spark, sf), "passenger_fullname", ("passenger_first_name", "passenger_last_name"), KEYS
    )
    return _keys_and(out, "passenger_fullname", "passenger_first_name", "passenger_last_name")


# -- runs and streams: each works in a folder of its own and hands out its committed rows --

_LABELS = {"wide": "concat('label ', cast(l_partkey as string))"}


def _base(spark) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tripkiln-runs/{uuid.uuid4().hex}"


def _file_schema(raw: DataFrame) -> StructType:
    return StructType(
        [f if f.name in KEYS or f.name == "batch_no" else StructField(f.name, StringType()) for f in raw.schema]
    )


def _land(raw: DataFrame, folder: str) -> None:
    # packed drops; a packed file is read by one task, so files are kept small
    packed = raw.write.mode("append").option("header", True).option("compression", "gzip")
    with shuffles_end(raw.sparkSession):
        packed.option("maxRecordsPerFile", 250_000).csv(folder)


def _land_trips(spark, sf, folder: str, of: str = "true") -> None:
    """The raw trips that ``of`` chooses, of large tables slice by slice."""
    for part in raw_slices(spark, sf):
        _land(part.where(of), folder)


def _by_number(rows: DataFrame) -> DataFrame:
    """Without the partitions, and with the micro-batch's number only."""
    number = F.element_at(F.split("batch_id", "-"), -1).cast("int")
    return rows.drop("ingest_date", "ingest_hour").withColumn("batch_id", number)


def q_csv_source(spark, sf):
    """Raw trips written as CSV in two folders and read back from both."""
    base, raw = _base(spark), raw_trips(spark, sf)
    _land_trips(spark, sf, f"{base}/a", "batch_no < 2")
    _land_trips(spark, sf, f"{base}/b", "batch_no >= 2")
    return read_raw_csv(spark, [f"{base}/a", f"{base}/b"], schema=_file_schema(raw))


def _sink_rows(spark, sf):
    return _keys_and(trips(spark, sf), "trip_distance", "passenger_email", "batch_no")


def q_csv_sinks(spark, sf):
    """Trips written as CSV with and without a header, read back together."""
    base, rows = _base(spark), _sink_rows(spark, sf)
    write_csv(rows.where("batch_no < 3"), f"{base}/with", header=True)
    write_csv(rows.where("batch_no >= 3"), f"{base}/without", header=False)
    read = lambda header, name: spark.read.schema(rows.schema).option("header", header).csv(f"{base}/{name}")
    return read(True, "with").union(read(False, "without"))


def _sink_tables(spark, sf):
    """A folder filled by two appends, partitioned by batch, and a folder
    filled by two appends through the fan-out."""
    base, rows = _base(spark), _sink_rows(spark, sf)
    for part in (rows.where("batch_no < 3"), rows.where("batch_no >= 3")):
        write_parquet(part, f"{base}/t", partition_by=["batch_no"])
        write_fanout(part, [("parquet", f"{base}/copy", "append")])
    # a partition column comes back as an integer
    both = spark.read.parquet(f"{base}/t").withColumn("batch_no", F.col("batch_no").cast("long"))
    return both.select(rows.columns), spark.read.parquet(f"{base}/copy")


def q_parquet_sinks(spark, sf):
    """The partitioned table less batch 4 of the fan-out's table; all rows of
    both tables are in ``parquet_sink_tables``."""
    both, copy = _sink_tables(spark, sf)
    return both.exceptAll(copy.where("batch_no = 4"))


def q_parquet_sink_tables(spark, sf):
    """All rows of both written tables, with the table's name."""
    both, copy = _sink_tables(spark, sf)
    return both.withColumn("written", F.lit("partitioned")).unionByName(copy.withColumn("written", F.lit("fanout")))


def q_observed_rows(spark, sf):
    """The row count that a write reports beside its own work."""
    rows, seen = tables.observe_rows(trips(spark, sf).select(*KEYS))
    rows.write.format("noop").mode("overwrite").save()
    return spark.range(1).select(F.lit(seen.get["rows"]).cast("long").alias("n_rows"))


def q_row_id(spark, sf):
    """A stable id of the keys: as many ids as keys, and the same on a second pass."""
    once = cleanse.add_row_id(trips(spark, sf).select(*KEYS), KEYS)
    again = cleanse.add_row_id(trips(spark, sf).select(*KEYS), KEYS)
    return once.join(again, [*KEYS, "id"], "left_semi").groupBy("l_linenumber").agg(F.countDistinct("id").alias("n_ids"))


def q_compute_columns(spark, sf):
    t = cleanse.compute_columns(
        trips(spark, sf),
        {"tip_share": F.round(F.try_divide("tip_amount", "total_amount"), 4), "is_long": F.col("trip_distance") > 25},
    )
    return _keys_and(t, "tip_share", "is_long")


def q_busiest_areas(spark, sf):
    """Sort descending and limit: the ten busiest area pairs."""
    areas = A.busy_area(trips(spark, sf)).withColumnRenamed("count", "n_trips")
    return areas.orderBy(F.desc("n_trips"), "PULocationID", "DOLocationID").limit(10)


def q_parse_format(spark, sf):
    """Timestamps bound to one format: null on any other text."""
    raw = raw_trips(spark, sf)
    return _keys_and(
        raw.select(*KEYS, parse_timestamp("lpep_pickup_datetime", "yyyy-MM-dd'T'HH:mm:ss").alias("pickup_iso"),
                   parse_timestamp("request_datetime", "yyyy-MM-dd HH:mm:ss").alias("request_plain")),
        "pickup_iso", "request_plain",
    )


def q_encode_wide(spark, sf):
    """Ordinal encoding of a column with about as many labels as parts."""
    t = trips(spark, sf).withColumn("label", F.expr(_LABELS["wide"]))
    return _keys_and(encode_ordinal(t, ("label",)), "label", "label_index")


# -- further features and data quality --

#: Professional jobs, extreme words and the experienced driver's trips of the queries (the fixture names its jobs and weather by number).
_JOBS, _EXTREME, _EXPERIENCED = ("job 3", "job 7", "job 11"), ("weather 4", "weather 5"), 60
#: Overlapping boxes over the fixture's coordinates, 5 by 5.
_BOXES = {
    "lat_min": "38 + (n_nationkey % 5) * cast(1.875 as double)",
    "lon_min": "-80.5 + floor(n_nationkey / 5) * cast(1.875 as double)",
}
_CELL = 0.5


def q_pickup_calendar(spark, sf):
    t = _renamed_trips(spark, sf).transform(insights.pickup_weekday).transform(insights.season)
    return _keys_and(t, "pickup_datetime", "pickup_weekday", "pickup_weekday_name", "season")


def q_net_fare(spark, sf):
    return _keys_and(insights.net_fare(trips(spark, sf)), "fare_amount", "net_fare")


def q_airport_trips(spark, sf):
    """Places are unknown (null) where the raw id is not a number."""
    t = cleanse.cast_columns(raw_trips(spark, sf), CAST_SPEC).transform(insights.is_airport_trip)
    return _keys_and(t, "PULocationID", "DOLocationID", "is_airport_trip")


def q_weather_flags(spark, sf):
    t = insights.weather_flags(trips(spark, sf), extreme=_EXTREME)
    return _keys_and(t, "humidity", "is_high_humidity", "is_extreme_weather", "feels_like_difference")


def q_passenger_category(spark, sf):
    t = insights.passenger_category(trips(spark, sf), professional=_JOBS)
    return _keys_and(t, "passenger_age", "passenger_Job", "passenger_category")


def q_experienced_driver(spark, sf):
    t = insights.experienced_driver(A.driver_experience_level(trips(spark, sf)), _EXPERIENCED)
    return _keys_and(t, "driver_email", "driver_experience_level", "experienced_driver")


def q_zone_names(spark, sf):
    """Nations as zones of their regions: half of the location ids have one, one id has two."""
    nation, region = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("nation", "region"))
    zones = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.when(F.col("n_nationkey") == 24, 7).otherwise(F.col("n_nationkey")).cast("int").alias("LocationID"),
        F.col("r_name").alias("Borough"), F.col("n_name").alias("Zone"),
    )
    t = insights.attach_zones(trips(spark, sf), zones)
    return _keys_and(t, "PULocationID", "DOLocationID", "pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone")


def q_neighborhoods(spark, sf):
    """Boxes named after nations, some over each other."""
    low = spark.read.parquet(f"{sf}/nation.parquet").select(F.col("n_name").alias("name"), *[F.expr(e).alias(c) for c, e in _BOXES.items()])
    areas = low.select("name", "lat_min", (F.col("lat_min") + 2).alias("lat_max"), "lon_min", (F.col("lon_min") + 2).alias("lon_max"))
    t = insights.attach_neighborhoods(trips(spark, sf), areas, cell=_CELL)
    return _keys_and(t, "pickup_neighborhood", "dropoff_neighborhood")


def q_repeated_trips(spark, sf):
    """One trip a line item's key, which is not unique."""
    t = _keys_and(trips(spark, sf), "trip_distance", "total_amount", "passenger_email")
    return quality.drop_repeated(t, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


_MEASURED = ["trip_distance", "fare_amount", "tip_amount", "humidity", "passenger_age"]


def q_outlier_bounds(spark, sf):
    return quality.outlier_bounds(trips(spark, sf), _MEASURED, fence=0.5)


def q_outlier_trips(spark, sf):
    t = quality.flag_outliers(trips(spark, sf), _MEASURED, fence=0.5)
    return _keys_and(t, *[f"{c}_outlier" for c in _MEASURED])


def q_plain_trips(spark, sf):
    """Trips without an outlier."""
    return _keys_and(quality.drop_outliers(trips(spark, sf), _MEASURED, fence=0.5), *_MEASURED)


def _silver_in(spark, base: str, raw: DataFrame, folder: str, at: _dt.datetime = BATCH_TIME):
    return run_silver(spark, folder, f"{base}/silver", batch_time=at, schema=_file_schema(raw))


def q_silver_rerun(spark, sf):
    """A drop ingested twice, and once more with a new file: no row twice."""
    base, raw = _base(spark), raw_trips(spark, sf)
    _land_trips(spark, sf, f"{base}/drop", "batch_no < 3")
    first = _silver_in(spark, base, raw, f"{base}/drop")
    again = _silver_in(spark, base, raw, f"{base}/drop")
    assert not first.empty and again.empty
    _land_trips(spark, sf, f"{base}/drop", "batch_no >= 3")
    _silver_in(spark, base, raw, f"{base}/drop")
    return _keys_and(ledger.read_committed(spark, f"{base}/silver"), "batch_no", "driver_email")


def _two_batches(spark, sf, silver_name: str, gold_name: str) -> DataFrame:
    """Gold runs after a first batch, after one stamped earlier, and once more."""
    base, raw = _base(spark), raw_trips(spark, sf)
    silver_name, gold_name = silver_name.format(base=base), gold_name.format(base=base)
    schema = _file_schema(raw)
    for drop, part, late in (("one", "batch_no < 3", 0), ("two", "batch_no >= 3", 5)):
        _land_trips(spark, sf, f"{base}/{drop}", part)
        run_silver(spark, f"{base}/{drop}", silver_name, batch_time=BATCH_TIME - _dt.timedelta(hours=late), schema=schema)
        remove(spark, f"{base}/{drop}")  # committed: nothing lists this drop again
        run_gold(spark, silver_name, gold_name)
    assert run_gold(spark, silver_name, gold_name).empty
    return _keys_and(ledger.read_committed(spark, gold_name), "batch_no", "driver_email", "driver_experience_level", "ingest_hour")


def q_gold_late_batch(spark, sf):
    return _two_batches(spark, sf, "{base}/silver", "{base}/gold")


def q_gold_catalog_table(spark, sf):
    """The same with catalog tables as the targets."""
    tag = uuid.uuid4().hex
    return _two_batches(spark, sf, f"tk_silver_{tag}", f"tk_gold_{tag}")


def _stream(spark, raw: DataFrame, base: str, folder: str, checkpoint: str, **options) -> None:
    silver_stream(
        spark, f"{base}/{folder}", f"{base}/silver", f"{base}/{checkpoint}",
        schema=_file_schema(raw), batch_time=BATCH_TIME, **options,
    )


def q_stream_ingest(spark, sf):
    """Raw trips land as CSV files; an available-now stream ingests them."""
    base, raw = _base(spark), raw_trips(spark, sf)
    _land_trips(spark, sf, f"{base}/landing")
    _stream(spark, raw, base, "landing", "checkpoint")
    return _by_number(ledger.read_committed(spark, f"{base}/silver"))


def q_stream_gold(spark, sf):
    """The silver stream's table feeds an available-now gold stream."""
    base, raw = _base(spark), raw_trips(spark, sf)
    _land_trips(spark, sf, f"{base}/landing")
    _stream(spark, raw, base, "landing", "checkpoint")
    remove(spark, f"{base}/landing")  # committed: no stream reads this folder again
    gold_stream(spark, f"{base}/silver", f"{base}/gold", f"{base}/checkpoint-gold")
    return _by_number(ledger.read_committed(spark, f"{base}/gold"))


def q_stream_two_batches(spark, sf):
    """Two landing folders with checkpoints of their own write to one silver
    table, consumed files are archived, and gold follows twice: every trip
    arrives once, counted within its increment."""
    base, raw = _base(spark), raw_trips(spark, sf)
    for folder, part in (("one", "batch_no < 3"), ("two", "batch_no >= 3")):
        _land_trips(spark, sf, f"{base}/{folder}", part)
        _stream(spark, raw, base, folder, f"checkpoint-{folder}", archive_dir=f"{base}/archive")
        gold_stream(spark, f"{base}/silver", f"{base}/gold", f"{base}/checkpoint-gold")
    return _keys_and(_by_number(ledger.read_committed(spark, f"{base}/gold")), "batch_no", "driver_email", "driver_experience_level", "batch_id")


def q_silver_clean(spark, sf):
    return silver(kept_raw_trips(spark, sf), SilverConfig(), batch_time=BATCH_TIME)


def q_silver_script_preset(spark, sf):
    return silver(kept_raw_trips(spark, sf), SilverConfig.script_variant(), batch_time=BATCH_TIME)


def q_gold_features(spark, sf):
    # gold reads its silver rows several times (a run reads the written table)
    rows = q_silver_clean(spark, sf)
    if len(slices(spark, sf)) == 1:
        return gold(rows.persist())
    with staged(rows, "silver") as kept:  # large tables: in files, and gold as a run writes it
        return stage_all(gold_slices(kept), "gold")


QUERIES: dict[str, Query] = {
    "trips_fixture": q_trips_fixture,
    "cast_types": q_cast_types,
    "impute_mean": q_impute_mean,
    "impute_mode": q_impute_mode,
    "drop_incomplete": q_drop_incomplete,
    "split_name": q_split_name,
    "mask_partial": q_mask_partial,
    "mask_full": q_mask_full,
    "mask_script_variant": q_mask_script_variant,
    "time_parts": q_time_parts,
    "trip_durations": q_trip_durations,
    "fare_ratios": q_fare_ratios,
    "speed_flags": q_speed_flags,
    "busy_area": q_busy_area,
    "passenger_loyalty": q_passenger_loyalty,
    "driver_experience": q_driver_experience,
    "high_water_mark": q_high_water_mark,
    "incremental_load": q_incremental_load,
    "encode_ordinal": q_encode_ordinal,
    "split_name_exploded": q_split_name_exploded,
    "encode_wide": q_encode_wide,
    "csv_source": q_csv_source,
    "csv_sinks": q_csv_sinks,
    "parquet_sinks": q_parquet_sinks,
    "parquet_sink_tables": q_parquet_sink_tables,
    "observed_rows": q_observed_rows,
    "row_id": q_row_id,
    "compute_columns": q_compute_columns,
    "busiest_areas": q_busiest_areas,
    "parse_format": q_parse_format,
    "pickup_calendar": q_pickup_calendar,
    "net_fare": q_net_fare,
    "airport_trips": q_airport_trips,
    "weather_flags": q_weather_flags,
    "passenger_category": q_passenger_category,
    "experienced_driver": q_experienced_driver,
    "zone_names": q_zone_names,
    "neighborhoods": q_neighborhoods,
    "repeated_trips": q_repeated_trips,
    "outlier_bounds": q_outlier_bounds,
    "outlier_trips": q_outlier_trips,
    "plain_trips": q_plain_trips,
    "silver_rerun": q_silver_rerun,
    "gold_late_batch": q_gold_late_batch,
    "gold_catalog_table": q_gold_catalog_table,
    "stream_two_batches": q_stream_two_batches,
    "stream_ingest": q_stream_ingest,
    "stream_gold": q_stream_gold,
    "silver_clean": q_silver_clean,
    "silver_script_preset": q_silver_script_preset,
    "gold_features": q_gold_features,
}


# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------

def _r(x: str, digits: int) -> str:
    """HALF_UP rounding of a double's shortest decimal text (as Spark does)."""
    return f"cast(round(cast(cast({x} as varchar) as decimal(38,15)), {digits}) as double)"


def _with(*ctes: tuple[str, str]) -> str:
    return "with " + ",\n".join(f"{name} as ({body})" for name, body in ctes) + "\n"


_TRIPS = ("trips", TRIPS_SQL)
_K = ", ".join(KEYS)
_TRIP_COLS = (
    "VendorID, lpep_pickup_datetime, lpep_dropoff_datetime, request_datetime, passenger_count, "
    "trip_distance, fare_amount, tip_amount, total_amount, PULocationID, DOLocationID, "
    "passenger_email, driver_email, passenger_phone_number, passenger_fullname, "
    "passenger_credit_card, store_and_fwd_flag, batch_no, " + ", ".join(MORE)
)
_INT_COLS = ("VendorID", "passenger_count", "PULocationID", "DOLocationID", *MORE_INTS)
_DOUBLE_COLS = ("trip_distance", "fare_amount", "tip_amount", "total_amount", *MORE_DOUBLES)
_TEXT_COLS = (
    *MORE_TEXTS,
    "passenger_email", "driver_email", "passenger_phone_number",
    "passenger_fullname", "passenger_credit_card", "store_and_fwd_flag",
)


def _mode(col: str, source: str) -> str:
    return (
        f"(select v from (select {col} as v, count(*) as n from {source} "
        f"where {col} is not null group by 1) order by n desc, v limit 1)"
    )


def _mean_filled(source: str) -> str:
    cols = []
    for c in _TRIP_COLS.split(", "):
        if c in _INT_COLS:
            cols.append(f"coalesce({c}, cast(trunc((select avg({c}) from {source})) as integer)) as {c}")
        elif c in _DOUBLE_COLS:
            cols.append(f"coalesce({c}, (select avg({c}) from {source})) as {c}")
        else:
            cols.append(c)
    return f"select {_K}, {', '.join(cols)} from {source}"


def _mode_filled(source: str) -> str:
    cols = [
        f"coalesce({c}, {_mode(c, source)}) as {c}" if c in _TEXT_COLS else c
        for c in _TRIP_COLS.split(", ")
    ]
    return f"select {_K}, {', '.join(cols)} from {source}"


_MORE_TYPED = ", ".join(
    [f"try_cast(trunc(try_cast({c} as double)) as integer) as {c}" for c in MORE_INTS]
    + [f"{_r(f'try_cast({c} as double)', digits)} as {c}" for c, (_, digits) in MORE_DOUBLES.items()]
    + list(MORE_TEXTS)
)
_TYPED_FROM_RAW = f"""
select {_K},
  try_cast(trunc(try_cast(VendorID as double)) as integer) as VendorID,
  try_cast(lpep_pickup_datetime as timestamp) as lpep_pickup_datetime,
  try_cast(lpep_dropoff_datetime as timestamp) as lpep_dropoff_datetime,
  try_cast(request_datetime as timestamp) as request_datetime,
  try_cast(trunc(try_cast(passenger_count as double)) as integer) as passenger_count,
  {_r("try_cast(trip_distance as double)", 2)} as trip_distance,
  {_r("try_cast(fare_amount as double)", 2)} as fare_amount,
  {_r("try_cast(tip_amount as double)", 2)} as tip_amount,
  {_r("try_cast(total_amount as double)", 1)} as total_amount,
  try_cast(trunc(try_cast(PULocationID as double)) as integer) as PULocationID,
  try_cast(trunc(try_cast(DOLocationID as double)) as integer) as DOLocationID,
  passenger_email, driver_email, passenger_phone_number, passenger_fullname,
  passenger_credit_card, store_and_fwd_flag, batch_no, {_MORE_TYPED}
from raw
"""

_MORE_SILVER = """
  left(driver_phone_number, 4) || '***' || right(driver_phone_number, 4) as driver_phone_number,
  '*****' as driver_credit_card,
  string_split(driver_fullname, ' ')[1] as driver_first_name,
  string_split(driver_fullname, ' ')[2] as driver_last_name,
  """ + ", ".join(c for c in MORE if not c.startswith("driver_"))
_SILVER_FROM_FILLED = f"""
select {_K}, VendorID,
  lpep_pickup_datetime as pickup_datetime,
  lpep_dropoff_datetime as dropoff_datetime,
  request_datetime, passenger_count, trip_distance, fare_amount, tip_amount, total_amount,
  PULocationID, DOLocationID, passenger_email, driver_email,
  left(passenger_phone_number, 4) || '***' || right(passenger_phone_number, 4) as passenger_phone_number,
  '*****' as passenger_credit_card,
  store_and_fwd_flag, batch_no, {_MORE_SILVER},
  string_split(passenger_fullname, ' ')[1] as passenger_first_name,
  string_split(passenger_fullname, ' ')[2] as passenger_last_name,
  cast({BATCH_EPOCH} as bigint) as ingest_timestamp,
  timestamp '{BATCH_TIME:%Y-%m-%d %H:%M:%S}' as ingest_datetime
from filled
where fare_amount is not null
"""

_SCRIPT_SILVER_FROM_FILLED = (
    _SILVER_FROM_FILLED.replace("left(passenger_phone_number, 4)", "left(passenger_phone_number, 3)")
    .replace("right(passenger_phone_number, 4)", "right(passenger_phone_number, 3)")
    .replace("'*****' as passenger_credit_card",
             "case when passenger_credit_card is not null then '*****' end as passenger_credit_card")
    .replace("as passenger_first_name", "as first_name")
    .replace("as passenger_last_name", "as last_name")
    .replace("left(driver_phone_number, 4)", "left(driver_phone_number, 3)")
    .replace("right(driver_phone_number, 4)", "right(driver_phone_number, 3)")
    .replace("'*****' as driver_credit_card", "case when driver_credit_card is not null then '*****' end as driver_credit_card")
    .replace("string_split(driver_fullname, ' ')[1] as driver_first_name,", "driver_fullname,")
    .replace("string_split(driver_fullname, ' ')[2] as driver_last_name,", "")
)

_SILVER_CTES = (
    _TRIPS,
    ("raw", RAW_TRIPS_SQL),
    ("typed", _TYPED_FROM_RAW),
    ("mean_filled", _mean_filled("typed")),
    ("filled", _mode_filled("mean_filled")),
    ("silver", _SILVER_FROM_FILLED),
)


def _secs(ts: str) -> str:
    return f"floor(epoch({ts}))"


_DURATION = f"({_secs('dropoff_datetime')} - {_secs('pickup_datetime')}) / 60"
_GOLD_ROW = f"""
select *,
  strftime(pickup_datetime, '%H') as pickup_hour,
  '0' || cast((day(pickup_datetime) - 1) % 7 as varchar) as pickup_day_of_week,
  {_DURATION} as trip_duration_minute,
  ({_secs('pickup_datetime')} - {_secs('request_datetime')}) / 60 as request_to_pickup_delay_min,
  {_r("trip_distance * cast(1.60934 as double)", 2)} as trip_distance_km,
  {_r("tip_amount / nullif(total_amount, 0) * 100", 1)} as total_tip_percentage,
  {_r("fare_amount / nullif(trip_distance, 0)", 2)} as fare_per_distance,
  {_r(f"total_amount / nullif({_DURATION}, 0)", 2)} as revenue_per_minute,
  strftime(pickup_datetime, '%m') as month,
  (cast(strftime(pickup_datetime, '%m') as int) between 4 and 9)
    and (cast(strftime(pickup_datetime, '%H') as int) between 6 and 20) as is_daylight,
  (cast(strftime(pickup_datetime, '%H') as int) between 7 and 9)
    or (cast(strftime(pickup_datetime, '%H') as int) between 16 and 18) as is_rush_hour,
  {_r(f"trip_distance / nullif({_DURATION} / 60, 0)", 0)} as average_speed,
  cast(PULocationID as varchar) || '-' || cast(DOLocationID as varchar) as route,
  case when passenger_email is not null then count(*) over (partition by passenger_email) end
    as passenger_loyalty,
  case when driver_email is not null then count(*) over (partition by driver_email) end
    as driver_experience_level
from silver
"""

_RENAMED = (
    "renamed",
    "select * rename (lpep_pickup_datetime as pickup_datetime, "
    "lpep_dropoff_datetime as dropoff_datetime) from trips",
)
_DUR_R = f"({_secs('dropoff_datetime')} - {_secs('pickup_datetime')}) / 60"

# ranks by running counts: the least value that a quarter of the values do not exceed
_BOUNDS = (
    (
        "pairs",
        " union all ".join(f"select '{c}' as name, cast({c} as double) as v from trips where {c} is not null" for c in _MEASURED),
    ),
    ("ranked", "select name, v, row_number() over (partition by name order by v) as k, count(*) over (partition by name) as n from pairs"),
    (
        "quartiles",
        """select name, n, min(v) filter (where 4 * k >= n) as q1, min(v) filter (where 4 * k >= 3 * n) as q3
           from ranked group by 1, 2""",
    ),
    ("bounds", "select name, n, q1, q3, q1 - (q3 - q1) * 0.5::double as low, q3 + (q3 - q1) * 0.5::double as high from quartiles"),
)


def _bound(c: str, side: str) -> str:
    return f"(select {side} from bounds where name = '{c}')"


_OUTLIER = {c: f"({c} < {_bound(c, 'low')} or {c} > {_bound(c, 'high')})" for c in _MEASURED}
_ZONES = (
    "zones",
    """select case when n_nationkey = 24 then 7 else n_nationkey end as id, min({'b': r_name, 'z': n_name}) as names
       from nation join region on n_regionkey = r_regionkey group by 1""",
)
_AREAS = (
    "areas",
    f"""select name, lat_min, lat_min + 2 as lat_max, lon_min, lon_min + 2 as lon_max from (
        select n_name as name, {", ".join(f"{e} as {c}" for c, e in _BOXES.items())} from nation)""",
)


def _area(lat: str, lon: str) -> str:
    return f"(select min(name) from areas where {lat} >= lat_min and {lat} < lat_max and {lon} >= lon_min and {lon} < lon_max)"


_TWO_INCREMENTS = f"""select {_K}, batch_no, driver_email,
  count(*) over (partition by driver_email, batch_no < 3) as driver_experience_level{{extra}} from trips"""

ORACLES: dict[str, str] = {
    "trips_fixture": TRIPS_SQL,
    "cast_types": _with(_TRIPS, ("raw", RAW_TRIPS_SQL)) + _TYPED_FROM_RAW,
    "impute_mean": _with(_TRIPS) + _mean_filled("trips"),
    "impute_mode": _with(_TRIPS) + _mode_filled("trips"),
    "drop_incomplete": _with(_TRIPS) + f"select {_K}, {_TRIP_COLS} from trips where fare_amount is not null",
    "split_name": _with(_TRIPS)
    + f"""select {_K}, passenger_fullname,
      string_split(passenger_fullname, ' ')[1] as passenger_first_name,
      string_split(passenger_fullname, ' ')[2] as passenger_last_name from trips""",
    "split_name_exploded": _with(_TRIPS)
    + f"""select {_K}, passenger_fullname,
      string_split(passenger_fullname, ' ')[1] as passenger_first_name,
      string_split(passenger_fullname, ' ')[2] as passenger_last_name from trips""",
    "mask_partial": _with(_TRIPS)
    + f"""select {_K},
      left(passenger_phone_number, 4) || '***' || right(passenger_phone_number, 4) as passenger_phone_number,
      left(passenger_credit_card, 4) || '***' || right(passenger_credit_card, 4) as passenger_credit_card
      from trips""",
    "mask_full": _with(_TRIPS)
    + f"select {_K}, '*****' as passenger_credit_card, '*****' as passenger_phone_number from trips",
    "mask_script_variant": _with(_TRIPS)
    + f"""select {_K},
      left(passenger_phone_number, 3) || '***' || right(passenger_phone_number, 3) as passenger_phone_number,
      case when store_and_fwd_flag is not null then '*****' end as store_and_fwd_flag from trips""",
    "time_parts": _with(_TRIPS)
    + f"""select {_K}, lpep_pickup_datetime as pickup_datetime,
      strftime(lpep_pickup_datetime, '%H') as pickup_hour,
      '0' || cast((day(lpep_pickup_datetime) - 1) % 7 as varchar) as pickup_day_of_week,
      strftime(lpep_pickup_datetime, '%m') as month from trips""",
    "trip_durations": _with(_TRIPS, _RENAMED)
    + f"""select {_K}, {_DUR_R} as trip_duration_minute,
      ({_secs('pickup_datetime')} - {_secs('request_datetime')}) / 60 as request_to_pickup_delay_min
      from renamed""",
    "fare_ratios": _with(_TRIPS, _RENAMED)
    + f"""select {_K},
      {_r("trip_distance * cast(1.60934 as double)", 2)} as trip_distance_km,
      {_r("tip_amount / nullif(total_amount, 0) * 100", 1)} as total_tip_percentage,
      {_r("fare_amount / nullif(trip_distance, 0)", 2)} as fare_per_distance,
      {_r(f"total_amount / nullif({_DUR_R}, 0)", 2)} as revenue_per_minute
      from renamed""",
    "speed_flags": _with(_TRIPS, _RENAMED)
    + f"""select {_K},
      {_r(f"trip_distance / nullif({_DUR_R} / 60, 0)", 0)} as average_speed,
      (cast(strftime(pickup_datetime, '%m') as int) between 4 and 9)
        and (cast(strftime(pickup_datetime, '%H') as int) between 6 and 20) as is_daylight,
      (cast(strftime(pickup_datetime, '%H') as int) between 7 and 9)
        or (cast(strftime(pickup_datetime, '%H') as int) between 16 and 18) as is_rush_hour,
      cast(PULocationID as varchar) || '-' || cast(DOLocationID as varchar) as route
      from renamed""",
    "busy_area": _with(_TRIPS)
    + 'select PULocationID, DOLocationID, count(*) as "count" from trips group by 1, 2',
    "passenger_loyalty": _with(_TRIPS)
    + f"""select {_K}, passenger_email,
      case when passenger_email is not null then count(*) over (partition by passenger_email) end
      as passenger_loyalty from trips""",
    "driver_experience": _with(_TRIPS)
    + f"""select {_K}, driver_email,
      case when driver_email is not null then count(*) over (partition by driver_email) end
      as driver_experience_level from trips""",
    "high_water_mark": _with(_TRIPS)
    + f"""select max(lpep_pickup_datetime) as high_water_mark from trips
      where lpep_pickup_datetime < timestamp '{LOADED_BEFORE}'""",
    "incremental_load": _with(_TRIPS)
    + f"""select {_K}, {_TRIP_COLS} from trips
      where lpep_pickup_datetime > (select max(lpep_pickup_datetime) from trips
                                    where lpep_pickup_datetime < timestamp '{LOADED_BEFORE}')""",
    "encode_ordinal": _with(
        _TRIPS,
        (
            "labels",
            """select store_and_fwd_flag as v,
               row_number() over (order by count(*) desc, store_and_fwd_flag) - 1 as idx
               from trips where store_and_fwd_flag is not null group by 1""",
        ),
    )
    + f"""select {_K}, store_and_fwd_flag,
      cast(coalesce(idx, (select count(*) from labels)) as double) as store_and_fwd_flag_index
      from trips left join labels on store_and_fwd_flag = v""",
    "encode_wide": _with(
        ("trips", f"select *, {_LABELS['wide']} as label from ({TRIPS_SQL})"),
        ("labels", "select label, row_number() over (order by count(*) desc, label) - 1 as idx from trips group by 1"),
    )
    + f"select {_K}, label, cast(idx as double) as label_index from trips left join labels using (label)",
    "csv_source": _with(_TRIPS, ("raw", RAW_TRIPS_SQL))
    + "select * replace (nullif(DOLocationID, '') as DOLocationID) from raw",
    "csv_sinks": _with(_TRIPS) + f"select {_K}, trip_distance, passenger_email, batch_no from trips",
    "parquet_sinks": _with(_TRIPS) + f"select {_K}, trip_distance, passenger_email, batch_no from trips where batch_no <> 4",
    "parquet_sink_tables": _with(_TRIPS)
    + f"""select {_K}, trip_distance, passenger_email, batch_no, written
      from trips, (values ('partitioned'), ('fanout')) as tables(written)""",
    "observed_rows": _with(_TRIPS) + "select count(*) as n_rows from trips",
    "row_id": _with(_TRIPS)
    + f"select l_linenumber, count(distinct ({_K})) as n_ids from trips group by 1",
    "compute_columns": _with(_TRIPS)
    + f"""select {_K}, {_r("tip_amount / nullif(total_amount, 0)", 4)} as tip_share,
      trip_distance > 25 as is_long from trips""",
    "busiest_areas": _with(_TRIPS)
    + """select PULocationID, DOLocationID, count(*) as n_trips from trips group by 1, 2
      order by n_trips desc, PULocationID, DOLocationID limit 10""",
    "parse_format": _with(_TRIPS, ("raw", RAW_TRIPS_SQL))
    + f"""select {_K},
      case when regexp_full_match(lpep_pickup_datetime, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T[0-9:]{{8}}')
           then try_cast(lpep_pickup_datetime as timestamp) end as pickup_iso,
      case when regexp_full_match(request_datetime, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} [0-9:]{{8}}')
           then try_cast(request_datetime as timestamp) end as request_plain from raw""",
    "pickup_calendar": _with(_TRIPS, _RENAMED)
    + f"""select {_K}, pickup_datetime, cast(isodow(pickup_datetime) as integer) as pickup_weekday,
      strftime(pickup_datetime, '%a') as pickup_weekday_name,
      case when month(pickup_datetime) in (12, 1, 2) then 'Winter' when month(pickup_datetime) <= 5 then 'Spring'
           when month(pickup_datetime) <= 8 then 'Summer' else 'Autumn' end as season from renamed""",
    "net_fare": _with(_TRIPS)
    + f"""select {_K}, fare_amount, {_r("fare_amount - coalesce(tolls_amount, 0) - coalesce(improvement_surcharge, 0) - coalesce(congestion_surcharge, 0)", 2)}
      as net_fare from trips""",
    "airport_trips": _with(_TRIPS, ("raw", RAW_TRIPS_SQL), ("typed", _TYPED_FROM_RAW))
    + f"""select {_K}, PULocationID, DOLocationID,
      PULocationID in (1, 132, 138) or DOLocationID in (1, 132, 138) as is_airport_trip from typed""",
    "weather_flags": _with(_TRIPS)
    + f"""select {_K}, humidity, humidity > 80 as is_high_humidity,
      weather_description in ('weather 4', 'weather 5') as is_extreme_weather,
      {_r("feels_like - temperature", 1)} as feels_like_difference from trips""",
    "passenger_category": _with(_TRIPS)
    + f"""select {_K}, passenger_age, passenger_Job,
      case when passenger_age is null then null when passenger_age < 18 then 'Minor' when passenger_age < 30 then 'Young'
           when passenger_age < 60 then 'Adult' else 'Senior' end
      || case when passenger_age between 18 and 59 and passenger_Job in ('job 3', 'job 7', 'job 11') then ' Professional' else '' end
      as passenger_category from trips""",
    "experienced_driver": _with(_TRIPS)
    + f"""select {_K}, driver_email, n as driver_experience_level, n >= {_EXPERIENCED} as experienced_driver
      from (select *, count(*) over (partition by driver_email) as n from trips)""",
    "zone_names": _with(_TRIPS, _ZONES)
    + f"""select {_K}, PULocationID, DOLocationID, a.names.b as pickup_borough, a.names.z as pickup_zone,
      o.names.b as dropoff_borough, o.names.z as dropoff_zone
      from trips left join zones a on PULocationID = a.id left join zones o on DOLocationID = o.id""",
    "neighborhoods": _with(_TRIPS, _AREAS)
    + f"""select {_K}, {_area('pickup_latitude', 'pickup_longitude')} as pickup_neighborhood,
      {_area('dropoff_latitude', 'dropoff_longitude')} as dropoff_neighborhood from trips""",
    "repeated_trips": _with(_TRIPS)
    + f"""select {_K}, trip_distance, total_amount, passenger_email from trips
      qualify row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, trip_distance,
        total_amount, passenger_email nulls first) = 1""",
    "outlier_bounds": _with(_TRIPS, *_BOUNDS) + "select * from bounds",
    "outlier_trips": _with(_TRIPS, *_BOUNDS) + f"select {_K}, {', '.join(f'{f} as {c}_outlier' for c, f in _OUTLIER.items())} from trips",
    "plain_trips": _with(_TRIPS, *_BOUNDS)
    + f"select {_K}, {', '.join(_MEASURED)} from trips where {' and '.join(f'not coalesce({f}, false)' for f in _OUTLIER.values())}",
    "silver_rerun": _with(_TRIPS) + f"select {_K}, batch_no, driver_email from trips",
    "gold_late_batch": _with(_TRIPS) + _TWO_INCREMENTS.format(extra=", case when batch_no < 3 then 0 else 19 end as ingest_hour"),
    "gold_catalog_table": _with(_TRIPS) + _TWO_INCREMENTS.format(extra=", case when batch_no < 3 then 0 else 19 end as ingest_hour"),
    "stream_two_batches": _with(_TRIPS) + _TWO_INCREMENTS.format(extra=", 0 as batch_id"),
    "silver_clean": _with(*_SILVER_CTES) + "select * from silver",
    "stream_ingest": _with(*_SILVER_CTES) + "select *, 0 as batch_id from silver",
    "stream_gold": _with(*_SILVER_CTES, ("gold", _GOLD_ROW)) + "select *, 0 as batch_id from gold",
    "silver_script_preset": _with(*_SILVER_CTES[:-1], ("silver", _SCRIPT_SILVER_FROM_FILLED))
    + "select * from silver",
    "gold_features": _with(*_SILVER_CTES) + _GOLD_ROW,
}
