"""Trip records derived from the TPC-H-style test tables.

The test tables hold no trips, so the registered queries run over a
deterministic projection of ``lineitem ⋈ orders ⋈ part``: every trip column
is a fixed function of the joined row, including nulls, zero distances,
zero durations and single-token names. The projection grows with the
tables (one trip per line item).

Both joins are equi-joins on the tables' keys. ``lineitem ⋈ orders`` is
pinned to a shuffle join (both grow with the scale factor); ``part`` is left
to the planner, which broadcasts it only while its size is under the
broadcast threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkiln.session import compiled_stages, slices_of
from tripkiln.sources.staging import stage_all

def _double(expr: str, by: int) -> str:
    return f"({expr}) / cast({by} as double)"


def _some(expr: str, null_when: str) -> str:
    return f"case when {null_when} then null else {expr} end"


#: The other columns of a trip, as SQL that Spark and DuckDB read alike: whole
#: numbers, numbers with more digits than the cast keeps, text, and nulls.
MORE_INTS: dict[str, str] = {
    "RatecodeID": _some("cast(l_linenumber % 6 as int)", "l_orderkey % 9 = 0"),
    "payment_type": "cast(l_suppkey % 5 as int)",
    "passenger_age": _some("cast(18 + o_custkey % 60 as int)", "o_custkey % 8 = 0"),
    "pickup_AQI": "cast(l_partkey % 300 as int)",
    "dropoff_AQI": _some("cast(l_suppkey % 300 as int)", "l_linenumber = 2"),
    "uv_index": "cast(l_orderkey % 12 as int)",
}
MORE_DOUBLES: dict[str, tuple[str, int]] = {  # with the digits that the cast keeps
    "extra": (_double("l_partkey % 70", 8), 1),
    "mta_tax": (_double("l_suppkey % 100", 64), 2),
    "tolls_amount": (_some(_double("l_orderkey % 5000", 128), "l_partkey % 6 = 0"), 2),
    "improvement_surcharge": (_double("l_linenumber", 4), 1),
    "congestion_surcharge": (_some(_double("l_orderkey % 33", 16), "l_orderkey % 10 = 0"), 1),
    "airport_fee": (_double("l_partkey % 900", 512), 2),
    "pickup_latitude": (_double("40000000 + (l_orderkey * 7919 + l_partkey) % 9999999", 1 << 20), 6),
    "pickup_longitude": (_double("-74000000 - (l_orderkey * 104729) % 9999999", 1 << 20), 6),
    "dropoff_latitude": (_some(_double("40000000 + (l_partkey * 7919) % 9999999", 1 << 20), "l_orderkey % 14 = 0"), 6),
    "dropoff_longitude": (_double("-74000000 - (l_suppkey * 104729 + l_linenumber) % 9999999", 1 << 20), 6),
    "temperature": (_double("l_orderkey % 700 - 200", 16), 1),
    "humidity": (_some(_double("l_partkey % 1600", 16), "l_suppkey % 21 = 0"), 1),
    "pickup_precipitation_chance": (_double("l_suppkey % 800", 8), 1),
    "feels_like": (_double("l_orderkey % 71 - 20", 2), 0),
    "wind_speed_km": (_some(_double("l_partkey % 121", 2), "l_linenumber = 5"), 0),
}
MORE_TEXTS: dict[str, str] = {
    "driver_phone_number": _some("concat('+4930', lpad(cast(l_suppkey as string), 6, '0'))", "l_suppkey % 16 = 0"),
    "driver_fullname": "concat('Dana ', cast(l_suppkey as string))",
    "driver_credit_card": _some("concat('5', lpad(cast(l_suppkey as string), 15, '0'))", "l_linenumber = 4"),
    "passenger_address": _some("concat(cast(o_custkey as string), ' Main St')", "o_custkey % 12 = 0"),
    "passenger_Job": "concat('job ', cast(o_custkey % 30 as string))",
    "passenger_sex": _some("substr('FMX', cast(1 + o_custkey % 3 as int), 1)", "o_custkey % 18 = 0"),
    "weather_description": _some("concat('weather ', cast(l_orderkey % 6 as string))", "l_orderkey % 25 = 0"),
}
MORE: dict[str, str] = {**MORE_INTS, **{c: e for c, (e, _) in MORE_DOUBLES.items()}, **MORE_TEXTS}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _seconds_after(base: str, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds.cast("int"), F.col(base))


def _of_slice(df: DataFrame, key: str, part: tuple[int, int] | None) -> DataFrame:
    return df.where(F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(part[1])) == part[0]) if part else df


def _joined(spark: SparkSession, sf_dir: str, part: tuple[int, int] | None = None) -> DataFrame:
    """The joined rows; with ``part`` (i, n) those of slice i of n by the order's key."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_quantity", "l_extendedprice", "l_discount", "l_returnflag",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    names = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    li, orders = _of_slice(li, "l_orderkey", part), _of_slice(orders, "o_orderkey", part)
    # lineitem and orders are the two largest tables: pin the shuffle
    # (sort-merge) join that runs at scale, instead of a broadcast chosen from
    # small test files, which would keep all row work in the scan's tasks.
    # It comes last, so that an order's rows stay together: their texts pack well.
    j = li.join(names, li.l_partkey == names.p_partkey).join(
        orders.hint("merge"), li.l_orderkey == orders.o_orderkey
    )
    return j.drop("p_partkey", "o_orderkey")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _projected(_joined(spark, sf_dir))


def kept_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips for a query that reads them several times: large tables are
    joined once, slice by slice, and the joined rows staged."""
    parts = slices(spark, sf_dir)
    if len(parts) == 1:
        return trips(spark, sf_dir)
    return _projected(stage_all((_joined(spark, sf_dir, part) for part in parts), "trips"))


def slices(spark: SparkSession, sf_dir: str) -> list[tuple[int, int]]:
    """``(i, n)`` of every slice in which the trips are joined."""
    n = slices_of(table(spark, sf_dir, "lineitem"))
    return [(i, n) for i in range(n)]


def _projected(j: DataFrame) -> DataFrame:
    compiled_stages(j.sparkSession)
    ok, ln, pk, sk, ck = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_custkey"))
    base = (ok * 37 + ln * 3600 + pk * 60) % 86400
    null = F.lit(None)
    return j.select(
        ok, ln, pk, sk,
        (sk % 3).cast("int").alias("VendorID"),
        _seconds_after("o_orderdate", base).alias("lpep_pickup_datetime"),
        _seconds_after("o_orderdate", base + (pk * 13) % 7200).alias("lpep_dropoff_datetime"),
        _seconds_after("o_orderdate", base - ln * 60 - sk % 300).alias("request_datetime"),
        F.when(pk % 11 == 0, null.cast("int")).otherwise(ln.cast("int")).alias("passenger_count"),
        (F.col("l_quantity") - 1).alias("trip_distance"),
        F.when(ok % 17 == 0, null.cast("double")).otherwise(F.col("l_extendedprice")).alias("fare_amount"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("tip_amount"),
        F.col("l_extendedprice").alias("total_amount"),
        (sk % 50).cast("int").alias("PULocationID"),
        (pk % 50).cast("int").alias("DOLocationID"),
        F.when(ck % 13 == 0, null.cast("string"))
        .otherwise(F.concat(F.lit("c"), ck.cast("string"), F.lit("@example.com")))
        .alias("passenger_email"),
        F.concat(F.lit("d"), sk.cast("string"), F.lit("@example.com")).alias("driver_email"),
        F.when(ln == 3, null.cast("string"))
        .otherwise(F.concat(F.lit("+1555"), F.lpad(ck.cast("string"), 7, "0")))
        .alias("passenger_phone_number"),
        F.when(ok % 19 == 0, F.lit("Cher")).otherwise(F.col("p_name")).alias("passenger_fullname"),
        F.concat(F.lit("4"), F.lpad(ok.cast("string"), 15, "0")).alias("passenger_credit_card"),
        F.when(ok % 7 == 0, null.cast("string")).otherwise(F.col("l_returnflag")).alias("store_and_fwd_flag"),
        (ok % 5).alias("batch_no"),
        *[F.expr(sql).alias(c) for c, sql in MORE.items()],
    )


# DuckDB form of the same projection, for oracle queries.
TRIPS_SQL = f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  cast(l_suppkey % 3 as int) as VendorID,
  o_orderdate + to_seconds((l_orderkey*37+l_linenumber*3600+l_partkey*60) % 86400) as lpep_pickup_datetime,
  o_orderdate + to_seconds((l_orderkey*37+l_linenumber*3600+l_partkey*60) % 86400 + (l_partkey*13) % 7200) as lpep_dropoff_datetime,
  o_orderdate + to_seconds((l_orderkey*37+l_linenumber*3600+l_partkey*60) % 86400 - l_linenumber*60 - l_suppkey % 300) as request_datetime,
  case when l_partkey % 11 = 0 then null else cast(l_linenumber as int) end as passenger_count,
  l_quantity - 1 as trip_distance,
  case when l_orderkey % 17 = 0 then null else l_extendedprice end as fare_amount,
  l_extendedprice * l_discount as tip_amount,
  l_extendedprice as total_amount,
  cast(l_suppkey % 50 as int) as PULocationID,
  cast(l_partkey % 50 as int) as DOLocationID,
  case when o_custkey % 13 = 0 then null
       else 'c' || cast(o_custkey as varchar) || '@example.com' end as passenger_email,
  'd' || cast(l_suppkey as varchar) || '@example.com' as driver_email,
  case when l_linenumber = 3 then null
       else '+1555' || lpad(cast(o_custkey as varchar), 7, '0') end as passenger_phone_number,
  case when l_orderkey % 19 = 0 then 'Cher' else p_name end as passenger_fullname,
  '4' || lpad(cast(l_orderkey as varchar), 15, '0') as passenger_credit_card,
  case when l_orderkey % 7 = 0 then null else l_returnflag end as store_and_fwd_flag,
  l_orderkey % 5 as batch_no,
  {", ".join(f"{sql} as {c}" for c, sql in MORE.items())}
from lineitem
join orders on l_orderkey = o_orderkey
join part on l_partkey = p_partkey
"""

# key columns of a fixture trip (not unique on their own: use all four)
TRIP_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(trips(spark, sf_dir))


def kept_raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`raw_trips` over :func:`kept_trips`."""
    return _as_text(kept_trips(spark, sf_dir))


def raw_slices(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The rows of :func:`raw_trips` in slices, to be written one after another."""
    parts = slices(spark, sf_dir)
    return [_as_text(_projected(_joined(spark, sf_dir, part if len(parts) > 1 else None))) for part in parts]


def _as_text(t: DataFrame) -> DataFrame:
    """The trips as text, the way a raw CSV drop carries them.

    Some values are spoiled on purpose (as real drops are): a number out of
    the integer range, fractional counts, text in a number column, empty
    fields, an impossible date, and pickup times with fractional seconds in
    ISO ``T`` form. Keys and ``batch_no`` stay numeric.
    """
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")

    def text(c: str) -> Column:
        return F.col(c).cast("string")


    # zone-free text of the wall-clock time, in ISO 'T' form
    iso = F.translate(text("lpep_pickup_datetime"), " ", "T")
    return t.withColumns(
        {
            "VendorID": F.when(ok % 23 == 0, F.lit("1e12")).otherwise(text("VendorID")),
            "lpep_pickup_datetime": F.concat(iso, F.when(ln % 2 == 0, F.lit(".5")).otherwise(F.lit(""))),
            "lpep_dropoff_datetime": text("lpep_dropoff_datetime"),
            "request_datetime": F.when(ok % 43 == 0, F.lit("2021-13-01")).otherwise(text("request_datetime")),
            "passenger_count": F.when(ok % 29 == 0, F.concat(text("passenger_count"), F.lit(".7")))
            .otherwise(text("passenger_count")),
            "trip_distance": F.when(ok % 31 == 0, F.lit("n/a")).otherwise(text("trip_distance")),
            "fare_amount": text("fare_amount"),
            "tip_amount": text("tip_amount"),
            "total_amount": text("total_amount"),
            "PULocationID": text("PULocationID"),
            "DOLocationID": F.when(ok % 41 == 0, F.lit("")).otherwise(text("DOLocationID")),
            **{c: text(c) for c in MORE},
        }
    )


RAW_TRIPS_SQL = f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  case when l_orderkey % 23 = 0 then '1e12' else cast(VendorID as varchar) end as VendorID,
  strftime(lpep_pickup_datetime, '%Y-%m-%dT%H:%M:%S')
    || case when l_linenumber % 2 = 0 then '.5' else '' end as lpep_pickup_datetime,
  cast(lpep_dropoff_datetime as varchar) as lpep_dropoff_datetime,
  case when l_orderkey % 43 = 0 then '2021-13-01' else cast(request_datetime as varchar) end as request_datetime,
  case when l_orderkey % 29 = 0 then cast(passenger_count as varchar) || '.7'
       else cast(passenger_count as varchar) end as passenger_count,
  case when l_orderkey % 31 = 0 then 'n/a' else cast(trip_distance as varchar) end as trip_distance,
  cast(fare_amount as varchar) as fare_amount,
  cast(tip_amount as varchar) as tip_amount,
  cast(total_amount as varchar) as total_amount,
  cast(PULocationID as varchar) as PULocationID,
  case when l_orderkey % 41 = 0 then '' else cast(DOLocationID as varchar) end as DOLocationID,
  passenger_email, driver_email, passenger_phone_number, passenger_fullname,
  passenger_credit_card, store_and_fwd_flag, batch_no,
  {", ".join(f"cast({c} as varchar) as {c}" for c in MORE)}
from trips
"""
