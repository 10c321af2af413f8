"""Raw and typed schemas of a trip record.

Raw CSV drops are read with an explicit all-string schema (no inference pass
over the data); :data:`CAST_SPEC` then types every column in one projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

INT = "int"
DOUBLE = "double"
STRING = "string"
TIMESTAMP = "timestamp"


@dataclass(frozen=True)
class CastRule:
    name: str
    kind: str
    digits: int | None = None


# fixed values: the 45 raw trip columns, their types and rounding digits,
# in the order of the raw file.
CAST_SPEC: tuple[CastRule, ...] = (
    CastRule("VendorID", INT),
    CastRule("lpep_pickup_datetime", TIMESTAMP),
    CastRule("lpep_dropoff_datetime", TIMESTAMP),
    CastRule("request_datetime", TIMESTAMP),
    CastRule("passenger_count", INT),
    CastRule("trip_distance", DOUBLE, 2),
    CastRule("RatecodeID", INT),
    CastRule("store_and_fwd_flag", STRING),
    CastRule("PULocationID", INT),
    CastRule("DOLocationID", INT),
    CastRule("payment_type", INT),
    CastRule("fare_amount", DOUBLE, 2),
    CastRule("extra", DOUBLE, 1),
    CastRule("mta_tax", DOUBLE, 2),
    CastRule("tip_amount", DOUBLE, 2),
    CastRule("tolls_amount", DOUBLE, 2),
    CastRule("improvement_surcharge", DOUBLE, 1),
    CastRule("total_amount", DOUBLE, 1),
    CastRule("congestion_surcharge", DOUBLE, 1),
    CastRule("airport_fee", DOUBLE, 2),
    CastRule("driver_email", STRING),
    CastRule("driver_phone_number", STRING),
    CastRule("driver_fullname", STRING),
    CastRule("driver_credit_card", STRING),
    CastRule("passenger_email", STRING),
    CastRule("passenger_phone_number", STRING),
    CastRule("passenger_fullname", STRING),
    CastRule("passenger_credit_card", STRING),
    CastRule("passenger_address", STRING),
    CastRule("passenger_Job", STRING),
    CastRule("passenger_age", INT),
    CastRule("passenger_sex", STRING),
    CastRule("pickup_latitude", DOUBLE, 6),
    CastRule("pickup_longitude", DOUBLE, 6),
    CastRule("dropoff_latitude", DOUBLE, 6),
    CastRule("dropoff_longitude", DOUBLE, 6),
    CastRule("pickup_AQI", INT),
    CastRule("dropoff_AQI", INT),
    CastRule("temperature", DOUBLE, 1),
    CastRule("humidity", DOUBLE, 1),
    CastRule("pickup_precipitation_chance", DOUBLE, 1),
    CastRule("uv_index", INT),
    CastRule("feels_like", DOUBLE, 0),
    CastRule("weather_description", STRING),
    CastRule("wind_speed_km", DOUBLE, 0),
)

RAW_COLUMNS: tuple[str, ...] = tuple(r.name for r in CAST_SPEC)

SPARK_TYPES = {
    INT: T.IntegerType(),
    DOUBLE: T.DoubleType(),
    STRING: T.StringType(),
    # wall-clock time without a zone: results never depend on the session zone
    TIMESTAMP: T.TimestampNTZType(),
}

CORRUPT_RECORD = "_corrupt_record"


def raw_schema(with_corrupt_record: bool = False) -> T.StructType:
    """All-string schema of a raw CSV drop (header names as in the file)."""
    fields = [T.StructField(n, T.StringType(), True) for n in RAW_COLUMNS]
    if with_corrupt_record:
        fields.append(T.StructField(CORRUPT_RECORD, T.StringType(), True))
    return T.StructType(fields)


def typed_schema(spec: tuple[CastRule, ...] = CAST_SPEC) -> T.StructType:
    return T.StructType([T.StructField(r.name, SPARK_TYPES[r.kind], True) for r in spec])


def numeric_columns(schema: T.StructType) -> list[str]:
    """Columns filled with the mean: integer, double and float (not long/decimal)."""
    kinds = (T.IntegerType, T.DoubleType, T.FloatType)
    return [f.name for f in schema.fields if isinstance(f.dataType, kinds)]


def categorical_columns(schema: T.StructType) -> list[str]:
    """Columns filled with the mode: strings."""
    return [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
