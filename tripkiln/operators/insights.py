"""Further trip features: calendar, places, fares, weather, people.

All but the two lookups are per-row expressions (one fused projection, no
shuffle). The lookups join tables that the caller brings: zone names by
location id and neighbourhoods by coordinates. Neither multiplies a trip,
whatever the table holds; whether it is broadcast is left to the planner,
which knows its size, and AQE splits a hot id or cell otherwise.

The thresholds and word lists are defaults of this library; every function
takes others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripkiln.config import GoldConfig

_G = GoldConfig()
#: Location ids of the three airports in the public zone table.
AIRPORT_IDS = (1, 132, 138)
SURCHARGES = ("tolls_amount", "improvement_surcharge", "congestion_surcharge")
HUMID_PERCENT = 80.0
EXTREME_WORDS = ("heavy", "storm", "thunder", "hail", "blizzard", "snow", "freezing", "hurricane", "tornado")
#: Upper ends (excluded) of the age groups, and the group beyond.
AGE_GROUPS = ((18, "Minor"), (30, "Young"), (60, "Adult"))
OLDEST_GROUP = "Senior"
PROFESSIONAL_JOBS = ("Accountant", "Architect", "Doctor", "Engineer", "Lawyer", "Scientist", "Software Developer")
EXPERIENCED_TRIPS = 100
#: Grid of the neighbourhood lookup, in degrees.
CELL_DEGREES = 0.02


def pickup_weekday(df: DataFrame, ts: str = _G.pickup) -> DataFrame:
    """``pickup_weekday`` (1 Monday to 7 Sunday) and ``pickup_weekday_name``
    (Mon to Sun): the true weekday, unlike ``pickup_day_of_week``."""
    names = F.array(*[F.lit(d) for d in ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")])
    return df.withColumns({"pickup_weekday": F.weekday(ts) + 1, "pickup_weekday_name": F.get(names, F.weekday(ts))})


def season(df: DataFrame, ts: str = _G.pickup) -> DataFrame:
    """``season`` of the pickup month: Winter is December to February, and so on."""
    names = F.array(*[F.lit(s) for s in ("Winter", "Spring", "Summer", "Autumn")])
    return df.withColumn("season", F.get(names, F.floor(F.month(ts) % 12 / 3).cast("int")))


def net_fare(df: DataFrame, fare: str = "fare_amount", less: tuple[str, ...] = SURCHARGES) -> DataFrame:
    """``net_fare``: the fare without tolls and surcharges (missing ones count
    as 0; null for a null fare), to the cent."""
    value = F.col(fare)
    for c in less:
        value = value - F.coalesce(F.col(c), F.lit(0.0))
    return df.withColumn("net_fare", F.round(value, 2))


def is_airport_trip(
    df: DataFrame, airports: tuple[int, ...] = AIRPORT_IDS, start: str = "PULocationID", end: str = "DOLocationID"
) -> DataFrame:
    """``is_airport_trip``: begins or ends at one of the airports; null if an
    unknown place decides."""
    return df.withColumn("is_airport_trip", F.col(start).isin(*airports) | F.col(end).isin(*airports))


def weather_flags(df: DataFrame, humid: float = HUMID_PERCENT, extreme: tuple[str, ...] = EXTREME_WORDS) -> DataFrame:
    """``is_high_humidity`` (above ``humid`` percent), ``is_extreme_weather``
    (the description holds one of the words, in any case) and
    ``feels_like_difference`` (felt less measured temperature); null of null."""
    said = F.lower("weather_description")
    return df.withColumns(
        {
            "is_high_humidity": F.col("humidity") > humid,
            "is_extreme_weather": _any([said.contains(w.lower()) for w in extreme]),
            "feels_like_difference": F.round(F.col("feels_like") - F.col("temperature"), 1),
        }
    )


def _any(flags: list[Column]) -> Column:
    out = flags[0]
    for f in flags[1:]:
        out = out | f
    return out


def passenger_category(
    df: DataFrame, groups: tuple[tuple[int, str], ...] = AGE_GROUPS, professional: tuple[str, ...] = PROFESSIONAL_JOBS
) -> DataFrame:
    """``passenger_category``: the age group, with `` Professional`` behind it
    for adults and the young with one of these jobs; null for a null age."""
    age = F.col("passenger_age")
    group = F.when(age.isNull(), F.lit(None).cast("string"))
    for below, name in groups:
        group = group.when(age < below, F.lit(name))
    group = group.otherwise(F.lit(OLDEST_GROUP))
    works = F.coalesce(F.lower("passenger_Job").isin(*[j.lower() for j in professional]), F.lit(False))
    grown = (age >= groups[0][0]) & (age < groups[-1][0])
    return df.withColumn("passenger_category", F.when(works & grown, F.concat(group, F.lit(" Professional"))).otherwise(group))


def experienced_driver(df: DataFrame, threshold: int = EXPERIENCED_TRIPS, level: str = "driver_experience_level") -> DataFrame:
    """``experienced_driver``: the driver's trips reach ``threshold`` (needs
    the attached count)."""
    return df.withColumn("experienced_driver", F.col(level) >= threshold)


def attach_zones(
    df: DataFrame, zones: DataFrame, ends: dict[str, str] | None = None, id_col: str = "LocationID",
    names: tuple[str, ...] = ("Borough", "Zone"),
) -> DataFrame:
    """For each location column and prefix of ``ends`` the columns
    ``<prefix>_<name>`` of the zone with that id, in lower case; null where
    there is none.

    An id that repeats in ``zones`` counts once, with its least names."""
    ends = ends or {"PULocationID": "pickup", "DOLocationID": "dropoff"}
    one = zones.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__tk_id")).agg(F.min(F.struct(*names)).alias("__tk_names"))
    out = df
    for column, prefix in ends.items():
        mine = one.select(F.col("__tk_id"), *[F.col("__tk_names")[n].alias(f"{prefix}_{n.lower()}") for n in names])
        out = out.join(mine, out[column] == mine["__tk_id"], "left").drop("__tk_id")
    return out


def area_cells(areas: DataFrame, cell: float = CELL_DEGREES) -> DataFrame:
    """One row a grid cell that an area touches: the areas there, by name."""
    steps = lambda low, high: F.explode(F.sequence(F.floor(F.col(low) / cell), F.floor(F.col(high) / cell)))
    sides = ("lat_min", "lat_max", "lon_min", "lon_max")
    whole = areas.where((F.col("lat_min") < F.col("lat_max")) & (F.col("lon_min") < F.col("lon_max")) & F.col("name").isNotNull())
    return (
        whole.withColumn("__tk_row", steps("lat_min", "lat_max")).withColumn("__tk_col", steps("lon_min", "lon_max"))
        .groupBy("__tk_row", "__tk_col").agg(F.sort_array(F.collect_set(F.struct("name", *sides))).alias("__tk_areas"))
    )


def attach_neighborhoods(
    df: DataFrame, areas: DataFrame, points: dict[str, tuple[str, str]] | None = None, cell: float = CELL_DEGREES
) -> DataFrame:
    """For each name and (latitude, longitude) columns of ``points`` the name
    of the area there: of ``areas`` (name, lat_min, lat_max, lon_min, lon_max;
    lower ends included, upper ends not) the least by name that holds the point.

    The range condition becomes an equi-join on grid cells of ``cell`` degrees
    (an area takes as many rows as it touches cells), and the few areas of the
    point's cell are looked through beside the row."""
    points = points or {
        "pickup_neighborhood": ("pickup_latitude", "pickup_longitude"),
        "dropoff_neighborhood": ("dropoff_latitude", "dropoff_longitude"),
    }
    cells, out = area_cells(areas, cell), df
    for name, (lat, lon) in points.items():
        at = out.withColumns({"__tk_lat": F.floor(F.col(lat) / cell), "__tk_lon": F.floor(F.col(lon) / cell)})
        joined = at.join(cells, (at["__tk_lat"] == cells["__tk_row"]) & (at["__tk_lon"] == cells["__tk_col"]), "left")
        inside = F.filter(
            "__tk_areas",
            lambda a: (F.col(lat) >= a["lat_min"]) & (F.col(lat) < a["lat_max"]) & (F.col(lon) >= a["lon_min"]) & (F.col(lon) < a["lon_max"]),  # noqa: B023
        )
        out = joined.withColumn(name, F.get(inside, F.lit(0))["name"]).drop("__tk_lat", "__tk_lon", "__tk_row", "__tk_col", "__tk_areas")
    return out


def add_insights(df: DataFrame, cfg: GoldConfig = _G) -> DataFrame:
    """All per-row features of this module that need no count and no table."""
    return (
        df.transform(pickup_weekday, cfg.pickup).transform(season, cfg.pickup).transform(net_fare)
        .transform(is_airport_trip).transform(weather_flags).transform(passenger_category)
    )
