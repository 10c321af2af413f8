"""Typing, column maintenance and required-value filtering (silver stage)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkiln import config as C
from tripkiln.functions.columns import cast_value
from tripkiln.schema import CAST_SPEC, CastRule
from tripkiln.session import compiled_stages


def cast_columns(
    df: DataFrame,
    spec: tuple[CastRule, ...] = CAST_SPEC,
    missing: str = "error",
) -> DataFrame:
    """Type and round every column of ``spec`` in one projection.

    Columns not in ``spec`` pass through unchanged, in place. A ``spec``
    column absent from ``df`` raises (``missing="error"``, like a fixed cast
    list) or is skipped (``missing="skip"``) for frames holding a subset.
    """
    compiled_stages(df.sparkSession)
    rules = {r.name: r for r in spec}
    present = set(df.columns)
    absent = [r.name for r in spec if r.name not in present]
    if absent and missing == "error":
        raise ValueError(f"columns missing from input: {absent}")
    return df.select(
        *[
            cast_value(F.col(c), rules[c].kind, rules[c].digits).alias(c) if c in rules else F.col(c)
            for c in df.columns
        ]
    )


def drop_incomplete(df: DataFrame, required: tuple[str, ...] = C.REQUIRED_COLUMNS) -> DataFrame:
    """Drop rows with a null (or NaN) in any required column."""
    return df.dropna(subset=list(required)) if required else df


def drop_columns(df: DataFrame, columns: tuple[str, ...] = C.COLUMNS_TO_DROP) -> DataFrame:
    """Drop columns; names that are not present are ignored."""
    return df.drop(*columns)


def rename_columns(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Rename columns; names that are not present are ignored."""
    mapping = C.COLUMNS_TO_RENAME if mapping is None else mapping
    return df.withColumnsRenamed(dict(mapping))


def compute_columns(df: DataFrame, exprs: dict | None = None) -> DataFrame:
    """Add or replace columns from a ``{name: Column}`` mapping (a hook)."""
    return df.withColumns(exprs) if exprs else df


def utc_batch_time(batch_time: _dt.datetime | None = None) -> _dt.datetime:
    """A naive UTC datetime: ``batch_time`` converted, or now."""
    if batch_time is None:
        return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    if batch_time.tzinfo is not None:
        return batch_time.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return batch_time


def epoch_seconds_of(batch_time: _dt.datetime) -> int:
    """Whole epoch seconds of a naive UTC datetime (floored)."""
    return int((batch_time - _dt.datetime(1970, 1, 1)).total_seconds() // 1)


def add_ingest_columns(
    df: DataFrame,
    batch_time: _dt.datetime | None = None,
    epoch_column: str = C.INGEST_TS_COLUMN,
    datetime_column: str = "ingest_datetime",
) -> DataFrame:
    """Stamp every row of a batch with one ingest time.

    ``epoch_column`` holds whole epoch seconds (long), ``datetime_column`` the
    same instant with microseconds as a timestamp. Without ``batch_time`` the
    driver's current UTC time is used, fixed once for the whole batch.
    """
    batch_time = utc_batch_time(batch_time)
    epoch = epoch_seconds_of(batch_time)
    return df.withColumns(
        {
            epoch_column: F.lit(epoch).cast("long"),
            # from text: a datetime literal would pass through local zones
            datetime_column: F.lit(batch_time.isoformat(sep=" ")).cast("timestamp_ntz"),
        }
    )


def add_row_id(df: DataFrame, keys: list[str] | None = None, name: str = "id") -> DataFrame:
    """Surrogate row id.

    With ``keys`` the id is a stable 64-bit hash of those columns (same row,
    same id across reruns); without, ``monotonically_increasing_id`` gives a
    unique id that depends on the physical partitioning.
    """
    if keys:
        return df.withColumn(name, F.xxhash64(*[F.col(k) for k in keys]))
    return df.withColumn(name, F.monotonically_increasing_id())
