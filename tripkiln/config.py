"""Pipeline configuration.

The values marked *fixed values* must equal the ones of the original trip
pipeline for identical results; they are stated here once, in natural order,
and every operator takes them as overridable keyword arguments.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# fixed values (silver stage)
# ---------------------------------------------------------------------------
REQUIRED_COLUMNS: tuple[str, ...] = ("fare_amount",)
SPLIT_COLUMNS: dict[str, tuple[str, str]] = {
    "passenger_fullname": ("passenger_first_name", "passenger_last_name"),
    "driver_fullname": ("driver_first_name", "driver_last_name"),
}
SPLIT_SEPARATOR = " "
MASK_FULL_COLUMNS: tuple[str, ...] = ("driver_credit_card", "passenger_credit_card")
MASK_PARTIAL_COLUMNS: tuple[str, ...] = ("passenger_phone_number", "driver_phone_number")
COLUMNS_TO_DROP: tuple[str, ...] = ("passenger_fullname", "driver_fullname")
COLUMNS_TO_RENAME: dict[str, str] = {
    "lpep_pickup_datetime": "pickup_datetime",
    "lpep_dropoff_datetime": "dropoff_datetime",
}
ORDINAL_ENCODING_COLUMNS: tuple[str, ...] = ("passenger_sex",)
FULL_MASK_TEXT = "*****"
PARTIAL_MASK_TEXT = "***"
PARTIAL_MASK_KEEP = 4
# the single-machine variant of the pipeline keeps 3 characters on each side,
# splits only the passenger name and drops only that source column
PARTIAL_MASK_KEEP_SCRIPT = 3
SPLIT_COLUMNS_SCRIPT: dict[str, tuple[str, str]] = {"passenger_fullname": ("first_name", "last_name")}
COLUMNS_TO_DROP_SCRIPT: tuple[str, ...] = ("passenger_fullname",)

# ---------------------------------------------------------------------------
# fixed values (gold stage)
# ---------------------------------------------------------------------------
MILES_TO_KM = 1.60934
DAYLIGHT_MONTHS = (4, 9)        # inclusive range
DAYLIGHT_HOURS = (6, 20)        # inclusive range
RUSH_HOURS = ((7, 9), (16, 18))  # inclusive ranges
PASSENGER_KEY = "passenger_email"
DRIVER_KEY = "driver_email"
INGEST_TS_COLUMN = "ingest_timestamp"


@dataclass(frozen=True)
class SilverConfig:
    """Column roles of the silver stage (defaults = fixed values above)."""

    required: tuple[str, ...] = REQUIRED_COLUMNS
    split: dict[str, tuple[str, str]] = field(default_factory=lambda: dict(SPLIT_COLUMNS))
    mask_full: tuple[str, ...] = MASK_FULL_COLUMNS
    mask_partial: tuple[str, ...] = MASK_PARTIAL_COLUMNS
    drop: tuple[str, ...] = COLUMNS_TO_DROP
    rename: dict[str, str] = field(default_factory=lambda: dict(COLUMNS_TO_RENAME))
    partial_keep: int = PARTIAL_MASK_KEEP
    # False: the full mask overwrites nulls too (distributed variant);
    # True: nulls stay null (single-machine variant).
    full_mask_keep_null: bool = False
    # "impute_first": impute then drop incomplete rows (the drop never fires
    # for numeric required columns); "required_first": drop, then impute.
    order: str = "impute_first"

    @classmethod
    def script_variant(cls) -> "SilverConfig":
        """Preset of the single-machine variant: keep-3 partial mask,
        null-preserving full mask, passenger name split only."""
        return cls(
            split=dict(SPLIT_COLUMNS_SCRIPT),
            drop=COLUMNS_TO_DROP_SCRIPT,
            partial_keep=PARTIAL_MASK_KEEP_SCRIPT,
            full_mask_keep_null=True,
        )


@dataclass(frozen=True)
class GoldConfig:
    """Column roles of the gold stage (defaults = fixed values above)."""

    pickup: str = "pickup_datetime"
    dropoff: str = "dropoff_datetime"
    request: str = "request_datetime"
    passenger_key: str = PASSENGER_KEY
    driver_key: str = DRIVER_KEY
