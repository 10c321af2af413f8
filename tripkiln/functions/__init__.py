"""Column-expression builders (all JVM-side built-ins, no Python UDFs)."""

from tripkiln.functions.columns import (  # noqa: F401
    cast_value,
    epoch_seconds,
    mask_full,
    mask_partial,
    minutes_between,
    ratio,
    split_part,
)
