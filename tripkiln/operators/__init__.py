"""DataFrame -> DataFrame operators of the silver and gold stages."""

from tripkiln.operators.aggregates import (  # noqa: F401
    attach_group_count,
    busy_area,
    driver_experience_level,
    group_counts,
    high_water_mark,
    passenger_loyalty,
)
from tripkiln.operators.cleanse import (  # noqa: F401
    add_ingest_columns,
    add_row_id,
    cast_columns,
    compute_columns,
    drop_columns,
    drop_incomplete,
    rename_columns,
)
from tripkiln.operators.features import add_row_features  # noqa: F401
from tripkiln.operators.impute import impute, impute_mean, impute_mode  # noqa: F401
from tripkiln.operators.insights import add_insights, attach_neighborhoods, attach_zones  # noqa: F401
from tripkiln.operators.privacy import (  # noqa: F401
    mask_full_columns,
    mask_partial_columns,
    split_names,
)
from tripkiln.operators.quality import drop_outliers, drop_repeated, flag_outliers, outlier_bounds  # noqa: F401
