"""DataFrame -> DataFrame operators built from Spark's DataFrame API."""

from lodgelake.operators.calendar import calendar, calendar_from_data, dim_date  # noqa: F401
from lodgelake.operators.dedup import earliest_per_group, latest_per_group, top_per_group  # noqa: F401
from lodgelake.operators.joins import month_version_join  # noqa: F401
from lodgelake.operators.lookup import lga_lookup_table, overrides, priority_lookup  # noqa: F401
from lodgelake.operators.median import exact_median  # noqa: F401
from lodgelake.operators.scd2 import month_versions, scd2_merge, scd2_replay  # noqa: F401
