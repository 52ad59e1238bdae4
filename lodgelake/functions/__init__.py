"""Column expressions (all JVM-side built-ins; no Python UDF anywhere)."""

from lodgelake.functions.cleaning import (  # noqa: F401
    blank_to_null,
    cast_blank,
    census_code,
    flag_to_bool,
    lower_trim_after_nullif,
    normalise,
)
from lodgelake.functions.dates import (  # noqa: F401
    calendar_date_id,
    date_from_id,
    date_id,
    month_start,
)
from lodgelake.functions.keys import scd_id, surrogate_key  # noqa: F401
from lodgelake.functions.numeric import avg_exact, pct_change, ratio_pct, round_ratio  # noqa: F401
