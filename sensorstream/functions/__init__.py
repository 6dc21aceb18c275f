"""Column-expression helpers: time, JSON and arithmetic."""

from .json import CORRUPT, from_json_col, to_json_col, with_corrupt_field  # noqa: F401
from .math import exact_mean, exact_sum, safe_avg  # noqa: F401
from .time import (format_ts, from_epoch_ms, parse_any_ts, parse_iso_ts,  # noqa: F401
                   parse_sql_ts, parse_ts, to_epoch_ms, to_ntz)
