"""Column expressions (JVM-side built-ins only)."""
from .numeric import safe_divide  # noqa: F401
from .temporal import (day_name, delay_bucket, delay_days, format_timestamp, month_name,  # noqa: F401
                       month_start, on_time_flag, parse_timestamp, weekday)
from .text import (apply_contains_rules, lower, normalize_place, replace_values,  # noqa: F401
                   strip_accents, strip_accents_legacy, strip_whitespace)
