"""Column-expression helpers (all JVM-side, codegen'd)."""

from martflow.functions.cols import (as_bigint, as_decimal, decimal_product_text,
                                     delta_text, map_fields, whitelist)
from martflow.functions.jsonfn import drop_null_values, is_json_object, map_json, to_json_text
from martflow.functions.timefmt import (DAY_MS, millis_to_utc_wallclock, ntz_to_millis,
                                        previous_day_str, to_date_str, to_datetime_str,
                                        to_ts, wallclock)

__all__ = [
    "as_bigint", "as_decimal", "decimal_product_text", "delta_text", "map_fields",
    "whitelist", "drop_null_values", "is_json_object", "map_json", "to_json_text",
    "DAY_MS", "millis_to_utc_wallclock", "ntz_to_millis", "previous_day_str",
    "to_date_str", "to_datetime_str", "to_ts", "wallclock",
]
