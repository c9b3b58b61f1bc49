"""Column-expression helpers (all JVM-side, codegen-friendly)."""

from stayframe.functions.time import (
    elapsed_micros,
    window_index,
    add_seconds,
    iso_string,
    parse_ntz,
    truncate_hour,
)
from stayframe.functions.values import (
    nan_to_null,
    flag,
    safe_div,
    right_closed_bucket,
)

__all__ = [
    "elapsed_micros",
    "window_index",
    "add_seconds",
    "iso_string",
    "parse_ntz",
    "truncate_hour",
    "nan_to_null",
    "flag",
    "safe_div",
    "right_closed_bucket",
]
