"""Column-level helpers: pure Spark expressions, no Python per row."""

from payrisk.functions.columns import (  # noqa: F401
    decision,
    default_if_falsy,
    epoch_seconds,
    heuristic_probability,
    iso_to_timestamp,
    missing_feature_flags,
    round6,
    seconds_between,
    try_double,
    try_label,
    uuid5_expr,
    window_end,
)
