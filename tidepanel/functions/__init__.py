"""Column-expression helpers: all built-in Spark expressions (codegen-friendly)."""

from tidepanel.functions.columns import (  # noqa: F401
    bin_right_closed,
    clip,
    date_as_int,
    date_from_ordinal,
    date_ordinal,
    hash_bucket,
    hash_unit,
    nan_to_null,
    parse_date,
    sentinel_to_null,
    threshold_to_null,
    time_number,
)
