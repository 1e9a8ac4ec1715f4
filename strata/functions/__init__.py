from strata.functions.columns import (  # noqa: F401
    default_if_blank,
    default_if_null,
    fill_default,
    is_blank,
    now_in_zone,
    strip_or_sentinel,
    strip_prefix,
    to_date,
    to_int,
    to_money,
    to_timestamp,
    trim_lower,
    utc_to_zone,
)
