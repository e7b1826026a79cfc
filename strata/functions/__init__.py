from strata.functions.scalars import (
    blank_to_default,
    ci_key,
    date_key,
    days_before,
    digits_from_code,
    elapsed_seconds,
    first_present_label,
    is_month_end,
    is_weekend,
    local_day,
    lower_text,
    month_name,
    null_default,
    parse_date,
    parse_timestamp,
    price_fallback,
    repair_timestamp,
    safe_cast,
    shift_hours,
    ts_literal,
    weekday_name,
    zone_day,
)

__all__ = [
    "blank_to_default", "ci_key", "date_key", "days_before", "digits_from_code",
    "elapsed_seconds", "first_present_label", "is_month_end", "is_weekend", "local_day",
    "lower_text", "month_name", "null_default", "parse_date", "parse_timestamp",
    "price_fallback", "repair_timestamp", "safe_cast", "shift_hours", "ts_literal",
    "weekday_name", "zone_day",
]
