from agorakit.functions.scalar import (  # noqa: F401
    as_number,
    as_timestamp,
    bucket,
    days_between_floor,
    from_units,
    half_up,
    lookup,
    money_avg,
    money_sum,
    money_units,
    month_gap,
    ratio_pct,
    sentiment,
    status_category,
    surrogate_key,
    text_key,
)
