from tidemark.functions.columns import (  # noqa: F401
    SEVERITY_ORDER,
    WEEKDAY_LABELS,
    banded,
    count_true,
    floor_bin,
    from_epoch_ms,
    last_token,
    local_day_end,
    local_day_start,
    mapped,
    percentage,
    position_in,
    remerged,
    rounded_mean,
    severity,
    truncated,
    weekday_index,
    weekday_label,
)
