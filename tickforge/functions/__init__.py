from tickforge.functions.mathexpr import (  # noqa: F401
    half_even_long,
    is_close,
    nan_to_null,
    on_grid,
    safe_ratio,
)
from tickforge.functions.text import (  # noqa: F401
    escape_tag,
    has_prefix,
    line_protocol,
    mentions,
    run_id,
    run_timestamp,
)
from tickforge.functions.timeexpr import (  # noqa: F401
    compact_utc,
    days_between,
    epoch_ns,
    epoch_us,
    from_epoch_ns,
    naive,
    seconds_between,
    week_index,
)
