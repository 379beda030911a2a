"""Column-level functions (no DataFrame in, no DataFrame out)."""

from staylake.functions.exact import avg_exact, pct, ratio, round_half_away
from staylake.functions.dates import (label_time_key, month_label, month_start,
                                      parse_date)
from staylake.functions.listing import (active_only, estimated_nights,
                                        estimated_revenue, flag_count, is_true)
from staylake.functions.text import fold, lga_code_parse

__all__ = [
    "active_only", "avg_exact", "estimated_nights", "estimated_revenue",
    "flag_count", "fold", "is_true", "label_time_key", "lga_code_parse",
    "month_label", "month_start", "parse_date", "pct", "ratio",
    "round_half_away",
]
