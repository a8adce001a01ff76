"""Column -> Column expression helpers (all built-in Spark functions)."""

from pricelake.functions.calendar import (date_key, easter_sunday,
                                          is_market_holiday, is_weekend,
                                          month_name, quarter_label,
                                          weekday_name)
from pricelake.functions.numeric import (exact_avg, exact_sum, exact_sum_over,
                                         pct_change, pct_change_or_zero,
                                         round_half_away,
                                         round_half_even, safe_div)
from pricelake.functions.text import (clean_ticker, first_chars, py_strip,
                                      title_label)

__all__ = [
    "date_key", "easter_sunday", "is_market_holiday", "is_weekend",
    "month_name", "quarter_label", "weekday_name", "exact_avg", "exact_sum",
    "exact_sum_over",
    "pct_change", "pct_change_or_zero", "round_half_away", "round_half_even",
    "safe_div", "clean_ticker", "first_chars", "py_strip", "title_label",
]
