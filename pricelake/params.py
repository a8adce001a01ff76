"""Run parameters.

The reference reads the wall clock inside its transformations.  Here the
run timestamp and the "today" used by validation and SCD2 are explicit
arguments, so a rerun reproduces the same output and tests can pin them.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


# Fixed values that must equal the reference's.
SENTINEL_VALID_TO = dt.date(9999, 12, 31)
DEFAULT_SECTOR = "Unknown"
MUTUAL_FUND = "mutual_fund"
STOCK = "stock"
SOURCE_SYSTEM = "yfinance"
CALENDAR_END = dt.date(2035, 12, 31)


@dataclass(frozen=True)
class RunParams:
    """Everything a run needs that the reference takes from the clock."""

    run_ts: dt.datetime
    as_of_date: dt.date | None = None          # defaults to run_ts.date()
    source_system: str = SOURCE_SYSTEM
    calendar_start: dt.date = dt.date(2025, 3, 9)
    calendar_end: dt.date = CALENDAR_END
    # SCD2 policy for tickers that left the holdings: close / keep / drop.
    # A removed ticker has no baseline value, so the fact prices current
    # holdings only; closing its dimension row says the same.
    on_removed: str = "close"
    # valid_from for rows inserted when the dimension is empty
    initial_valid_from: dt.date | None = None
    extra: dict = field(default_factory=dict)

    @property
    def today(self) -> dt.date:
        return self.as_of_date or self.run_ts.date()

    @property
    def run_iso(self) -> str:
        return self.run_ts.isoformat()

    @property
    def batch_id(self) -> str:
        return self.run_ts.strftime("%Y-%m-%d_%H%M%S")

    @property
    def run_date_iso(self) -> str:
        return self.run_ts.date().isoformat()
