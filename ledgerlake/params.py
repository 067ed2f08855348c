"""Run parameters.

Every job takes its clock from here instead of ``current_date()`` /
``current_timestamp()`` so that a rebuild for the same ``as_of`` gives the
same rows (the reference reads the wall clock; we inject it).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class RunParams:
    # business date the run reports on (reference: current_date())
    as_of: dt.date = dt.date(2024, 1, 31)
    # run timestamp, used for _unified_at / _loaded_at style columns
    # (reference: current_timestamp()); the daily schedule runs at 06:00 UTC
    run_ts: dt.datetime = dt.datetime(2024, 1, 31, 6, 0, 0)
    # incremental re-read window in days (project variable incremental_lookback)
    lookback_days: int = 3
    # earliest transaction date pulled from NetSuite (project variable)
    min_transaction_date: dt.date = dt.date(2020, 1, 1)
    # declared by the reference but never used by any model
    base_currency: str = "USD"

    @property
    def as_of_str(self) -> str:
        return self.as_of.isoformat()

    @property
    def run_ts_str(self) -> str:
        return self.run_ts.strftime("%Y-%m-%d %H:%M:%S")


DEFAULT = RunParams()
