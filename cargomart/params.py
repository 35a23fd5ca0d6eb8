"""Run parameters and their date derivations (H9).

These are scalars computed on the driver before any job is planned; nothing
here touches data.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from decimal import Decimal

_DAY = re.compile(r"^\d{4}-\d{2}-\d{2}$")
_MONTH = re.compile(r"^\d{4}-\d{2}$")


def check_day(value: str) -> str:
    if not isinstance(value, str) or not _DAY.match(value):
        raise ValueError(f"expected a day as 'YYYY-MM-DD', got {value!r}")
    date.fromisoformat(value)
    return value


def check_month(value: str) -> str:
    if not isinstance(value, str) or not _MONTH.match(value):
        raise ValueError(f"expected a month as 'YYYY-MM', got {value!r}")
    date.fromisoformat(value + "-01")
    return value


def _as_date(run_dt: str | date | datetime) -> date:
    if isinstance(run_dt, datetime):
        return run_dt.date()
    if isinstance(run_dt, date):
        return run_dt
    return date.fromisoformat(check_day(run_dt))


def trans_dt_for(run_dt: str | date) -> str:
    """Jobs 1 and 3 process the day before the run date."""
    return (_as_date(run_dt) - timedelta(days=1)).isoformat()


def report_month_of(trans_dt: str) -> str:
    """Derived from trans_dt, never passed separately (Q21)."""
    return check_day(trans_dt)[:7]


def export_month_for(run_dt: str | date) -> str:
    """Month before the run date, truncating to the 1st first (Q11: a run on
    the 31st must not land in its own month)."""
    first = _as_date(run_dt).replace(day=1)
    return (first - timedelta(days=1)).strftime("%Y-%m")


def days_between(first: str, last: str) -> list[str]:
    a, b = date.fromisoformat(check_day(first)), date.fromisoformat(check_day(last))
    return [(a + timedelta(days=i)).isoformat() for i in range((b - a).days + 1)]


@dataclass(frozen=True)
class RunParams:
    """Database names, dates and thresholds of one run."""

    run_dt: str
    landing_db: str = "landing"
    uc_db: str = "shipmart"
    dim_db: str = "shipmart_dim"
    # Fixed values of the reference's configuration.
    min_declared_value: Decimal = Decimal("10.00")
    err_rate_threshold: int = 5
    job_name: str = "cargomart"
    run_stamp: str | None = None  # literal load_timestamp (tests); None = now

    @property
    def trans_dt(self) -> str:
        return trans_dt_for(self.run_dt)

    @property
    def load_dt(self) -> str:
        return check_day(self.run_dt)

    @property
    def report_month(self) -> str:
        return report_month_of(self.trans_dt)

    @property
    def export_month(self) -> str:
        return export_month_for(self.run_dt)
