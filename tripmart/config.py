"""One settings object for every layer (date range, services, question arguments).

The reference spreads its dates over three places (load plan 2022-01..2023-12,
calendar and partitions 2022-01..2025-12). Here a single ``Settings`` value
drives the load plan, the calendar, the declared month partitions and the
question arguments, so they cannot drift apart.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

# Fixed values that must equal the reference's for the same answers.
SERVICES = ("yellow", "green")
SERVICE_KEYS = {"yellow": 1, "green": 2}
PAYMENT_TYPES = {1: "card", 2: "cash", 3: "other/unknown"}
VENDORS = {
    1: "Creative Mobile Technologies, LLC",
    2: "VeriFone Inc.",
    3: "Other/Unknown",
}
# Trip-file columns that arrive as float but hold integers.
INT_REPAIR_COLUMNS = (
    "vendorid",
    "ratecodeid",
    "payment_type",
    "passenger_count",
    "pulocationid",
    "dolocationid",
    "trip_type",
)


@dataclass(frozen=True)
class Settings:
    calendar_start: dt.date = dt.date(2022, 1, 1)
    calendar_end: dt.date = dt.date(2025, 12, 31)
    plan_start: dt.date = dt.date(2022, 1, 1)
    plan_end: dt.date = dt.date(2023, 12, 31)
    services: tuple[str, ...] = SERVICES
    focus_year: int = 2024
    top_n: int = 10
    top_per_group: int = 5
    min_trips: int = 100
    payment_classes: tuple[str, ...] = ("cash", "card")
    # A dimension is broadcast only when its counted row number is at most
    # this; above it the planner keeps a shuffle join (AQE may still switch).
    broadcast_max_rows: int = 1_000_000

    def with_(self, **kw) -> "Settings":
        return replace(self, **kw)

    @property
    def calendar_days(self) -> int:
        return (self.calendar_end - self.calendar_start).days + 1


REFERENCE = Settings()

# Parameters for the supplied TPC-H-shaped test tables (FIXTURES.md part 2):
# calendar 1995-01-01 .. 2001-06-30, focus year 1998, minimum trips 100.
TESTDATA = Settings(
    calendar_start=dt.date(1995, 1, 1),
    calendar_end=dt.date(2001, 6, 30),
    # The plan reaches past both ends of the landed months, so coverage
    # reports both statuses.
    plan_start=dt.date(1994, 7, 1),
    plan_end=dt.date(2002, 6, 30),
    focus_year=1998,
)
