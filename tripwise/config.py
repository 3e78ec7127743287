"""Run parameters.

Every constant the warehouse SQL hard-codes (window, cutoff, floors, caps,
thresholds, "now") is a field here so runs are repeatable and the window can
be widened for large inputs.  Defaults reproduce the original constants.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace


def _d(s: str) -> _dt.date:
    return _dt.date.fromisoformat(s)


def date_key(d: _dt.date) -> int:
    """yyyymmdd integer key of a date."""
    return d.year * 10000 + d.month * 100 + d.day


# Fixed values that must equal the original pipeline's for the same results.
BOOKING_STATUSES = ("SERVER_ABORT", "SUCCESS", "DRIVER_ABORT", "NO_DRIVER_FOUND", "PASSENGER_ABORT")
OFFER_STATES = ("ACCEPTED", "CANCELED")
MARKETING_TRUE = ("TRUE", "1", "YES")
MARKETING_FALSE = ("FALSE", "0", "NO")
DRIVER_READ_VALID = ("TRUE", "FALSE", "0", "1")
NULL_TEXT = "null"
# Rule messages, in rule order (trailing blanks and '|' are part of the text).
RULE_MESSAGES = {
    "R1": "NULL/EMPTY ID | ",
    "R2": "INVALID DATE_REGISTRATION",
    "R3": "DATE_REGISTRATION FORMAT ERROR: ",
    "R4": "RATING FORMAT ERROR: ",
    "R5": "COUNT FORMAT ERROR: ",
    "R6": "DRIVER_RATING OUT OF RANGE ",
    "R7": "NEGATIVE RATING_COUNT ",
    "R8": "RATING EXISTS BUT RATING_COUNT IS 0/NULL  ",
    "R9": "RATING_COUNT EXISTS BUT RATING IS 0/NULL  ",
    "R10": "INVALID RECEIVE_MARKETING ",
    "R11": "NULL COUNTRY ",
    "R12": "UNMAPPED COUNTRY: ",
    "R13": "NULL/EMPTY ID",
    "R14": "INVALID REQUEST_DATE",
    "R15": "REQUEST_DATE FORMAT ERROR: |",
    "R16": "INVALID STATUS: |",
    "R17": "INVALID ESTIMATED_ROUTE_FARE",
    "R18": "ESTIMATED_ROUTE_FARE FORMAT ERROR: |",
    "R19": "INVALID ID",
    "R20": "Null in driverid",
    "R21": "INVALID DATECREATED ",
    "R22": "DATE_CREATED FORMAT ERROR: ",
    "R23": "NULL BOOKINGID  ",
    "R24": "INVALID ROUTEDISTANCE",
    "R25": "ROUTE_DISTANCE FORMAT ERROR: ",
    "R26": "INVALID STATE",
    "R27": "INVALID DRIVERREAD ",
}
ERROR_SEPARATOR = " | "
OPEN_END_TS = "9999-12-31 00:00:00"


@dataclass(frozen=True)
class EngagementConfig:
    # "now" used inside validity rules and audit columns
    as_of: str = "2026-06-01 00:00:00"
    # calendar (dim_date): 30 days from 2021-06-01, extended to cover every date that can be
    # valid (from the date floors to ``as_of``) and the window, unless the literal calendar is asked for
    calendar_start: str = "2021-06-01"
    calendar_days: int = 30
    calendar_covers_data: bool = True
    # activity window (inclusive)
    window_start: str = "2021-06-01"
    window_end: str = "2021-06-14"
    # registration on/before this day -> 'Veteran'
    tenure_cutoff: str = "2021-06-07"
    # lower bounds for plausible dates
    driver_date_floor: str = "2009-06-01"
    booking_date_floor: str = "2009-01-01"
    offer_date_floor: str = "2009-06-01"
    max_route_distance: int = 500000
    # mean daily abort rate (percent) at/above which a driver is 'High Abort'
    abort_threshold_pct: int = 30
    histogram_bins: int = 20
    # Literal-behaviour switches (see README "Decisions"); False = fixed behaviour.
    # Offers: text 'null' driver id passes the null-driver rule and counts as missing.
    literal_offer_driver_text_null: bool = False
    # SCD2: plain '!=' on tracked columns (misses NULL<->value) and no marketing carried.
    literal_scd2_compare: bool = False
    # Fixed 30-day calendar inside 2020-2030; tenure and population use its key (NULL before its start).
    literal_calendar_tenure: bool = False
    # Revenue per trip in the KPI summary multiplied by 100.
    literal_revenue_pct: bool = False
    # SCD2 columns whose change opens a new version.
    scd2_tracked: tuple = field(default=("driver_rating", "country_code", "receive_marketing"))

    # derived helpers -------------------------------------------------------
    @property
    def window_start_key(self) -> int:
        return date_key(_d(self.window_start))

    @property
    def window_end_key(self) -> int:
        return date_key(_d(self.window_end))

    @property
    def tenure_cutoff_key(self) -> int:
        return date_key(_d(self.tenure_cutoff))

    @property
    def calendar_end(self) -> str:
        return (_d(self.calendar_start) + _dt.timedelta(days=self.calendar_days - 1)).isoformat()

    @property
    def window_days(self) -> int:
        return (_d(self.window_end) - _d(self.window_start)).days + 1

    def window_day_keys(self) -> list[int]:
        """Keys of the window's days; the literal calendar has only its own days in 2020-2030."""
        lo, hi = _d(self.window_start), _d(self.window_end)
        if self.literal_calendar_tenure:
            lo = max(lo, _d(self.calendar_start), _d("2020-01-01"))
            hi = min(hi, _d(self.calendar_end), _d("2030-12-31"))
        n = (hi - lo).days + 1
        return [date_key(lo + _dt.timedelta(days=i)) for i in range(max(n, 0))]

    @property
    def extends_calendar(self) -> bool:
        return self.calendar_covers_data and not self.literal_calendar_tenure

    def with_calendar(self) -> "EngagementConfig":
        """Config whose calendar spans every date that can be valid, and the window (a few thousand days)."""
        if not self.extends_calendar:
            return self
        start = min(map(_d, (self.calendar_start, self.window_start, self.driver_date_floor,
                             self.booking_date_floor, self.offer_date_floor)))
        end = max(map(_d, (self.calendar_end, self.window_end, self.as_of[:10])))
        return replace(self, calendar_start=start.isoformat(), calendar_days=(end - start).days + 1,
                       calendar_covers_data=False)

    def with_(self, **kw) -> "EngagementConfig":
        return replace(self, **kw)


DEFAULT = EngagementConfig()

# Second driver batch used by the SCD2 queries (see FIXTURES.md section 6).
BATCH2_LOAD_TZ = "2026-06-02 00:00:00"
BATCH2_AS_OF = "2026-06-02 00:00:00"
# Third driver batch (FIXTURES.md section 8), pending together with the second in ``incremental_dimension``.
BATCH3_LOAD_TZ = "2026-06-03 00:00:00"
BATCH3_AS_OF = "2026-06-03 00:00:00"


def wide(days: int = 365) -> EngagementConfig:
    """Config with a long window and a calendar that covers it (benchmarks)."""
    start = _d(DEFAULT.window_start)
    end = start + _dt.timedelta(days=days - 1)
    return DEFAULT.with_(window_end=end.isoformat(), calendar_days=max(DEFAULT.calendar_days, days))
